"""Stateless preparation on a streaming frame.

The reference has no streaming input; the cleaning, default-filling and field-combining operators are
pure column expressions, so they apply unchanged to a Structured Streaming frame (no state, no watermark).
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from tixprep import schema as S
from tixprep.operators.fields import clean_columns, combine_text7_clean, fill_defaults


def prepare_stream(stream: DataFrame, serving: bool = True) -> DataFrame:
    """Fill and clean the text fields and build the combined text of each arriving ticket."""
    d = fill_defaults(stream, "main")
    if serving:
        return combine_text7_clean(d)
    from tixprep.operators.fields import combine_text7
    return combine_text7(clean_columns(d, S.TEXT_FIELDS, "basic"))
