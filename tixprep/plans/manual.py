"""Manual bundle: strict cleaning, manual defaults, combinations with enough rows, 7-field text,
hierarchical weights, codes; three tables (samples, dictionary, level weights)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tixprep import schema as S
from tixprep.operators import classes as C
from tixprep.operators import fields as FL
from tixprep.operators.encode import encode_labels, label_dictionary
from tixprep.operators.hierarchy import filter_rare_combos
from tixprep.session import cut_lineage
from tixprep.sources.io import sink_bundle


def prepare_manual_set(tickets: DataFrame, min_rows: int = 5) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(samples, dictionary, level_weights)."""
    d = FL.clean_columns(FL.fill_defaults(tickets, "manual"), S.TEXT_FIELDS, "strict")
    d = FL.combine_text7(FL.drop_missing_targets(d))
    d = cut_lineage(filter_rare_combos(d.select(S.NUMBER, "combined_text", *S.TARGETS), S.TARGETS, min_rows))
    weighted, levels = C.hierarchical_weights(d)
    dictionary = label_dictionary(d)
    cols = [F.col(S.NUMBER).alias("src_id"), F.col("combined_text").alias("text"), *S.TARGETS, *[t + "_code" for t in S.TARGETS], "sample_weight"]
    return encode_labels(weighted, dictionary).select(*cols), dictionary, levels


def write_manual_bundle(tickets: DataFrame, path: str) -> str:
    samples, dictionary, levels = prepare_manual_set(tickets)
    return sink_bundle(samples, dictionary, levels, path)
