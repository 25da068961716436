"""Seeded, partition-independent randomness.

``uniform(seed, key, tag)`` is a deterministic number in [0, 1) derived from the md5 of the
seed, a row key and a tag. Unlike ``rand()`` it is the same after a retry, a repartition or on
another engine, which makes random operators reproducible and checkable.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

TWO32 = 4294967296.0


def _c(x) -> Column:
    return x if isinstance(x, Column) else F.lit(x)


def hash32(*parts) -> Column:
    """Unsigned 32-bit integer from md5(concat_ws('|', parts))."""
    h = F.md5(F.concat_ws("|", *[_c(p).cast("string") for p in parts]))
    return F.conv(F.substring(h, 1, 8), 16, 10).cast("bigint")


def uniform(seed, key, tag="") -> Column:
    """Seeded uniform in [0, 1)."""
    return hash32(seed, key, tag) / F.lit(TWO32)


def hash60(*parts) -> Column:
    """60-bit integer from md5(concat_ws('|', parts)): fine enough to reach any row of any table."""
    h = F.md5(F.concat_ws("|", *[_c(p).cast("string") for p in parts]))
    return F.conv(F.substring(h, 1, 15), 16, 10).cast("bigint")
