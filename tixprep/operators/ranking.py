"""Exact global row numbers without a single-partition window.

``global_rank`` numbers rows in a total order. The caller names bucket columns that are a prefix
of the order (so each bucket is a contiguous run of it); rows are numbered inside each bucket by a
window partitioned by the bucket, and a small bucket table supplies each bucket's offset. Work per
task is bounded by the bucket size, not by the table size.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tixprep.session import cut_lineage


def global_rank(df: DataFrame, bucket_cols: Sequence[str], order_cols: Sequence[Column],
                partition_cols: Sequence[str] = (), out: str = "_rank") -> DataFrame:
    """1-based row number in ``order`` within ``partition_cols`` (exact, distributed).

    ``bucket_cols`` must be non-decreasing along ``order_cols`` (for instance a coarse prefix of
    the first sort key)."""
    part, buck = list(partition_cols), list(bucket_cols)
    keys = part + buck
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_bn"))
    w_off = (Window.partitionBy(*part) if part else Window.partitionBy(F.lit(0))).orderBy(*buck) \
        .rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.withColumn("_off", F.coalesce(F.sum("_bn").over(w_off), F.lit(0))).drop("_bn")
    local = F.row_number().over(Window.partitionBy(*keys).orderBy(*order_cols))
    ranked = df.withColumn("_local", local)
    return ranked.join(offsets, on=keys, how="left").withColumn(out, F.col("_off") + F.col("_local")) \
        .drop("_off", "_local")


def range_rank(df: DataFrame, order_cols: Sequence[Column], out: str = "_rank") -> DataFrame:
    """1-based row number in a total order of any keys, narrow, wide or hash-like.

    Rows are range-partitioned (bounds from Spark's sample only steer the balance), written once
    with their partition number, numbered inside it, and offset by the sizes of the partitions
    before: one row per partition, however large the table."""
    n = max(2, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    dealt = cut_lineage(df.repartitionByRange(n, *order_cols).withColumn("_range", F.spark_partition_id()))
    return global_rank(dealt, ["_range"], order_cols, out=out).drop("_range")
