"""Profile report: the profiling steps as one long table (section, item, metric, value): shape and
schema, memory, describe, missing values, texts, value counts and class report of each target, text
lengths, duplicates, correlations, and a seeded sample of rows.

Steps run in the reference order; the length step adds two columns that the duplicate and
correlation steps then see. Each step is one fused aggregate (or one class table per column).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tixprep import schema as S
from tixprep.functions.text import char_length_nan
from tixprep.operators import classes as C
from tixprep.operators import profile as P
from tixprep.operators.sampling import uniform_sample
from tixprep.session import cut_lineage


def _long(df: DataFrame, section: str, item_col, metrics: list[str]) -> DataFrame:
    item = F.lit(item_col) if not isinstance(item_col, str) or item_col not in df.columns else F.col(item_col).cast("string")
    structs = [F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value")) for m in metrics]
    return df.select(F.lit(section).alias("section"), item.alias("item"), F.explode(F.array(*structs)).alias("s")) \
        .select("section", "item", "s.metric", "s.value")


def profile_report(tickets: DataFrame) -> DataFrame:
    df = cut_lineage(tickets)  # read once; every step below scans the snapshot
    parts = [
        _long(P.shape(df), "basic_info", F.lit("table"), ["n_rows", "n_columns"]),
        _long(P.schema_info(df), "basic_info", "column_name", ["non_null"]),
        _long(P.column_bytes(df), "memory", "column_name", ["bytes"]),
        _long(P.describe_numeric(df, snapshot=False), "describe", "column_name",
              ["count", "mean", "std", "min", "p25", "p50", "p75", "max"]),
        _long(P.missing_summary(df), "missing", "column_name", ["missing", "percent"]),
        _long(P.text_exploration(df, [S.DESC, S.SHORT]), "text", "column_name", ["n_null", "n_unique"]),
    ]
    for t in S.TARGETS:
        vc = C.value_counts(df, t, k=20, keep_null=True)
        parts.append(_long(vc.withColumn("value", F.coalesce(F.col("value"), F.lit("NaN"))), f"value_counts:{t}", "value", ["n"]))
        report = C.class_distribution(df, t).agg(F.max("n_classes").alias("n_classes"), F.max("n").alias("largest"), F.min("n").alias("smallest"),
                                                 F.max("percentage").alias("largest_percent"), (F.max("n") / F.min("n")).alias("imbalance_ratio"))
        parts.append(_long(report, "class_report", F.lit(t), ["n_classes", "largest", "smallest", "largest_percent", "imbalance_ratio"]))
    with_len = df.withColumns({f"{c}_length": char_length_nan(c) for c in [S.SHORT, S.DESC]})
    parts.append(_long(P.text_length_stats(df, [S.SHORT, S.DESC]), "text_length", "column_name",
                       ["count", "mean", "std", "min", "p25", "p50", "p75", "max"]))
    parts.append(_long(P.duplicate_rows(with_len), "duplicates", F.lit("table"), ["duplicate_rows"]))
    nums = [f.name for f in with_len.schema.fields if isinstance(f.dataType, T.NumericType)]
    corr = P.correlation_matrix(with_len, nums).select(F.concat_ws(" ~ ", "column_a", "column_b").alias("pair"), "r")
    parts.append(_long(corr, "correlation", "pair", ["r"]))
    parts.append(_long(uniform_sample(with_len, S.NUMBER, 5), "sample", S.NUMBER, nums))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def table_profile(df: DataFrame) -> DataFrame:
    """One-call column profile: type, missing, distinct, most frequent value and its count, the five
    most frequent values (their first 40 characters) with counts, and for numeric columns
    mean/min/max. One row per column."""
    snap = cut_lineage(df)
    miss = P.missing_summary(snap).select("column_name", "missing")
    uniq = P.unique_count(snap, snap.columns).select("column_name", "n_unique")
    info = P.schema_info(snap).select("column_name", "data_type")
    out = info.join(miss, "column_name").join(uniq, "column_name")
    tops = None
    for c in snap.columns:
        five = C.value_counts(snap, c, k=5).select(F.col("value").cast("string").alias("v"), "n", F.struct(-F.col("n"), F.col("value")).alias("o"))
        top = five.agg(F.min_by("v", "o").alias("top_value"), F.max("n").alias("top_count"),
                       F.array_sort(F.collect_list(F.struct("o", "v", "n"))).alias("all"))  # five rows
        top = top.select(F.lit(c).alias("column_name"), "top_value", "top_count", F.array_join(F.transform(
            "all", lambda x: F.concat(F.left(x["v"], F.lit(40)), F.lit("="), x["n"].cast("string"))), "; ").alias("top_values"))
        tops = top if tops is None else tops.unionByName(top)
    nums = [f.name for f in snap.schema.fields if isinstance(f.dataType, T.NumericType)]
    stats = snap.agg(*[F.avg(c).alias(f"a{i}") for i, c in enumerate(nums)], *[F.min(c).cast("double").alias(f"n{i}") for i, c in enumerate(nums)],
                     *[F.max(c).cast("double").alias(f"x{i}") for i, c in enumerate(nums)])
    st = P._unpivot(stats, nums, {"mean": "a", "min": "n", "max": "x"})
    return out.join(tops, "column_name", "left").join(st, "column_name", "left")
