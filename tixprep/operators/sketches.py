"""A table profile that is kept up to date: each part of the input leaves mergeable sketches, and a new part
costs one pass over itself alone.

Per part and column: counts and moments (exact), a quantile sketch of numeric columns, a distinct-count sketch and the
frequent values with a bound on what they may miss. Reading merges the stored rows of all parts; no input is read again."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tixprep.session import cut_lineage

KLL_K = 800        # quantile sketches: rank error about 0.3 %
HLL_LOG_K = 14     # distinct sketches: relative error about 0.8 %
FREQUENT = 200     # values kept a part and column


def _plain(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(cols)])


def add_part(df: DataFrame, folder: str, part: str, cols: Sequence[str] | None = None, frequent: int = FREQUENT) -> None:
    """Writes the sketches of ``df`` as part ``part`` of the profile in ``folder``; a part that is there is replaced."""
    cols = list(cols or df.columns)
    numeric = {c for c in cols if isinstance(df.schema[c].dataType, T.NumericType)}
    d = _plain(df, cols)
    aggs = []
    for i, c in enumerate(cols):
        x = F.col(f"c{i}")
        v = F.nanvl(x.cast("double"), F.lit(None).cast("double")) if c in numeric else F.lit(None).cast("double")
        aggs.append(F.struct(
            F.lit(c).alias("column_name"), F.count(x).alias("n"), F.count(v).alias("n_numbers"), F.coalesce(F.sum(v), F.lit(0.0)).alias("total"),
            F.coalesce(F.avg(v), F.lit(0.0)).alias("mean"), F.coalesce(F.var_pop(v), F.lit(0.0)).alias("variance"), F.min(v).alias("low"), F.max(v).alias("high"),
            (F.kll_sketch_agg_double(v, KLL_K) if c in numeric else F.lit(None).cast("binary")).alias("quantiles"),
            F.hll_sketch_agg(x.cast("string"), HLL_LOG_K).alias("distinct")))
    one = d.agg(F.array(*aggs).alias("a")).select(F.explode("a").alias("r")).select("r.*")
    one.write.mode("overwrite").parquet(f"{folder.rstrip('/')}/columns/part={part}")
    cells = d.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"c{i}").cast("string").alias("value")) for i, c in enumerate(cols)])).alias("x")).select("x.*")
    counts = cells.filter(F.col("value").isNotNull()).groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("n"))
    # the most frequent values by the sum of all values' counts: kept up to the bound, the largest count left out beside them
    ranked = counts.withColumn("k", F.row_number().over(Window.partitionBy("column_name", F.pmod(F.xxhash64("value"), F.lit(64))).orderBy(F.desc("n"), "value"))).filter(F.col("k") <= frequent + 1)
    ranked = ranked.withColumn("k", F.row_number().over(Window.partitionBy("column_name").orderBy(F.desc("n"), "value"))).filter(F.col("k") <= frequent + 1)
    ranked.select("column_name", F.when(F.col("k") <= frequent, F.col("value")).alias("value"), "n").write.mode("overwrite").parquet(f"{folder.rstrip('/')}/values/part={part}")


def profile(spark: SparkSession, folder: str, qs: Sequence[float] = (0.25, 0.5, 0.75)) -> DataFrame:
    """(column_name, n, mean, std, min, q0, q1, ..., max, distinct) of all parts together. Counts, mean, deviation and ends are
    exact; quantiles and distinct counts carry the sketches' errors."""
    d = spark.read.parquet(f"{folder.rstrip('/')}/columns")
    whole = d.groupBy("column_name").agg(F.sum("n").alias("n"), F.sum("n_numbers").alias("k"), F.sum("total").alias("total"), F.min("low").alias("min"), F.max("high").alias("max"),
                                         F.kll_merge_agg_double("quantiles").alias("sketch"), F.hll_sketch_estimate(F.hll_union_agg("distinct")).alias("distinct"))
    mean = F.try_divide("total", "k")
    spread = (d.join(whole.select("column_name", mean.alias("m")), "column_name").groupBy("column_name")
              .agg(F.sum(F.col("n_numbers") * (F.col("variance") + F.pow(F.col("mean") - F.col("m"), F.lit(2)))).alias("squares")))
    return whole.join(spread, "column_name").select(
        "column_name", "n", mean.alias("mean"), F.sqrt(F.try_divide("squares", F.col("k") - 1)).alias("std"), "min",
        *[F.when(F.col("k") > 0, F.kll_sketch_get_quantile_double("sketch", F.lit(float(q)))).alias(f"q{i}") for i, q in enumerate(qs)], "max", "distinct")


def frequent_values(spark: SparkSession, folder: str, k: int = 10) -> DataFrame:
    """(column_name, value, at_least, at_most): the ``k`` values with the largest counts of each column. A part that does not list a value
    may hold it as often as its largest count left out, which is what ``at_most`` adds."""
    d = spark.read.parquet(f"{folder.rstrip('/')}/values")
    left_out = cut_lineage(d.filter("value IS NULL").select("part", "column_name", F.col("n").alias("rest")))
    listed = d.filter("value IS NOT NULL")
    own = listed.join(left_out, ["part", "column_name"], "left").groupBy("column_name", "value").agg(F.sum("n").alias("at_least"), F.sum(F.coalesce("rest", F.lit(0))).alias("known"))
    rest = left_out.groupBy("column_name").agg(F.sum("rest").alias("rest"))
    out = own.join(rest, "column_name", "left").withColumn("at_most", F.col("at_least") + F.coalesce("rest", F.lit(0)) - F.col("known"))
    by = Window.partitionBy("column_name").orderBy(F.desc("at_least"), "value")
    return out.withColumn("_k", F.row_number().over(by)).filter(F.col("_k") <= k).select("column_name", "value", "at_least", "at_most")
