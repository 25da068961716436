"""Label hierarchy: parent/child contingency, label combinations and their threshold reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tixprep import schema as S
from tixprep.functions.math import percent_round
from tixprep.operators.profile import describe_column
from tixprep.session import dimension


def _nn(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    cond = F.lit(True)
    for c in cols:
        cond = cond & F.col(c).isNotNull()
    return df.filter(cond)


def contingency_table(df: DataFrame, parent: str, child: str) -> DataFrame:
    """Long form (parent, child, n) of the observed pairs."""
    return _nn(df, [parent, child]).groupBy(parent, child).agg(F.count(F.lit(1)).alias("n"))


def zero_filled_combos(df: DataFrame, cols: Sequence[str], levels: dict[str, Sequence[str]] | None = None) -> DataFrame:
    """Combinations of ``cols`` with their row counts: the observed ones, or, given the ``levels`` of
    every column, each combination of these levels (0 when unseen). The full product is only made
    of the caller's own lists, never of what the data holds."""
    cols = list(cols)
    counts = _nn(df, cols).groupBy(*cols).agg(F.count(F.lit(1)).alias("n"))
    if levels is None:
        return counts
    combos = df.sparkSession.range(1).select()
    for c in cols:
        combos = combos.withColumn(c, F.explode(F.array(*[F.lit(v) for v in levels[c]])))
    return combos.join(counts, on=cols, how="left").withColumn("n", F.coalesce("n", F.lit(0)).cast("bigint"))


def children_per_parent(df: DataFrame, parent: str, child: str) -> DataFrame:
    """(parent, n_children): distinct observed children per parent."""
    return _nn(df, [parent, child]).groupBy(parent).agg(F.count_distinct(child).alias("n_children"))


def children_per_parent_describe(df: DataFrame, parent: str, child: str) -> DataFrame:
    return describe_column(children_per_parent(df, parent, child), "n_children")


def conditional_stats(df: DataFrame, parent: str, child: str) -> DataFrame:
    """Unique parents, unique children and mean distinct children per parent, one row."""
    cpp = children_per_parent(df, parent, child)
    return df.agg(
        F.count_distinct(parent).alias("n_parents"),
        F.count_distinct(child).alias("n_children"),
    ).withColumn("mean_children_per_parent", cpp.select(F.avg("n_children")).scalar())


def top_pairs(df: DataFrame, parent: str, child: str, k: int = 5) -> DataFrame:
    return contingency_table(df, parent, child).orderBy(F.desc("n"), parent, child).limit(k)


def combo_counts(df: DataFrame, cols: Sequence[str] = S.TARGETS, digits: int = 4) -> DataFrame:
    """(cols..., n, percentage of all rows rounded half-even to ``digits``)."""
    total = df.select(F.count(F.lit(1))).scalar()
    c = df.groupBy(*cols).agg(F.count(F.lit(1)).alias("n"))
    return c.withColumn("percentage", percent_round(F.col("n"), total, digits))


PCT_THRESHOLDS = [0.01, 0.05, 0.1, 0.5]  # percent of all rows
COUNT_THRESHOLDS = [5, 10, 20, 50]       # rows


def combo_threshold_report(df: DataFrame, cols: Sequence[str] = S.TARGETS) -> DataFrame:
    """For each threshold: combinations below it, their share of all combinations, rows affected
    and their share of all rows. One conditional aggregate over the combination table, then an
    unpivot (no join with a threshold table)."""
    cc = combo_counts(df, cols)
    aggs = [F.count(F.lit(1)).alias("n_combos"), F.sum("n").alias("n_rows")]
    specs = [("percentage", t) for t in PCT_THRESHOLDS] + [("count", t) for t in COUNT_THRESHOLDS]
    for i, (kind, t) in enumerate(specs):
        below = (F.col("percentage") < t) if kind == "percentage" else (F.col("n") < t)
        aggs += [F.count(F.when(below, 1)).alias(f"c{i}"), F.coalesce(F.sum(F.when(below, F.col("n"))), F.lit(0)).alias(f"r{i}")]
    wide = cc.agg(*aggs)
    rows = [F.struct(F.lit(kind).alias("kind"), F.lit(float(t)).alias("threshold"),
                     F.col(f"c{i}").alias("combos_below"), F.col(f"r{i}").alias("rows_affected"))
            for i, (kind, t) in enumerate(specs)]
    long = wide.select("n_combos", "n_rows", F.explode(F.array(*rows)).alias("r")).select("n_combos", "n_rows", "r.*")
    return long.select(
        "kind", "threshold", F.col("combos_below").cast("bigint").alias("combos_below"),
        (F.col("combos_below") / F.col("n_combos") * 100.0).alias("combos_pct"),
        F.col("rows_affected").cast("bigint").alias("rows_affected"),
        (F.col("rows_affected") / F.col("n_rows") * 100.0).alias("rows_pct"))


def top_bottom_combos(df: DataFrame, cols: Sequence[str] = S.TARGETS, k: int = 10) -> DataFrame:
    """k most and k least common combinations (ties ordered by the labels)."""
    c = df.groupBy(*cols).agg(F.count(F.lit(1)).alias("n"))
    top = c.orderBy(F.desc("n"), *[F.asc(x) for x in cols]).limit(k).withColumn("end", F.lit("top"))
    bottom = c.orderBy(F.asc("n"), *[F.desc(x) for x in cols]).limit(k).withColumn("end", F.lit("bottom"))
    return top.unionByName(bottom)


def filter_rare_combos(df: DataFrame, cols: Sequence[str] = S.TARGETS, min_rows: int = 5) -> DataFrame:
    """Keep rows whose combination has at least ``min_rows`` rows (left-semi join)."""
    valid = df.groupBy(*cols).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= min_rows).select(*cols)
    return semi_join_combos(df, valid, cols)


def semi_join_combos(df: DataFrame, valid: DataFrame, cols: Sequence[str] = S.TARGETS) -> DataFrame:
    """Rows whose combination is listed. The list is written first: its real size decides whether it is
    broadcast, and then no row moves."""
    return df.join(dimension(valid.select(*cols)), on=list(cols), how="left_semi")


def distinct_labels(df: DataFrame, cols: Sequence[str] = S.TARGETS) -> DataFrame:
    return _nn(df, cols).select(*cols).distinct()
