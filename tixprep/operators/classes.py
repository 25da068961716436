"""Class tables and everything derived from them: counts, rare/minority sets, merging, weights.

A class table is a small ``DataFrame(label, n)`` built by a partial+final hash aggregate that
reads only the label column, so a hot label costs one map-side counter, not one hot task.
Class tables go back to rows by joins; AQE broadcasts them when their measured size is below
the broadcast threshold and falls back to a (skew-split) sort-merge join otherwise. Scalars over a
class table (max, total) are scalar subqueries (``DataFrame.scalar``), never driver loops.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tixprep import schema as S
from tixprep.functions.math import percent_round
from tixprep.session import dimension, label_table


def class_counts(df: DataFrame, col: str, keep_null: bool = False) -> DataFrame:
    """(col, n): rows per class; the null class is dropped unless ``keep_null``."""
    src = df.select(col)
    if not keep_null:
        src = src.filter(F.col(col).isNotNull())
    return src.groupBy(col).agg(F.count(F.lit(1)).alias("n"))


def value_counts(df: DataFrame, col: str, k: int | None = None, keep_null: bool = False) -> DataFrame:
    """(value, n) sorted by n desc then value; top ``k`` when given."""
    out = class_counts(df, col, keep_null).select(F.col(col).alias("value"), "n")
    out = out.orderBy(F.desc("n"), F.asc_nulls_first("value"))
    return out.limit(k) if k else out


def scalar_of(df: DataFrame, expr) -> object:
    """A one-value aggregate as a scalar-subquery Column."""
    return df.select(expr).scalar()


def over_all(expr):
    """Aggregate over the whole (small) class table as a window: keeps multi-pass class
    computations in one plan instead of one job per scalar. Class tables only — never rows."""
    return expr.over(Window.partitionBy(F.lit(0)))


def class_distribution(df: DataFrame, col: str) -> DataFrame:
    """(value, n, percentage of all rows, n_classes)."""
    cc = class_counts(df, col)
    total = scalar_of(df, F.count(F.lit(1)))
    k = scalar_of(cc, F.count(F.lit(1)))
    return cc.select(
        F.col(col).alias("value"), "n",
        (F.col("n") / total * 100.0).alias("percentage"),
        k.alias("n_classes"),
    )


def imbalance_ratio(df: DataFrame, col: str) -> DataFrame:
    cc = class_counts(df, col)
    return cc.agg((F.max("n") / F.min("n")).alias("imbalance_ratio"))


def merge_rare_classes(df: DataFrame, col: str, min_count: int = S.MIN_SAMPLES, merged: str = S.OTHER) -> DataFrame:
    """Classes with fewer than ``min_count`` rows become ``merged`` (an existing one absorbs them)."""
    rare = dimension(class_counts(df, col).filter(F.col("n") < min_count).select(col, F.lit(True).alias("_rare")))
    return (
        df.join(rare, on=col, how="left")
        .withColumn(col, F.when(F.col("_rare"), F.lit(merged)).otherwise(F.col(col)))
        .drop("_rare")
        .select(*df.columns)
    )


def merge_map(triples: DataFrame, targets: Sequence[str] = S.TARGETS, min_count: int = S.MIN_SAMPLES,
              merged: str = S.OTHER) -> DataFrame:
    """(targets..., m_targets...): each target's class merged to ``merged`` when its total < min. A
    null label stays null."""
    out = triples
    for t in targets:
        tot = F.sum("n").over(Window.partitionBy(t))
        out = out.withColumn("m_" + t, F.when(F.col(t).isNotNull() & (tot < min_count), F.lit(merged)).otherwise(F.col(t)))
    return out


def merge_rare_targets(df: DataFrame, targets: Sequence[str] = S.TARGETS, min_count: int = S.MIN_SAMPLES,
                       merged: str = S.OTHER, counted: DataFrame | None = None) -> DataFrame:
    """Rare classes of all targets merged at once: one label-only aggregate, one null-safe join of the
    small combination table. Same result as ``merge_rare_classes`` target by target. ``counted`` holds the
    labels of the rows, where they are written already."""
    combos = merge_map(triple_counts(df if counted is None else counted, targets), targets, min_count, merged)
    changed = F.lit(False)
    for t in targets:
        changed = changed | ~F.col("m_" + t).eqNullSafe(F.col(t))
    names = [F.col(t).alias(f"_t{i}") for i, t in enumerate(targets)] + [F.col("m_" + t).alias(f"_m{i}") for i, t in enumerate(targets)]
    m = label_table(combos.filter(changed).select(*names, F.lit(True).alias("_hit")))
    on = F.lit(True)
    for i, t in enumerate(targets):
        on = on & F.col(t).eqNullSafe(F.col(f"_t{i}"))
    j = df.join(m, on, "left")
    new = {t: F.when(F.col("_hit"), F.col(f"_m{i}")).otherwise(F.col(t)).alias(t) for i, t in enumerate(targets)}
    return j.select(*[new.get(c, F.col(c)) for c in df.columns])


def rare_class_set(df: DataFrame, col: str, min_count: int = S.MIN_SAMPLES) -> DataFrame:
    return class_counts(df, col).filter(F.col("n") < min_count)


def minority_class_set(df: DataFrame, col: str, factor: float = S.THRESHOLD_FACTOR, exclude: str = S.OTHER) -> DataFrame:
    """Classes with n < factor * max_n, excluding the merged class."""
    cc = class_counts(df, col)
    mx = scalar_of(cc, F.max("n"))
    return cc.filter((F.col("n") < mx * factor) & (F.col(col) != exclude))


def class_weights_inverse(df: DataFrame, col: str) -> DataFrame:
    """total / (k * n), divided by its minimum."""
    cc = class_counts(df, col)
    total = scalar_of(df, F.count(F.lit(1)))
    k = scalar_of(cc, F.count(F.lit(1)))
    raw = cc.withColumn("w", total / (k * F.col("n")))
    mn = scalar_of(raw, F.min("w"))
    return raw.select(F.col(col).alias("value"), "n", (F.col("w") / mn).alias("class_weight"))


def weight_summary(df: DataFrame, col: str) -> DataFrame:
    w = class_weights_inverse(df, col)
    return w.agg(
        F.min("class_weight").alias("min_weight"),
        F.max("class_weight").alias("max_weight"),
        F.avg("class_weight").alias("mean_weight"),
    )


def rare_and_dominant(df: DataFrame, col: str, threshold_rare: float = 0.001, threshold_dominant: float = 0.1) -> DataFrame:
    """Rounded percentage (2 places, half-even) compared with the raw thresholds, as the notebook does:
    rare means percentage < threshold_rare (a fraction compared with a percent), dominant means
    percentage > threshold_dominant * 100."""
    cc = class_counts(df, col)
    total = scalar_of(df, F.count(F.lit(1)))
    pct = percent_round(F.col("n"), total, 2)
    return cc.select(
        F.col(col).alias("value"), "n", pct.alias("percentage"),
        (pct < threshold_rare).alias("is_rare"),
        (pct > threshold_dominant * 100).alias("is_dominant"),
    )


def sampling_strategy(df: DataFrame, col: str, min_samples: int = S.MIN_SAMPLES) -> DataFrame:
    """Target sizes: skip n < min_samples; when n < 0.1*max: int(min(0.5*max, 3n))."""
    cc = class_counts(df, col)
    mx = scalar_of(cc, F.max("n"))
    return cc.filter((F.col("n") >= min_samples) & (F.col("n") < mx * 0.1)).select(
        F.col(col).alias("value"), "n",
        F.floor(F.least(mx * 0.5, F.col("n") * 3.0)).cast("bigint").alias("target_n"),
    )


def sampling_warnings(df: DataFrame, col: str, min_samples: int = S.MIN_SAMPLES) -> DataFrame:
    return class_counts(df, col).filter(F.col("n") < min_samples).select(F.col(col).alias("value"), "n")


def cumulative_coverage(df: DataFrame, col: str, coverage: float = 80.0) -> DataFrame:
    """Running share of all rows by class rank; flags the classes needed to reach ``coverage`` %.

    The window has no partition, which is acceptable only because it runs on the class table."""
    cc = class_counts(df, col)
    total = scalar_of(df, F.count(F.lit(1)))
    w = Window.orderBy(F.desc("n"), F.asc(col)).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = cc.select(
        F.col(col).alias("value"), "n",
        F.row_number().over(Window.orderBy(F.desc("n"), F.asc(col))).alias("class_rank"),
        F.sum("n").over(w).alias("cum_n"),
    )
    out = out.withColumn("cum_pct", F.col("cum_n") / total * 100.0)
    return out.withColumn("needed", (F.col("cum_pct") - F.col("n") / total * 100.0) < coverage)


# --- sample weights ------------------------------------------------------------------------

def triple_counts(df: DataFrame, targets: Sequence[str] = S.TARGETS, weight_col: str | None = None) -> DataFrame:
    """(cat, sub, grp, n): label-only aggregate shared by every per-target statistic."""
    n = F.count(F.lit(1)) if weight_col is None else F.sum(weight_col)
    return df.groupBy(*targets).agg(n.cast("bigint").alias("n"))


def level_weight_tables(triples: DataFrame, targets: Sequence[str] = S.TARGETS) -> dict[str, DataFrame]:
    """Per target: (label, n, level_weight) with level_weight = sqrt(1/n) / min(sqrt(1/n))."""
    out = {}
    for t in targets:
        cc = triples.groupBy(t).agg(F.sum("n").alias("n"))
        mx = over_all(F.max("n"))
        out[t] = cc.withColumn("level_weight", F.sqrt(F.lit(1.0) / F.col("n")) / F.sqrt(F.lit(1.0) / mx))
    return out


def with_level_weights(triples: DataFrame, targets: Sequence[str] = S.TARGETS) -> DataFrame:
    """Adds ``_w0.._w2`` to the triple table using windows only (no self-joins, linear plan):
    class total = sum(n) over (partition by label), and its maximum over the whole table."""
    t = triples
    for i, tg in enumerate(targets):
        nt = F.sum("n").over(Window.partitionBy(tg))
        t = t.withColumn(f"_n{i}", nt)
        t = t.withColumn(f"_w{i}", F.sqrt(F.lit(1.0) / F.col(f"_n{i}")) / F.sqrt(F.lit(1.0) / over_all(F.max(f"_n{i}"))))
    return t.drop(*[f"_n{i}" for i in range(len(targets))])


def triple_weights(triples: DataFrame, targets: Sequence[str] = S.TARGETS, max_weight: float = S.MAX_WEIGHT) -> DataFrame:
    """(cat, sub, grp, sample_weight): geometric mean of the three level weights, clipped to [1, max]."""
    t = with_level_weights(triples, targets)
    g = F.pow(F.col("_w0") * F.col("_w1") * F.col("_w2"), F.lit(1.0 / 3.0))
    return t.select(*targets, F.least(F.lit(max_weight), F.greatest(F.lit(1.0), g)).alias("sample_weight"))


def sample_weights(df: DataFrame, targets: Sequence[str] = S.TARGETS, max_weight: float = S.MAX_WEIGHT,
                   out: str = "sample_weight") -> DataFrame:
    """Per-row weight from the three class frequencies (one join on the label triple)."""
    tw = dimension(triple_weights(triple_counts(df, targets), targets, max_weight).withColumnRenamed("sample_weight", out))
    return df.join(tw, on=list(targets), how="left").select(*df.columns, out)


def level_weights(df: DataFrame, targets: Sequence[str] = S.TARGETS) -> DataFrame:
    """(target, value, n, level_weight): the weight of every class of every target, long form."""
    lv = level_weight_tables(triple_counts(df, targets), targets)
    levels = None
    for t in targets:
        part = lv[t].select(F.lit(t).alias("target"), F.col(t).alias("value"), "n", "level_weight")
        levels = part if levels is None else levels.unionByName(part)
    return levels


def hierarchical_weights(df: DataFrame, targets: Sequence[str] = S.TARGETS, max_weight: float = S.MAX_WEIGHT):
    """(rows with sample_weight, long level-weight table (target, value, n, level_weight))."""
    return sample_weights(df, targets, max_weight), level_weights(df, targets)


def weight_lookup(df: DataFrame, weights: DataFrame, col: str, value_col: str = "value",
                  weight_col: str = "class_weight", default: float | None = 1.0, out: str = "weight") -> DataFrame:
    """Row -> class weight; a class missing from the table gets ``default``."""
    w = dimension(weights.select(F.col(value_col).alias(col), F.col(weight_col).alias("_w")))
    j = df.join(w, on=col, how="left")
    val = F.col("_w") if default is None else F.coalesce(F.col("_w"), F.lit(default))
    return j.withColumn(out, val).drop("_w")
