"""All combinations of the columns' own levels, the unseen ones included, without making the product.

A combination is a number in mixed radix: the rank of each label among its column's sorted levels is
a digit, the first column the highest. Seen combinations are ranked by joins with the level tables;
how many are unseen follows from the sizes; single unseen ones are found as gaps between seen
numbers and turned back into labels digit by digit. Numbers are decimals, so the product may
exceed 64 bits. Only ``full_combos`` makes all rows, as that is its result."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tixprep import schema as S
from tixprep.functions.math import percent_round
from tixprep.operators.classes import class_counts
from tixprep.operators.hierarchy import COUNT_THRESHOLDS, PCT_THRESHOLDS, _nn
from tixprep.operators.ranking import range_rank
from tixprep.session import cut_lineage, dimension

_NUMBER = "decimal(38,0)"
_FREE = "_product_number"


def level_tables(df: DataFrame, cols: Sequence[str] = S.TARGETS) -> tuple[list[DataFrame], list[int]]:
    """(label, digit) of every column, 0-based in label order, and the number of its levels. Null is no level."""
    tables = [range_rank(class_counts(df, c).select(F.col(c).cast("string").alias("label")), [F.col("label")], out="digit")
              .select("label", (F.col("digit") - 1).alias("digit")) for c in cols]
    tables = [dimension(t) for t in tables]
    return tables, [t.count() for t in tables]


def _places(sizes: Sequence[int]) -> list[int]:
    """Weight of every digit."""
    out = [1]
    for n in reversed(sizes[1:]):
        out.insert(0, out[0] * n)
    return out


def product_size(sizes: Sequence[int]) -> int:
    total = 1
    for n in sizes:
        total *= n
    if total >= 10 ** 36:
        raise ValueError(f"{total} combinations do not fit a number of 36 digits")
    return total


def ranked_combos(df: DataFrame, cols: Sequence[str], tables: Sequence[DataFrame], sizes: Sequence[int]) -> DataFrame:
    """Seen combinations with their row count ``n`` and number."""
    out = _nn(df, cols).groupBy(*cols).agg(F.count(F.lit(1)).alias("n")).withColumn(_FREE, F.lit(0).cast(_NUMBER))
    for c, t, place in zip(cols, tables, _places(sizes), strict=True):
        digit = t.select(F.col("label").alias("_label"), F.col("digit").alias("_digit"))
        out = out.join(digit, F.col(c).cast("string") == F.col("_label")).withColumn(
            _FREE, (F.col(_FREE) + F.col("_digit").cast(_NUMBER) * F.lit(str(place)).cast(_NUMBER)).cast(_NUMBER)).drop("_label", "_digit")
    return out.withColumnRenamed(_FREE, "number")


def unranked(numbers: DataFrame, cols: Sequence[str], tables: Sequence[DataFrame], sizes: Sequence[int]) -> DataFrame:
    """The labels of every ``number``; other columns stay."""
    out = numbers
    for c, t, n, place in zip(cols, tables, sizes, _places(sizes), strict=True):
        # an exact quotient: the rest is taken off first, so no rounding can carry
        whole = (F.col("number") - F.col("number") % F.lit(str(place)).cast(_NUMBER)).cast(_NUMBER)
        digit = (whole / F.lit(str(place)).cast(_NUMBER)).cast(_NUMBER) % F.lit(str(n)).cast(_NUMBER)
        out = out.withColumn("_digit", digit.cast("long")).join(t.select(F.col("label").alias(c), F.col("digit").alias("_digit")), "_digit").drop("_digit")
    return out


def unseen_combos(df: DataFrame, cols: Sequence[str] = S.TARGETS, k: int = 10, last: bool = True) -> DataFrame:
    """The ``k`` last (or first) unseen combinations in label order, with ``n`` = 0.

    A number before (after) a seen one that is itself unseen ends a gap; the ``k`` outermost gaps hold the
    ``k`` outermost unseen numbers, at most ``k`` steps from their ends."""
    tables, sizes = level_tables(df, cols)
    return _unseen(ranked_combos(df, cols, tables, sizes), cols, tables, sizes, k, last)


def _unseen(seen: DataFrame, cols: Sequence[str], tables: Sequence[DataFrame], sizes: Sequence[int], k: int, last: bool) -> DataFrame:
    size = product_size(sizes)
    step = -1 if last else 1
    numbers = dimension(seen.select("number"))
    inside = (F.col("number") >= 0) & (F.col("number") < F.lit(str(size)).cast(_NUMBER))

    def free(df: DataFrame) -> DataFrame:
        return df.filter(inside).join(numbers, "number", "left_anti")
    outer = numbers.sparkSession.range(1).select(F.lit(str(size - 1 if last else 0)).cast(_NUMBER).alias("number"))
    order = F.col("number").desc() if last else F.col("number").asc()
    ends = free(numbers.select((F.col("number") + step).cast(_NUMBER).alias("number")).unionByName(outer)).distinct().orderBy(order).limit(k)
    near = ends.withColumn("_step", F.explode(F.sequence(F.lit(0), F.lit(k - 1)))).select((F.col("number") + step * F.col("_step")).cast(_NUMBER).alias("number"))
    found = free(near.distinct()).orderBy(order).limit(k)
    return unranked(cut_lineage(found), cols, tables, sizes).select(*cols, F.lit(0).cast("bigint").alias("n"))


def full_combos(df: DataFrame, cols: Sequence[str] = S.TARGETS, max_rows: int = 10 ** 9) -> DataFrame:
    """Every combination of the columns' levels with its row count, 0 for unseen ones. The result is the
    product of the levels; beyond ``max_rows`` it is refused (``unseen_combos`` and the reports need no product)."""
    tables, sizes = level_tables(df, cols)
    size = product_size(sizes)
    if size > max_rows:
        raise ValueError(f"{size} combinations are more than max_rows = {max_rows}")
    seen = ranked_combos(df, cols, tables, sizes).select("number", "n")
    numbers = df.sparkSession.range(size).select(F.col("id").cast(_NUMBER).alias("number"))
    return unranked(numbers.join(seen, "number", "left"), cols, tables, sizes).select(*cols, F.coalesce("n", F.lit(0)).cast("bigint").alias("n"))


def full_threshold_report(df: DataFrame, cols: Sequence[str] = S.TARGETS) -> DataFrame:
    """``combo_threshold_report`` over all combinations of the columns' levels. Unseen ones have no rows and lie
    below every threshold: they are added to the counts in closed form. Percentages of rows are of all rows,
    those with a null label too."""
    cols = list(cols)
    levels = df.agg(*[F.count_distinct(c).alias(f"l{i}") for i, c in enumerate(cols)], F.count(F.lit(1)).alias("n_rows"))
    counts = _nn(df, cols).groupBy(*cols).agg(F.count(F.lit(1)).alias("n"))
    total = levels.select("n_rows").scalar()
    specs = [("percentage", t) for t in PCT_THRESHOLDS] + [("count", t) for t in COUNT_THRESHOLDS]
    pct = percent_round(F.col("n"), total, 4)
    aggs = [F.count(F.lit(1)).alias("seen")]
    for i, (kind, t) in enumerate(specs):
        below = (pct < t) if kind == "percentage" else (F.col("n") < t)
        aggs += [F.count(F.when(below, 1)).alias(f"c{i}"), F.coalesce(F.sum(F.when(below, F.col("n"))), F.lit(0)).alias(f"r{i}")]
    wide = counts.agg(*aggs)
    product = F.lit(1).cast(_NUMBER)
    for i in range(len(cols)):
        product = (product * levels.select(F.col(f"l{i}").cast("decimal(12,0)")).scalar()).cast(_NUMBER)
    rows = [F.struct(F.lit(kind).alias("kind"), F.lit(float(t)).alias("threshold"), F.col(f"c{i}").alias("c"), F.col(f"r{i}").alias("r")) for i, (kind, t) in enumerate(specs)]
    long = wide.select("seen", product.alias("combos"), F.explode(F.array(*rows)).alias("x")).select("seen", "combos", "x.*")
    below = (F.col("combos") - F.col("seen") + F.col("c")).cast(_NUMBER)
    return long.select("kind", "threshold", F.col("combos").cast("bigint").alias("combos"), below.cast("bigint").alias("combos_below"),
                       F.try_divide(below.cast("double") * 100.0, F.col("combos").cast("double")).alias("combos_pct"), F.col("r").cast("bigint").alias("rows_affected"),
                       F.try_divide(F.col("r") * 100.0, total).alias("rows_pct"))


def full_top_bottom(df: DataFrame, cols: Sequence[str] = S.TARGETS, k: int = 10) -> DataFrame:
    """``top_bottom_combos`` over all combinations of the columns' levels: the bottom are unseen ones (last in
    label order first) as long as there are any."""
    tables, sizes = level_tables(df, cols)
    seen = cut_lineage(ranked_combos(df, cols, tables, sizes))
    both = seen.select(*cols, "n").unionByName(_unseen(seen, cols, tables, sizes, k, True))
    first = seen.select(*cols, "n").unionByName(_unseen(seen, cols, tables, sizes, k, False))
    top = first.orderBy(F.desc("n"), *[F.asc(c) for c in cols]).limit(k).withColumn("end", F.lit("top"))
    bottom = both.orderBy(F.asc("n"), *[F.desc(c) for c in cols]).limit(k).withColumn("end", F.lit("bottom"))
    return top.unionByName(bottom)
