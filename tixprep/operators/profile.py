"""Table profiling: shape, schema, missing values, distinct counts, describe, lengths, word
frequencies, duplicates, correlations, histograms, densities and associations.

Per-column scalars are fused into one aggregate per pass and unpivoted into a long table.
Quantiles are exact without collecting a column into one task, for all columns at once: values are
reduced to (column, value, count) by a partial aggregate (a hot value collapses to one row), range
partitioned (a sample's bounds only steer the balance), and running counts per partition are offset
by a table with one row per column and partition.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tixprep.functions.math import clip
from tixprep.functions.text import char_length_nan, tokenize_words
from tixprep.session import cut_lineage

def _unpivot(df: DataFrame, names: Sequence[str], fields: dict[str, str], name_col: str = "column_name") -> DataFrame:
    """One-row wide aggregate -> one row per column name; ``fields`` maps output field -> prefix."""
    structs = [F.struct(F.lit(n).alias(name_col), *[F.col(f"{p}{i}").alias(f) for f, p in fields.items()])
               for i, n in enumerate(names)]
    return df.select(F.explode(F.array(*structs)).alias("r")).select("r.*")


# --- shape and schema -------------------------------------------------------------------------

def shape(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n_rows")).withColumn("n_columns", F.lit(len(df.columns)))


def schema_info(df: DataFrame) -> DataFrame:
    """(position, column_name, data_type, non_null) — one fused aggregate over all columns."""
    agg = df.agg(*[F.count(F.col(c)).alias(f"nn{i}") for i, c in enumerate(df.columns)])
    out = _unpivot(agg, df.columns, {"non_null": "nn"})
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    pos = {c: i for i, c in enumerate(df.columns)}
    tmap = F.create_map(*[x for c in df.columns for x in (F.lit(c), F.lit(types[c]))])
    pmap = F.create_map(*[x for c in df.columns for x in (F.lit(c), F.lit(pos[c]))])
    return out.select(pmap[F.col("column_name")].alias("position"), "column_name",
                      tmap[F.col("column_name")].alias("data_type"), "non_null")


def _footprint(f: T.StructField) -> Column:
    c = F.col(f.name)
    if isinstance(f.dataType, T.StringType):
        return F.coalesce(F.octet_length(c), F.lit(0))
    width = {T.LongType: 8, T.DoubleType: 8, T.IntegerType: 4, T.FloatType: 4, T.BooleanType: 1,
             T.TimestampType: 8, T.TimestampNTZType: 8, T.DateType: 4, T.ShortType: 2, T.ByteType: 1}
    w = next((v for k, v in width.items() if isinstance(f.dataType, k)), 8)
    return F.when(c.isNull(), F.lit(0)).otherwise(F.lit(w))


def column_bytes(df: DataFrame) -> DataFrame:
    """Encoded footprint per column (UTF-8 bytes of strings, fixed width otherwise), largest first,
    with the total in MB on every row."""
    agg = df.agg(*[F.sum(_footprint(f)).cast("bigint").alias(f"b{i}") for i, f in enumerate(df.schema.fields)])
    out = _unpivot(agg, df.columns, {"bytes": "b"})
    total = F.sum("bytes").over(Window.partitionBy(F.lit(0)))  # over the per-column table only
    return out.withColumn("total_mb", total / (1024.0 * 1024.0))


def missing_summary(df: DataFrame, only_missing: bool = False) -> DataFrame:
    """(column_name, missing, percent), sorted by missing desc then name."""
    agg = df.agg(*[F.count_if(F.col(c).isNull()).alias(f"m{i}") for i, c in enumerate(df.columns)],
                 F.count(F.lit(1)).alias("_n"))
    out = _unpivot(agg.select("*", *[F.col("_n").alias(f"t{i}") for i in range(len(df.columns))]),
                   df.columns, {"missing": "m", "_total": "t"})
    out = out.select("column_name", "missing", (F.col("missing") / F.col("_total") * 100.0).alias("percent"))
    if only_missing:
        out = out.filter(F.col("missing") > 0)
    return out.orderBy(F.desc("missing"), "column_name")


def _digest(c: str) -> Column:
    """A value as 16 bytes: what distinct counts shuffle instead of whole texts."""
    return F.unhex(F.md5(F.col(c).cast("string")))


def distinct_values(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(column number, digest, n) of every distinct non-null value: one narrow aggregate for all columns."""
    pairs = [F.when(F.col(c).isNotNull(), F.struct(F.lit(i).alias("i"), _digest(c).alias("d"))) for i, c in enumerate(cols)]
    long = df.select(F.explode(F.array_compact(F.array(*pairs))).alias("p")).select("p.i", "p.d")
    return long.groupBy("i", "d").agg(F.count(F.lit(1)).alias("n"))


def unique_count(df: DataFrame, cols: Sequence[str], approx: bool = False) -> DataFrame:
    """Distinct non-null values per column (exact; ``approx`` uses HyperLogLog++)."""
    if approx:
        return _unpivot(df.agg(*[F.approx_count_distinct(F.col(c)).alias(f"u{i}") for i, c in enumerate(cols)]), cols, {"n_unique": "u"})
    found = distinct_values(df, cols).groupBy("i").agg(F.count(F.lit(1)).alias("n_unique"))
    names = df.sparkSession.createDataFrame([(i, c) for i, c in enumerate(cols)], "i int, column_name string")
    return names.join(found, "i", "left").select("column_name", F.coalesce("n_unique", F.lit(0)).alias("n_unique"))


def unique_count_with_null(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Distinct values per column where null counts as one value."""
    nulls = _unpivot(df.agg(*[F.max(F.col(c).isNull().cast("int")).alias(f"z{i}") for i, c in enumerate(cols)]), cols, {"has_null": "z"})
    return unique_count(df, cols).join(nulls, "column_name").select("column_name", (F.col("n_unique") + F.coalesce("has_null", F.lit(0))).alias("n_unique"))


def text_exploration(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    cols = [c for c in cols if c in df.columns]
    nulls = _unpivot(df.agg(*[F.count_if(F.col(c).isNull()).alias(f"z{i}") for i, c in enumerate(cols)]), cols, {"n_null": "z"})
    return nulls.join(unique_count(df, cols), "column_name")


# --- exact quantiles and describe ----------------------------------------------------------

def _long_values(df: DataFrame, cols: Sequence[str], names: Sequence[str] | None = None) -> DataFrame:
    """(column_name, v): every non-null number of ``cols``."""
    names = names or cols
    cells = [F.when(F.col(c).isNotNull() & ~F.isnan(F.col(c).cast("double")), F.struct(F.lit(n).alias("column_name"), F.col(c).cast("double").alias("v")))
             for c, n in zip(cols, names, strict=True)]
    return df.select(F.explode(F.array_compact(F.array(*cells))).alias("p")).select("p.*")


def quantile_table(long: DataFrame, qs: Sequence[float] = (0.25, 0.5, 0.75)) -> DataFrame:
    """(column_name, q0, q1, ...): exact linear-interpolation quantiles of the values of every column."""
    vc = long.groupBy("column_name", "v").agg(F.count(F.lit(1)).alias("c"))
    n_parts = max(2, int(long.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    dealt = cut_lineage(vc.repartitionByRange(n_parts, "column_name", "v").withColumn("b", F.spark_partition_id()))
    sizes = dealt.groupBy("column_name", "b").agg(F.sum("c").alias("bc"))  # one row per column and partition
    w = Window.partitionBy("column_name")
    offs = sizes.select("column_name", "b", F.sum("bc").over(w).alias("n"), F.coalesce(F.sum("bc").over(
        w.orderBy("b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("off"))
    run = F.coalesce(F.sum("c").over(Window.partitionBy("column_name", "b").orderBy("v").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ranked = dealt.withColumn("before", run).join(offs, ["column_name", "b"]).withColumn("start", F.col("before") + F.col("off"))
    aggs, out = [], []
    for i, q in enumerate(qs):
        pos = (F.col("n") - 1) * float(q)
        for side, r in (("l", F.floor(pos)), ("h", F.ceil(pos))):
            aggs.append(F.max(F.when((F.col("start") <= r) & (r < F.col("start") + F.col("c")), F.col("v"))).alias(f"{side}{i}"))
        out.append((F.col(f"l{i}") + (F.col(f"h{i}") - F.col(f"l{i}")) * (pos - F.floor(pos))).alias(f"q{i}"))
    return ranked.groupBy("column_name").agg(F.max("n").alias("n"), *aggs).select("column_name", *out)


def quantiles(df: DataFrame, col: str, qs: Sequence[float] = (0.25, 0.5, 0.75)) -> DataFrame:
    """(q, value) rows of one column."""
    row = quantile_table(_long_values(df, [col]), qs)
    structs = [F.struct(F.lit(float(q)).alias("q"), F.col(f"q{i}").alias("value")) for i, q in enumerate(qs)]
    return row.select(F.explode(F.array(*structs)).alias("s")).select("s.*")


def _describe(df: DataFrame, cols: Sequence[str], names: Sequence[str] | None = None) -> DataFrame:
    """describe of ``cols`` of a table that is cheap to read twice: one aggregate and one quantile table."""
    names = list(names or cols)
    fns = {"count": F.count, "mean": F.avg, "std": F.stddev_samp, "min": F.min, "max": F.max}
    agg = df.agg(*[(f(c).cast("double") if k in ("min", "max") else f(c)).alias(f"{k}{i}") for k, f in fns.items() for i, c in enumerate(cols)])
    base = _unpivot(agg, names, {k: k for k in fns})
    q = quantile_table(_long_values(df, cols, names))
    return base.join(q, "column_name", "left").select("column_name", "count", "mean", "std", "min", F.col("q0").alias("p25"),
                                                      F.col("q1").alias("p50"), F.col("q2").alias("p75"), "max")


def describe_column(df: DataFrame, col: str, name: str | None = None) -> DataFrame:
    """count, mean, std (ddof 1), min, 25/50/75 %, max of one column, one row."""
    return _describe(cut_lineage(df.select(col)), [col], [name or col])


def describe_numeric(df: DataFrame, cols: Sequence[str] | None = None, snapshot: bool = True) -> DataFrame:
    """describe of every numeric column. The (narrow) numeric projection is written once so that the
    aggregate and the quantile table do not re-run an expensive upstream plan."""
    cols = list(cols) if cols is not None else [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]
    return _describe(cut_lineage(df.select(*cols)) if snapshot else df, cols)


# --- text lengths and words -------------------------------------------------------------------

def text_length_stats(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """describe of ``astype(str).str.len()`` (a missing value is 'nan', 3 characters)."""
    lens = cut_lineage(df.select(*[char_length_nan(c).alias(f"_l{i}") for i, c in enumerate(cols)]))
    return _describe(lens, lens.columns, cols)


def processed_length_stats(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    agg = df.agg(*[F.avg(F.length(c)).alias(f"a{i}") for i, c in enumerate(cols)],
                 *[F.max(F.length(c)).alias(f"x{i}") for i, c in enumerate(cols)])
    return _unpivot(agg, cols, {"mean_chars": "a", "max_chars": "x"})


def token_length_stats(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Mean, max and 95th percentile of word counts of each column (an empty text has 0 words)."""
    w = cut_lineage(df.select(*[F.size(tokenize_words(c)).alias(f"_n{i}") for i, c in enumerate(cols)]))
    agg = w.agg(*[F.avg(x).alias(f"a{i}") for i, x in enumerate(w.columns)], *[F.max(x).alias(f"x{i}") for i, x in enumerate(w.columns)])
    base = _unpivot(agg, cols, {"mean_tokens": "a", "max_tokens": "x"})
    p95 = quantile_table(_long_values(w, w.columns, list(cols)), [0.95])
    return base.join(p95, "column_name").select("column_name", "mean_tokens", "max_tokens", F.col("q0").alias("p95_tokens"))


def word_frequency(df: DataFrame, cols: Sequence[str], k: int = 10) -> DataFrame:
    """Top ``k`` words of each column (ties by word); map-side partial counts keep a frequent word
    cheap, and only each task's best ``k`` reach the final ranking."""
    out = None
    for c in cols:
        words = df.select(F.explode(tokenize_words(c)).alias("word"))
        top = words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "word").limit(k).select(F.lit(c).alias("column_name"), "word", "n")
        out = top if out is None else out.unionByName(top)
    return out


# --- duplicates ------------------------------------------------------------------------------

def duplicate_rows(df: DataFrame) -> DataFrame:
    """Rows equal (null-safe) to an earlier row: sum over identical-row groups of (n - 1).

    A 64-bit row hash finds candidate groups cheaply (only hashes are shuffled); the exact
    comparison of whole rows runs on the candidates alone."""
    cols = df.columns
    h = F.xxhash64(*[F.col(c) for c in cols], *[F.col(c).isNull() for c in cols])
    hashed = df.withColumn("_h", h)
    cand = hashed.groupBy("_h").agg(F.count(F.lit(1)).alias("_hn")).filter(F.col("_hn") > 1).select("_h")
    rows = hashed.join(cand, "_h", "left_semi").drop("_h")
    groups = rows.groupBy(*cols).agg(F.count(F.lit(1)).alias("_n"))
    return groups.agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).cast("bigint").alias("duplicate_rows"))


# --- correlation, histogram, density, associations ---------------------------------------

def correlation_matrix(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Pearson r for every ordered pair over rows where both are present; a constant column gives
    null (``try_divide``; ANSI ``corr`` would raise). Each unordered pair is computed once."""
    aggs, seen = [], {}
    for i, a in enumerate(cols):
        for b in cols[i:]:
            both = F.col(a).isNotNull() & F.col(b).isNotNull()
            x, y = F.when(both, F.col(a).cast("double")), F.when(both, F.col(b).cast("double"))
            seen[a, b] = seen[b, a] = f"r{len(aggs)}"
            aggs.append(F.try_divide(F.covar_samp(x, y), F.stddev_samp(x) * F.stddev_samp(y)).alias(f"r{len(aggs)}"))
    structs = [F.struct(F.lit(a).alias("column_a"), F.lit(b).alias("column_b"), F.col(seen[a, b]).alias("r")) for a in cols for b in cols]
    return df.agg(*aggs).select(F.explode(F.array(*structs)).alias("s")).select("s.*")


def histogram(df: DataFrame, col: str, bins: int = 50, lo: float | None = None, hi: float | None = None) -> DataFrame:
    """(bin, lower, upper, n) equal-width bins over [min, max] (or a clip range), last bin closed,
    empty bins included."""
    v = clip(F.col(col).cast("double"), lo, hi)
    vals = df.select(v.alias("v")).filter(F.col("v").isNotNull())
    rng = vals.agg(F.min("v").alias("lo"), F.max("v").alias("hi"))
    rng = rng.select(F.when(F.col("lo") == F.col("hi"), F.col("lo") - 0.5).otherwise(F.col("lo")).alias("lo"),
                     F.when(F.col("lo") == F.col("hi"), F.col("hi") + 0.5).otherwise(F.col("hi")).alias("hi"))
    lo_c, hi_c = rng.select("lo").scalar(), rng.select("hi").scalar()
    b = F.least(F.lit(bins - 1), F.floor((F.col("v") - lo_c) / (hi_c - lo_c) * bins)).cast("int")
    counts = vals.select(b.alias("bin")).groupBy("bin").agg(F.count(F.lit(1)).alias("n"))
    grid = rng.select(F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"), "lo", "hi")
    step = (F.col("hi") - F.col("lo")) / bins
    return grid.join(counts, "bin", "left").select(
        "bin", (F.col("lo") + step * F.col("bin")).alias("lower"), (F.col("lo") + step * (F.col("bin") + 1)).alias("upper"),
        F.coalesce("n", F.lit(0)).cast("bigint").alias("n"))


def density_curve(df: DataFrame, col: str, gridsize: int = 200, cut: float = 3.0) -> DataFrame:
    """Gaussian kernel density on a grid (Scott's bandwidth), evaluated exactly on the (value,
    count) table: each distinct value contributes count * kernel at every grid point."""
    vals = df.select(F.col(col).cast("double").alias("v")).filter(F.col("v").isNotNull())
    vc = vals.groupBy("v").agg(F.count(F.lit(1)).alias("c"))
    st = vals.agg(F.count(F.lit(1)).alias("n"), F.stddev_samp("v").alias("sd"), F.min("v").alias("lo"), F.max("v").alias("hi")).first()
    if not st["n"] or not st["sd"]:  # no spread, no bandwidth
        return df.sparkSession.createDataFrame([], "point bigint, x double, density double")
    h = st["sd"] * st["n"] ** -0.2
    g0, g1 = st["lo"] - cut * h, st["hi"] + cut * h
    xs = [g0 + (g1 - g0) * i / (gridsize - 1) for i in range(gridsize)]
    # one aggregate with a sum per grid point (``gridsize`` of them), combined before the shuffle
    sums = [F.sum(F.col("c") * F.exp(F.pow((F.lit(x) - F.col("v")) / h, 2) / -2.0)).alias(f"s{i}") for i, x in enumerate(xs)]
    points = [F.struct(F.lit(i).cast("bigint").alias("point"), F.lit(x).alias("x"), F.col(f"s{i}").alias("s")) for i, x in enumerate(xs)]
    dens = vc.agg(*sums).select(F.explode(F.array(*points)).alias("p")).select("p.*")
    return dens.select("point", "x", (F.col("s") / (st["n"] * h * math.sqrt(2 * math.pi))).alias("density"))


def association_matrix(df: DataFrame, numeric: Sequence[str], categorical: Sequence[str]) -> DataFrame:
    """(column_a, column_b, kind, value): Pearson r (numeric-numeric), correlation ratio eta
    (categorical -> numeric) and the uncertainty coefficient U(a|b) (categorical-categorical).

    The needed columns are written once; then one aggregate for all pairs of numbers, one grouped
    aggregate for all (class, number) pairs and one for all pairs of classes."""
    snap = cut_lineage(df.select(*numeric, *categorical))
    parts = [correlation_matrix(snap, numeric).select("column_a", "column_b", F.lit("pearson").alias("kind"), F.col("r").alias("value"))]
    if numeric and categorical:
        cells = [F.when(F.col(c).isNotNull() & F.col(x).isNotNull(), F.struct(
            F.lit(c).alias("column_a"), F.lit(x).alias("column_b"), F.col(c).cast("string").alias("g"), F.col(x).cast("double").alias("x"))) for c in categorical for x in numeric]
        per = snap.select(F.explode(F.array_compact(F.array(*cells))).alias("p")).select("p.*").groupBy("column_a", "column_b", "g").agg(
            F.count(F.lit(1)).alias("n"), F.avg("x").alias("m"), F.var_pop("x").alias("v"))
        mean = F.sum(F.col("n") * F.col("m")) / F.sum("n")
        both = per.groupBy("column_a", "column_b").agg(mean.alias("mean"), F.sum(F.col("n") * F.col("v")).alias("within"))
        between = per.join(both, ["column_a", "column_b"]).groupBy("column_a", "column_b", "within").agg(
            F.sum(F.col("n") * F.pow(F.col("m") - F.col("mean"), 2)).alias("between"))
        parts.append(between.select("column_a", "column_b", F.lit("eta").alias("kind"),
                                    F.sqrt(F.try_divide(F.col("between"), F.col("between") + F.col("within"))).alias("value")))
    if len(categorical) > 1:
        cells = [F.when(F.col(a).isNotNull() & F.col(b).isNotNull(), F.struct(
            F.lit(a).alias("column_a"), F.lit(b).alias("column_b"), F.col(a).cast("string").alias("a"), F.col(b).cast("string").alias("b")))
            for i, a in enumerate(categorical) for b in categorical[i + 1:]]
        ab = snap.select(F.explode(F.array_compact(F.array(*cells))).alias("p")).select("p.*").groupBy("column_a", "column_b", "a", "b").agg(F.count(F.lit(1)).alias("n"))
        ab = cut_lineage(ab)
        turned = ab.select(F.col("column_b").alias("column_a"), F.col("column_a").alias("column_b"), F.col("b").alias("a"), F.col("a").alias("b"), "n")
        ab = ab.unionByName(turned)
        pair = ["column_a", "column_b"]
        total = ab.groupBy(*pair).agg(F.sum("n").alias("t"))
        h_a = (ab.groupBy(*pair, "a").agg(F.sum("n").alias("n")).join(total, pair)
               .groupBy(*pair).agg((-F.sum(F.col("n") / F.col("t") * F.log(F.col("n") / F.col("t")))).alias("h_a")))
        of_b = ab.groupBy(*pair, "b").agg(F.sum("n").alias("nb"))
        h_ab = (ab.join(of_b, [*pair, "b"]).join(total, pair)  # H(a|b) = -sum p(a,b) log(p(a,b)/p(b))
                .groupBy(*pair).agg((-F.sum(F.col("n") / F.col("t") * F.log(F.col("n") / F.col("nb")))).alias("h_ab")))
        parts.append(h_a.join(h_ab, pair).select(*pair, F.lit("uncertainty").alias("kind"), F.try_divide(F.col("h_a") - F.col("h_ab"), F.col("h_a")).alias("value")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def head(df: DataFrame, order_col: str, n: int = 10) -> DataFrame:
    return df.orderBy(F.asc(order_col)).limit(n)


def tail(df: DataFrame, order_col: str, n: int = 10) -> DataFrame:
    return df.orderBy(F.desc(order_col)).limit(n)


NODES_PER_POINT = 330  # nodes between two points of the curve


def density_curve_binned(df: DataFrame, col: str, gridsize: int = 200, cut: float = 3.0, nodes_per_point: int = NODES_PER_POINT) -> DataFrame:
    """(point, x, density, error_bound): the curve of ``density_curve`` from binned values.

    Every value is split between the two nodes around it in proportion to its distance (linear
    binning), so the rest of the work is the same however many different values there are: the node
    weights, at most ``(gridsize - 1) * nodes_per_point + 1``, are convolved with the kernel at the points,
    which are nodes themselves. For nodes ``d`` apart and the bandwidth ``h`` no point is off by more than
    ``error_bound`` = d^2 / (8 h^3 sqrt(2 pi)), the error of linear interpolation of the kernel."""
    vals = df.select(F.col(col).cast("double").alias("v")).filter(F.col("v").isNotNull())
    st = vals.agg(F.count(F.lit(1)).alias("n"), F.stddev_samp("v").alias("sd"), F.min("v").alias("lo"), F.max("v").alias("hi")).first()
    if not st["n"] or not st["sd"]:  # no spread, no bandwidth
        return df.sparkSession.createDataFrame([], "point bigint, x double, density double, error_bound double")
    h = st["sd"] * st["n"] ** -0.2
    g0, g1 = st["lo"] - cut * h, st["hi"] + cut * h
    d = (g1 - g0) / ((gridsize - 1) * nodes_per_point)
    at = (F.col("v") - F.lit(g0)) / F.lit(d)
    left = F.floor(at)
    sides = F.array(F.struct(left.alias("node"), (1 - (at - left)).alias("w")), F.struct((left + 1).alias("node"), (at - left).alias("w")))
    nodes = vals.select(F.explode(sides).alias("s")).groupBy("s.node").agg(F.sum("s.w").alias("w"))
    sums = [F.sum(F.col("w") * F.exp(F.pow((F.col("node") - i * nodes_per_point) * F.lit(d / h), 2) / -2.0)).alias(f"s{i}") for i in range(gridsize)]
    points = [F.struct(F.lit(i).cast("bigint").alias("point"), F.lit(g0 + (g1 - g0) * i / (gridsize - 1)).alias("x"), F.col(f"s{i}").alias("s")) for i in range(gridsize)]
    dens = nodes.agg(*sums).select(F.explode(F.array(*points)).alias("p")).select("p.*")
    bound = d * d / (8 * h ** 3 * math.sqrt(2 * math.pi))
    return dens.select("point", "x", (F.col("s") / (st["n"] * h * math.sqrt(2 * math.pi))).alias("density"), F.lit(bound).alias("error_bound"))
