import uuid

import numpy as np
from pyspark.sql import functions as F

from tixprep.operators import profile as P
from tixprep.operators import sketches as K
from tixprep.operators.wide import wide_correlation


def test_block_products_equal_the_pairwise_correlations(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(400, 11)) * rng.uniform(0.1, 1e4, 11) + rng.normal(size=11) * 1e5
    x[:, 3] = x[:, 0] * -2 + rng.normal(size=400)
    x[:, 5] = 7.0
    x[rng.random(x.shape) < 0.2] = np.nan
    x[1:, 6] = np.nan
    names = [f"a.{i}" if i == 2 else f"a{i}" for i in range(11)]
    rows = [[None if np.isnan(v) and rng.random() < 0.5 else float(v) for v in r] for r in x]
    df = spark.createDataFrame(rows, ", ".join(f"`{n}` double" for n in names)).repartition(3)
    clean = df.select(*[F.nanvl(F.col(f"`{n}`"), F.lit(None).cast("double")).alias(n.replace(".", "")) for n in names])
    want = {(r.column_a, r.column_b): r.r for r in P.correlation_matrix(clean, clean.columns).collect()}
    for block in (4, 128):
        got = {(r.column_a.replace(".", ""), r.column_b.replace(".", "")): r.r for r in wide_correlation(df, names, block).collect()}
        assert set(got) == set(want)
        for k, r in want.items():
            if "a5" in k:  # constant: no correlation, whatever rounding leaves
                assert got[k] is None
                continue
            assert (got[k] is None) == (r is None) and (r is None or abs(got[k] - r) < 1e-9), k


def test_a_thousand_columns(spark):
    k = 1000
    df = spark.range(64).select(*[(F.sin(F.col("id") * (i + 1) * 0.7) + F.lit(i % 7)).alias(f"x{i}") for i in range(k)])
    out = wide_correlation(df, df.columns)
    n, total = out.agg(F.count("r"), F.sum(F.when(F.col("column_a") == F.col("column_b"), F.col("r")))).first()
    assert n == k * k and abs(total - k) < 1e-6
    one = out.filter("column_a = 'x3' AND column_b = 'x700'").first().r
    assert abs(one - P.correlation_matrix(df, ["x3", "x700"]).filter("column_a = 'x3' AND column_b = 'x700'").first().r) < 1e-9


def test_no_columns_and_no_rows(spark):
    df = spark.createDataFrame([], "a double, b double")
    assert wide_correlation(df, []).count() == 0 and wide_correlation(df, ["a", "b"]).count() == 0


def folder(spark):
    from tixprep.session import table_folder
    return f"{table_folder(spark)}/sketch-{uuid.uuid4().hex}"


def test_merged_sketches_against_the_exact_profile(spark):
    rng = np.random.default_rng(1)
    at = folder(spark)
    parts = []
    for p in range(3):
        n = [5000, 1, 3000][p]
        rows = [(float(v), int(rng.zipf(1.5) % 4000), None if rng.random() < 0.1 else f"w{rng.integers(0, 50)}", None) for v in rng.gamma(2, 10 * (p + 1), n)]
        df = spark.createDataFrame(rows, "x double, y long, `z z` string, none double")
        K.add_part(df, at, f"p{p}")
        parts.append(df)
    whole = parts[0].union(parts[1]).union(parts[2])
    got = {r["column_name"]: r for r in K.profile(spark, at).collect()}
    exact = {r["column_name"]: r for r in P.describe_numeric(whole, ["x", "y"]).collect()}
    for c in ("x", "y"):
        g, e = got[c], exact[c]
        assert g["n"] == e["count"] and np.allclose([g["mean"], g["std"], g["min"], g["max"]], [e["mean"], e["std"], e["min"], e["max"]])
        values = np.sort([r[c] for r in whole.select(c).collect()])
        for q, name in ((0.25, "q0"), (0.5, "q1"), (0.75, "q2")):
            lo, hi = np.searchsorted(values, g[name], "left") / len(values), np.searchsorted(values, g[name], "right") / len(values)
            assert lo - 0.01 <= q <= hi + 0.01
        true = whole.select(c).distinct().count()
        assert abs(got[c]["distinct"] - true) <= max(2, 0.03 * true)
    assert got["z z"]["n"] == whole.filter("`z z` IS NOT NULL").count() and got["z z"]["mean"] is None and abs(got["z z"]["distinct"] - 50) <= 2
    assert got["none"]["n"] == 0 and got["none"]["distinct"] == 0 and got["none"]["q1"] is None
    counts = {(c, str(r["v"])): r["n"] for c in ("y", "z z") for r in whole.groupBy(F.col(f"`{c}`").alias("v")).agg(F.count(F.lit(1)).alias("n")).collect()}
    for r in K.frequent_values(spark, at, 5).filter("column_name IN ('y', 'z z')").collect():
        assert r["at_least"] <= counts[r["column_name"], r["value"]] <= r["at_most"]
    assert K.frequent_values(spark, at, 5).filter("column_name = 'z z'").count() == 5


def test_a_new_part_reads_itself_alone(spark):
    at = folder(spark)
    K.add_part(spark.range(100), at, "a")
    before = K.profile(spark, at).first()
    K.add_part(spark.range(100, 300), at, "b")
    after = K.profile(spark, at).first()
    K.add_part(spark.range(100, 200), at, "b")  # replaced
    last = K.profile(spark, at).first()
    assert (before["n"], after["n"], last["n"]) == (100, 300, 200) and after["max"] == 299 and last["max"] == 199
    K.add_part(spark.range(0), at, "c")
    assert K.profile(spark, at).first()["n"] == 200
