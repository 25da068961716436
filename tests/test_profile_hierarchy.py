import numpy as np
from pyspark.sql import functions as F

from tixprep.operators import hierarchy as H
from tixprep.operators import profile as P


def test_quantiles_match_numpy(spark):
    vals = [3.0, 1.0, 4.0, 1.0, 5.0, 9.0, 2.0, 6.0, 5.0, 3.0, 5.0] * 7 + [None]
    d = spark.createDataFrame([(v,) for v in vals], "x double")
    got = {r.q: r.value for r in P.quantiles(d, "x", [0.0, 0.25, 0.5, 0.75, 0.95, 1.0]).collect()}
    arr = np.array([v for v in vals if v is not None])
    for q, v in got.items():
        assert abs(v - np.quantile(arr, q)) < 1e-9


def test_constant_column_correlation_is_null(spark):
    d = spark.createDataFrame([(1.0, 2.0), (1.0, 3.0), (1.0, None)], "a double, b double")
    got = {(r.column_a, r.column_b): r.r for r in P.correlation_matrix(d, ["a", "b"]).collect()}
    assert got[("a", "b")] is None and abs(got[("b", "b")] - 1.0) < 1e-12


def test_duplicates_null_safe(spark):
    rows = [(1, "a"), (1, "a"), (None, "b"), (None, "b"), (None, None), (2, "c")]
    d = spark.createDataFrame(rows, "x int, y string")
    assert P.duplicate_rows(d).collect()[0].duplicate_rows == 2


def test_histogram_matches_numpy(spark):
    vals = [0.0, 1.0, 2.5, 10.0, 7.2, 7.2, 3.3]
    d = spark.createDataFrame([(v,) for v in vals], "x double")
    got = [r.n for r in P.histogram(d, "x", 5).orderBy("bin").collect()]
    assert got == list(np.histogram(vals, bins=5)[0])


def test_zero_filled_and_threshold_report(spark):
    rows = [("a", "x", "p"), ("a", "x", "p"), ("b", "y", "q")]
    d = spark.createDataFrame(rows, "category string, subcategory string, assignment_group string")
    cols = ["category", "subcategory", "assignment_group"]
    seen = H.zero_filled_combos(d, cols)
    assert seen.count() == 2 and seen.agg(F.sum("n")).collect()[0][0] == 3
    z = H.zero_filled_combos(d, cols, {"category": ["a", "b"], "subcategory": ["x", "y"], "assignment_group": ["p", "q"]})
    assert z.count() == 8 and z.agg(F.sum("n")).collect()[0][0] == 3
    rep = {(r.kind, r.threshold): r.combos_below for r in H.combo_threshold_report(d).collect()}
    assert rep[("count", 5.0)] == 2 and rep[("percentage", 0.5)] == 0


def test_quantiles_with_outliers_negatives_zeros(spark):
    vals = [0.0] * 5 + [-3.5, -1e9, 1e12, 7.0, 7.0, 2.0 ** 10, 2.0 ** 10 - 1e-9, 1e-300, -0.0] + [float(i) / 7 for i in range(50)]
    d = spark.createDataFrame([(v,) for v in vals], "x double")
    qs = [0.0, 0.1, 0.25, 0.5, 0.75, 0.9, 1.0]
    got = {r.q: r.value for r in P.quantiles(d, "x", qs).collect()}
    for q in qs:
        assert abs(got[q] - np.quantile(np.array(vals), q)) <= 1e-9 * max(1.0, abs(np.quantile(np.array(vals), q)))
