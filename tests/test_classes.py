import math

from pyspark.sql import functions as F

from tixprep.operators import classes as C
from tixprep.operators.encode import label_dictionary


def _df(spark, counts, col="label"):
    rows = [(i, lab) for i, lab in enumerate(lab for lab, n in counts for _ in range(n))]
    return spark.createDataFrame(rows, f"id int, {col} string")


def test_merge_rare_boundary_and_existing_other(spark):
    d = _df(spark, [("a", 49), ("b", 50), ("Other", 3), ("c", 60)])
    d = d.unionByName(spark.createDataFrame([(999, None)], "id int, label string"))
    m = C.merge_rare_classes(d, "label", 50)
    got = {r.label: r.n for r in m.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert got == {"Other": 52, "b": 50, "c": 60, None: 1}


def test_minority_excludes_other(spark):
    d = _df(spark, [("Other", 5), ("big", 100), ("small", 29), ("edge", 30)])
    got = {r.label for r in C.minority_class_set(d, "label", 0.3).collect()}
    assert got == {"small"}


def test_rare_rule_uses_rounded_percent(spark):
    # 1 row of 200,000 is 0.0005 % -> rounds to 0.0 -> rare; 3 rows -> 0.0015 % -> 0.0 -> rare too
    d = spark.range(200000).select(F.when(F.col("id") == 0, "x").when(F.col("id") < 4, "y").otherwise("z").alias("label"))
    got = {r.value: r.is_rare for r in C.rare_and_dominant(d, "label").collect()}
    assert got == {"x": True, "y": True, "z": False}


def test_sample_weight_formula(spark):
    rows = [("a", "s1", "g1")] * 10 + [("a", "s2", "g2")] * 2 + [("b", "s2", "g1")] * 3
    d = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "id int, category string, subcategory string, assignment_group string")
    w = {r.id: r.sample_weight for r in C.sample_weights(d).collect()}
    cnt = {}
    for k in range(3):
        for r in rows:
            cnt.setdefault(k, {}).setdefault(r[k], 0)
            cnt[k][r[k]] += 1
    for i, r in enumerate(rows):
        lw = [math.sqrt(1.0 / cnt[k][r[k]]) / min(math.sqrt(1.0 / v) for v in cnt[k].values()) for k in range(3)]
        exp = min(10.0, max(1.0, (lw[0] * lw[1] * lw[2]) ** (1 / 3)))
        assert abs(w[i] - exp) < 1e-12


def test_label_dictionary_codepoint_order(spark):
    d = spark.createDataFrame([("b", "x", "z"), ("B", "y", "z"), ("é", "x", "z")], "category string, subcategory string, assignment_group string")
    got = sorted((r.target, r.code, r.label) for r in label_dictionary(d).collect())
    assert [x for x in got if x[0] == "category"] == [("category", i, l) for i, l in enumerate(sorted(["b", "B", "é"]))]
