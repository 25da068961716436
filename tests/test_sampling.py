import math

import pytest
from pyspark.sql import functions as F

from tixprep.operators import sampling as SM


def test_split_quota_and_partition_invariance(spark):
    d = spark.range(1000).select(F.col("id"), F.when(F.col("id") % 10 < 6, "a").when(F.col("id") % 10 < 9, "b").otherwise("c").alias("label"))
    s1 = SM.stratified_split(d, "label", "id")
    s2 = SM.stratified_split(d.repartition(7), "label", "id")
    v1 = {r.id for r in s1.filter("split = 'val'").collect()}
    v2 = {r.id for r in s2.filter("split = 'val'").collect()}
    assert v1 == v2 and len(v1) == math.ceil(0.1 * 1000)
    per = {r.label: r.n for r in s1.filter("split = 'val'").groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert per == {"a": 60, "b": 30, "c": 10}


def test_split_rejects_singleton_class(spark):
    d = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b")], "id long, label string")
    with pytest.raises(Exception):
        SM.stratified_split(d, "label", "id").collect()


def test_weighted_sample_counts_and_support(spark):
    d = spark.createDataFrame([(i, float(w)) for i, w in enumerate([0, 1, 1, 8, 0.5])], "id long, w double")
    s = SM.weighted_sample_replace(d, "w", "id", n_draws=5000)
    rows = s.collect()
    assert len(rows) == 5000 and len({r.draw for r in rows}) == 5000
    ids = [r.id for r in rows]
    assert 0 not in ids
    assert abs(ids.count(3) / 5000 - 8 / 10.5) < 0.03


def test_batch_index_and_shuffle(spark):
    d = spark.range(300).select("id")
    b = {r.id: r.batch for r in SM.batch_index(d, "id", 128).collect()}
    assert b[0] == 0 and b[127] == 0 and b[128] == 1 and b[299] == 2
    p = sorted(r.position for r in SM.shuffle_rows(d, "id").collect())
    assert p == list(range(1, 301))


def test_tiny_weights_can_be_drawn_and_heavy_rows_spread(spark):
    d = spark.createDataFrame([(1, 1e-9), (2, 2e-9), (3, 0.0)], "id long, w double")
    ids = [r.id for r in SM.weighted_sample_replace(d, "w", "id", n_draws=3000).collect()]
    assert len(ids) == 3000 and 3 not in ids and abs(ids.count(1) / 3000 - 1 / 3) < 0.04
    heavy = spark.range(5000).select("id", F.when(F.col("id") == 7, 1e5).otherwise(1.0).alias("w"))
    ids = [r.id for r in SM.weighted_sample_replace(heavy, "w", "id", n_draws=2000).collect()]
    assert len(ids) == 2000 and ids.count(7) > 1800


def test_draws_are_finer_than_32_bits(spark):
    from tixprep.functions.hashing import hash60
    h = [r.h for r in spark.range(2000).select(hash60(1, F.col("id")).alias("h")).collect()]
    assert max(h) < 1 << 60 and max(h) > 1 << 58 and len({x & 0xFFFFFFF for x in h}) > 1990


def test_range_rank_on_hash_like_keys(spark):
    from tixprep.operators.ranking import range_rank
    d = spark.range(3000).select(F.xxhash64("id").alias("k"))
    got = [(r.k, r.r) for r in range_rank(d, [F.col("k")], "r").collect()]
    assert [r for _, r in sorted(got)] == list(range(1, 3001))
