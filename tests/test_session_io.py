import os

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from tixprep import session
from tixprep.operators import classes as C
from tixprep.operators import encode as EN
from tixprep.sources import io as IO


class _Conf:
    def get(self, key, default=None):
        return default


class _Context:
    master = "spark://host:7077"

    def getConf(self):
        return _Conf()

    def getCheckpointDir(self):
        return None


class _Session:
    conf, sparkContext = _Conf(), _Context()


def test_a_cluster_without_a_shared_folder_is_refused():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.ensure_checkpoint_dir(_Session())


def test_tables_have_one_owner(spark):
    folder = session.table_folder(spark)
    assert spark.sparkContext.applicationId in folder
    before = len(os.listdir(folder.replace("file:", "")))
    session.cut_lineage(spark.range(3))
    assert len(os.listdir(folder.replace("file:", ""))) == before + 1


def test_guarded_scan_only_excuses_a_missing_path(spark, tmp_path):
    assert IO.scan_guarded(spark, str(tmp_path / "none")).count() == 0
    (tmp_path / "bad").mkdir()
    with pytest.raises(AnalysisException):
        IO.scan_guarded(spark, str(tmp_path / "bad"))


def test_bundle_round_trip_with_weights(spark, tmp_path):
    s = spark.createDataFrame([(1, "a", "x", "g", "train"), (2, "b", "x", "h", "val")], "src_id long, category string, subcategory string, assignment_group string, split string")
    path = IO.sink_bundle(s, EN.label_dictionary(s), C.level_weights(s), str(tmp_path / "b"))
    samples, labels, levels = IO.scan_bundle(spark, path)
    assert samples.count() == 2 and labels.count() == 5 and levels.count() == 5
    bare = IO.sink_bundle(s, EN.label_dictionary(s), None, str(tmp_path / "c"))
    assert IO.scan_bundle(spark, bare)[2].count() == 0


def test_strict_decode_refuses_unknown_codes(spark):
    d = spark.createDataFrame([("category", 0, "a")], "target string, code int, label string")
    codes = spark.createDataFrame([(1, 0), (2, None)], "id int, c int")
    got = {r.id: r.category_label for r in EN.label_decode(codes, d, {"category": "c"}, strict=True).collect()}
    assert got == {1: "a", 2: None}
    with pytest.raises(Exception, match="no category label"):
        EN.label_decode(codes.withColumn("c", F.lit(9)), d, {"category": "c"}, strict=True).collect()


def test_sampling_strategy_takes_three_times_the_class(spark):
    d = spark.range(2000).select(F.when(F.col("id") < 60, "s").when(F.col("id") < 90, "xs").otherwise("l").alias("c"))
    assert {r.value: (r.n, r.target_n) for r in C.sampling_strategy(d, "c").collect()} == {"s": (60, 180)}


def test_merge_of_all_targets_equals_one_by_one(spark):
    rows = [("a", "x", None)] * 60 + [("b", "x", "g")] * 10 + [(None, "y", "g")] * 55 + [("Other", None, "h")] * 3
    d = spark.createDataFrame(rows, "category string, subcategory string, assignment_group string")
    one = d
    for t in d.columns:
        one = C.merge_rare_classes(one, t)
    assert sorted(map(str, C.merge_rare_targets(d).collect())) == sorted(map(str, one.collect()))
