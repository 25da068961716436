import zlib

import numpy as np
import pyarrow.parquet as pq
from pyspark.sql import functions as F

from tixprep.llm.quality import FEATURES, keep_good, pooled, quality_scores, train


def test_held_out_accuracy(spark):
    from tixprep.llm.queries import QUERIES
    labels = pq.read_table("/root/testdata/sf0.1/labels.parquet").to_pydict()
    truth = dict(zip(labels["doc_id"], labels["quality"], strict=True))
    rows = QUERIES["op5_quality"](spark, "/root/testdata/sf0.1").collect()
    assert len(rows) == 10000 and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in rows)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in rows)
    seen = [r for r in rows if r["held_out"] and r["doc_id"] in truth]
    good = [r["score"] for r in seen if truth[r["doc_id"]] == 1]
    bad = [r["score"] for r in seen if truth[r["doc_id"]] == 0]
    assert np.mean([truth[r["doc_id"]] == r["predicted"] for r in seen]) > 0.97
    assert np.mean([[g > b for b in bad] for g in good]) > 0.98
    # calibrated: the mean score is near the share of label 1
    assert abs(np.mean(good + bad) - len(good) / len(seen)) < 0.03


def test_edge_rows(spark, make_docs):
    texts = [None, "", " ", "a", "word " * 300, (4, "again"), "é😀 ###"]
    docs = make_docs(texts).withColumn("score", F.lit("own"))
    for labels in ([], [(3, 1)], [(i, i % 2) for i in range(6)] + [(None, 1), (99, 0), (1, None), (2, 7)]):
        table = spark.createDataFrame(labels, "doc_id long, quality int")
        rows = quality_scores(docs, table).collect()
        assert len(rows) == len(texts) and all(0 <= r["score"] <= 1 for r in rows)
        kept = keep_good(docs, table)
        assert kept.columns == docs.columns and kept.count() == sum(r["score"] >= 0.5 for r in rows)
    assert quality_scores(docs.limit(0), table).count() == 0


def test_labels_of_held_out_rows_change_nothing(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    turned = labels.withColumn("quality", F.when(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, 1 - F.col("quality")).otherwise(F.col("quality")))
    scores = [{r["doc_id"]: r["score"] for r in quality_scores(docs, t).collect()} for t in (labels, turned)]
    assert scores[0] == scores[1]


def test_network_separates_and_handles_one_class():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(400, FEATURES))
    y = (x[:, 0] * x[:, 1] > 0).astype(float)
    net = train(x, y, epochs=120)
    assert np.mean((net.scores(x) >= 0.5) == y) > 0.9
    assert (train(x, np.ones(400)).scores(x) > 0.99).all()
    assert train(np.zeros((0, FEATURES)), np.zeros(0)).scores(x)[0] == 0.5


def test_pooling_is_per_row():
    import pyarrow as pa
    vectors = np.random.default_rng(0).normal(size=(1 << 14, 32)).astype(np.float32)
    texts = ["one two three", None, "", "four", "one two three"]
    whole = pooled(pa.array(texts), vectors)
    alone = np.vstack([pooled(pa.array([t], pa.string()), vectors) for t in texts])
    assert np.allclose(whole, alone) and np.allclose(whole[0], whole[4]) and not whole[1].any()
