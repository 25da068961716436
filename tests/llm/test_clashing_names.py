"""Every operator that hands columns on keeps those named like its own."""

from pyspark.sql import functions as F

from tixprep.llm.decontaminate import contamination, remove_contaminated
from tixprep.llm.pii import find_pii, mask_pii
from tixprep.llm.quality import keep_good, quality_scores
from tixprep.llm.simhash import keep_one_of_each

NAMES = ["_id", "_y", "sample_id", "y", "doc", "_pii", "pii", "PII_", "_pii_email", "row", "_row", "bad", "_bad", "fp", "FP_", "id", "component", "first", "score", "n_hit"]


def with_names(docs):
    return docs.withColumns({n: F.lit(k) for k, n in enumerate(n for n in NAMES if n not in docs.columns)})


def test_columns_stay(spark, make_docs):
    docs = with_names(make_docs(["mail a@b.cd now", "one two three four five six", None, "another text of words " * 40]))
    labels = spark.createDataFrame([(i, i % 2) for i in range(4)], "doc_id long, quality int")
    benchmark = spark.createDataFrame([(1, "one two three four five six"), (2, "never there at all"), (3, None)], "item_id long, text string")
    assert quality_scores(docs, labels).count() == 4
    for out in (keep_good(docs, labels), mask_pii(docs), remove_contaminated(docs, benchmark), remove_contaminated(docs, benchmark, block_bytes=1), keep_one_of_each(docs)):
        assert out.columns == docs.columns
        assert all([r[n] for n in NAMES if n in docs.columns] for r in out.collect())
    assert mask_pii(docs).filter("doc_id = 0").first()["text"] == "mail <EMAIL> now"
    assert sorted(r["doc_id"] for r in remove_contaminated(docs, benchmark, block_bytes=1).collect()) == [0, 2, 3]
    assert find_pii(docs, out_col="spans").filter("doc_id = 0").first()["spans"][0]["kind"] == "email"
    assert contamination(docs, benchmark, block_bytes=1).filter("contaminated").count() == 1
