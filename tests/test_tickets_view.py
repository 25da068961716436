"""The tickets view: rows with repeated and null keys, and texts that stay where only labels are asked for."""

import datetime
import re

from pyspark.sql import functions as F

from tixprep.sources.tables import tickets


def _tables(spark, folder):
    day = datetime.date(2024, 1, 2)
    rows = {
        "documents": ([(1, "Alpha beta\nx", "en", 12), (1, "Gamma", "de", 5), (2, None, "en", 0), (None, "lost", "en", 4), (7, "no order", "fr", 8)], "doc_id long, text string, lang string, n_chars long"),
        "orders": ([(1, 10, 5.0, day, "1"), (1, 11, 6.0, day, "2"), (2, None, 7.0, day, "3"), (None, 10, 8.0, day, "4"), (9, 10, 9.0, day, "5")], "o_orderkey long, o_custkey long, o_totalprice double, o_orderdate date, o_orderpriority string"),
        "customer": ([(10, 1, "A"), (10, 2, "B"), (11, 1, "C")], "c_custkey long, c_nationkey long, c_mktsegment string"),
        "nation": ([(1, "N1", 0), (2, "N2", 0)], "n_nationkey long, n_name string, n_regionkey long"),
        "region": ([(0, "R")], "r_regionkey long, r_name string"),
        "events": ([(1, "click", 0.5), (1, "view", 1.5)], "event_id long, event_type string, value double"),
    }
    for name, (data, schema) in rows.items():
        spark.createDataFrame(data, schema).write.mode("overwrite").parquet(f"{folder}/{name}.parquet")
    return str(folder)


def test_repeated_and_null_keys(spark, tmp_path):
    t = tickets(spark, _tables(spark, tmp_path))
    # 2 documents x (2 customers of the first order + 1 of the second) x 2 events
    assert sorted(map(tuple, t.groupBy("category", "assignment_group").count().collect())) == [("de", "gamma", 6), ("en", "alpha", 6)]
    assert sorted({(r.total_price, r.location, r.contact_type) for r in t.collect()}) == [
        (p, n, e) for p, n in ((5.0, "N1"), (5.0, "N2"), (6.0, "N1")) for e in ("click", "view")]


def test_labels_travel_without_texts(spark, tmp_path):
    t = tickets(spark, _tables(spark, tmp_path)).groupBy("category", "assignment_group").agg(F.count(F.lit(1)))
    plan = t._jdf.queryExecution().optimizedPlan().toString()
    lines = [re.sub(r"regexp_extract\(text#\d+", "", x) for x in plan.splitlines() if "Relation" not in x]
    assert not any(re.search(r"\btext#", x) for x in lines), plan


def test_columns_of_texts_travel_without_texts(spark, tmp_path):
    folder = _tables(spark, tmp_path)
    t = tickets(spark, folder, lambda short, desc: [F.length(short).alias("n_short"), F.length(desc).alias("n_desc")])
    assert {(r.n_short, r.n_desc) for r in t.collect()} == {(10, 12), (5, 5)}
    assert t.drop("n_short", "n_desc").exceptAll(tickets(spark, folder)).isEmpty()
    t = t.groupBy("category").agg(F.avg("n_short"), F.avg("n_desc"))
    plan = t._jdf.queryExecution().optimizedPlan().toString()
    assert not any(re.search(r"[\[ ]text#\d+[,\]]", x) for x in plan.splitlines() if "Relation" not in x), plan


def test_summary_statistics_moves_no_text(spark, tmp_path):
    """Rows of 2 kB text each: what is shuffled and written stays far below the texts."""
    import random

    from tixprep.queries import QUERIES, load_all
    load_all()
    r = random.Random(3)
    folder = _tables(spark, tmp_path)
    words = ["".join(r.choices("abcdefghij", k=9)) for _ in range(2000)]
    docs = [(k % 90, " ".join(r.choices(words, k=200)), "en", 2000) for k in range(300)]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, n_chars long").write.mode("overwrite").parquet(f"{folder}/documents.parquet")
    out = QUERIES["summary_statistics"](spark, folder)
    assert not any("documents.parquet" in f for f in out.inputFiles())
    t = tickets(spark, folder)
    row, n = out.first(), t.count()
    assert row["n_rows"] == n > 0 and row["n_categories"] == 1
    assert row["mean_description_length"] == round(t.select(F.avg(F.length(F.lower(F.coalesce("description", F.lit("")))))).first()[0], 9)
