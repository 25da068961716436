import hashlib
import re

import pyarrow.parquet as pq
import pytest

from tixprep.llm.decontaminate import contamination, find_matches, remove_contaminated

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def tokens(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))


def brute(docs, items):
    windows = {}
    for item, text in items:
        w = tokens(text)
        for j in range(max(1, len(w) - 12) if w else 0):
            windows.setdefault(tuple(w[j:j + 13]), set()).add(str(item))
    lengths = sorted({len(w) for w in windows})
    out = {}
    for doc, text in docs:
        w, hit, found = tokens(text), set(), set()
        for n in lengths:
            for p in range(len(w) - n + 1):
                key = tuple(w[p:p + n])
                if key in windows:
                    hit.update(range(p, p + n))
                    found |= windows[key]
        out[doc] = (len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(),
                    len(hit) > 0 and 20 * len(hit) >= len(w))
    return out


def got(df):
    return {r["doc_id"]: (r["n_words"], r["n_hit"], r["n_items"], r["items_sha256"], r["contaminated"]) for r in df.collect()}


@pytest.mark.parametrize("block_bytes", [8 << 20, 700])
def test_small_cases(spark, make_docs, block_bytes):
    passage = " ".join(f"w{i}" for i in range(30))
    items = [(1, passage), (2, "only five words in here"), (10, passage), (3, None), (4, ""), (5, "...!"),
             (6, " ".join(f"w{i}" for i in range(5, 18))), (7, "a a a a a a a a a a a a a a a")]
    texts = [passage.upper(), "x " + " ".join(f"w{i}" for i in range(13)) + " y", " ".join(f"w{i}" for i in range(12)),
             "ONLY five, words in/here and more", None, "", "é" * 5, "a " * 40, passage + " " + passage,
             "pre " * 500 + " ".join(f"w{i}" for i in range(2, 20)), "w1 w2 w3 only five words in", "w0_w1",
             "\x00 w1\x7f " + passage]
    docs = make_docs(texts)
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = brute(list(enumerate(texts)), items)
    assert got(contamination(docs, bench, block_bytes=block_bytes)) == want
    clean = {r["doc_id"] for r in remove_contaminated(docs, bench, block_bytes=block_bytes).collect()}
    assert clean == {d for d, w in want.items() if not w[4]}


def test_longest_match_and_place(spark, make_docs):
    passage = " ".join(f"w{i}" for i in range(20))
    bench = spark.createDataFrame([(1, "q " + passage)], "item_id long, text string")
    m = find_matches(make_docs(["z z z " + passage + " z"]), bench).first()["matches"]
    assert [tuple(x) for x in m] == [("1", 1, 3, 20)]


def test_whole_table_against_brute_force(spark):
    from tixprep.llm.queries import QUERIES
    d = pq.read_table("/root/testdata/sf0.001/documents.parquet").to_pydict()
    b = pq.read_table("/root/testdata/sf0.001/benchmark.parquet").to_pydict()
    want = brute(zip(d["doc_id"], d["text"], strict=True), list(zip(b["item_id"], b["text"], strict=True)))
    assert got(QUERIES["op1_decontaminate"](spark, "/root/testdata/sf0.001")) == want
    assert any(w[4] for w in want.values())


def test_empty_tables_repeats_and_clashing_columns(spark, make_docs):
    empty = spark.createDataFrame([], "item_id long, text string")
    docs = make_docs([(1, "a b"), (1, "a b"), (None, "a b")]).withColumn("n_hit", docs_lit())
    assert contamination(docs, empty).count() == 3
    assert remove_contaminated(docs, empty).columns == docs.columns
    assert contamination(docs.limit(0), empty).count() == 0
    bench = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert contamination(docs, bench).filter("contaminated").count() == 3


def docs_lit():
    from pyspark.sql import functions as F
    return F.lit("own")
