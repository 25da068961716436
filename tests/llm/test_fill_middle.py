import hashlib
import re

import numpy as np
import pytest
from hypothesis import given, strategies as st
from pyspark.sql import functions as F

from tixprep.llm.fill_middle import fill_in_middle, restore, rotate, turned, turned_back

TEXTS = [None, "", "a", "ab cd", "é😀 x-y\n\nz", "has <P> in it", "<S>", "x<M", "<", "<<>>PSM", "word " * 30000, "ü" * 5000, "Ab1" * 700, "> <P", "\x00\t\r\n"]


def expected(doc, text):
    text = text or ""
    w = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
    digest = hashlib.sha256(f"1:{'' if doc is None else doc}".encode()).hexdigest()
    h = [int(digest[8 * k:8 * k + 8], 16) for k in range(4)]
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return len(w), "plain", None, None, text
    a, b = sorted((h[0] % (len(w) + 1), h[1] % (len(w) + 1)))
    p, m, s = "".join(w[:a]), "".join(w[a:b]), "".join(w[b:])
    if h[3] % 100 < 20:
        return len(w), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return len(w), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def check(df, texts):
    rows = restore(fill_in_middle(df)).collect()
    assert len(rows) == len(texts)
    got = sorted(((r["doc_id"], r["n"], r["form"], r["prefix_chars"], r["middle_chars"], r["output"], r["text"]) for r in rows), key=repr)
    assert got == sorted(((d, *expected(d, t), t or "") for d, t in texts), key=repr)
    return {r["form"] for r in rows}


def test_edge_rows_in_every_form(spark):
    # every text under many ids, repeated ids, a null id, columns named like the operator's own
    texts = [(100 * k + i, t) for k in range(25) for i, t in enumerate(TEXTS)] + [(None, "null id"), (None, "another"), (7, "again"), (7, "again")]
    df = spark.createDataFrame(texts, "doc_id long, text string").withColumn("output", F.lit("x")).withColumn("form", F.lit(1)).withColumn("h1", F.lit(0))
    assert check(df, texts) == {"plain", "psm", "spm"}


def test_whole_smallest_table(spark, sample_texts):
    check(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"), list(sample_texts.items()))


def test_empty_table_and_clash(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert restore(fill_in_middle(empty)).count() == 0
    with pytest.raises(ValueError):
        restore(fill_in_middle(empty), as_col="form")


def test_restore_of_nulls(spark):
    df = spark.createDataFrame([(None, "psm"), ("x", None), ("<P>a<S>c<M>b", "psm"), ("<S>c<P>a<M>b", "spm")], "output string, form string")
    assert [r["text"] for r in restore(df).collect()] == [None, None, "abc", "abc"]


@given(st.binary(max_size=40), st.data())
def test_rotation_is_an_exchange(raw, data):
    lo, mid, hi = sorted(data.draw(st.integers(0, len(raw))) for _ in range(3))
    out = bytearray(raw)
    rotate(np.frombuffer(out, np.uint8), lo, mid, hi)
    assert bytes(out) == raw[:lo] + raw[mid:hi] + raw[lo:mid] + raw[hi:]


@given(st.text(alphabet="<>PSMé", max_size=30), st.data(), st.sampled_from(["psm", "spm"]))
def test_round_trip(text, data, form):
    raw = text.encode()
    if not any(m in raw for m in (b"<P>", b"<S>", b"<M>")):
        a, b = sorted(data.draw(st.integers(0, len(raw))) for _ in range(2))
        assert bytes(turned_back(bytes(turned(raw, a, b, form)), form)) == raw
