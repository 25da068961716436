import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from tixprep.llm import divergence as D
from tixprep.llm.batches import utf8
from tixprep.llm.divergence import share, source_divergence

SCHEMA = "doc_id long, text string, lang string, source string"


def brute(rows, min_docs=10, top=10):
    """The contract's words, one number after the other."""
    df, counts, groups = defaultdict(Counter), defaultdict(Counter), set()
    for _, text, lang, source in rows:
        lang, source = lang or "", source or ""
        text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        terms = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text)
        groups.add((lang, source))
        df[lang].update(set(terms))
        counts[lang, source].update(terms)
    out = []
    for lang in {g[0] for g in groups}:
        kept = sorted(t for t, n in df[lang].items() if n >= min_docs)
        sources = [s for la, s in groups if la == lang]

        def p_of(c, kept=kept):
            total = sum(c[t] for t in kept)
            return {t: 1 + 10 ** 9 * (c[t] + 2) // (total + 2 * len(kept)) for t in kept}
        p = {s: p_of(counts[lang, s]) for s in sources}
        q = p_of(sum((counts[lang, s] for s in sources), Counter()))
        f = lambda a, b: (a - b) ** 2 // (a + b)
        for s in sources:
            pair = [(sum(f(p[s][t], p[o][t]) for t in kept), o) for o in sources if o != s]
            term = [(f(p[s][t], q[t]), t) for t in kept if counts[lang, s][t] > 0 and p[s][t] > q[t]]
            for part, found in (("pair", pair), ("term", term)):
                found.sort(key=lambda x: (-x[0], x[1].encode()))
                out += [(lang, s, part, item, v, k) for k, (v, item) in enumerate(found, 1) if part == "pair" or k <= top]
    return sorted(out)


def run(df, **options):
    out = source_divergence(df, **options)
    assert out.columns == ["lang", "source", "part", "item", "value", "rank"]
    return sorted(tuple(r) for r in out.collect())


def made(seed, n=120):
    rng = np.random.default_rng(seed)
    words = ["aa", "Bb", "éÉ", "ÀÀ", "cc", "dd", "x", "日本", "l'an", "z9z", "ee-ff", "😀"]
    rows = []
    for i in range(n):
        k = rng.integers(0, 30)
        text = " ".join(rng.choice(words, k, p=np.arange(12, 0, -1) / 78))
        lang, source = [("en", f"s{rng.integers(0, 6)}"), ("fr", "only"), (None, "n"), ("", None), ("de", f"é{rng.integers(0, 3)}")][rng.choice(5, p=[.5, .1, .1, .1, .2])]
        rows.append((i, text, lang, source))
    return rows + [(7, None, "en", "silent"), (7, "", "en", "silent"), (None, "9 9", "xx", "a"), (8, "solo", "xx", "b"), (8, "solo", "xx", "b"), (9, "q " * 5000, "yy", "c"), (1, None, None, None)]


def test_against_plain_counting(spark):
    for seed in range(2):
        rows = made(seed)
        df = spark.createDataFrame(rows, SCHEMA).withColumn("term", F.lit("own")).withColumn("df", F.lit(1)).repartition(5)
        assert run(df) == brute(rows)


def test_spilling_passes_and_blocks_change_nothing(spark, monkeypatch):
    rows = made(3)
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    want = brute(rows, 3, 2)
    assert run(df, min_docs=3, top_terms=2) == want
    monkeypatch.setattr(D, "HELD_FROM", 2)
    assert run(df, min_docs=3, top_terms=2, cells_held=7, step_bytes=200, groups_a_pass=3, sources_a_block=2) == want


def test_ties_rank_by_item(spark):
    rows = [(i, "b a é c", "en", s) for i, s in enumerate(["s2", "s1", "S3"] * 5)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = run(df)
    assert got == brute(rows) and [r[3] for r in sorted(got, key=lambda r: r[5]) if r[1] == "s2"] == ["S3", "s1"]


def test_empty_tables(spark):
    assert run(spark.createDataFrame([], SCHEMA)) == []
    assert run(spark.createDataFrame([(1, None, None, None)], SCHEMA)) == []


def test_smallest_table(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text", "lang", "source")
    rows = [tuple(r) for r in df.collect()]
    assert run(df) == brute(rows)


def test_shares_beyond_64_bits():
    rng = np.random.default_rng(1)
    total = rng.integers(1, 9 * 10 ** 15, 500)
    count = (total * rng.random(500)).astype(np.int64)
    assert share(count, total).tolist() == [1 + 10 ** 9 * int(c) // int(t) for c, t in zip(count, total, strict=True)]


def test_equal_fingerprints_of_different_words(spark, monkeypatch):
    """Words that share the first fingerprint are told apart by the second."""
    keys = D._keys
    monkeypatch.setattr(D, "_keys", lambda *a: (keys(*a)[0] % np.uint64(3), keys(*a)[1]))
    texts = ["one two three four", "", "four one", "three three x"]
    rows = D.stripes_of(*utf8(pa.array(texts)), pa.array(["a", "a", "b", "a"]), pa.array(["s", "t", "s", "s"]))
    got = {(r["lang"], r["term"].decode(), r["df"], *sorted(zip(r["sources"], r["counts"], strict=True))) for r in rows.to_pylist()}
    want = {("a", "", 3, ("s", 0), ("t", 0)), ("b", "", 1, ("s", 0)), *(("a", w, 1, ("s", 1)) for w in ("one", "two", "four", "x")), ("a", "three", 2, ("s", 3)),
            *(("b", w, 1, ("s", 1)) for w in ("one", "four"))}
    assert got == want
