import zlib

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import functions as F

from tixprep.llm.batches import utf8
from tixprep.llm.toxicity import (_NONE, FUZZY_FROM, FUZZY_STEM_FROM, QUOTED, Automaton, Matches, Words, choose, fit, regression, toxicity_scores)


def words_of(texts):
    return Words.of(*utf8(pa.array(texts, pa.string())))


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def brute_hit(word, terms):
    best = _NONE
    for k, (term, stem) in enumerate(terms):
        edits = int(len(term) >= (FUZZY_STEM_FROM if stem else FUZZY_FROM))
        found = min(distance(word[:j], term) for j in range(len(word) + 1)) if stem else distance(word, term)
        if found <= edits:
            best = min(best, found * len(terms) + k)
    return best


def test_automaton_against_edit_distance():
    rng = np.random.default_rng(5)
    for _ in range(15):
        word = lambda a, b: "".join(rng.choice(list("abcé"), rng.integers(a, b)))
        terms = list({word(2, 9): bool(rng.integers(0, 2)) for _ in range(12)}.items())
        automaton = Automaton.of(terms)
        texts = [word(1, 12) for _ in range(400)] + [t + x for t, _ in terms for x in ("", "a", "zz")] + [t[1:] for t, _ in terms if len(t) > 1]
        assert automaton.hits(words_of(texts)).tolist() == [brute_hit(t, terms) for t in texts]
    assert Automaton.of([]).hits(words_of(["a b"])).tolist() == [_NONE, _NONE]


def test_words():
    texts = ["Idiot's st*pid, a-", None, "", "ÉÀ 日本😀 1d!ot!!", "-a", "b@ c"]
    w = words_of(texts)
    assert [w.text(k) for k in range(len(w.starts))] == ["idiot's", "st*pid", "a", "éà", "日本", "1d!ot", "a", "b", "c"]
    assert w.counts.tolist() == [3, 0, 0, 3, 1, 2]


def test_context_windows_stay_in_their_text():
    automaton = Automaton.of([("idiot", False)])
    for text, quoted in (("he said \"you idiot\" today", True), ("\"one two three four five idiot six\"", False), ("idiot", False), ("«idiot»", True), ("idiot\"", False)):
        alone = Matches.of(words_of([text]), automaton)
        among = Matches.of(words_of(["\"", text, "\" \""]), automaton)
        assert (QUOTED in alone.context) == quoted
        assert sorted(alone.context) == sorted(among.context) and among.row.tolist() == [1]
    m = Matches.of(words_of(["a b c d e idiot f g h i j"]), automaton)
    assert len(m.context) == 8


def test_choice_of_terms():
    rows = [("bad", 40, 0, 0, 0), ("badly", 40, 0, 40, 0), ("bade", 4, 0, 0, 0), ("stem", 50, 5, 2, 5), ("stemmed", 20, 0, 20, 0), ("the", 100, 900, 100, 900), ("few", 3, 0, 3, 0)]
    assert choose(rows, 100, 900) == [("stem", True), ("badly", False), ("bade", True)]


def test_regression_and_one_class():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(500, 3))
    y = (x[:, 0] + rng.normal(size=500) > 0).astype(float)
    centre, scale, w = regression(x, y)
    p = 1 / (1 + np.exp(-(((x - centre) / scale) @ w[:-1] + w[-1])))
    assert abs(p.mean() - y.mean()) < 1e-6 and w[0] > 1 and abs(w[1]) < 0.5
    assert regression(x, np.ones(500))[2][-1] > 5 and regression(x[:0], y[:0])[2].tolist() == [0, 0, 0, 0]


def test_held_out_accuracy(spark):
    from tixprep.llm.queries import QUERIES
    labels = pq.read_table("/root/testdata/sf0.1/labels.parquet").to_pydict()
    truth = dict(zip(labels["doc_id"], labels["toxic"], strict=True))
    rows = QUERIES["op12_toxicity"](spark, "/root/testdata/sf0.1").collect()
    assert len(rows) == 10000 and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7) for r in rows)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in rows)
    seen = [r for r in rows if r["held_out"] and r["doc_id"] in truth]
    toxic = [r["predicted"] for r in seen if truth[r["doc_id"]] == 1]
    clean = [r["predicted"] for r in seen if truth[r["doc_id"]] == 0]
    assert np.mean(toxic) > 0.9 and np.mean(clean) < 0.005


def test_misspelled_and_quoted_terms(spark):
    rng = np.random.default_rng(3)
    plain = lambda n: list(rng.choice(["river", "stone", "meadow", "letter", "window", "garden", "paper"], n))
    docs, labels = [], []
    def with_term(put):
        words = plain(20)
        words.insert(7, put)
        return " ".join(words)
    terms = ["dimwit", "blockhead"]
    for i in range(900):
        toxic, quoted = i % 4 == 0, i % 8 == 1
        term = str(rng.choice(terms))
        docs.append((i, with_term(term if toxic else f"they reported \"the {term}\" and wrote" if quoted else "then")))
        labels.append((i, int(toxic)))
    new = [with_term("dimwitt") for _ in range(20)] + [with_term("blokhead") for _ in range(20)] + [with_term("dimwit") for _ in range(20)]
    new += [with_term("they reported \"the blockhead\" and wrote") for _ in range(20)] + [" ".join(plain(25)) for _ in range(20)]
    docs += [(1000 + i, t) for i, t in enumerate(new)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    scores = {r["doc_id"]: r["score"] for r in toxicity_scores(df, spark.createDataFrame(labels, "doc_id long, toxic int")).collect()}
    long_term, short_term, exact, quoted, clean = (np.array([scores[1000 + 20 * k + i] for i in range(20)]) for k in range(5))
    assert exact.min() > 0.7 and quoted.max() < 0.5 and clean.max() < 0.1
    # with one edit: above clean and quoted texts, below exact ones
    for edited in (long_term, short_term):
        assert clean.max() < edited.mean() < exact.mean() and edited.mean() > quoted.mean()


def test_edge_rows(spark, make_docs):
    texts = [None, "", " ", "a", "word " * 30000, "x" * 200000, (4, "again"), "é😀 ### \"\"", "idiot"]
    docs = make_docs(texts).withColumn("score", F.lit("own")).withColumn("y", F.lit(1)).withColumn("doc", F.lit(2))
    for labels in ([], [(3, 1)], [(i, i % 2) for i in range(6)] + [(None, 1), (99, 0), (1, None), (2, 7)]):
        table = spark.createDataFrame(labels, "doc_id long, toxic int")
        rows = toxicity_scores(docs, table).collect()
        assert len(rows) == len(texts) and all(0 <= r["score"] <= 1 for r in rows)
    assert toxicity_scores(docs.limit(0), table).count() == 0


def test_labels_of_held_out_rows_and_order_change_nothing(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    turned = labels.withColumn("toxic", F.when(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    first, second = fit(docs, labels), fit(docs.repartition(7), turned)
    assert first.automaton.n_terms == second.automaton.n_terms > 5
    assert np.array_equal(first.context, second.context) and np.allclose(first.context_odds, second.context_odds)
    assert np.allclose(first.weights, second.weights, atol=1e-6)
