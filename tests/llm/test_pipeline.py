"""Each stage of the corpus pipeline against its brute-force version, and run() against the chain."""

import random

import public_tokenizers
import pytest
from test_decontaminate import brute as brute_contamination
from test_packing import check as check_packing
from test_pii import brute as brute_pii
from test_simhash import brute_fingerprint, brute_groups
from tokenizers import Tokenizer

import corpus_pipeline as P
from tixprep.llm.quality import quality_scores

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def sf_dir(spark, tmp_path_factory):
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 8)))
    good = [" ".join(word() for _ in range(rng.randint(30, 90))) + "." for _ in range(60)]
    bad = [" ".join(word() + "$$$ ###" for _ in range(40)) for _ in range(25)]
    items = [(k, " ".join(word() for _ in range(20))) for k in range(5)]
    texts = good + bad + [good[3], good[4] + " x", "Start " + items[1][1] + " end", good[7] + " " + items[2][1], "", None,
                          "write to someone@mail.example.org or +1 (017) 555-7713 now " + good[9], " ".join(good)]
    rows = [(i * 3, t, "en", f"src{i % 4}", len(t) if t is not None else None) for i, t in enumerate(texts)]
    labels = [(r[0], int(i < 60), 0) for i, r in enumerate(rows[:85])] + [(r[0], 1, 0) for r in rows[85:]]
    path = str(tmp_path_factory.mktemp("sf"))
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path


def by_id(df):
    return {r["doc_id"]: r for r in df.collect()}


def test_stages_against_brute_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    read = lambda name: spark.read.parquet(f"{sf_dir}/{name}.parquet")
    stage = dict(P.STAGES)
    assert [name for name, _ in P.STAGES] == ["quality", "near_duplicates", "decontamination", "personal_data", "packing"]

    kept = stage["quality"](spark, docs, sf_dir)
    scores = {r["doc_id"]: r["score"] for r in quality_scores(docs, read("labels")).collect()}
    assert kept.schema == docs.schema and set(by_id(kept)) == {i for i, s in scores.items() if s >= 0.5}
    before = by_id(docs)
    assert by_id(kept).items() <= before.items() and 55 < len(by_id(kept)) < 75
    docs = kept

    kept = stage["near_duplicates"](spark, docs, sf_dir)
    groups = brute_groups({i: brute_fingerprint(r["text"]) for i, r in by_id(docs).items()})
    assert kept.columns == docs.columns and set(by_id(kept)) == {i for i, g in groups.items() if i == g}
    assert kept.count() < docs.count()
    docs = kept

    kept = stage["decontamination"](spark, docs, sf_dir)
    found = brute_contamination([(i, r["text"]) for i, r in by_id(docs).items()], [(r["item_id"], r["text"]) for r in read("benchmark").collect()])
    assert kept.schema == docs.schema and set(by_id(kept)) == {i for i, f in found.items() if not f[4]}
    assert kept.count() < docs.count()
    docs = kept

    masked = stage["personal_data"](spark, docs, sf_dir)
    assert masked.columns == docs.columns
    changed = 0
    for i, r in by_id(masked).items():
        text, spans = by_id(docs)[i]["text"], sorted(brute_pii(by_id(docs)[i]["text"]), key=lambda s: s[1])
        for kind, a, b in reversed(spans):
            text = text[:a] + f"<{kind.upper()}>" + text[b:]
        assert r["text"] == text and (text is None or r["n_chars"] == len(text))
        changed += bool(spans)
    assert changed >= 1
    docs = masked

    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    rows = stage["packing"](spark, docs, sf_dir).collect()
    check_packing(rows, {i: r["text"] for i, r in by_id(docs).items()}, tokenizer)
    for r in rows:
        assert len(r["ids"]) == r["length"]


def test_run_is_the_chain(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in P.STAGES[:-1]:
        docs = spark.createDataFrame(stage(spark, docs, sf_dir).collect(), docs.schema)
    key = lambda r: (r["doc_id"], r["start"])
    texts = {i: r["text"] for i, r in by_id(docs).items()}
    rows = P.run(spark, sf_dir).collect()
    check_packing(rows, texts, Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json")))
    assert len({key(r) for r in rows}) == len(rows)


def test_empty_documents(spark, sf_dir, tmp_path):
    for name in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{sf_dir}/{name}.parquet").limit(0).write.parquet(str(tmp_path / f"{name}.parquet"))
    assert P.run(spark, str(tmp_path)).count() == 0


def test_registered():
    import __spark_entry__ as E
    names = set(E.queries())
    assert "pipeline" in names and all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 11))
