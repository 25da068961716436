import random

import numpy as np
import pyarrow.parquet as pq
import xxhash
from pyspark.sql import functions as F

from tixprep.llm.components import connected_components
from tixprep.llm.simhash import close_pairs, keep_one_of_each, near_duplicates


def brute_fingerprint(text):
    words = [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", (text or "")) if w]
    words = ["".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in w) for w in words]
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_groups(fps, reach=2):
    parent = {i: i for i in fps}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i
    ids = sorted(fps)
    for a in ids:
        for b in ids:
            if a < b and bin(fps[a] ^ fps[b]).count("1") <= reach:
                ra, rb = sorted((root(a), root(b)))
                parent[rb] = ra
    return {i: root(i) for i in ids}


def test_whole_table_against_brute_force(spark):
    from tixprep.llm.queries import QUERIES
    d = pq.read_table("/root/testdata/sf0.001/documents.parquet").to_pydict()
    fps = {i: brute_fingerprint(t) for i, t in zip(d["doc_id"], d["text"], strict=True)}
    groups = brute_groups(fps)
    rows = QUERIES["op7_simhash_dedup"](spark, "/root/testdata/sf0.001").collect()
    assert {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in rows} == {i: (f"{fps[i]:016x}", groups[i]) for i in fps}


def test_edge_texts(spark, make_docs):
    texts = [None, "", " \t\n", "One", "one", "a b", "A B c", "a b c d", " x y z", "a b c d"]
    rows = {r["doc_id"]: r for r in near_duplicates(make_docs(texts)).collect()}
    fps = {i: brute_fingerprint(t) for i, t in enumerate(texts)}
    assert {i: r["fingerprint"] for i, r in rows.items()} == {i: f"{f:016x}" for i, f in fps.items()}
    assert {i: r["component_id"] for i, r in rows.items()} == brute_groups(fps)
    assert near_duplicates(make_docs(texts).limit(0)).count() == 0


def test_crowded_blocks_give_the_same_components(spark):
    rng = random.Random(5)
    fps = set()
    for _ in range(6):
        base = rng.getrandbits(64)
        for _ in range(80):
            x = base
            for _ in range(rng.randint(0, 4)):
                x ^= 1 << rng.randrange(64)
            fps.add(x)
    fps = dict(enumerate(sorted(fps)))
    rows = [(int(np.uint64(f).astype(np.int64)), i) for i, f in fps.items()]
    classes = spark.createDataFrame(rows, "fp long, node long")
    want = brute_groups(fps)
    for limit in (2, 10, 1000):
        found = {r["node"]: r["component"] for r in connected_components(close_pairs(classes, block_limit=limit)).collect()}
        assert {i: found.get(i, i) for i in fps} == want


def test_components_on_a_long_path(spark):
    n = 300
    order = list(range(n))
    random.Random(1).shuffle(order)
    edges = [(order[i], order[i + 1]) for i in range(n - 1)] + [(1000, 1001), (1001, 1001), (None, 4)]
    found = {r["node"]: r["component"] for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {**{i: 0 for i in range(n)}, 1000: 1000, 1001: 1000}


def test_one_of_each_group_stays(spark, make_docs):
    docs = make_docs([(3, "a b c d e"), (1, "a b c d e"), (2, "other words are here now"), (2, "other words are here now"), (None, "a b c d e")]).withColumn("fp", F.lit(1))
    kept = keep_one_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted((r["doc_id"] or 0) for r in kept.collect()) == [0, 1, 2]


def test_one_id_with_two_texts(spark, make_docs):
    """Groups that share an id stay apart: no text goes for the sake of another."""
    a, b = "a b c d e f g h", "some other words that are here now"
    rows = [(1, a), (1, b), (2, a), (3, b), (4, "a third text of its own"), (None, b), (5, "q r s t u v"), (5, "q r s t u v")]
    docs = make_docs(rows).withColumn("component", F.lit("own")).withColumn("first", F.lit(0))
    got = sorted((r["doc_id"] or 0, r["fingerprint"], r["component_id"]) for r in near_duplicates(docs).collect())
    fps = [brute_fingerprint(t) for _, t in rows]
    groups = brute_groups(dict(enumerate(fps)))
    least = {g: min(rows[i][0] for i in groups if groups[i] == g and rows[i][0] is not None) for g in groups.values()}
    assert got == sorted((rows[i][0] or 0, f"{fps[i]:016x}", least[groups[i]]) for i in range(len(rows)))
    kept = sorted((r["doc_id"] or 0, r["text"]) for r in keep_one_of_each(docs).collect())
    assert kept == sorted([(1, a), (1, b), (4, "a third text of its own"), (0, b), (5, "q r s t u v")])
    assert keep_one_of_each(docs).columns == docs.columns and keep_one_of_each(docs.limit(0)).count() == 0
