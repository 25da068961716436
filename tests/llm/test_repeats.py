import hashlib
import random

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tixprep.llm import repeats as R


def brute(docs, length=100):
    """docs: (id, text) in order of ids; rows that repeat an id are one document."""
    first, out = {}, []
    rows = sorted(docs, key=lambda d: (d[0] is None, d[0] or 0))
    for doc, text in rows:
        data = (text or "").encode()
        for p in range(len(data) - length + 1):
            first.setdefault(data[p:p + length], (doc is None, doc, p))
    for doc, text in docs:
        data = (text or "").encode()
        gone = bytearray(len(data))
        for p in range(len(data) - length + 1):
            if first[data[p:p + length]] != (doc is None, doc, p):
                gone[p:p + length] = b"\x01" * length
        kept = bytes(b for b, g in zip(data, gone, strict=True) if not g)
        spans = sum(1 for k in range(len(gone)) if gone[k] and (k == 0 or not gone[k - 1]))
        out.append((doc, len(data), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def got(df):
    return sorted([tuple(r[:5]) for r in df.collect()], key=str)


def texts_with_repeats(seed, n=60):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdeé ") for _ in range(rng.randint(1, 9)))
    text = lambda k: " ".join(word() for _ in range(k))
    line, passage = text(14), text(70)
    out = []
    for k in range(n):
        t = text(rng.randint(0, 120))
        for piece in (line, passage, passage[40:], line * 3):
            if rng.random() < 0.3:
                at = rng.randint(0, len(t))
                t = t[:at] + piece + t[at:]
        if out and rng.random() < 0.2:
            t = rng.choice(out)
        if out and rng.random() < 0.2:
            t = rng.choice(out)
            at = rng.randint(0, len(t))
            t = t[:at] + word() + t[at:]
        out.append(t)
    return out + ["a" * 500, "ab" * 300, "a" * 99, "a" * 100, "", None, "x" + "a" * 250, "\x00" * 150, "é" * 80, "ÿ\x00" * 60]


@pytest.mark.parametrize("crowd", [2000, 3, 1])
def test_small_texts(spark, make_docs, crowd):
    texts = texts_with_repeats(4)
    docs = make_docs(texts).withColumn("key", F.lit(1)).repartition(5)
    assert got(R.without_repeats(docs, crowd=crowd)) == brute(list(enumerate(texts)))


def test_tiny_holds_and_chunks(spark, make_docs, monkeypatch):
    texts = texts_with_repeats(9, 40)
    rows = list(enumerate(texts))
    for name, value in (("HELD_ROWS", 7), ("CHUNK_BYTES", 200), ("STRETCH", 256)):
        monkeypatch.setattr(R, name, value)
    import pyarrow as pa
    from tixprep.llm.batches import steps
    monkeypatch.setattr(R, "steps", lambda o: steps(o, 128))
    # the same functions as in the tasks, run here so that the small limits hold
    batch = lambda part: pa.RecordBatch.from_arrays([pa.array([r[0] for r in part], pa.int64()), pa.array([r[1] for r in part], pa.string())], ["key", "text"])
    seen = pa.Table.from_batches([b for k in range(0, len(rows), 9) for b in R._scan(batch(rows[k:k + 9]), 100)]).to_pandas()
    seen = seen.sort_values(["gram", "content", "key", "place"])
    cols = [seen[c].to_numpy() for c in seen.columns]
    stream = (pa.RecordBatch.from_arrays([pa.array(c[k:k + 5]) for c in cols], list(seen.columns)) for k in range(0, len(seen), 5))
    passed = pa.Table.from_batches(list(R._sorted_stream(stream, 4))).to_pandas()
    runs = [tuple(x) for x in passed[passed.kind == R.REPEAT][["key", "place", "count"]].to_numpy()]
    listed = passed[passed.kind != R.REPEAT]
    joined = []
    for doc, part in listed.groupby("key"):
        segs = [{"place": a, "count": b, "gram": c, "kind": d} for a, b, c, d in part[["place", "count", "gram", "kind"]].to_numpy()]
        joined.append(pa.RecordBatch.from_arrays([pa.array([doc], pa.int64()), pa.array([texts[doc]]), pa.array([segs], pa.list_(pa.struct([("place", pa.int32()), ("count", pa.int32()), ("gram", pa.int64()), ("kind", pa.int32())])))], ["key", "text", "segments"]))
    strings = pa.Table.from_batches(list(R._segment_texts(iter(joined), 100)))
    whole = strings.filter(pa.compute.is_valid(strings["data"])).sort_by("gram")
    for b in R._sort_chunks(iter(whole.to_batches(max_chunksize=3)), 100):
        runs += list(zip(*(c.to_pylist() for c in b.columns), strict=True))
    single = strings.filter(pa.compute.is_null(strings["data"])).to_pandas().sort_values(["gram", "second", "key", "place"])
    for _, part in single.groupby(["gram", "second"]):
        runs += [(k, p, 1) for k, p in part[["key", "place"]].to_numpy()[1:]]
    out = []
    for doc, text in rows:
        data = (text or "").encode()
        gone = np.zeros(len(data), bool)
        for k, p, n in runs:
            if k == doc:
                gone[p:p + n + 99] = True
        kept = np.frombuffer(data, np.uint8)[~gone].tobytes()
        out.append((doc, len(data), int(gone.sum()), int((np.diff(np.append(False, gone).astype(int)) == 1).sum()), hashlib.sha256(kept).hexdigest()))
    assert sorted(out, key=str) == brute(rows)


@pytest.mark.parametrize("seed", range(6))
def test_two_stage_sort(seed):
    rng = np.random.default_rng(seed)
    text = rng.integers(1, [3, 4, 30, 257, 2, 3][seed], 400).astype(np.uint16)
    if seed == 5:
        text = np.tile(text[:40], 10)
    text[[50, 120, 399]] = 0
    order, packed = R.two_stage_sort(text, 105)
    padded = [tuple(text[k:k + 105].tolist()) for k in range(len(text))]
    assert sorted(order.tolist()) == list(range(len(text)))
    assert [padded[k] for k in order] == sorted(padded)
    lcp = R.common_prefixes(order, packed, 100)
    for k in range(1, len(order)):
        a, b = padded[order[k - 1]] + (0,) * 105, padded[order[k]] + (0,) * 105
        n = next((q for q in range(100) if a[q] != b[q]), 100)
        assert lcp[k] == n


def test_defined_results(spark, make_docs):
    t = "".join(random.Random(2).choices("abcdef", k=300))
    rows = [(5, t), (5, t), (7, t[50:250]), (None, t), (3, None), (9, "")]
    docs = make_docs(rows)
    out = got(R.without_repeats(docs))
    assert out == brute(rows)
    kept = {r["doc_id"]: (bytes(r["kept"]), [tuple(s) for s in r["spans"]]) for r in R.without_repeats(docs, with_bytes=True).collect()}
    assert kept[7] == (b"", [(0, 200)]) and kept[5] == (t.encode(), []) and kept[3] == (b"", [])
    assert R.without_repeats(docs.limit(0)).count() == 0


def by_place(rows, length=100):
    """As brute, but among rows of one id the smallest place is the earliest, as in the SQL twin."""
    first, out = {}, []
    texts = [((doc is None, doc or 0), doc, (text or "").encode()) for doc, text in rows]
    for order, _, data in texts:
        for p in range(len(data) - length + 1):
            first[data[p:p + length]] = min(first.get(data[p:p + length], (order, p)), (order, p))
    for order, doc, data in texts:
        gone = np.zeros(len(data), bool)
        for p in range(len(data) - length + 1):
            if first[data[p:p + length]] != (order, p):
                gone[p:p + length] = True
        kept = np.frombuffer(data, np.uint8)[~gone].tobytes()
        out.append((doc, len(data), int(gone.sum()), int((np.diff(np.append(False, gone).astype(int)) == 1).sum()), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("crowd", [2000, 3, 1])
def test_rows_that_share_an_id(spark, make_docs, crowd):
    """Different texts without an id or under one id: each is cut by its own repeats alone."""
    rng = random.Random(7)
    text = lambda n: "".join(rng.choices("abcdefgh ", k=n))
    head, shared, tail = text(180), text(150), text(130)
    rows = [(1, head + text(40)), (2, shared), (5, text(300) + shared), (5, text(90)), (5, head + tail), (5, head + text(20) + tail), (6, tail),
            (None, text(400) + shared + text(60)), (None, text(150)), (None, head), (None, head + text(250)), (None, text(10) + tail + head), (None, None), (None, "")]
    rows += [(None, head[:170] + text(200)) for _ in range(6)] + [(8, tail + text(50)) for _ in range(4)]
    # one long beginning that many rows without an id share, and a later place of part of it
    begin = text(220)
    rows += [(None, begin + text(30)) for _ in range(8)] + [(None, "x" + begin[20:]), (None, begin[:160])]
    # last in its batch, shorter than another row of its id
    for part in (1, 4):
        assert got(R.without_repeats(make_docs(rows).repartition(part), crowd=crowd)) == by_place(rows)


def test_a_crowded_beginning_told_in_parts(monkeypatch):
    """One content that fills all that is held, tied in many rows, and later places of it."""
    monkeypatch.setattr(R, "HELD_ROWS", 4)
    rows = [(7, 1, 5, 0, 3, R.COMPARE, r) for r in range(11)] + [(7, 1, 5, 9, 3, R.COMPARE, 2)] + [(7, 1, 6, 0, 3, R.COMPARE, r) for r in range(9)]
    rows += [(7, 2, 4, 1, 3, R.COMPARE, 0), (8, 3, 1, 0, 3, R.COMPARE, 0), (8, 3, 1, 0, 3, R.COMPARE, 1), (9, 4, 1, 5, 2, R.COMPARE, 0), (9, 5, 1, 0, 2, R.COMPARE, 0)]
    import pyarrow as pa
    types = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int64()]
    names = ["gram", "content", "key", "place", "count", "kind", "row"]
    for size in (1, 3, 4, 5, 40):
        parts = [pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*rows[k:k + size], strict=True), types, strict=True)], names) for k in range(0, len(rows), size)]
        out = [tuple(r.values()) for b in R._sorted_stream(iter(parts), 3) for r in b.to_pylist()]
        repeats = sorted((r[2], r[6], r[3]) for r in out if r[5] == R.REPEAT)
        assert repeats == sorted([(5, 2, 9)] + [(6, r, 0) for r in range(9)])
        goes_on = {(r[0], r[1], r[2], r[6], r[3]): r[5] for r in out if r[5] != R.REPEAT}
        assert set(goes_on) == {(7, 1, 5, r, 0) for r in range(11)} | {(7, 2, 4, 0, 1), (9, 4, 1, 0, 5), (9, 5, 1, 0, 0)}
        assert all((kind == R.SPREAD) == (k[0] == 7) for k, kind in goes_on.items())


def test_whole_table_against_brute_force(spark):
    from tixprep.llm.queries import QUERIES
    t = pq.read_table("/root/testdata/sf0.001/documents.parquet").to_pydict()
    assert got(QUERIES["op9_repeats"](spark, "/root/testdata/sf0.001")) == brute(list(zip(t["doc_id"], t["text"], strict=True)))
