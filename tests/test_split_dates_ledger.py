import datetime as dt
import hashlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tixprep.operators import dates as D
from tixprep.operators.ledger import ChunkLedger
from tixprep.operators.sampling import stratified_split_by_source


def brute_split(rows, share=0.1, seed=42):
    """(val sources, quota per class): whole sources in hash order within each class's quota."""
    sid = lambda r: str(r[1]) if r[1] is not None else "\0" + str(r[0])
    own, size = defaultdict(set), Counter()
    for r in rows:
        own[sid(r)].add(r[2])
        size[sid(r)] += 1
    stratum = {s: min(c) for s, c in own.items()}
    n = Counter()
    for s, c in stratum.items():
        n[c] += size[s]
    total = sum(n.values())
    nv = -(-total * 10 // 100) if share == 0.1 else None
    nt = total - nv

    def allocate(counts, draws):
        tot = sum(counts.values())
        fl = {c: draws * k // tot for c, k in counts.items()}
        order = sorted(counts, key=lambda c: (-(draws * counts[c] % tot), c))
        for c in order[:draws - sum(fl.values())]:
            fl[c] += 1
        return fl
    train = allocate(dict(n), nt)
    quota = allocate({c: n[c] - train[c] for c in n}, nv)
    u = lambda s: int(hashlib.md5(f"{seed}|{s}|split".encode()).hexdigest()[:8], 16)
    val = set()
    for c in n:
        run = 0
        for s in sorted((s for s in stratum if stratum[s] == c), key=lambda s: (u(s), s)):
            run += size[s]
            if run > quota[c]:
                break
            val.add(s)
    return {r[0]: "val" if sid(r) in val else "train" for r in rows}, quota


def test_split_keeps_sources_whole(spark):
    import random
    rng = random.Random(1)
    rows, key = [], 0
    for source in range(120):
        label = rng.choice("aaabbc")
        for _ in range(rng.choice([1, 1, 2, 3, 9])):
            rows.append((key, source if rng.random() > 0.02 else None, label if rng.random() > 0.01 else "z"))
            key += 1
    rows += [(key + 100 + i, 2000 + i, "z") for i in range(3)]
    rows += [(key + i, 1000, "b") for i in range(60)]  # one source larger than its quota
    df = spark.createDataFrame(rows, "key int, source int, label string").repartition(4)
    want, quota = brute_split(rows)
    got = stratified_split_by_source(df, "label", "source", "key")
    assert got.columns == ["key", "source", "label", "split"]
    assert {r["key"]: r["split"] for r in got.collect()} == want
    sides = defaultdict(set)
    for k, s, _ in rows:
        if s is not None:
            sides[s].add(want[k])
    assert all(len(x) == 1 for x in sides.values())


DATES = [
    ("2024-03-05", (2024, 3, 5)), ("2024/03/05 07:08", (2024, 3, 5, 7, 8)), ("2024.3.5", (2024, 3, 5)), ("2024-03-05T07:08:09Z", (2024, 3, 5, 7, 8, 9)),
    ("20240305", (2024, 3, 5)), ("5 Mar 2024", (2024, 3, 5)), ("05-March-2024 11:00 PM", (2024, 3, 5, 23)), ("Mar 5, 2024", (2024, 3, 5)), ("March 5 2024 12:30 am", (2024, 3, 5, 0, 30)),
    (" 2024-03-05 ", (2024, 3, 5)), ("2024-13-05", None), ("2024-02-30", None), ("2024-03/05", None), ("31/31/2024", None), ("Foo 5 2024", None), ("2024-03-05 25:00", None),
    ("2024-03-05 13:00 PM", None), ("", None), ("soon", None), (None, None), ("5.3.24", (2024, 5, 3)), ("5.3.71", (1971, 5, 3)), ("2024-03-05 07:08:60", None),
    ("2024-03-05 07:08:09.123", (2024, 3, 5, 7, 8, 9))]


def test_known_shapes(spark):
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(DATES)], "id int, t string")
    got = {r.id: r.at for r in D.parse_dates_inferred(df, "t", "at").collect()}
    for i, (t, want) in enumerate(DATES):
        assert got[i] == (None if want is None else dt.datetime(*want)), t
    report = {r["shape"]: (r["n"], r["parsed"]) for r in D.date_report(df, "t").collect()}
    assert report["9999-99-99"] == (4, 2) and report["A"] == (1, 0) and sum(n for n, _ in report.values()) == len(DATES) - 1


def test_order_of_day_and_month_comes_from_the_column(spark):
    day = [(f"{d:02d}/{m:02d}/2023",) for d in (3, 14, 25) for m in (2, 11)]
    month = [(f"{m:02d}-{d:02d}-2023 10:00",) for d in (3, 14, 25) for m in (2, 11)]
    df = spark.createDataFrame(day + month + [("1.2.23",), ("25/12/2023",), ("12/25/2023",)], "t string")
    order = D.infer_order(df, "t")
    assert order.day_first == {("/", 4): True, ("-", 4): False, (".", 2): False}
    got = {r.t: r.at for r in D.parse_dates_inferred(df, "t", "at").collect()}
    assert got["03/02/2023"] == dt.datetime(2023, 2, 3) and got["02-03-2023 10:00"] == dt.datetime(2023, 2, 3, 10)
    assert got["25/12/2023"] == got["12/25/2023"] == dt.datetime(2023, 12, 25)  # only one order is possible
    assert D.infer_order(df.filter("t = '1.2.23'"), "t", default_day_first=True).day_first == {(".", 2): True}
    assert D.infer_order(df.limit(0), "t").day_first == {} and D.parse_dates_inferred(df.limit(0), "t").count() == 0


def failing(bad):
    def fn(texts):
        if any(t and t.startswith(tuple(bad)) for t in texts):
            raise ValueError("no service for " + texts[0])
        return [None if t is None else t.upper() for t in texts]
    return fn


@pytest.fixture
def folder(spark):
    from tixprep.session import table_folder
    import uuid
    return f"{table_folder(spark)}/ledger-{uuid.uuid4().hex}"


def test_failed_chunks_lose_nothing(spark, folder):
    rows = [(i, f"t{i:03d}") for i in range(57)] + [(57, None), (58, ""), (57, "same key")]
    df = spark.createDataFrame(rows, "id int, text string").repartition(4)
    book = ChunkLedger(spark, folder, ["id"])
    book.start(df, chunk=10)
    assert {r["status"] for r in book.ledger().collect()} == {"open"} and book.results().count() == 0
    first = {r["chunk"]: r for r in book.run(failing(["t015", "t042"]), wave_chunks=2).collect()}
    assert len(first) == 6 and [first[c]["status"] for c in range(6)] == ["done", "failed", "done", "done", "failed", "done"]
    assert first[1]["error"] == "ValueError: no service for t010" and first[0]["error"] is None
    assert book.results().count() == 40
    calls, still_failing = spark.sparkContext.accumulator(0), failing(["t042"])

    def counted(texts):
        calls.add(1)
        return still_failing(texts)
    again = {r["chunk"]: r for r in book.run(counted).collect()}
    assert calls.value == 2 and again[1]["status"] == "done" and (again[4]["status"], again[4]["attempts"]) == ("failed", 2)
    book.start(df.limit(1), chunk=3)  # an input that is there is not replaced
    last = book.run(failing([]))
    assert {r["status"] for r in last.collect()} == {"done"}
    got = sorted(((r["id"], r["new_text"]) for r in book.results().collect()), key=str)
    assert got == sorted(((i, None if t is None else t.upper()) for i, t in rows), key=str)
    assert book.run(failing(["t"])).filter("status = 'done'").count() == 6  # nothing left to do


def test_wrong_number_of_texts_and_empty_input(spark, folder):
    book = ChunkLedger(spark, folder, ["id"])
    book.start(spark.createDataFrame([(1, "a"), (2, "b")], "id int, text string"), chunk=5)
    assert book.run(lambda t: t[:1]).first()["error"] == "ValueError: 1 texts for 2"
    empty = ChunkLedger(spark, folder + "-empty", ["id"])
    empty.start(spark.createDataFrame([], "id int, text string"))
    assert empty.run(lambda t: t).count() == 0 and empty.results().count() == 0
