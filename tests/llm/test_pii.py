import hashlib
import re

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from tixprep.llm.pii import mask_pii, pii_report


def luhn(d):
    return sum((2 * int(c) - 9 * (2 * int(c) > 9)) if i % 2 else int(c) for i, c in enumerate(reversed(d))) % 10 == 0


def brute(text):
    text = text or ""
    digits = lambda s: re.sub("[^0-9]", "", s)
    rules = [("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda s: True),
             ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda s: all(int(p) <= 255 for p in s.split("."))),
             ("card", r"[0-9]([\x20-]?[0-9])+", lambda s: 16 <= len(digits(s)) <= 19 and luhn(digits(s))),
             ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda s: 8 <= len(digits(s)) <= 15)]
    return [(k, m.start(), m.end()) for k, p, ok in rules for m in re.finditer(p, text) if ok(m.group())]


def as_rows(df):
    return {r["doc_id"]: r for r in df.collect()}


def agrees(rows, texts):
    for doc, text in texts.items():
        base = brute(text)
        r = rows[doc]
        assert [r[f"n_{k}"] for k in ("email", "ip", "card", "phone")] == [sum(s[0] == k for s in base) for k in ("email", "ip", "card", "phone")], doc
        assert r["base_sha256"] == hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in base).encode()).hexdigest(), doc
        assert set(filter(None, r["spans"].split(","))) >= {f"{k}:{a}:{b}" for k, a, b in base}


EDGE = [None, "", "a@b.cd+x@d.e", "a@b..c d@e.f.g.", "é😀 x@y.zz 1.2.3.4.5.6.7.8 256.1.1.1 0001.02.3.255 1.2.3", "@a.b", "x@@y.z q@-.-",
        "4111 1111 1111 1111", "4111-1111-1111-1111 9", "4111  1111 1111 1111", "41111111111111111", "7992739871300000000 +1 (017) 555-7713 rethsh",
        "+1.2.3.4.5.6.7.8 ++1 23456789 +123456789012345678 +1()-2345678", "1" * 20000, "12 " * 6000 + "x", "a" * 30000 + "@", "1." * 9000,
        "+1" * 5000, "a@b.c" * 300, "1.1.1.1 " * 900, "x.1.2.3.4@h.i-j.k 5-5", "٣٣٣ １２３４", "\t+4 4444\t4444 4"]


def test_edge_texts(spark, make_docs):
    agrees(as_rows(pii_report(make_docs(EDGE))), dict(enumerate(EDGE)))
    assert pii_report(make_docs(EDGE).limit(0)).count() == 0


def test_whole_table_against_brute_force(spark):
    from tixprep.llm.queries import QUERIES
    t = pq.read_table("/root/testdata/sf0.01/documents.parquet").to_pydict()
    texts = dict(zip(t["doc_id"], t["text"], strict=True))
    rows = as_rows(QUERIES["op8_pii"](spark, "/root/testdata/sf0.01"))
    agrees(rows, texts)
    assert sum(r["n_card"] for r in rows.values()) > 0


def test_added_kinds_need_checksum_or_context(spark, make_docs):
    texts = ["pay to DE89 3704 0044 0532 0130 00 now", "DE88 3704 0044 0532 0130 00", "my ssn is 123-45-6789", "part 123-45-6789", "ssn 000-45-6789"]
    rows = as_rows(pii_report(make_docs(texts)))
    assert "iban:7:34" in rows[0]["spans"].split(",") and "iban" not in rows[1]["spans"]
    assert "ssn:10:21" in rows[2]["spans"].split(",") and "ssn" not in rows[3]["spans"] and "ssn" not in rows[4]["spans"]
    scores = [as_rows(pii_report(make_docs([t])))[0]["scores"] for t in ("x 1.2.3.4", "host 1.2.3.4")]
    assert scores == ["ip:2:9:70", "ip:5:12:95"]


def test_masking(spark, make_docs):
    docs = make_docs(["é a@b.cd, 4111 1111 1111 1111!", None, "", "clean 12"]).withColumn("pii", F.lit(1))
    out = mask_pii(docs)
    assert out.columns == docs.columns
    assert {r["doc_id"]: r["text"] for r in out.collect()} == {0: "é <EMAIL>, <CARD>!", 1: None, 2: "", 3: "clean 12"}
