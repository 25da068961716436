import re

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from tixprep.llm.licenses import TEMPLATES, THRESHOLD, find_licenses, find_notices, key_words


def grams(text):
    w = re.sub("[^a-z0-9]+", " ", text.lower()).split()
    return {(a, b) for a, b in zip(w, w[1:], strict=False)}


def brute(text):
    """Every unit against every template, without size bounds or key words."""
    if text is None:
        return []
    lines = text.split("\n")
    units = [(i, k) for k in (1, 2, 3) for i in range(len(lines) - k + 1)] + ([(0, len(lines))] if len(lines) > 3 else [])
    out = []
    for i, k in units:
        a = grams("\n".join(lines[i:i + k]))
        for name, texts in TEMPLATES.items():
            for t in texts:
                b = grams(t)
                dice = 2 * len(a & b) / (len(a) + len(b)) if a else 0
                if dice >= THRESHOLD:
                    out.append((name, round(dice, 9), i, k))
    return sorted(out, key=lambda x: (-x[1], x[0], x[2], x[3]))


def agrees(rows, texts):
    for r in rows:
        want = brute(texts[r["doc_id"]])
        assert [(f["license"], round(f["dice"], 9), f["line"], f["n_lines"]) for f in r["found"]] == want, texts[r["doc_id"]][:200]
        assert r["n_found"] == len(want) and r["license"] == (want[0][0] if want else None)


def test_whole_table_against_brute_force(spark):
    t = pq.read_table("/root/testdata/sf0.01/documents.parquet").to_pydict()
    rows = find_licenses(spark.read.parquet("/root/testdata/sf0.01/documents.parquet")).collect()
    assert len(rows) == len(t["doc_id"]) and sum(r["license"] is not None for r in rows) > 10
    agrees(rows, dict(zip(t["doc_id"], t["text"], strict=True)))


def test_edge_texts(spark, make_docs):
    notice = TEMPLATES["MIT"][2]
    words = notice.split()
    texts = [None, "", "\n\n", "licensed", notice.upper(), "\n".join([" ".join(words[:10]), " ".join(words[10:])]),
             "x\n" + "\n".join([" ".join(words[:8]), "  *  " + " ".join(words[8:16]), "// " + " ".join(words[16:])]) + "\nend",
             " ".join(words[:len(words) // 2]), "Licensed under CC BY-NC 4.0! Released under the MIT License.", "word " * 5000 + "license",
             "\n".join(["Licensed", "under", "the", "Apache", "License,", "Version", "2.0."]), "Licensed under the MIT License.\nLicensed under the MIT License.",
             "the MIT the MIT the MIT License", "éLicensed under CC BY 4.0"]
    docs = make_docs(texts).withColumn("license", F.lit(1))
    agrees(find_licenses(docs).collect(), dict(enumerate(texts)))
    assert find_licenses(docs.limit(0)).count() == 0


def test_key_words_cover_every_template():
    for texts in TEMPLATES.values():
        for t in texts:
            free = [g for g in grams(t) if not set(g) & set(key_words())]
            assert len(free) < THRESHOLD / (2 - THRESHOLD) * len(grams(t))


def window_brute(text):
    """Every window of words against every template, without key words; of a license's windows that
    overlap, the best."""
    w = re.sub("[^a-z0-9]+", " ", (text or "").lower()).split()
    places = list(zip(w, w[1:], strict=False))
    out = []
    for name, texts in TEMPLATES.items():
        windows = set()
        for t in texts:
            words = re.sub("[^a-z0-9]+", " ", t.lower()).split()
            b = grams(t)
            most = int(len(b) * (2 - THRESHOLD) / THRESHOLD + 1e-9) + len(words) - 1 - len(b)
            for i in range(len(places)):
                for k in range(1, min(most, len(places) - i) + 1):
                    a = set(places[i:i + k])
                    dice = 2 * len(a & b) / (len(a) + len(b))
                    if dice >= THRESHOLD and places[i] in b and places[i + k - 1] in b:
                        windows.add((-dice, i, k + 1))
        kept = []
        for dice, i, n in sorted(windows):
            if all(i >= j + m or j >= i + n for _, j, m in kept):
                kept.append((dice, i, n))
        out += [(name, round(-d, 9), i, n) for d, i, n in kept]
    return sorted(out, key=lambda x: (-x[1], x[0], x[2], x[3]))


def test_notices_wrapped_and_embedded(spark, make_docs):
    """Notices over many lines, inside longer lines, twice in a text, changed and cut short."""
    texts = [None, "", "license", "word " * 300 + "license"]
    for bodies in TEMPLATES.values():
        for t in bodies:
            words = t.split()
            texts += [t, "\n".join(words), "Before it, some words. " + t + " And more words follow after it, as in any text.",
                      "\n".join(" * " + " ".join(words[k:k + 4]) for k in range(0, len(words), 4)), " ".join(words[:len(words) * 3 // 4]),
                      "one\ntwo\n" + " ".join([*words[:len(words) // 2], "really", *words[len(words) // 2:]]) + "\nthree", t + " " + t + "\n\nother words\n" + t, "_" + t.replace(" ", "_") + "_"]
    texts += [" ".join(t for bodies in TEMPLATES.values() for t in bodies)]
    rows = find_notices(make_docs(texts)).collect()
    assert len(rows) == len(texts)
    for r in rows:
        want = window_brute(texts[r["doc_id"]])
        assert [(f["license"], round(f["dice"], 9), f["word"], f["n_words"]) for f in r["found"] or []] == want, texts[r["doc_id"]]
        assert r["n_found"] == len(want) and r["license"] == (want[0][0] if want else None)
    words = TEMPLATES["MIT"][2].split()
    two = ["\n".join(" ".join(words[k:k + 5]) for k in range(0, len(words), 5)) + "\nmore\nlines", "All of this is free to use. Licensed under the MIT License. See the file for more on that."]
    found = {r["doc_id"]: r for r in find_notices(make_docs(two)).collect()}
    assert [(found[k]["license"], found[k]["dice"], found[k]["n_found"]) for k in (0, 1)] == [("MIT", 1.0, 1), ("MIT", 1.0, 1)]
    assert find_notices(make_docs(texts).limit(0)).count() == 0
