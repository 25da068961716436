from collections import Counter

from pyspark.sql import functions as F

from tixprep.operators import augment as A


def _lex(spark):
    pairs = [(1, "printer"), (1, "Copier"), (1, "ink_jet"), (2, "printer"), (2, "device"), (3, "alone")]
    return A.synonym_lexicon(spark.createDataFrame(pairs, "synset int, lemma string"))


def test_lexicon_semantics(spark):
    lx = {r.word: r.synonyms for r in _lex(spark).collect()}
    assert lx["printer"] == sorted(["copier", "ink jet", "device"])
    assert lx["copier"] == sorted(["printer", "ink jet"])
    assert lx["ink_jet"] == sorted(["printer", "copier", "ink jet"])
    assert "alone" not in lx  # a word alone in its synset has no synonym


def test_single_edit_changes_at_most_one_word(spark):
    texts = [(i, "the printer  is broken printer") for i in range(50)] + [(99, "")]
    d = spark.createDataFrame(texts, "id long, t string")
    out = {r.id: r.t for r in A.synonym_replace(d, _lex(spark), "t", F.col("id"), "x").collect()}
    assert out[99] == ""
    changed = 0
    for i in range(50):
        a, b = "the printer is broken printer".split(), out[i].split(" ")
        if a != b:
            changed += 1
            assert sum(x != y for x, y in zip(a, b)) == 1 or len(b) == len(a) + 1
    assert 0 < changed < 50


def test_deletion_and_swap_invariants(spark):
    rows = [(i, " ".join(f"w{j}" for j in range(i % 12))) for i in range(200)]
    d = spark.createDataFrame(rows, "id long, t string")
    dl = {r.id: r.t for r in A.random_deletion(d, "t", F.col("id"), "d").collect()}
    sw = {r.id: r.t for r in A.random_swap_segments(d, "t", F.col("id"), "s").collect()}
    for i, t in rows:
        w = t.split()
        if len(w) < 4:
            assert dl[i] == t
        else:
            kept = dl[i].split(" ")
            assert kept and set(kept) <= set(w)
        if len(w) < 3:
            assert sw[i] == t
        else:
            assert Counter(sw[i].split(" ")) == Counter(w)


def _simulate_chain(labels, factor=0.3, mult=2):
    rows = list(labels)
    for k in range(3):
        cnt = Counter(r[k] for r in rows)
        mx = max(cnt.values())
        minor = {c for c, n in cnt.items() if n < mx * factor and c != "Other"}
        rows = rows + [r for r in rows if r[k] in minor for _ in range(mult)]
    return Counter(rows)


def test_oversample_chain_matches_direct_passes(spark):
    labels = ([("a", "x", "p")] * 40 + [("a", "y", "q")] * 5 + [("b", "x", "q")] * 6 + [("Other", "z", "p")] * 3
              + [("c", "z", "r")] * 2)
    d = spark.createDataFrame([(i, *l, "w1 w2 w3") for i, l in enumerate(labels)],
                              "id long, category string, subcategory string, assignment_group string, t string")
    lx = _lex(spark)
    out = A.oversample_chain(d, lx, "t", "id")
    got = Counter((r.category, r.subcategory, r.assignment_group) for r in out.collect())
    assert got == _simulate_chain(labels)


def _sentences(spark, n=40):
    return spark.createDataFrame([(i, f"printer device row {i} printer copier device end") for i in range(n)], "id long, t string")


def test_seeds_differ_and_repeat(spark):
    d, lx = _sentences(spark), _lex(spark)
    edits = {
        "ratio": lambda s: A.synonym_replace_ratio(d, lx, "t", F.col("id"), "x", 0.3, seed=s),
        "insert": lambda s: A.random_insertion(d, lx, "t", F.col("id"), "x", seed=s),
        "replace": lambda s: A.synonym_replace(d, lx, "t", F.col("id"), "x", seed=s),
        "fast": lambda s: A.fast_augment(d, lx, "t", F.col("id"), F.col("id") % 2 == 0, seed=s)}
    for name, run in edits.items():
        one, again, other = ({r.id: r.t for r in run(s).collect()} for s in (1, 1, 2))
        assert one == again and one != other, name


def test_counts_above_one(spark):
    d, lx = _sentences(spark), _lex(spark)
    base = {r.id: r.t.split(" ") for r in d.collect()}
    words = lambda out: {r.id: r.t for r in out.collect()}
    three = words(A.random_insertion(d, lx, "t", F.col("id"), "x", n=3))
    grown = [len(three[i].split(" ")) - len(base[i]) for i in base]
    assert max(grown) >= 3 and min(grown) >= 0
    one, many = words(A.synonym_replace(d, lx, "t", F.col("id"), "x")), words(A.synonym_replace(d, lx, "t", F.col("id"), "x", replace_count=4))
    changed = lambda out: sum(a != b for i in base for a, b in zip(base[i], out[i].split(" "), strict=False))
    assert changed(many) > changed(one) > 0


def test_null_labels_keep_their_rows(spark):
    rows = [(i, "printer one two three", "a" if i < 40 else "b", "x", "g") for i in range(44)] + [(90, "printer here", None, "x", "g"), (91, "printer here", None, None, None)]
    d = spark.createDataFrame(rows, "id long, t string, category string, subcategory string, assignment_group string")
    out = A.oversample_chain(d, _lex(spark), "t", "id").collect()
    per = Counter(r.id for r in out)
    assert per[90] == per[91] == 1 and per[41] == 3 and per[0] == 1
    assert len({(r.id, r.aug_no) for r in out}) == len(out)
    flags = {r.id: (r.is_rare, r.is_heavy) for r in A.rare_flags(d, min_count=10, heavy_below=5).collect()}
    assert len(flags) == 46 and flags[91] == (False, False) and flags[41] == (True, True)


def test_many_copies_have_distinct_paths(spark):
    factors = spark.createDataFrame([("a", "x", "g", 120, 3, 1)], "category string, subcategory string, assignment_group string, f1 int, f2 int, f3 int")
    d = spark.createDataFrame([(1, "printer ink", "a", "x", "g")], "id long, t string, category string, subcategory string, assignment_group string")
    out = A.oversample_chain(d, _lex(spark), "t", "id", factors=factors)
    assert out.count() == 360 and out.select("aug_no").distinct().count() == 360
