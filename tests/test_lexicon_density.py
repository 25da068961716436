import numpy as np
from pyspark.sql import functions as F

from tixprep.operators import lexicon as LX
from tixprep.operators import profile as P

PAIRS = [(1, "dog"), (1, "Hound"), (1, "canis_familiaris"), (2, "run"), (2, "sprint"), (3, "leave"), (3, "depart"), (4, "leaf"), (4, "foliage"), (5, "Ing"),
         (6, "goose"), (6, "bird"), (7, "box"), (7, "case"), (8, "church"), (8, "chapel"), (9, "man"), (9, "male"), (10, "fly"), (10, "soar"), (11, "hope"), (11, "wish"),
         (12, "fast"), (12, "quick"), (13, "geese"), (13, "flock"), (None, "ghost"), (14, None)]


def synonyms(spark, words, exceptions=None):
    pairs = spark.createDataFrame(PAIRS, "synset int, lemma string")
    exc = None if exceptions is None else spark.createDataFrame(exceptions, "word string, form string")
    return {r["word"]: r["synonyms"] for r in LX.inflected_lexicon(pairs, spark.createDataFrame([(w,) for w in words], "word string"), exc).collect()}


def brute_forms(word, entries, exceptions):
    rules = lambda forms: [f[:len(f) - len(a)] + b for f in forms for a, b in LX.DETACHMENT_RULES if f.endswith(a) and f[:len(f) - len(a)] + b]
    if word in exceptions:
        return {f for f in (word, *exceptions[word]) if f in entries}
    forms = rules([word])
    found = {f for f in (word, *forms) if f in entries}
    while not found and forms:
        forms = rules(forms)
        found = {f for f in forms if f in entries}
    return found


def test_inflected_words_find_their_entries(spark):
    words = ["dogs", "dog", "running", "leaves", "leaving", "boxes", "churches", "women", "men", "flies", "hoped", "hoping", "fastest", "faster", "geese", "ing", "cats", "s", "", None,
             "dogses", "hopings", "hopinged", "mans", "dogss"]
    got = synonyms(spark, words)
    assert got["dogs"] == ["canis familiaris", "dog", "hound"] and got["dog"] == ["canis familiaris", "hound"]
    assert got["leaves"] == ["depart", "foliage", "leaf", "leave"]  # the noun's and the verb's entry
    assert got["flies"] == ["fly", "soar"] and got["hoped"] == ["hope", "wish"] and got["fastest"] == ["fast", "quick"] and got["men"] == ["male", "man"]
    assert got["geese"] == ["flock"] and "cats" not in got and "s" not in got and "" not in got
    with_table = synonyms(spark, words, [("geese", "goose"), ("running", "run"), ("women", "woman"), ("men", "nothing")])
    assert with_table["geese"] == ["bird", "flock", "goose"] and with_table["running"] == ["run", "sprint"] and "women" not in with_table and "men" not in with_table
    entries = {lemma.lower() for _, lemma in PAIRS if lemma}
    for exceptions in ({}, {"geese": ["goose"], "men": ["nothing"]}):
        rows = LX.lexical_forms(spark.createDataFrame([(w,) for w in words], "word string"), spark.createDataFrame([(e,) for e in entries], "word string"),
                                spark.createDataFrame([(w, f) for w, fs in exceptions.items() for f in fs], "word string, form string") if exceptions else None).collect()
        assert sorted((r["word"], r["form"]) for r in rows) == sorted((w, f) for w in set(words) - {None} for f in brute_forms(w, entries, exceptions))


def test_lookup_on_empty_tables(spark):
    assert synonyms(spark, []) == {}
    none = spark.createDataFrame([], "synset int, lemma string")
    assert LX.inflected_lexicon(none, spark.createDataFrame([("dogs",)], "word string")).count() == 0


def test_binned_density_keeps_its_bound(spark):
    rng = np.random.default_rng(4)
    for values in (np.concatenate([rng.normal(0, 1, 2000), rng.normal(8, 0.3, 300)]), np.append(rng.exponential(3, 1500), 4000.0), np.array([1.0, 1.0, 2.0])):
        df = spark.createDataFrame([(float(v),) for v in values] + [(None,)], "x double")
        for nodes in (P.NODES_PER_POINT, 3):
            exact = {r.point: r for r in P.density_curve(df, "x").collect()}
            got = P.density_curve_binned(df, "x", nodes_per_point=nodes).collect()
            assert len(got) == 200 and all(abs(r.density - exact[r.point].density) <= r.error_bound + 1e-15 and abs(r.x - exact[r.point].x) < 1e-9 for r in got)
    for values in ([], [2.0], [2.0, 2.0]):
        assert P.density_curve_binned(spark.createDataFrame([(v,) for v in values], "x double"), "x").count() == 0


def test_binned_density_work_does_not_grow_with_values(spark):
    """The curve is summed over the nodes only."""
    df = spark.range(200000).select((F.col("id") / 7.0).alias("x"))
    sides = P.density_curve_binned(df, "x", gridsize=20, nodes_per_point=10)
    assert sides.count() == 20
    total = sides.agg(F.sum("density")).first()[0] * (sides.agg(F.max("x") - F.min("x")).first()[0] / 19)
    assert abs(total - 1) < 0.02
