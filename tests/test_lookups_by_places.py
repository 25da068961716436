"""Edits whose words are looked up by narrow rows: the same rows as the row-wise way, also on repeated and null keys."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tixprep import schema as S
from tixprep.operators import augment as A

WORDS = ["alpha", "beta", "gamma", "delta", "it", "x1", "epsilon", "zeta"]


def _lexicon(spark, extra=()):
    groups = [("alpha", 1), ("beta", 1), ("gamma", 1), ("delta", 2), ("epsilon", 2), ("zeta", 3), ("eta", 3), ("alpha", 3), *extra]
    return A.synonym_lexicon(spark.createDataFrame([(g, w) for w, g in groups], "synset int, lemma string"))


def _rows(spark):
    r = random.Random(5)
    rows = []
    for i in range(60):
        words = [r.choice(WORDS) for _ in range(r.choice([0, 1, 2, 5, 30]))]
        key = None if i % 17 == 0 else i - i % 3 % 2
        lab = ("a" if i < 50 else "b", "s" if i % 9 else "t", None if i % 13 == 0 else "g" if i % 4 else "h")
        f = ["  ".join(words), "delta zeta [SEP]" if i % 11 == 0 else " ".join(reversed(words)), "p", "c", "l", "u", "o"]
        rows.append((key, S.SEP.join(f) if i % 5 else "one alpha", f[0], f[1], *lab, i % 2 == 0))
    return spark.createDataFrame(rows, f"k long, t string, {S.SHORT} string, {S.DESC} string, {', '.join(c + ' string' for c in S.TARGETS)}, heavy boolean")


def _bag(df):
    return Counter(map(tuple, df.select(*sorted(df.columns)).collect()))


@pytest.mark.parametrize("field_aware", [False, True])
def test_chain(spark, monkeypatch, field_aware):
    d, lex = _rows(spark), _lexicon(spark)
    new = _bag(A.oversample_chain(d, lex, "t", "k", field_aware=field_aware))
    monkeypatch.setattr(A, "one_word_synonyms", lambda _: False)
    assert new == _bag(A.oversample_chain(d, lex, "t", "k", field_aware=field_aware))


def test_copies(spark, monkeypatch):
    d, lex = _rows(spark), _lexicon(spark)
    fast = lambda: _bag(A.fast_augment(d, lex, "t", F.col("k"), F.col("heavy")))
    rare = lambda: _bag(A.augment_rare_rows(d, lex, "t", "k"))
    new = fast(), rare()
    monkeypatch.setattr(A, "one_word_synonyms", lambda _: False)
    assert new == (fast(), rare())


def test_ratio_with_a_repeated_key(spark):
    d = spark.createDataFrame([(1, "alpha beta gamma delta"), (1, "alpha beta gamma delta"), (2, "it"), (None, "zeta")], "k long, t string")
    out = A.synonym_replace_ratio(d, _lexicon(spark), "t", F.col("k"), "r", 0.5).collect()
    one = [r.t for r in out if r.k == 1]
    assert len(out) == 4 and one[0] == one[1] and sum(a != b for a, b in zip(one[0].split(), "alpha beta gamma delta".split(), strict=True)) == 2


def test_synonyms_of_several_words(spark):
    assert A.one_word_synonyms(_lexicon(spark))
    assert not A.one_word_synonyms(_lexicon(spark, [("ink_jet", 1)]))
