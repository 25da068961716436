"""Synonyms of inflected words: a word that is no entry of the lexical table is led back to the entries
it can stem from, by a table of irregular forms and by rules that exchange endings."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tixprep.functions.text import ALPHA_WORD, tokenize_words
from tixprep.session import cut_lineage, dimension

# --- fixed values: endings and what they are exchanged for, nouns, verbs, adjectives -----------
DETACHMENT_RULES = [
    ("s", ""), ("ses", "s"), ("ves", "f"), ("xes", "x"), ("zes", "z"), ("ches", "ch"), ("shes", "sh"), ("men", "man"), ("ies", "y"),
    ("es", "e"), ("es", ""), ("ed", "e"), ("ed", ""), ("ing", "e"), ("ing", ""),
    ("er", ""), ("est", ""), ("er", "e"), ("est", "e"),
]
MOST_ROUNDS = 6  # endings taken off one after the other


def detached(word: Column, rules: Sequence[tuple[str, str]] = DETACHMENT_RULES) -> Column:
    """All different words, not empty, that one rule makes of ``word``."""
    made = [F.when(word.endswith(old) & (F.length(word) > (0 if new else len(old))), F.concat(F.substring(word, F.lit(1), F.length(word) - len(old)), F.lit(new))) for old, new in rules]
    return F.array_distinct(F.array_compact(F.array(*made)))


def lexical_forms(words: DataFrame, entries: DataFrame, exceptions: DataFrame | None = None,
                  rules: Sequence[tuple[str, str]] = DETACHMENT_RULES) -> DataFrame:
    """(word, form): the ``entries`` (word) that each of ``words`` (word) stands for.

    A word with irregular forms (``exceptions``: word, form) stands for those of them that are entries, and for
    itself if it is one. Any other word stands for itself and for what one rule makes of it, as far
    as these are entries; if none is, rules are applied to the results again, until an entry is found,
    nothing is left or ``MOST_ROUNDS`` is reached. Words with no entry are not in the result. Only distinct words are joined,
    never texts."""
    entries = dimension(entries.select(F.col("word").alias("form")).filter(F.col("form").isNotNull()).distinct())
    left = words.select("word").filter(F.col("word").isNotNull()).distinct()
    out = None
    if exceptions is not None:
        irregular = dimension(exceptions.select("word", "form").distinct())
        own = left.join(irregular.select("word").distinct(), "word", "left_semi")
        out = own.select("word", F.col("word").alias("form")).unionByName(own.join(irregular, "word")).distinct().join(entries, "form", "left_semi")
        left = left.join(irregular.select("word").distinct(), "word", "left_anti")
    first = True
    left = cut_lineage(left.select("word", F.col("word").alias("now")))
    for _ in range(MOST_ROUNDS):
        made = left.select("word", F.explode(F.concat(F.array("now") if first else F.array().cast("array<string>"), detached(F.col("now"), rules))).alias("form")).distinct()
        made = cut_lineage(made)
        found = made.join(entries, "form", "left_semi").select("word", "form")
        out = found if out is None else out.unionByName(found)
        left = made.join(found.select("word").distinct(), "word", "left_anti").select("word", F.col("form").alias("now"))
        if first:
            left = left.filter(F.col("now") != F.col("word"))
        first = False
        if left.isEmpty():
            break
    return out.select("word", "form").distinct()


def inflected_lexicon(pairs: DataFrame, words: DataFrame, exceptions: DataFrame | None = None, synset_col: str = "synset", lemma_col: str = "lemma",
                      rules: Sequence[tuple[str, str]] = DETACHMENT_RULES) -> DataFrame:
    """(word, synonyms): for each of ``words`` the members of all synsets of its lexical forms, lower-cased, '_' as a
    blank, without the word itself, sorted. ``pairs`` holds (synset, lemma); synsets have bounded size."""
    p = dimension(pairs.select(F.col(synset_col).alias("synset"), F.col(lemma_col).alias("lemma")).distinct())
    members = p.groupBy("synset").agg(F.collect_set(F.lower(F.regexp_replace("lemma", "_", " "))).alias("members"))
    keyed = p.select("synset", F.lower("lemma").alias("form")).distinct()
    forms = lexical_forms(words, keyed.select(F.col("form").alias("word")), exceptions, rules)
    syns = forms.join(keyed, "form").select("word", "synset").distinct().join(members, "synset").groupBy("word").agg(
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("members")))).alias("all"))
    out = syns.select("word", F.filter("all", lambda x: x != F.col("word")).alias("synonyms"))
    return out.filter(F.size("synonyms") > 0)


def text_words(texts: DataFrame, text_col: str) -> DataFrame:
    """(word): the different alphabetic words of a text column, lower-cased."""
    words = texts.select(F.explode(tokenize_words(F.lower(F.col(text_col)))).alias("word"))
    return words.filter(F.col("word").rlike(ALPHA_WORD)).distinct()
