"""License scan: lines, runs of lines and whole texts against license notices.

Texts are normalised (lower case, runs of other signs as one space) and compared by the Dice
coefficient of their sets of word bigrams. A template is only compared to units whose number of
bigrams allows the threshold: 2*min(a, b) / (a + b) >= t. Before that, a row must hold a key word:
the key words are chosen so that a text without any of them lacks too many bigrams of every template
to reach the threshold, so the prefilter drops no match. Only DataFrame functions; no shuffle."""

from __future__ import annotations

import math
import re
from functools import lru_cache

from pyspark.sql import Column, DataFrame, functions as F

# Short public license notices by SPDX-like name.
TEMPLATES = {
    "Apache-2.0": ["Licensed under the Apache License, Version 2.0.",
                   "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.",
                   "Distributed under the Apache License, Version 2.0."],
    "MIT": ["Released under the MIT License.", "Licensed under the MIT License.",
            "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction."],
    "GPL-3.0": ["This work is licensed under the GNU General Public License, version 3.",
                "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."],
    "CC-BY-NC-4.0": ["Licensed under CC BY-NC 4.0.",
                     "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."],
    "CC-BY-4.0": ["Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."],
    "CC-BY-SA-4.0": ["Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."],
    "BSD-3-Clause": ["Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met.",
                     "Released under the BSD 3-Clause License."],
    "MPL-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."],
}
THRESHOLD = 0.8
# Notices wrapped over up to this many lines are found as one unit.
LINES_JOINED = 3
_COMMON = {"the", "a", "of", "to", "and", "is", "in", "by", "this", "or", "any", "are", "you", "it", "at", "as", "use", "with", "not", "be"}


def _words(text: str) -> list[str]:
    return re.sub("[^a-z0-9]+", " ", text.lower()).split()


def _bigrams(words: list[str]) -> list[str]:
    return sorted({f"{a} {b}" for a, b in zip(words, words[1:], strict=False)})


def bounds(n: int, threshold: float) -> tuple[int, int]:
    """Sizes of the other set with which a set of ``n`` bigrams can reach the threshold."""
    return math.ceil(n * threshold / (2 - threshold) - 1e-9), math.floor(n * (2 - threshold) / threshold + 1e-9)


@lru_cache
def key_words(threshold: float = THRESHOLD) -> tuple[str, ...]:
    """Words such that any unit within the threshold of a template holds at least one of them."""
    chosen: list[str] = []
    for texts in TEMPLATES.values():
        for text in texts:
            grams = _bigrams(_words(text))
            need = bounds(len(grams), threshold)[0]  # at least so many of its bigrams must be there
            order = sorted(set(_words(text)) - _COMMON, key=lambda w: (-sum(w in g.split() for g in grams), -len(w), w)) + sorted(set(_words(text)) & _COMMON)
            for w in order:
                if sum(not set(g.split()) & set(chosen) for g in grams) < need:
                    break
                if w not in chosen:
                    chosen.append(w)
    return tuple(sorted(chosen))


def _unit_bigrams(words: Column) -> Column:
    return F.when(F.size(words) > 1, F.array_distinct(F.transform(
        F.sequence(F.lit(1), F.size(words) - 1), lambda i: F.concat_ws(" ", F.element_at(words, i), F.element_at(words, i + 1)))))


def find_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """Per row: ``doc_id, license, dice, n_found, found``. ``found`` lists (license, dice, first line
    from 0, number of lines) of every unit and license within the threshold, best first (then by
    name, line and fewest lines); ``license`` and ``dice`` are its first, null if there is none. A
    null or empty text has none; repeated rows each get a row."""
    pattern = r"(?i)\b(?:" + "|".join(key_words(threshold)) + r")\b"
    compiled = [(name, _bigrams(_words(t))) for name, texts in TEMPLATES.items() for t in texts]
    least = min(bounds(len(g), threshold)[0] for _, g in compiled)
    most = max(bounds(len(g), threshold)[1] for _, g in compiled)
    clean = lambda x: F.trim(F.regexp_replace(F.lower(x), "[^a-z0-9]+", " "))
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    rows = rows.select("doc_id", F.when(F.col("text").rlike(pattern), F.transform(F.split("text", "\n"), clean)).alias("lines"))
    n_lines = F.size("lines")
    def run_of(k):
        return F.when(n_lines >= k, F.transform(F.sequence(F.lit(1), n_lines - (k - 1)), lambda i: F.struct(
            (i - 1).alias("line"), F.lit(k).alias("n_lines"), F.filter(F.split(F.array_join(F.slice("lines", i, k), " "), " +"), lambda w: w != "").alias("words"))))
    empty = "cast(array() as array<struct<line:int,n_lines:int,words:array<string>>>)"
    whole = F.when(n_lines > LINES_JOINED, F.array(F.struct(
        F.lit(0).alias("line"), n_lines.alias("n_lines"), F.filter(F.split(F.array_join("lines", " "), " +"), lambda w: w != "").alias("words"))))
    units = F.concat(*[F.coalesce(run_of(k), F.expr(empty)) for k in range(1, LINES_JOINED + 1)], F.coalesce(whole, F.expr(empty)))
    sized = F.filter(units, lambda u: F.size(u["words"]) > least)  # at least one word more than bigrams
    rows = rows.select("doc_id", F.transform(sized, lambda u: F.struct(u["line"].alias("line"), u["n_lines"].alias("n_lines"), _unit_bigrams(u["words"]).alias("grams"))).alias("units"))
    rows = rows.select("doc_id", F.filter("units", lambda u: F.size(u["grams"]).between(least, most)).alias("units"))
    found = []
    for name, grams in compiled:
        low, high = bounds(len(grams), threshold)
        template = F.array(*[F.lit(g) for g in grams])
        found.append(_against("units", name, template, len(grams), low, high, threshold))
    ranked = F.array_sort(F.concat(*found), lambda a, b: F.when(a["dice"] != b["dice"], F.when(a["dice"] > b["dice"], -1).otherwise(1)).when(
        a["license"] != b["license"], F.when(a["license"] < b["license"], -1).otherwise(1)).when(a["line"] != b["line"], a["line"] - b["line"]).otherwise(a["n_lines"] - b["n_lines"]))
    rows = rows.select("doc_id", F.when(F.size("units") > 0, ranked).otherwise(F.expr("cast(array() as array<struct<license:string,dice:double,line:int,n_lines:int>>)")).alias("found"))
    return rows.select("doc_id", F.try_element_at("found", F.lit(1))["license"].alias("license"), F.try_element_at("found", F.lit(1))["dice"].alias("dice"),
                       F.size("found").cast("long").alias("n_found"), "found")


def _against(units: str, name: str, template: Column, size: int, low: int, high: int, threshold: float) -> Column:
    """Units within the size bounds of one template and within the threshold of it."""
    near = F.filter(units, lambda u: F.size(u["grams"]).between(low, high))
    scored = F.transform(near, lambda u: F.struct(
        F.lit(name).alias("license"),
        (F.lit(2.0) * F.size(F.array_intersect(u["grams"], template)) / (F.size(u["grams"]) + size)).alias("dice"),
        u["line"].alias("line"), u["n_lines"].alias("n_lines")))
    return F.filter(scored, lambda x: x["dice"] >= threshold)


def _window_bounds(text: str, threshold: float) -> tuple[int, int]:
    """Fewest and most bigram places of a window that is compared to a template. A template that
    repeats bigrams has more places than bigrams, and its windows may be longer by as many."""
    words = _words(text)
    low, high = bounds(len(_bigrams(words)), threshold)
    return low, high + len(words) - 1 - len(_bigrams(words))


def find_notices(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """Per row: ``doc_id, license, dice, n_found, found``, wherever lines break and whatever surrounds a
    notice. Compared are windows of words of the whole normalised text, as long as the size bounds of
    a template allow, that start and end with a bigram of the template (other bigrams at its
    ends only take a window farther off). Of windows of one license that overlap, the best stays (then the
    earliest, then the shortest). ``found`` lists (license, dice, first word from 0, number of words),
    best first, then by name and word. A null or empty text has none; repeated rows each get a row.

    Windows lie within a window's length of a key word, so only these places are looked at."""
    keys = key_words(threshold)
    compiled = [(name, _bigrams(_words(t)), *_window_bounds(t, threshold)) for name, texts in TEMPLATES.items() for t in texts]
    longest = max(high for _, _, _, high in compiled)
    all_grams = F.array(*[F.lit(g) for g in sorted({g for _, grams, _, _ in compiled for g in grams})])
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    clean = F.trim(F.regexp_replace(F.lower("text"), "[^a-z0-9]+", " "))
    rows = rows.select("doc_id", F.when(F.col("text").rlike(r"(?i)(?<![a-z0-9])(?:" + "|".join(keys) + r")(?![a-z0-9])"), F.split(clean, " ")).alias("words"))
    key_array = F.array(*[F.lit(k) for k in keys])
    hits = F.filter(F.transform("words", lambda w, i: F.when(F.array_contains(key_array, w), i)), lambda i: i.isNotNull())
    rows = rows.select("doc_id", "words", hits.alias("hits"))
    # places of bigrams (from 0) within a window of a key word, then those that hold a bigram of any template
    last = F.size("words") - 2
    near = F.array_sort(F.array_distinct(F.flatten(F.transform("hits", lambda h: F.sequence(F.greatest(h - longest, F.lit(0)), F.least(h + longest, last))))))
    rows = rows.select("doc_id", "words", F.when((F.size("hits") > 0) & (last >= 0), near).alias("near"))
    placed = F.transform("near", lambda i: F.struct(i.alias("at"), F.concat_ws(" ", F.get("words", i), F.get("words", i + 1)).alias("gram")))
    rows = rows.select("doc_id", "words", F.filter(placed, lambda x: F.array_contains(all_grams, x["gram"])).alias("placed"))
    # a template with fewer of its bigrams than the threshold needs has no window
    rows = rows.select("doc_id", "words", *[_places(grams).alias(f"at{k}") for k, (_, grams, _, _) in enumerate(compiled)])
    empty = F.expr("cast(array() as array<struct<far:double,word:int,n_words:int>>)")
    matched: dict[str, list[Column]] = {}
    for k, (name, grams, low, high) in enumerate(compiled):
        windows = F.when(F.size(f"at{k}") >= low, _windows(f"at{k}", grams, low, high, threshold))
        matched.setdefault(name, []).append(F.coalesce(windows, empty))
    rows = rows.select("doc_id", *[F.array_sort(F.array_distinct(F.concat(*m))).alias(f"of{k}") for k, m in enumerate(matched.values())])
    found = [_named(F.aggregate(f"of{k}", empty, _unless_overlapped), name) for k, name in enumerate(matched)]
    ranked = F.transform(F.array_sort(F.concat(*found)), lambda x: F.struct(x["license"].alias("license"), (-x["far"]).alias("dice"), x["word"].alias("word"), x["n_words"].alias("n_words")))
    rows = rows.select("doc_id", ranked.alias("found"))
    return rows.select("doc_id", F.try_element_at("found", F.lit(1))["license"].alias("license"), F.try_element_at("found", F.lit(1))["dice"].alias("dice"),
                       F.size("found").cast("long").alias("n_found"), "found")


def _places(grams: list[str]) -> Column:
    template = F.array(*[F.lit(g) for g in grams])
    return F.transform(F.filter("placed", lambda x: F.array_contains(template, x["gram"])), lambda x: x["at"])


def _named(windows: Column, name: str) -> Column:
    return F.transform(windows, lambda w: F.struct(w["far"].alias("far"), F.lit(name).alias("license"), w["word"].alias("word"), w["n_words"].alias("n_words")))


def _windows(at: str, grams: list[str], low: int, high: int, threshold: float) -> Column:
    """Windows between two places of a template's bigrams that reach the threshold, as (minus Dice,
    first word, number of words), so that the best come first in order."""
    template = F.array(*[F.lit(g) for g in grams])

    def from_place(a, i):
        ends = F.filter(F.slice(at, i + low, high), lambda b: b - a < high)
        return F.transform(ends, lambda b: scored(a, b))

    def scored(a, b):
        # arrays of one, so that the words are cut and their bigrams made once
        sets = F.transform(F.array(F.slice("words", a + 1, b - a + 2)), _unit_bigrams)
        far = F.transform(sets, lambda u: F.lit(-2.0) * F.size(F.array_intersect(u, template)) / (F.size(u) + len(grams)))
        return F.struct(F.get(far, F.lit(0)).alias("far"), a.alias("word"), (b - a + 2).alias("n_words"))

    return F.filter(F.flatten(F.transform(at, from_place)), lambda w: w["far"] <= -threshold)


def _unless_overlapped(kept: Column, w: Column) -> Column:
    meets = F.exists(kept, lambda x: (x["word"] < w["word"] + w["n_words"]) & (w["word"] < x["word"] + x["n_words"]))
    return F.when(meets, kept).otherwise(F.concat(kept, F.array(w)))
