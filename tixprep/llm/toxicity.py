"""Toxicity scores: a learnt lexicon as a trie, Levenshtein automata run against it, context windows.

The lexicon is learnt from a bounded sample of labelled rows: whole words and stems (beginnings of
words) that toxic texts hold far more often than others. Its trie is intersected with the
Levenshtein automata of its terms: a state is the set of trie nodes that the letters read so far
can stand for, with the edits spent on the way. The reachable states are listed once, so that a
word costs one table look-up a letter; a word that leaves the lexicon behind dies after a few
letters. A whole-word term of ``FUZZY_FROM`` letters or more is found with one edit too, so is a
stem of ``FUZZY_STEM_FROM`` or more.

Each match carries the log odds of its term (less for edited ones, unless the sample says
otherwise) and those of its context window: the words around it and whether quotation marks
enclose it, each judged by how toxic the texts of such matches are beyond what their terms alone
tell. So quoted or reported terms count less. The evidence of a text, summed over its different
matched words, alone and against its length, gives the score through a logistic regression; all texts
without evidence have one low score.

Scale: texts never shuffle but those of the sample (``sample_rows``, the rows with the smallest hash of their
id; one row an id). Lexicon, automaton, context table and regression have fixed bounds and are
broadcast. Scoring is one pass over whole texts."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tixprep.llm.batches import arrow_map, column, list_array, ranges, steps, utf8, word_hashes
from tixprep.llm.tables import Steps

SAMPLE_ROWS = 20_000
LEXICON = 400             # terms at most, the most telling ones
CANDIDATES = 20_000       # beginnings and words that the choice is made from
LEAST_DOCS = 4            # toxic texts of the sample that hold a term
LEAST_G = 16.0            # likelihood ratio statistic of a term
LEAST_ODDS = float(np.log(3.0))
STEM_FROM, STEM_TO, WORD_TO = 3, 12, 24
FUZZY_FROM, FUZZY_STEM_FROM = 4, 6
WINDOW = 4                # words on either side of a match
CONTEXT_WORDS = 5_000
CONTEXT_LEAST = 10        # matches beside which a context word must stand
CONTEXT_CLIP = 1.5
QUOTED = 0                # the context of a match between quotation marks
QUOTED_PRIOR = -1.0       # its log odds before the sample has its say
TOXIC_FROM = 0.7

_QUOTES = [ord(c) for c in "\"«»„“”‟〝〞「」『』"]
_EMOJI = (0x1F000, 0x1FC00)  # beyond the 65,536 first code points, all others are letters
_INNER = [ord(c) for c in "*@$!|'-’"]  # part of a word between two letters or digits


def _tables() -> tuple[np.ndarray, np.ndarray]:
    """Lower case and kind (1 letter or digit, 2 inner sign, 3 quotation mark) of the first 65,536 code points."""
    lower = np.arange(1 << 16, dtype=np.uint32)
    kind = np.zeros(1 << 16, np.uint8)
    for c in range(1 << 16):
        s = chr(c)
        if s.isalnum():
            kind[c] = 1
            low = s.lower()
            if len(low) == 1:
                lower[c] = ord(low)
    kind[_INNER], kind[_QUOTES] = 2, 3
    return lower, kind


_LOWER, _KIND = _tables()


@dataclass
class Words:
    """The words of some texts: lower-case code points and where texts begin, starts and ends of words,
    words per text, quotation marks."""

    codes: np.ndarray
    bounds: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    counts: np.ndarray
    quotes: np.ndarray

    @staticmethod
    def of(raw: np.ndarray, offsets: np.ndarray) -> Words:
        where = np.append(0, np.cumsum((raw & 0xC0) != 0x80))[offsets]
        try:
            text = raw.tobytes().decode()
        except UnicodeDecodeError:
            texts = [raw[a:b].tobytes().decode("utf-8", "replace") for a, b in zip(offsets, offsets[1:], strict=False)]
            text, where = "".join(texts), np.cumsum([0, *map(len, texts)])
        codes = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        low = np.minimum(codes, 0xFFFF)
        kind = np.where(codes > 0xFFFF, ((codes < _EMOJI[0]) | (codes >= _EMOJI[1])).view(np.uint8), _KIND[low])
        codes = np.where(codes > 0xFFFF, codes, _LOWER[low])
        n = len(codes)
        if n == 0:
            z = np.zeros(0, np.int64)
            return Words(codes, where, z, z, np.zeros(len(offsets) - 1, np.int64), z)
        first = np.zeros(n + 1, bool)
        first[where] = True
        solid = kind == 1
        inside = solid.copy()
        inside[1:-1] |= (kind[1:-1] == 2) & solid[:-2] & solid[2:] & ~first[1:n - 1] & ~first[2:n]
        starts = np.flatnonzero(inside & (first[:-1] | ~np.append(False, inside[:-1])))
        ends = np.flatnonzero(inside & (first[1:] | ~np.append(inside[1:], False))) + 1
        return Words(codes, where, starts, ends, np.diff(np.searchsorted(starts, where)), np.flatnonzero(kind == 3))

    def hashes(self, which: np.ndarray | None = None) -> np.ndarray:
        return word_hashes(self.codes, self.starts if which is None else self.starts[which], self.ends if which is None else self.ends[which])

    def text(self, k: int) -> str:
        return self.codes[self.starts[k]:self.ends[k]].tobytes().decode("utf-32-le")


# --- automaton ---------------------------------------------------------------------------------

_NONE = np.int32(2 ** 31 - 1)


@dataclass
class Automaton:
    """All Levenshtein automata of the lexicon's terms, intersected with its trie. State 0 is dead, 1 the
    start. A hit is ``edits * terms + term``, so the least hit has the fewest edits and the best term."""

    n_terms: int
    chars: np.ndarray   # sorted code points of the lexicon; all others are class 0
    follow: np.ndarray  # state x class -> state
    word_hit: np.ndarray
    stem_hit: np.ndarray

    @staticmethod
    def of(terms: list[tuple[str, bool]]) -> Automaton:
        """``terms``: (text, is a stem), best first."""
        children: list[dict[str, int]] = [{}]
        reach, word_at, stem_at = [0], {}, {}
        for number, (term, stem) in enumerate(terms):
            edits = int(len(term) >= (FUZZY_STEM_FROM if stem else FUZZY_FROM))
            node = 0
            reach[0] = max(reach[0], edits)
            for c in term:
                if c not in children[node]:
                    children[node][c] = len(children)
                    children.append({})
                    reach.append(0)
                node = children[node][c]
                reach[node] = max(reach[node], edits)
            (stem_at if stem else word_at).setdefault(node, (number, edits))

        def closed(nodes: dict[int, int]) -> frozenset:
            """Letters left out: children of a node with one edit more."""
            todo = list(nodes.items())
            while todo:
                node, spent = todo.pop()
                for child in children[node].values():
                    if spent + 1 <= reach[child] and nodes.get(child, 9) > spent + 1:
                        nodes[child] = spent + 1
                        todo.append((child, spent + 1))
            return frozenset(nodes.items())

        def step(state: frozenset, c: str | None) -> frozenset:
            out: dict[int, int] = {}
            for node, spent in state:
                if spent < reach[node]:  # a letter too many
                    out[node] = min(out.get(node, 9), spent + 1)
                for letter, child in children[node].items():
                    cost = spent + (letter != c)
                    if cost <= reach[child] and out.get(child, 9) > cost:
                        out[child] = cost
            return closed(out)

        chars = sorted({c for term, _ in terms for c in term})
        number_of = {c: k for k, c in enumerate(chars, 1)}
        states = {frozenset(): 0, closed({0: 0}): 1} if terms else {frozenset(): 0}
        order = list(states)
        follow, k = [np.zeros(len(chars) + 1, np.int32)], 1
        while k < len(order):
            state = order[k]
            letters = {c for node, _ in state for c in children[node]}
            row = np.zeros(len(chars) + 1, np.int32)
            for c in [None, *sorted(letters)]:
                to = step(state, c)
                if to not in states:
                    states[to] = len(order)
                    order.append(to)
                row[slice(None) if c is None else number_of[c]] = states[to]
            follow.append(row)
            k += 1
        n = len(terms)
        hits = np.full((2, max(len(order), 2)), _NONE)
        for k, state in enumerate(order):
            for node, spent in state:
                for kind, at in enumerate((word_at, stem_at)):
                    if node in at and spent <= at[node][1]:
                        hits[kind, k] = min(hits[kind, k], spent * n + at[node][0])
        if len(follow) < 2:
            follow.append(follow[0])
        return Automaton(n, np.array([ord(c) for c in chars], np.uint32), np.array(follow), hits[0], hits[1])

    def hits(self, words: Words) -> np.ndarray:
        """Hit of every word, ``_NONE`` without one."""
        best = np.full(len(words.starts), _NONE)
        if self.n_terms == 0 or len(best) == 0:
            return best
        place = np.minimum(np.searchsorted(self.chars, words.codes), len(self.chars) - 1)
        cls = np.where(self.chars[place] == words.codes, place + 1, 0).astype(np.int32)
        at = words.starts.copy()
        ends = words.ends
        alive = np.arange(len(best))
        state = np.ones(len(best), np.int32)
        while len(alive):
            state = self.follow[state, cls[at]]
            at = at + 1
            found = self.stem_hit[state]
            over = at == ends[alive]
            found = np.where(over, np.minimum(found, self.word_hit[state]), found)
            some = found != _NONE
            best[alive[some]] = np.minimum(best[alive[some]], found[some])
            on = (state != 0) & ~over
            alive, state, at = alive[on], state[on], at[on]
        return best


# --- matches -----------------------------------------------------------------------------------


@dataclass
class Matches:
    """Matched words of some texts: row, surface, hit, and the contexts of all matches in one array."""

    row: np.ndarray
    surface: np.ndarray
    hit: np.ndarray
    context: np.ndarray
    context_of: np.ndarray

    @staticmethod
    def of(words: Words, automaton: Automaton) -> Matches:
        hit = automaton.hits(words)
        at = np.flatnonzero(hit != _NONE)
        row_of = np.repeat(np.arange(len(words.counts)), words.counts)
        row = row_of[at]
        last = np.cumsum(words.counts)
        lo = np.maximum(at - WINDOW, (last - words.counts)[row])
        hi = np.minimum(at + WINDOW + 1, last[row])
        near, which = ranges(lo, hi)
        beside = near != at[which]
        near, which = near[beside], which[beside]
        context = words.hashes(near)
        # a quotation mark on either side within the window
        begin, end = np.maximum(words.starts[lo] - 1, words.bounds[row]), np.minimum(words.ends[hi - 1] + 1, words.bounds[row + 1])
        left = np.searchsorted(words.quotes, words.starts[at]) > np.searchsorted(words.quotes, begin)
        right = np.searchsorted(words.quotes, end) > np.searchsorted(words.quotes, words.ends[at])
        quoted = np.flatnonzero(left & right)
        return Matches(row, words.hashes(at), hit[at], np.append(context, np.full(len(quoted), QUOTED, np.uint64)), np.append(which, quoted))


@dataclass
class Model:
    automaton: Automaton
    evidence: np.ndarray = field(default_factory=lambda: np.zeros(0))      # log odds by hit
    context: np.ndarray = field(default_factory=lambda: np.zeros(0, np.uint64))  # sorted context hashes
    context_odds: np.ndarray = field(default_factory=lambda: np.zeros(0))
    centre: np.ndarray = field(default_factory=lambda: np.zeros(0))
    scale: np.ndarray = field(default_factory=lambda: np.zeros(0))
    weights: np.ndarray = field(default_factory=lambda: np.zeros(0))       # the last one is the constant

    def features(self, raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Evidence of a text in stretches, its different matched words and its evidence against its length:
        all zero in a text without evidence."""
        words = Words.of(raw, offsets)
        m = Matches.of(words, self.automaton)
        rows = len(words.counts)
        total, different = np.zeros(rows), np.zeros(rows)
        if len(m.row):
            odds = np.zeros(len(m.context))
            if len(self.context):
                place = np.minimum(np.searchsorted(self.context, m.context), len(self.context) - 1)
                odds = np.where(self.context[place] == m.context, self.context_odds[place], 0.0)
            around = np.clip(np.bincount(m.context_of, weights=odds, minlength=len(m.row)), -CONTEXT_CLIP, CONTEXT_CLIP)
            own = self.evidence[m.hit]
            value = np.where(own > 0, np.maximum(own + around, 0.0), 0.0)
            # a word that is repeated counts once, where its context is worst
            order = np.lexsort((-value, m.surface, m.row))
            first = np.append(True, (m.row[order][1:] != m.row[order][:-1]) | (m.surface[order][1:] != m.surface[order][:-1]))
            kept = order[first]
            total = np.bincount(m.row[kept], weights=value[kept], minlength=rows)
            different = np.bincount(m.row[kept], weights=value[kept] > 0, minlength=rows)
        length = np.log1p(words.counts)
        cuts = [0.0, 2.0, 4.0, 6.0, 9.0, 14.0]
        parts = [np.clip(total - a, 0, b - a) for a, b in zip(cuts, cuts[1:], strict=False)]
        return np.column_stack([*parts, different / (1 + length), total / (1 + length)])

    def scores(self, raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        out = np.zeros(len(offsets) - 1)
        for i, j in steps(offsets, 1 << 18):
            x = (self.features(raw[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i]) - self.centre) / self.scale
            out[i:j] = 1 / (1 + np.exp(-np.clip(x @ self.weights[:-1] + self.weights[-1], -35, 35)))
        return out


def regression(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, rounds: int = 50) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Logistic regression by Newton steps: centre, scale, weights. With rows of one class only, or none,
    the constant is that class's smoothed share."""
    width = x.shape[1]
    share = (y.sum() + 0.5) / (len(y) + 1.0)
    weights = np.append(np.zeros(width), np.log(share / (1 - share)))
    if len(y) == 0 or y.min() == y.max():
        return np.zeros(width), np.ones(width), weights
    centre, scale = x.mean(axis=0), x.std(axis=0) + 1e-6
    z = np.column_stack([(x - centre) / scale, np.ones(len(y))])
    penalty = np.append(np.full(width, ridge), 1e-9)

    def loss(w: np.ndarray) -> float:
        s = z @ w
        return float(np.sum(np.logaddexp(0, s) - y * s) + 0.5 * np.sum(penalty * w * w))
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(z @ weights, -35, 35)))
        gradient = z.T @ (p - y) + penalty * weights
        move = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + np.diag(penalty + 1e-9), gradient)
        size = 1.0
        while loss(weights - size * move) > loss(weights) and size > 1e-4:
            size /= 2
        weights = weights - size * move
        if np.abs(move).max() < 1e-8:
            break
    return centre, scale, weights


# --- learning ----------------------------------------------------------------------------------


def held_out(id_col: str = "doc_id"):
    """Rows whose labels are never learnt from."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 3 == 1, F.lit(False))


def _sample(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, sample_rows: int) -> DataFrame:
    """``doc, y, text``: one row an id (the least text), of repeated labels the least."""
    usable = (labels.filter(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull() & ~held_out(id_col))
              .groupBy(F.col(id_col).alias("sample_id")).agg(F.min(label_col).cast("long").alias("y")))
    chosen = usable.orderBy(F.xxhash64("sample_id"), "sample_id").limit(sample_rows)
    rows = docs.select(F.col(id_col).alias("doc"), F.col(text_col).alias("text"))
    # at most sample_rows rows of two numbers: a proven bound for the broadcast
    return (rows.join(F.broadcast(chosen), rows["doc"] == chosen["sample_id"])
            .groupBy("doc", "y").agg(F.min(F.coalesce("text", F.lit(""))).alias("text")))


def _beginnings(sample: DataFrame) -> DataFrame:
    """Per word and beginning of a word: the toxic and other texts that hold it, and those that hold it as a whole word."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[int]] = {}

        def taken() -> pa.RecordBatch:
            values = np.array(list(held.values()))
            out = pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), *(pa.array(values[:, k]) for k in range(4))],
                                             ["term", "toxic", "other", "toxic_whole", "other_whole"])
            held.clear()
            return out
        for batch in batches:
            raw, offsets = utf8(column(batch, "text"))
            y = column(batch, "y").to_pylist()
            for i in range(batch.num_rows):
                words = Words.of(raw[offsets[i]:offsets[i + 1]], np.array([0, offsets[i + 1] - offsets[i]]))
                _, one = np.unique(words.hashes(), return_index=True)
                whole = {words.text(k) for k in one if words.ends[k] - words.starts[k] <= WORD_TO}
                long = {words.text(k)[:STEM_TO] for k in one if words.ends[k] - words.starts[k] > WORD_TO}
                terms = whole | {w[:k] for w in whole | long for k in range(STEM_FROM, min(len(w), STEM_TO) + 1)}
                side = 0 if y[i] == 1 else 1
                for term in terms:
                    if len(term) >= STEM_FROM:
                        counts = held.setdefault(term, [0, 0, 0, 0])
                        counts[side] += 1
                        counts[2 + side] += term in whole
                if len(held) > 200_000:
                    yield taken()
        if held:
            yield taken()

    parts = sample.mapInArrow(run, "term string, toxic long, other long, toxic_whole long, other_whole long")
    return parts.groupBy("term").agg(*(F.sum(c).alias(c) for c in ("toxic", "other", "toxic_whole", "other_whole")))


def choose(rows: list[tuple[str, int, int, int, int]], n_toxic: int, n_other: int, lexicon: int = LEXICON) -> list[tuple[str, bool]]:
    """The lexicon, most telling first. Of a word and its beginnings the one with the highest likelihood
    ratio stands for all (of equal ones the longest). A term whose toxic texts hold it as a whole word
    nine times in ten is a word, others are stems."""
    def g(a: int, b: int) -> float:
        n, k = n_toxic + n_other, a + b
        cells = ((a, n_toxic * k / n), (b, n_other * k / n), (n_toxic - a, n_toxic * (n - k) / n), (n_other - b, n_other * (n - k) / n))
        return 2 * sum(o * np.log(o / e) for o, e in cells if o > 0)

    def odds(a: int, b: int) -> float:
        return float(np.log((a + 0.5) / (n_toxic + 1)) - np.log((b + 0.5) / (n_other + 1)))
    found = []
    for term, toxic, other, toxic_whole, other_whole in rows:
        word = toxic_whole >= 0.9 * toxic
        a, b = (toxic_whole, other_whole) if word else (toxic, other)
        if a >= LEAST_DOCS and odds(a, b) >= LEAST_ODDS and g(a, b) >= LEAST_G and (word or len(term) <= STEM_TO):
            found.append((-round(g(a, b), 9), -len(term), term, not word))
    chosen: list[tuple[str, bool]] = []
    above: set[str] = set()
    taken: set[str] = set()
    for _, _, term, stem in sorted(found):
        if len(chosen) < lexicon and term not in above and not any(term[:k] in taken for k in range(1, len(term) + 1)):
            chosen.append((term, stem))
            taken.add(term)
            above.update(term[:k] for k in range(1, len(term)))
    return chosen


def _log_odds(a: float, b: float, n_toxic: int, n_other: int) -> tuple[float, float]:
    """Smoothed log odds of texts with a term, and their standard error."""
    return (float(np.log((a + 0.5) / (n_toxic + 1)) - np.log((b + 0.5) / (n_other + 1))), float(np.sqrt(1 / (a + 0.5) + 1 / (b + 0.5))))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
        sample_rows: int = SAMPLE_ROWS, lexicon: int = LEXICON) -> Model:
    """Lexicon, automaton, contexts and regression from the sample. Labels other than 0 and 1, held-out rows
    and labels without a document are not used."""
    tables = Steps(docs)
    sample = tables.write(_sample(docs, labels, id_col, text_col, label_col, sample_rows))
    sizes = {r["y"]: r["n"] for r in sample.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    n_toxic, n_other = sizes.get(1, 0), sizes.get(0, 0)
    terms: list[tuple[str, bool]] = []
    if n_toxic and n_other:
        gap = F.col("toxic") / n_toxic - F.col("other") / n_other
        likely = (_beginnings(sample).filter((F.col("toxic") >= LEAST_DOCS) & (F.col("toxic") * n_other > F.col("other") * n_toxic * 2))
                  .orderBy(gap.desc(), F.length("term").desc(), "term").limit(CANDIDATES))
        terms = choose([tuple(r) for r in likely.collect()], n_toxic, n_other, lexicon)
    model = Model(Automaton.of(terms))
    if terms:
        _learn_matches(model, terms, sample, tables, n_toxic, n_other)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        raw, offsets = utf8(column(batch, "text"))
        x = [row.tobytes() for i, j in steps(offsets, 1 << 18) for row in shared.value.features(raw[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])]
        return pa.RecordBatch.from_arrays([column(batch, "y"), pa.array(x, pa.binary())], ["y", "x"])

    rows = sorted((r["y"], bytes(r["x"])) for r in arrow_map(sample, run, "y long, x binary").collect())
    x = np.array([np.frombuffer(r[1]) for r in rows]).reshape(len(rows), -1) if rows else np.zeros((0, 7))
    model.centre, model.scale, model.weights = regression(x, np.array([r[0] for r in rows], float))
    tables.drop(sample)
    return model


def _learn_matches(model: Model, terms: list[tuple[str, bool]], sample: DataFrame, tables: Steps, n_toxic: int, n_other: int) -> None:
    """Evidence of terms found exactly and with an edit, and of their contexts."""
    shared = sample.sparkSession.sparkContext.broadcast(model.automaton)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch | None:
        raw, offsets = utf8(column(batch, "text"))
        doc, y = column(batch, "doc"), column(batch, "y").to_numpy()
        parts = []
        for i, j in steps(offsets, 1 << 18):
            m = Matches.of(Words.of(raw[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i]), shared.value)
            if len(m.row) == 0:
                continue
            order = np.argsort(m.context_of, kind="stable")
            lengths = np.bincount(m.context_of, minlength=len(m.row))
            parts.append(pa.RecordBatch.from_arrays(
                [doc.take(pa.array(m.row + i)).cast(pa.string()), pa.array(y[m.row + i]), pa.array(m.hit),
                 list_array(lengths, pa.array(m.context[order].view(np.int64)))], ["doc", "y", "hit", "context"]))
        return pa.Table.from_batches(parts).combine_chunks().to_batches()[0] if parts else None

    matches = tables.write(arrow_map(sample, run, "doc string, y long, hit int, context array<long>"))
    texts = matches.select("doc", "y", "hit").distinct().groupBy("hit").agg(F.sum("y").alias("a"), F.sum(1 - F.col("y")).alias("b"))
    counts = {r["hit"]: (r["a"], r["b"]) for r in texts.collect()}  # at most two hits a term
    n = len(terms)
    model.evidence = np.zeros(2 * n)
    toxic_share = np.zeros(2 * n)
    for k, (_, stem) in enumerate(terms):
        odds, error = _log_odds(*counts.get(k, (0, 0)), n_toxic, n_other)
        model.evidence[k] = max(odds - error, 0.0)
        a, b = counts.get(n + k, (0, 0))
        edited, _ = _log_odds(a, b, n_toxic, n_other)
        before = 0.0 if stem else 0.5 * model.evidence[k]
        model.evidence[n + k] = max((10 * before + (a + b) * edited) / (10 + a + b), 0.0)
    for hit, (a, b) in counts.items():
        toxic_share[hit] = (a + 0.5) / (a + b + 1)
    spark = sample.sparkSession
    shares = F.broadcast(spark.createDataFrame([(k, float(s)) for k, s in enumerate(toxic_share)], "hit int, expected double"))  # two rows a term
    near = matches.select("doc", "y", "hit", F.explode("context").alias("word")).distinct().join(shares, "hit")
    words = (near.groupBy("word").agg(F.count(F.lit(1)).alias("n"), F.sum("y").alias("seen"), F.sum(F.col("expected").cast("decimal(20,10)")).cast("double").alias("due"))
             .filter((F.col("n") >= CONTEXT_LEAST) | (F.col("word") == QUOTED)).orderBy((F.col("word") == QUOTED).desc(), F.col("n").desc(), "word").limit(CONTEXT_WORDS))
    table = {QUOTED: QUOTED_PRIOR}
    for r in words.collect():
        odds = np.log((r["seen"] + 1) / (r["due"] + 1)) - np.log((r["n"] - r["seen"] + 1) / (r["n"] - r["due"] + 1))
        before, strength = (QUOTED_PRIOR, 10) if r["word"] == QUOTED else (0.0, 20)
        table[r["word"] % (1 << 64)] = float((strength * before + r["n"] * odds) / (strength + r["n"]))
    model.context = np.array(sorted(table), np.uint64)
    model.context_odds = np.array([table[int(k)] for k in model.context])


def toxicity_scores(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", **fit_options) -> DataFrame:
    """Per row: ``doc_id, held_out, score`` (0 to 1), ``predicted`` (1 from 0.7 on).

    A null text is an empty one; repeated rows each get a row; ids without a label, and null ids, are
    scored like all others. Without labels of both kinds every score is the smoothed share of label 1
    (0.5 without any). Other columns are not read. An empty table gives an empty result."""
    shared = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, id_col, text_col, **fit_options))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        score = shared.value.scores(*utf8(column(batch, "text")))
        return pa.RecordBatch.from_arrays([column(batch, "doc_id"), column(batch, "held_out"), pa.array(score), pa.array((score >= TOXIC_FROM).astype(np.int32))],
                                          ["doc_id", "held_out", "score", "predicted"])

    rows = docs.select(F.col(id_col).alias("doc_id"), held_out(id_col).alias("held_out"), F.col(text_col).alias("text"))
    return arrow_map(rows, run, f"doc_id {dict(rows.dtypes)['doc_id']}, held_out boolean, score double, predicted int")
