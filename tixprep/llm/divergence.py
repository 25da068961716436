"""How far the sources of a language diverge in their words, from in-mapper stripes.

Every partition folds whole documents into hash stripes: a term of a language leads to its document
frequency and its count in each source. Documents are folded some megabytes at a time. Stripes of terms
that many documents share are held over the whole partition and handed on when they fill their
allowance; those of rare terms leave at once. Spark sorts them by key and equal keys are merged as they stream past, so that a task
holds one stripe at a time. The merged stripes with enough documents are written once. They directly
give the divergences: each task adds up, term by term, what a pair of sources differs by, and keeps
the ten most telling terms of each source; a last aggregate sums the tasks.

The shares are integers and all arithmetic is exact.

Scale: texts never shuffle. A stripe is as wide as the sources that use its term. The sources' totals
go to the tasks in passes of bounded size (``GROUPS_A_PASS`` groups of whole languages; of a language
with more than ``SOURCES_A_BLOCK`` sources, two blocks at a time)."""

from __future__ import annotations

import heapq
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from tixprep.llm.batches import column, list_array, lower_ascii, mix, ranges, steps, utf8, word_hashes, word_spans
from tixprep.llm.tables import Steps

MIN_DOCS = 10
TOP_TERMS = 10
SCALE = 1_000_000_000
CELLS_HELD = 300_000        # stripes and source counts that a task holds before it hands them on
FOLD_BYTES = 8 << 20        # documents that are folded together
HELD_FROM = 4               # a term of so many documents of a step is held on, others leave with their step
GROUPS_A_PASS = 1 << 17
SOURCES_A_BLOCK = 4096
_CELLS_AT_ONCE = 1 << 20    # of the dense (term, source) table of a step
_SUMS_HELD = 1 << 22        # sums of pairs that a task holds before it hands them on

_IN_TERM = np.zeros(256, bool)
_IN_TERM[0x61:0x7B] = _IN_TERM[0x80:] = True
_OTHER = np.random.default_rng(3).permutation(256).astype(np.uint8)  # other bytes for a second fingerprint
_STRIPE = "lang string, term binary, df long, sources array<string>, counts array<long>"
_NAMES = ["lang", "term", "df", "sources", "counts"]


class Stripes:
    """The hash stripes that a task holds over all its documents: those of terms that many of them share
    and of the empty term, which lists a language's sources."""

    def __init__(self):
        self.by_lang: dict[str, dict[bytes, list]] = defaultdict(dict)
        self.cells = 0

    def add(self, rows: pa.RecordBatch) -> None:
        """Folds stripes into those held."""
        counts, sources = column(rows, "counts").to_pylist(), column(rows, "sources").to_pylist()
        for k, (lang, term, df) in enumerate(zip(*(column(rows, c).to_pylist() for c in ("lang", "term", "df")), strict=True)):
            stripe = self.by_lang[lang].get(term)
            if stripe is None:
                stripe = self.by_lang[lang][term] = [0, {}]
                self.cells += 1
            stripe[0] += df
            by_source = stripe[1]
            self.cells -= len(by_source)
            for source, n in zip(sources[k], counts[k], strict=True):
                by_source[source] = by_source.get(source, 0) + n
            self.cells += len(by_source)

    def take(self) -> pa.RecordBatch:
        """All stripes as rows; none are left."""
        rows = [(lang, term, df, by) for lang, stripes in self.by_lang.items() for term, (df, by) in stripes.items()]
        self.__init__()
        lengths = np.array([len(r[3]) for r in rows])
        return pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.binary()), pa.array([r[2] for r in rows], pa.int64()),
             list_array(lengths, pa.array([s for r in rows for s in r[3]], pa.string())),
             list_array(lengths, pa.array([c for r in rows for c in r[3].values()], pa.int64()))], _NAMES)


def _keys(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, lang: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two fingerprints of (language, word), 128 bits in all."""
    number = lang.astype(np.uint64)
    return mix(word_hashes(raw, starts, ends) + number), word_hashes(_OTHER[raw], starts, ends) + number


def stripes_of(raw: np.ndarray, offsets: np.ndarray, langs: pa.Array, sources: pa.Array) -> pa.RecordBatch:
    """The stripes of some documents, the empty terms' among them; equal words are found by sorted fingerprints."""
    langs, sources = langs.dictionary_encode(), sources.dictionary_encode()
    lang, source = langs.indices.to_numpy().astype(np.int64), sources.indices.to_numpy().astype(np.int64)
    many = len(sources.dictionary)
    low = lower_ascii(raw)
    starts, ends, n = word_spans(_IN_TERM[low], offsets)
    doc = np.repeat(np.arange(len(n)), n)
    # the empty term: a word of no bytes in every document, which counts nothing
    docs = np.arange(len(n))
    first, other = _keys(low, np.append(starts, np.zeros(len(n), np.int64)), np.append(ends, np.zeros(len(n), np.int64)), np.append(lang[doc], lang))
    doc, counted = np.append(doc, docs), np.append(np.ones(len(starts), np.int64), np.zeros(len(n), np.int64))
    starts, ends = np.append(starts, np.zeros(len(n), np.int64)), np.append(ends, np.zeros(len(n), np.int64))
    order = np.argsort(first, kind="stable")
    new = np.append(True, first[order][1:] != first[order][:-1])
    if (~new[1:] & (other[order][1:] != other[order][:-1])).any():
        order = np.lexsort((other, first))
        new = np.append(True, (first[order][1:] != first[order][:-1]) | (other[order][1:] != other[order][:-1]))
    group = np.cumsum(new) - 1
    begins = np.flatnonzero(new)
    doc, counted = doc[order], counted[order]
    df = np.add.reduceat((new | np.append(True, doc[1:] != doc[:-1])).astype(np.int64), begins)
    cell = group * many + source[doc]
    by_cell = np.argsort(cell, kind="stable")
    cell = cell[by_cell]
    cells = np.flatnonzero(np.append(True, cell[1:] != cell[:-1]))
    lengths = np.bincount(cell[cells] // many, minlength=len(begins))
    one = order[begins]
    where, _ = ranges(starts[one], ends[one])
    at = np.append(0, np.cumsum(ends[one] - starts[one])).astype(np.int32)
    terms = pa.Array.from_buffers(pa.binary(), len(one), [None, pa.py_buffer(at), pa.py_buffer(low[where])])
    return pa.RecordBatch.from_arrays(
        [langs.dictionary.take(pa.array(lang[doc[begins]])), terms, pa.array(df),
         list_array(lengths, sources.dictionary.take(pa.array(cell[cells] % many))), list_array(lengths, pa.array(np.add.reduceat(counted[by_cell], cells)))], _NAMES)


def fold(docs: DataFrame, text_col: str, lang_col: str, source_col: str, cells_held: int = CELLS_HELD, step_bytes: int = FOLD_BYTES) -> DataFrame:
    """The stripes of all partitions, a key once a task and step or less."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = Stripes()
        for batch in batches:
            raw, offsets = utf8(column(batch, "text"))
            for i, j in steps(offsets, step_bytes):
                rows = stripes_of(raw[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i], column(batch, "lang").slice(i, j - i), column(batch, "source").slice(i, j - i))
                shared = pc.or_(pc.greater_equal(column(rows, "df"), HELD_FROM), pc.equal(pc.binary_length(column(rows, "term")), 0))
                held.add(rows.filter(shared))
                yield rows.filter(pc.invert(shared))
                if held.cells >= cells_held:
                    yield held.take()
        if held.cells:
            yield held.take()

    filled = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(n) for c, n in ((lang_col, "lang"), (source_col, "source"))]
    return docs.select(F.col(text_col).alias("text"), *filled).mapInArrow(run, _STRIPE)


def _changes(rows: pa.RecordBatch) -> np.ndarray:
    """True where a row's key is not that of the row before it."""
    new = np.ones(rows.num_rows, bool)
    for name in ("lang", "term"):
        col = column(rows, name)
        other = pc.not_equal(col.slice(1), col.slice(0, len(col) - 1)).to_numpy(zero_copy_only=False)
        new[1:] = other if name == "lang" else new[1:] | other
    return new


def _merged(rows: pa.RecordBatch) -> pa.RecordBatch:
    """Rows of equal keys, which lie together, as one row each."""
    new = _changes(rows)
    first = np.flatnonzero(new)
    group = np.cumsum(new) - 1
    df = np.add.reduceat(column(rows, "df").to_numpy(), first)
    names = column(rows, "sources").flatten().dictionary_encode()
    cell_group = np.repeat(group, pc.list_value_length(column(rows, "sources")).to_numpy())
    key = cell_group * max(len(names.dictionary), 1) + names.indices.to_numpy()
    order = np.argsort(key, kind="stable")
    key = key[order]
    starts = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
    counts = np.add.reduceat(column(rows, "counts").flatten().to_numpy()[order], starts)
    lengths = np.bincount(cell_group[order][starts], minlength=len(first))
    sources = names.dictionary.take(names.indices.take(pa.array(order[starts])))
    at = pa.array(first)
    return pa.RecordBatch.from_arrays(
        [column(rows, "lang").take(at), column(rows, "term").take(at), pa.array(df), list_array(lengths, sources), list_array(lengths, pa.array(counts))], _NAMES)


def merge(stripes: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """One stripe a key, of terms in at least ``min_docs`` documents, and the empty term's."""
    def kept(rows: pa.RecordBatch) -> pa.RecordBatch:
        return rows.filter(pc.or_(pc.greater_equal(column(rows, "df"), min_docs), pc.equal(pc.binary_length(column(rows, "term")), 0)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # the key that the next batch may go on with
        for batch in batches:
            if batch.num_rows == 0:
                continue
            parts = [pa.RecordBatch.from_arrays(batch.columns, _NAMES)]
            if held is not None:
                parts.insert(0, held.cast(parts[0].schema))
            rows = _merged(pa.Table.from_batches(parts).combine_chunks().to_batches()[0])
            yield kept(rows.slice(0, rows.num_rows - 1))
            held = rows.slice(rows.num_rows - 1)
        if held is not None:
            yield kept(held)

    # (lang, term) rows: at most a few a task and key, since every task has folded its own
    return stripes.repartition("lang", "term").sortWithinPartitions("term", "lang").mapInArrow(run, _STRIPE)


def share(count: np.ndarray, total: np.ndarray | int) -> np.ndarray:
    """1 + floor(SCALE * count / total) for counts up to the total, exact beyond 64 bits: the nine
    decimal digits are divided out three at a time."""
    out, rest = np.divmod(count, total)
    for _ in range(3):
        digits, rest = np.divmod(rest * 1000, total)
        out = out * 1000 + digits
    return out + 1


def apart(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """floor((p - q)^2 / (p + q))."""
    d = p - q
    return d * d // (p + q)


class _Lang:
    """Sources of one language in a pass: their totals, the sums of their pairs, their best terms."""

    def __init__(self, terms: int, total: int, left: list[tuple[str, int]], right: list[tuple[str, int]] | None):
        self.same = right is None
        self.sources = left if right is None else left + right
        self.n_left = len(left)
        self.place = {s: k for k, (s, _) in enumerate(self.sources)}
        self.totals = np.array([n for _, n in self.sources], np.int64) + 2 * terms
        self.total = total + 2 * terms
        self.first_right = 0 if right is None else len(left)
        self.reset()

    def reset(self) -> None:
        self.sums = None
        self.best: dict[int, list[tuple[int, bytes]]] = {}

    def seen(self) -> int:
        """Makes the table of sums and returns its size."""
        if self.sums is None:
            self.sums = np.zeros((self.n_left, len(self.sources) - self.first_right), np.int64)
            return self.sums.size
        return 0

    def add(self, terms: list[bytes], cell_row: np.ndarray, cell_source: np.ndarray, counts: np.ndarray, whole: np.ndarray, top: int) -> None:
        table = np.zeros((len(terms), len(self.sources)), np.int64)
        table[cell_row, cell_source] = counts
        p = share(table + 2, self.totals)
        for s in range(self.n_left):
            right = slice(s + 1, None) if self.same else slice(self.first_right, None)
            if p[:, right].shape[1]:
                into = slice(s + 1, None) if self.same else slice(None)
                self.sums[s, into] += apart(p[:, s:s + 1], p[:, right]).sum(axis=0)
        if not self.same:
            return
        q = share(whole + 2, self.total)
        for s in np.unique(cell_source):
            rows = np.flatnonzero((table[:, s] > 0) & (p[:, s] > q))
            f = apart(p[rows, s], q[rows])
            best = self.best.get(s, [])
            if len(best) == top:
                close = f >= -best[-1][0]
                rows, f = rows[close], f[close]
            elif len(f) > top:
                close = f >= np.partition(f, len(f) - top)[len(f) - top]
                rows, f = rows[close], f[close]
            if len(rows):
                self.best[s] = heapq.nsmallest(top, [*best, *((-int(v), terms[r]) for r, v in zip(rows, f, strict=True))])

    def rows(self, lang: str) -> Iterator[tuple[str, str, str, bytes, int]]:
        if self.sums is not None:
            for s in range(self.n_left):
                for t in range(s + 1 if self.same else self.first_right, len(self.sources)):
                    a, b, v = self.sources[s][0], self.sources[t][0], int(self.sums[s, t - self.first_right])
                    yield "pair", lang, a, b.encode(), v
                    yield "pair", lang, b, a.encode(), v
        for s, best in self.best.items():
            for v, term in best:
                yield "term", lang, self.sources[s][0], term, -v


def _pass(stripes: DataFrame, langs: dict[str, tuple], top: int) -> DataFrame:
    """What every task finds for the sources of one pass."""
    shared = stripes.sparkSession.sparkContext.broadcast(langs)  # at most GROUPS_A_PASS and two blocks of sources

    def batch_of(rows: list) -> pa.RecordBatch:
        cols = list(zip(*rows, strict=True))
        kinds = [pa.string(), pa.string(), pa.string(), pa.binary(), pa.int64()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], ["part", "lang", "source", "item", "value"])

    def drained(known: dict[str, _Lang]) -> Iterator[pa.RecordBatch]:
        rows = []
        for lang, own in known.items():
            for row in own.rows(lang):
                rows.append(row)
                if len(rows) == 50_000:
                    yield batch_of(rows)
                    rows = []
            own.reset()
        if rows:
            yield batch_of(rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, _Lang] = {}
        sums = 0
        for batch in batches:
            names = column(batch, "lang")
            for lang in pc.unique(names).to_pylist():
                if lang not in shared.value:
                    continue
                if lang not in known:
                    known[lang] = _Lang(*shared.value[lang])
                own = known[lang]
                rows = batch.filter(pc.equal(names, lang))
                step = max(1, _CELLS_AT_ONCE // max(1, len(own.sources)))
                for i in range(0, rows.num_rows, step):
                    sums += own.seen()
                    _add_rows(own, rows.slice(i, step), top)
            if sums >= _SUMS_HELD:
                yield from drained(known)
                sums = 0
        yield from drained(known)

    return stripes.mapInArrow(run, "part string, lang string, source string, item binary, value long")


def _add_rows(own: _Lang, rows: pa.RecordBatch, top: int) -> None:
    terms = column(rows, "term").to_pylist()
    real = np.array([len(t) > 0 for t in terms], bool)
    counts = column(rows, "counts").flatten().to_numpy()
    lengths = pc.list_value_length(column(rows, "counts")).to_numpy()
    row = np.repeat(np.arange(len(terms)), lengths)
    whole = np.add.reduceat(counts, np.cumsum(lengths) - lengths)  # a stripe has one source at least
    names = column(rows, "sources").flatten().dictionary_encode()
    place = np.array([own.place.get(s, -1) for s in names.dictionary.to_pylist()], np.int64)[names.indices.to_numpy()]
    use = (place >= 0) & real[row]
    number = np.cumsum(real) - 1
    if real.any():
        own.add([t for t in terms if t], number[row[use]], place[use], counts[use], whole[real], top)


def source_divergence(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source",
                      min_docs: int = MIN_DOCS, top_terms: int = TOP_TERMS, cells_held: int = CELLS_HELD, step_bytes: int = FOLD_BYTES,
                      groups_a_pass: int = GROUPS_A_PASS, sources_a_block: int = SOURCES_A_BLOCK) -> DataFrame:
    """Per (language, source): ``part`` 'pair', its divergence from every other source of the language,
    and ``part`` 'term', its ``top_terms`` terms most above the language; ``lang, source, part, item,
    value, rank``.

    Null texts, languages and sources are empty strings; every row is a document, repeated ids and
    texts too. A group without kept terms still has its pairs (value 0 in a language without kept
    terms) and no terms; a language of one source has no pairs. Equal values rank by item. Other
    columns are not read. An empty table gives an empty result."""
    tables = Steps(docs)
    stripes = tables.write(merge(fold(docs, text_col, lang_col, source_col, cells_held, step_bytes), min_docs))
    cells = stripes.select("lang", F.explode(F.arrays_zip("sources", "counts")).alias("x"))
    groups = cells.groupBy("lang", F.col("x.sources").alias("source")).agg(F.sum("x.counts").alias("n"))
    of_lang = (cells.groupBy("lang").agg(F.sum("x.counts").alias("n_lang"))
               .join(stripes.filter(F.length("term") > 0).groupBy("lang").agg(F.count(F.lit(1)).alias("terms")), "lang", "left"))
    # every source of a language is in its mark's stripe, so groups without terms are there with 0
    groups = tables.write(groups.withColumn("block", F.floor((F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1) / sources_a_block))
                          .join(of_lang, "lang").withColumn("terms", F.coalesce("terms", F.lit(0))))
    size = groups.agg(F.count(F.lit(1)).alias("n"), F.max("block").alias("b")).first()
    buckets, blocks = -(-size["n"] // groups_a_pass), (size["b"] or 0) + 1
    found = None
    for bucket in range(max(buckets, 1)):
        here = F.pmod(F.xxhash64("lang"), F.lit(max(buckets, 1))) == bucket
        for i in range(blocks):
            for j in range(i, blocks):
                langs = _langs_of(groups.filter(here & F.col("block").isin(i, j)).collect(), i, j)
                one = _pass(stripes.filter(here), langs, top_terms)
                found = one if found is None else found.union(one)
    total = found.groupBy("part", "lang", "source", "item").agg(F.sum("value").alias("value"))
    by = Window.partitionBy("part", "lang", "source").orderBy(F.col("value").desc(), "item")
    ranked = total.withColumn("rank", F.row_number().over(by)).filter((F.col("part") == "pair") | (F.col("rank") <= top_terms))
    return ranked.select("lang", "source", "part", F.col("item").cast("string").alias("item"), "value", "rank")


def _langs_of(rows: list, i: int, j: int) -> dict[str, tuple]:
    sides: dict[str, tuple[list, list]] = defaultdict(lambda: ([], []))
    facts = {}
    for r in sorted(rows, key=lambda r: (r["lang"], r["block"], r["source"].encode())):
        sides[r["lang"]][0 if r["block"] == i else 1].append((r["source"], r["n"]))
        facts[r["lang"]] = (r["terms"], r["n_lang"])
    return {lang: (*facts[lang], left, None if i == j else right) for lang, (left, right) in sides.items() if i == j or right}
