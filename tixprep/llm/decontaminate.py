"""Benchmark decontamination with suffix arrays over the training texts.

Every task turns its rows into shards of a few hundred thousand words, sorts the shard's word
suffixes (a suffix array over word symbols) and binary-searches all benchmark suffixes in it:
the range of training suffixes that agree on a whole window gives the occurrences, and consecutive
windows on one diagonal join to the longest verbatim matches. Rows are independent of each other, so
nothing shuffles and a hot source or group of copies is no hot key.

The benchmark is read in blocks of bounded size (``block_bytes`` of text); each block is one pass
over the rows, the hits add up in a column. A single item above the bound is a block of its own."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from tixprep.llm.batches import arrow_map, column, list_array, lower_ascii, ranges, steps, utf8, word_hashes, word_spans
from tixprep.llm.tables import Steps, free_name

WINDOW = 13
# Suffixes are sorted up to this many words, beyond the longest window searched.
DEPTH = 16

_WORD = np.zeros(256, bool)
_WORD[0x30:0x3A] = True
_WORD[0x61:0x7B] = True
_WORD[0x80:] = True


def words(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Fingerprints of the words of all rows in order, and the number of words per row."""
    low = lower_ascii(raw)
    starts, ends, counts = word_spans(_WORD[low], offsets)
    return word_hashes(low, starts, ends), counts


def symbols(fingerprints: np.ndarray) -> np.ndarray:
    """32-bit symbols for sorting; 0 is kept for the end of a row."""
    return np.maximum(fingerprints >> np.uint64(32), np.uint64(1))


def suffix_array(seq: np.ndarray, depth: int = DEPTH) -> tuple[np.ndarray, np.ndarray]:
    """Order of the suffixes of ``seq`` (32-bit symbols) by their first ``depth`` symbols, and the
    symbol pairs at each position. Pairs are sorted at once; only ties are sorted deeper."""
    n = len(seq)
    padded = np.zeros(n + depth + 2, np.uint64)
    padded[:n] = seq
    pairs = (padded[:-1] << np.uint64(32)) | padded[1:]
    order = np.argsort(pairs[:n], kind="stable")
    key = pairs[order]
    new = np.ones(n, bool)
    np.not_equal(key[1:], key[:-1], out=new[1:])
    for step in range(2, depth, 2):
        tied = ~new
        tied[:-1] |= ~new[1:]
        at = np.flatnonzero(tied)
        if len(at) == 0:
            break
        group = np.cumsum(new)[at]
        sub = order[at]
        deeper = pairs[sub + step]
        by = np.lexsort((deeper, group))
        order[at] = sub[by]
        deeper = deeper[by]
        new[at[1:]] = (group[1:] != group[:-1]) | (deeper[1:] != deeper[:-1])
    return order, pairs


def _bound(order, pairs, lo, hi, step, value, right):
    """Per range [lo, hi) of the suffix array: first place whose pair at ``step`` is >= (or >) value."""
    lo, hi = lo.copy(), hi.copy()
    while True:
        open_ = lo < hi
        if not open_.any():
            return lo
        mid = (lo + hi) >> 1
        seen = pairs[order[np.minimum(mid, len(order) - 1)] + step]
        below = (seen <= value) if right else (seen < value)
        go = open_ & below
        lo = np.where(go, mid + 1, lo)
        hi = np.where(open_ & ~below, mid, hi)


def find_ranges(order: np.ndarray, pairs: np.ndarray, test: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each test suffix (a row of ``test``, symbols padded with 0; ``lengths`` words to match):
    the range of the suffix array whose suffixes start with those words."""
    count = len(test)
    lo, hi = np.zeros(count, np.int64), np.full(count, len(order), np.int64)
    if len(order) == 0:
        return lo, lo
    alive = np.arange(count)
    for step in range(0, test.shape[1], 2):
        alive = alive[(lengths[alive] > step) & (lo[alive] < hi[alive])]
        if len(alive) == 0:
            break
        first = test[alive, step] << np.uint64(32)
        second = test[alive, step + 1] if step + 1 < test.shape[1] else np.zeros(len(alive), np.uint64)
        half = lengths[alive] == step + 1
        low = np.where(half, first, first | second)
        high = np.where(half, first | np.uint64(0xFFFFFFFF), first | second)
        a, b = lo[alive], hi[alive]
        if step == 0:
            firsts = pairs[order]
            lo[alive], hi[alive] = np.searchsorted(firsts, low, "left"), np.searchsorted(firsts, high, "right")
        else:
            lo[alive], hi[alive] = _bound(order, pairs, a, b, step, low, False), _bound(order, pairs, a, b, step, high, True)
    return lo, np.maximum(lo, hi)


class TestSuffixes:
    """All windows of one block of items: distinct windows once, with the items that hold them."""

    __test__ = False

    def __init__(self, ids: list[str], texts: list[str | None], window: int):
        raw, offsets = utf8(pa.array(texts, pa.string()))
        prints, counts = words(raw, offsets)
        first = np.cumsum(counts) - counts
        per = np.where(counts == 0, 0, np.maximum(counts - window + 1, 1))
        at, item = ranges(first, first + per)
        length = np.minimum(counts[item], window).astype(np.int64)
        grid = at[:, None] + np.arange(window)
        inside = np.arange(window) < length[:, None]
        full = np.where(inside, prints[np.minimum(grid, max(len(prints) - 1, 0))], np.uint64(0)) if len(at) else np.zeros((0, window), np.uint64)
        self.prints, back = np.unique(full, axis=0, return_inverse=True)
        back = back.reshape(-1)
        self.lengths = (self.prints != 0).sum(axis=1).astype(np.int64)
        self.symbols = np.where(self.prints != 0, symbols(self.prints), np.uint64(0))
        by = np.lexsort((item, back))
        self.item = item[by]
        self.place = (at - first[item])[by]
        self.first = np.searchsorted(back[by], np.arange(len(self.prints) + 1))
        self.ids = ids


def shard_hits(prints: np.ndarray, counts: np.ndarray, test: TestSuffixes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Occurrences of test windows in the rows of one shard: row, word place in the row, window."""
    z = np.zeros(0, np.int64)
    if len(prints) == 0 or len(test.prints) == 0:
        return z, z, z
    rows = np.repeat(np.arange(len(counts)), counts)
    seq = np.zeros(len(prints) + len(counts), np.uint64)
    where = np.arange(len(prints)) + rows
    seq[where] = symbols(prints)
    order, pairs = suffix_array(seq)
    lo, hi = find_ranges(order, pairs, test.symbols, test.lengths)
    at, window = ranges(lo, hi)
    if len(at) == 0:
        return z, z, z
    full = np.zeros(len(seq) + test.prints.shape[1], np.uint64)
    full[where] = prints
    place = order[at]
    same = np.ones(len(place), bool)
    for k in range(test.prints.shape[1]):  # the sort's 32-bit symbols propose, whole fingerprints decide
        same &= (full[place + k] == test.prints[window, k]) | (test.lengths[window] <= k)
    place, window = place[same], window[same]
    owner = np.zeros(len(seq), np.int64)
    owner[where] = rows
    row = owner[place]
    return row, place - (np.cumsum(counts) - counts + np.arange(len(counts)))[row], window


HITS = "struct<spans:array<struct<start:int,end:int>>,matches:array<struct<item_id:string,item_place:int,place:int,n_words:int>>>"


def _spans(row, start, end, n_rows):
    """Union of word intervals per row: (row, start, end) merged and sorted."""
    if len(row) == 0:
        return row, start, end
    by = np.lexsort((start, row))
    row, start, end = row[by], start[by], end[by]
    shift = row * (np.int64(1) << 40)
    reach = np.maximum.accumulate(end + shift)
    new = np.ones(len(row), bool)
    new[1:] = (start + shift)[1:] > reach[:-1]
    last = np.append(np.flatnonzero(new)[1:], len(row)) - 1
    return row[new], start[new], (reach - shift)[last]


def _matches(row, place, window, test: TestSuffixes, lengths):
    """Consecutive windows of one item on one diagonal joined: the longest verbatim matches."""
    use, which = ranges(test.first[window], test.first[window + 1])
    row, place, item, at, n = row[which], place[which], test.item[use], test.place[use], lengths[window][which]
    diagonal = place - at
    by = np.lexsort((place, diagonal, item, row))
    row, place, item, at, n, diagonal = (x[by] for x in (row, place, item, at, n, diagonal))
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (item[1:] != item[:-1]) | (diagonal[1:] != diagonal[:-1]) | (place[1:] != place[:-1] + 1)
    last = np.append(np.flatnonzero(new)[1:], len(row)) - 1
    return row[new], item[new], at[new], place[new], place[last] + n[last] - place[new]


def _scan(col: pa.Array, test: TestSuffixes) -> tuple[np.ndarray, pa.Array]:
    """Per row: number of words, and spans and matches of the block's items."""
    raw, offsets = utf8(col)
    n_words = np.zeros(len(col), np.int64)
    found, matched = [], []
    for i, j in steps(offsets):
        prints, counts = words(raw[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])
        n_words[i:j] = counts
        row, place, window = shard_hits(prints, counts, test)
        if len(row):
            r, s, e = _spans(row, place, place + test.lengths[window], j - i)
            found.append((r + i, s, e))
            r, item, at, p, n = _matches(row, place, window, test, test.lengths)
            matched.append((r + i, item, at, p, n))
    def join(parts, k):
        return [np.concatenate(x) for x in zip(*parts, strict=True)] if parts else [np.zeros(0, np.int64)] * k
    row, start, end = join(found, 3)
    spans = list_array(np.bincount(row, minlength=len(col)), pa.StructArray.from_arrays(
        [pa.array(start, pa.int32()), pa.array(end, pa.int32())], ["start", "end"]))
    row, item, at, place, n = join(matched, 5)
    ids = pa.array([test.ids[k] for k in item], pa.string())
    matches = list_array(np.bincount(row, minlength=len(col)), pa.StructArray.from_arrays(
        [ids, *(pa.array(x, pa.int32()) for x in (at, place, n))], ["item_id", "item_place", "place", "n_words"]))
    return n_words, pa.StructArray.from_arrays([spans, matches], ["spans", "matches"])


def _blocks(benchmark: DataFrame, id_col: str, text_col: str, window: int, block_bytes: int) -> list:
    """The benchmark as test suffixes, at most ``block_bytes`` of text each."""
    items = benchmark.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).alias("text")).filter("text is not null")
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = -(-total // block_bytes) or 1
    for k in range(n):
        part = items.filter(F.pmod(F.xxhash64("id", "text"), F.lit(n)) == k) if n > 1 else items
        rows = sorted((r["id"] or "", r["text"]) for r in part.toLocalIterator())
        yield TestSuffixes([r[0] for r in rows], [r[1] for r in rows], window)


def find_matches(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 item_id: str = "item_id", item_text: str = "text", window: int = WINDOW, block_bytes: int = 8 << 20) -> DataFrame:
    """``doc_id, n_words, spans, matches`` of every row of ``docs``: ``spans`` are the word ranges
    inside any occurrence of a window, ``matches`` the longest verbatim matches with item, place in
    the item, place in the text and length in words. A null text has no words; an item without
    words has no windows; repeated rows each get their own row."""
    if window > DEPTH:
        raise ValueError(f"windows of at most {DEPTH} words")
    spark, out = docs.sparkSession, docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    id_type = dict(out.dtypes)["doc_id"]
    tables = Steps(docs)
    blocks = list(_blocks(benchmark, item_id, item_text, window, block_bytes))
    for k, block in enumerate(blocks):
        shared = spark.sparkContext.broadcast(block)
        last = k == len(blocks) - 1

        def run(batch: pa.RecordBatch, shared=shared, k=k, last=last) -> pa.RecordBatch:
            n_words, hits = _scan(column(batch, "text"), shared.value)
            earlier = [column(batch, f"hits{i}") for i in range(k)]
            arrays = [column(batch, "doc_id"), *([] if last else [column(batch, "text")]), pa.array(n_words), *earlier, hits]
            return pa.RecordBatch.from_arrays(arrays, ["doc_id", *([] if last else ["text"]), "n_words", *(f"hits{i}" for i in range(k + 1))])

        schema = [f"doc_id {id_type}", *([] if last else ["text string"]), "n_words long", *(f"hits{i} {HITS}" for i in range(k + 1))]
        out = arrow_map(out, run, ", ".join(schema))
        if not last:
            out = tables.write(out)
    names = [f"hits{i}" for i in range(len(blocks))]
    return out.select("doc_id", "n_words",
                      F.concat(*[F.col(f"{n}.spans") for n in names]).alias("spans"),
                      F.concat(*[F.col(f"{n}.matches") for n in names]).alias("matches"))


def hit_words(spans: str = "spans"):
    """Number of words inside at least one span (spans of several blocks may overlap)."""
    merged = F.aggregate(
        F.array_sort(F.col(spans)),
        F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("reach")),
        lambda s, x: F.struct(
            (s["n"] + F.greatest(x["end"].cast("long") - F.greatest(x["start"].cast("long"), s["reach"]), F.lit(0).cast("long"))).alias("n"),
            F.greatest(s["reach"], x["end"].cast("long")).alias("reach")))
    return F.when(F.size(spans) == 0, F.lit(0).cast("long")).otherwise(merged["n"])


def contamination(docs: DataFrame, benchmark: DataFrame, percent: int = 5, **names) -> DataFrame:
    """Per row: ``doc_id, n_words, n_hit, n_items, items_sha256, contaminated, matches``.
    Contaminated: some word is hit, and at least ``percent`` of every 100 words."""
    found = find_matches(docs, benchmark, **names).withColumn("n_hit", hit_words())
    items = F.array_sort(F.array_distinct(F.col("matches.item_id")))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size(items).cast("long").alias("n_items"),
        F.sha2(F.array_join(items, ","), 256).alias("items_sha256"),
        ((F.col("n_hit") > 0) & (F.col("n_hit") * 100 >= F.col("n_words") * percent)).alias("contaminated"), "matches")


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", percent: int = 5,
                        item_id: str = "item_id", item_text: str = "text", window: int = WINDOW, block_bytes: int = 8 << 20) -> DataFrame:
    """The rows of ``docs`` that are not contaminated, all columns as they are."""
    tables, out = Steps(docs), docs
    spark = docs.sparkSession
    blocks = list(_blocks(benchmark, item_id, item_text, window, block_bytes))
    if len(blocks) > 1:
        # hits of several blocks only count together: mark the rows by position in a written copy
        row, bad_row = free_name(docs, "row"), free_name(docs, "bad")
        marked = tables.write(docs.withColumn(row, F.monotonically_increasing_id()))
        bad = contamination(marked, benchmark, percent, id_col=row, text_col=text_col, item_id=item_id,
                            item_text=item_text, window=window, block_bytes=block_bytes).filter("contaminated").select(F.col("doc_id").alias(bad_row))
        return marked.join(bad, F.col(row) == F.col(bad_row), "left_anti").drop(row)
    shared = spark.sparkContext.broadcast(blocks[0])

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        n_words, hits = _scan(column(batch, text_col), shared.value)
        spans = hits.field("spans")
        flat = spans.flatten()
        width = np.asarray(flat.field("end")) - np.asarray(flat.field("start"))
        rows = np.repeat(np.arange(len(spans)), np.diff(np.asarray(spans.offsets)))
        n_hit = np.bincount(rows, weights=width, minlength=len(spans)).astype(np.int64)
        return batch.filter(pa.array(~((n_hit > 0) & (n_hit * 100 >= n_words * percent))))

    return arrow_map(out, run, T.StructType(docs.schema.fields))
