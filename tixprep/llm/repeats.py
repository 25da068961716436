"""Removal of repeated byte strings with suffix arrays, sorted in two stages.

A byte goes if a string of ``length`` bytes that covers it also starts earlier (in a row with a
smaller id, or earlier in the same text). All strings of that length are dealt to tasks by their
smallest 32-byte gram (by hash, leftmost on ties): equal strings have the same one, so they
meet. Neighbouring strings with the same gram are one segment, and only segments whose gram occurs
more than once go on:

* equal segments are one entry, the earliest; the later ones are repeats as a whole (found within a
  batch first, so that groups of copies do not travel, then over all rows);
* different segments of one gram get a suffix array. Only suffixes smaller than their successors
  are sorted directly, the others are induced by scanning the buckets of first bytes in order.
  Neighbours whose common prefix reaches ``length`` are repeats of the earliest among them;
* a gram shared by more than ``crowd`` different segments is not gathered: its strings are dealt
  one by one by their own 128-bit hash, and all but the earliest are repeats.

Scale: two passes over the texts and one shuffle of (gram, place) rows, about one for 35 bytes of
text; the texts of rows that hold repeats shuffle once by id. Tasks read sorted streams, no group is
held whole beyond ``crowd`` segments."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tixprep.llm.batches import column, list_array, mix, ranges, steps, utf8, word_hashes
from tixprep.llm.tables import Steps

LENGTH = 100
GRAM = 32
CROWD = 2000
# Places within a stretch of text take 24 bits beside 40 bits of a gram's hash.
STRETCH = 1 << 23
CHUNK_BYTES = 1 << 20
HELD_ROWS = 1 << 19
NO_ID = (1 << 63) - 1


def gram_hashes(raw: np.ndarray) -> np.ndarray:
    """64-bit hash of the 32 bytes from each place on, by doubling."""
    h = raw.astype(np.uint64) + np.uint64(1)
    factor = 0x9E3779B97F4A7C15
    for k in (1, 2, 4, 8, 16):
        h = h[:-k] * np.uint64(factor) + h[k:]
        factor = factor * factor % (1 << 64)
    return mix(h)


def least_grams(hashes: np.ndarray, length: int) -> np.ndarray:
    """Place of the smallest gram (leftmost on ties) of the string of ``length`` bytes from each place."""
    width = length - GRAM + 1
    best = (hashes >> np.uint64(24) << np.uint64(24)) | np.arange(len(hashes), dtype=np.uint64)
    reach = 1
    while 2 * reach <= width:
        best = np.minimum(best[:-reach], best[reach:])
        reach *= 2
    if reach < width:
        best = np.minimum(best[:reach - width], best[width - reach:])
    return (best & np.uint64(0xFFFFFF)).astype(np.int64)


def segments(raw: np.ndarray, offsets: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """Segments of one stretch: row, place in the row, number of strings, gram hash, content hash."""
    if len(raw) < length:
        return tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.int64, np.uint64, np.uint64))
    hashes = gram_hashes(raw)
    at = least_grams(hashes, length)
    rows = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))[:len(at)]
    whole = np.arange(len(at)) + length <= offsets[rows + 1]
    new = whole.copy()
    new[1:] &= ~whole[:-1] | (at[1:] != at[:-1])
    first = np.flatnonzero(new)
    stop = np.flatnonzero(whole & np.append(~whole[1:] | new[1:], True)) + 1
    content = word_hashes(raw, first, stop + length - 1)
    return rows[first], first - offsets[rows[first]], stop - first, hashes[at[first]], content


def joined_runs(key: np.ndarray, place: np.ndarray, count: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, ...]:
    """Sorted, with runs that follow one another in a row made one."""
    if len(key) == 0:
        return key, place, count, row
    by = np.lexsort((place, row, key))
    key, place, count, row = key[by], place[by], count[by], row[by]
    new = np.ones(len(key), bool)
    new[1:] = (key[1:] != key[:-1]) | (row[1:] != row[:-1]) | (place[1:] != place[:-1] + count[:-1])
    last = np.append(np.flatnonzero(new)[1:], len(key)) - 1
    return key[new], place[new], place[last] + count[last] - place[new], row[new]


def row_numbers(batch: pa.RecordBatch) -> np.ndarray:
    """What tells rows with the same key apart (0 where all keys differ)."""
    return np.asarray(column(batch, "row")) if "row" in batch.schema.names else np.zeros(len(batch), np.int64)


REPEAT, COMPARE, SPREAD = 0, 1, 2
ROWS = "gram long, content long, key long, place int, count int, kind int, row long"


def _rows(gram, content, key, place, count, kind, row) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([
        pa.array(gram.view(np.int64)), pa.array(content.view(np.int64)), pa.array(key), pa.array(place.astype(np.int32)), pa.array(count.astype(np.int32)),
        pa.array(np.full(len(key), kind, np.int32) if np.isscalar(kind) else kind.astype(np.int32)), pa.array(row)],
        ["gram", "content", "key", "place", "count", "kind", "row"])


def _repeats(key, place, count, row) -> pa.RecordBatch:
    key, place, count, row = joined_runs(key, place, count, row)
    # dealt by a hash of their own, so that they spread over the tasks
    return _rows(mix(key.astype(np.uint64) ^ (place.astype(np.uint64) << np.uint64(40))), np.zeros(len(key), np.uint64), key, place, count, REPEAT, row)


def _scan(batch: pa.RecordBatch, length: int) -> Iterator[pa.RecordBatch]:
    """All segments of a batch, each content once with its earliest place (in every row that has it
    there); the others are repeats."""
    raw, offsets = utf8(column(batch, "text"))
    keys, numbers = np.asarray(column(batch, "key")), row_numbers(batch)
    parts = []
    for i, j in steps(offsets):
        if offsets[j] - offsets[i] <= STRETCH:
            row, place, count, gram, content = segments(raw[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i], length)
            parts.append((keys[i + row], place, count, gram, content, numbers[i + row]))
            continue
        for start in range(0, int(offsets[j] - offsets[i]), STRETCH):  # one very long text
            part = raw[offsets[i] + start:min(offsets[j], offsets[i] + start + STRETCH + length - 1)]
            row, place, count, gram, content = segments(part, np.array([0, len(part)]), length)
            parts.append((keys[i + row], place + start, count, gram, content, numbers[i + row]))
    key, place, count, gram, content, row = (np.concatenate(x) for x in zip(*parts, strict=True))
    by = np.lexsort((row, place, key, content, gram))
    key, place, count, gram, content, row = (x[by] for x in (key, place, count, gram, content, row))
    new = np.ones(len(key), bool)
    new[1:] = (gram[1:] != gram[:-1]) | (content[1:] != content[:-1])
    if len(key):
        later = _later(key, place, new)
        goes_on = ~later & _differs(new, row)
        yield _rows(gram[goes_on], content[goes_on], key[goes_on], place[goes_on], count[goes_on], COMPARE, row[goes_on])
        if later.any():
            yield _repeats(key[later], place[later], count[later], row[later])


def _later(key: np.ndarray, place: np.ndarray, new: np.ndarray) -> np.ndarray:
    """Whether a row starts after the first of its group (rows that repeat an id start equally)."""
    first = np.flatnonzero(new)[np.cumsum(new) - 1]
    return (key != key[first]) | (place != place[first])


def _differs(new: np.ndarray, row: np.ndarray) -> np.ndarray:
    """Starts of groups, and rows other than the one before."""
    out = new.copy()
    out[1:] |= row[1:] != row[:-1]
    return out


class _Grams:
    """A stream sorted by gram, content, key, place, row: drops grams with one content, tells repeats,
    and passes on the earliest segment of each content (in every row that has it there) where a gram
    has several."""

    def __init__(self, crowd: int):
        self.crowd, self.held, self.n, self.spread = crowd, [], 0, None
        self.open = None  # the last content of a gram that is told before its end: gram, content, first key and place

    def add(self, cols: list) -> Iterator[pa.RecordBatch]:
        self.held.append(cols)
        self.n += len(cols[0])
        if self.n >= HELD_ROWS:
            yield from self.settle(False)

    def settle(self, last: bool) -> Iterator[pa.RecordBatch]:
        if not self.n:
            return
        gram, content, key, place, count, kind, row = (np.concatenate(x) for x in zip(*self.held, strict=True))
        keep = len(gram)
        if not last:
            keep = int(np.searchsorted(gram, gram[-1]))  # the last gram may go on
            if keep == 0:  # one gram fills all that is held: its contents are spread, and the last may go on
                self.spread = gram[0]
                keep = len(gram)
        rest = [x[keep:] for x in (gram, content, key, place, count, kind, row)]
        self.held, self.n = [rest], len(rest[0])
        gram, content, key, place, count, kind, row = (x[:keep] for x in (gram, content, key, place, count, kind, row))
        passed = kind == REPEAT
        if passed.any():
            yield _rows(gram[passed].view(np.uint64), content[passed].view(np.uint64), key[passed], place[passed], count[passed], REPEAT, row[passed])
        gram, content, key, place, count, row = (x[~passed] for x in (gram, content, key, place, count, row))
        if len(gram) == 0:
            return
        new = np.ones(len(gram), bool)
        new[1:] = (gram[1:] != gram[:-1]) | (content[1:] != content[:-1])
        later = _later(key, place, new)
        if self.open is not None and self.open[:2] == (gram[0], content[0]):
            group = slice(0, int(np.append(np.flatnonzero(new), len(new))[1]))
            later[group] = (key[group] != self.open[2]) | (place[group] != self.open[3])
        else:
            self.open = None
        if self.spread is not None and gram[-1] == self.spread:
            at = int(np.flatnonzero(new)[-1])
            if at or self.open is None:
                self.open = gram[at], content[at], key[at], place[at]
        if later.any():
            yield _repeats(key[later], place[later], count[later], row[later])
        goes_on = ~later & _differs(new, row)
        # contents are counted where they start; one that is told in two parts belongs to a spread gram
        gram, content, key, place, count, row, new = (x[goes_on] for x in (gram, content, key, place, count, row, new))
        if len(gram) == 0:
            return
        start = np.ones(len(gram), bool)
        start[1:] = gram[1:] != gram[:-1]
        group = np.cumsum(start) - 1
        spread = np.bincount(group)[group] > self.crowd
        if self.spread is not None:
            spread |= gram == self.spread
        some = (np.bincount(group, weights=new)[group] > 1) | spread
        if some.any():
            yield _rows(gram[some].view(np.uint64), content[some].view(np.uint64), key[some], place[some], count[some], np.where(spread[some], SPREAD, COMPARE), row[some])


def _sorted_stream(batches: Iterator[pa.RecordBatch], crowd: int) -> Iterator[pa.RecordBatch]:
    grams = _Grams(crowd)
    for batch in batches:
        yield from grams.add([np.asarray(c) for c in batch.columns])
    while grams.n:
        before = grams.n
        yield from grams.settle(True)
        if grams.n >= before:
            break


# -- suffix arrays in two stages ---------------------------------------------------------------

SYMBOLS = 257  # bytes from 1 on; 0 ends a segment
PACKED = 7  # symbols of 9 bits in one integer


def pack_symbols(text: np.ndarray, depth: int) -> np.ndarray:
    """The next PACKED symbols from each place on as one integer (0 beyond the end)."""
    wide = np.zeros(len(text) + depth + 2 * PACKED, np.uint64)
    wide[:len(text)] = text
    packed = np.zeros(len(wide) - PACKED + 1, np.uint64)
    for k in range(PACKED):
        packed |= wide[k:len(packed) + k] << np.uint64(9 * (PACKED - 1 - k))
    return packed


def smaller_than_next(text: np.ndarray) -> np.ndarray:
    """Whether each suffix is smaller than the one that starts a place later (true at the end)."""
    n = len(text)
    rise = np.ones(n, np.int8)
    rise[:-1] = np.sign(text[1:].astype(np.int32) - text[:-1])
    decided = np.where(rise != 0, np.arange(n), n)
    following = np.minimum.accumulate(decided[::-1])[::-1]
    return rise[np.minimum(following, n - 1)] > 0


def sort_directly(places: np.ndarray, packed: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes in order of their first ``depth`` symbols; ties are sorted deeper step by step."""
    order = places[np.argsort(packed[places], kind="stable")]
    key = packed[order]
    new = np.ones(len(order), bool)
    new[1:] = key[1:] != key[:-1]
    for step in range(PACKED, depth, PACKED):
        tied = ~new
        tied[:-1] |= ~new[1:]
        at = np.flatnonzero(tied)
        if len(at) == 0:
            break
        group = np.cumsum(new)[at]
        deeper = packed[order[at] + step]
        by = np.lexsort((deeper, group))
        order[at] = order[at][by]
        deeper = deeper[by]
        new[at[1:]] |= (group[1:] != group[:-1]) | (deeper[1:] != deeper[:-1])
    return order


def two_stage_sort(text: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffix array of ``text`` (symbols below SYMBOLS) to ``depth`` symbols, and the packed symbols.

    Stage one sorts the suffixes that are smaller than their successors. Stage two scans the
    buckets of first symbols in order: whenever a suffix is passed and the one before it is larger,
    that one takes the next free place of its own bucket. A bucket is scanned in waves, as it
    receives places from itself."""
    packed = pack_symbols(text, depth)
    small = smaller_than_next(text)
    direct = sort_directly(np.flatnonzero(small), packed, depth)
    bounds = np.searchsorted(text[direct], np.arange(SYMBOLS + 1))
    induced: list[list] = [[] for _ in range(SYMBOLS)]
    out = []

    def scan(places):
        out.append(places)
        before = places[places > 0] - 1
        before = before[~small[before]]
        if len(before) == 0:
            return
        symbol = text[before]
        by = np.argsort(symbol, kind="stable")
        before, symbol = before[by], symbol[by]
        cuts = np.flatnonzero(symbol[1:] != symbol[:-1]) + 1
        for part in np.split(before, cuts):
            induced[text[part[0]]].append(part)

    for symbol in range(SYMBOLS):
        wave = 0
        while wave < len(induced[symbol]):
            scan(induced[symbol][wave])
            wave += 1
        if bounds[symbol] < bounds[symbol + 1]:
            scan(direct[bounds[symbol]:bounds[symbol + 1]])
    return np.concatenate(out) if out else np.zeros(0, np.int64), packed


def common_prefixes(order: np.ndarray, packed: np.ndarray, depth: int) -> np.ndarray:
    """Length of the common prefix of each suffix with the one before it in order, at most ``depth``."""
    shared = np.zeros(len(order), np.int64)
    alive = np.arange(1, len(order))
    for step in range(0, depth, PACKED):
        if len(alive) == 0:
            break
        differ = packed[order[alive] + step] ^ packed[order[alive - 1] + step]
        same = np.full(len(alive), PACKED)
        for k in range(PACKED):
            same -= differ >= np.uint64(1 << (9 * k))
        shared[alive] += same
        alive = alive[differ == 0]
    return np.minimum(shared, depth)


def _compare(key: np.ndarray, place: np.ndarray, count: np.ndarray, row: np.ndarray, data: np.ndarray, sizes: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """Strings of the given segments that also start earlier in one of them."""
    ends = np.cumsum(sizes + 1)
    text = np.zeros(int(ends[-1]), np.uint16)
    inside = np.ones(len(text), bool)
    inside[ends - 1] = False
    text[inside] = data.astype(np.uint16) + 1
    order, packed = two_stage_sort(text, length)
    starts, which = ranges(ends - sizes - 1, ends - sizes - 1 + count)
    owner = np.full(len(text), -1, np.int64)
    owner[starts] = which
    order = order[owner[order] >= 0]
    run = np.cumsum(common_prefixes(order, packed, length) < length) - 1
    many = np.bincount(run)[run] > 1
    order, run = order[many], run[many]
    own = owner[order]
    key, place, row = key[own], place[own] + order - (ends - sizes - 1)[own], row[own]
    by = np.lexsort((place, key, run))
    key, place, row, run = key[by], place[by], row[by], run[by]
    new = np.ones(len(run), bool)
    new[1:] = run[1:] != run[:-1]
    later = ~new & _later(key, place, new) if len(run) else new
    return key[later], place[later], row[later]


def _segment_texts(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """The bytes of the listed segments of each row; spread segments as hashes of single strings."""
    for batch in batches:
        raw, offsets = utf8(column(batch, "text"))
        keys, numbers, lists = np.asarray(column(batch, "key")), row_numbers(batch), column(batch, "segments")
        flat = lists.flatten()
        place, count, gram, kind = (np.asarray(flat.field(x)) for x in ("place", "count", "gram", "kind"))
        row = np.repeat(np.arange(len(batch)), np.diff(np.asarray(lists.offsets)))
        start = offsets[row] + place
        whole = np.flatnonzero(kind == COMPARE)
        for k in range(0, len(whole), 1 << 15):
            part = whole[k:k + (1 << 15)]
            sizes = count[part].astype(np.int64) + length - 1
            at, _ = ranges(start[part], start[part] + sizes)
            bounds = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
            texts = pa.BinaryArray.from_buffers(pa.binary(), len(part), [None, pa.py_buffer(bounds.tobytes()), pa.py_buffer(raw[at].tobytes())])
            yield _string_rows(gram[part], np.zeros(len(part), np.int64), keys[row[part]], place[part], count[part], texts, numbers[row[part]])
        spread = np.flatnonzero(kind == SPREAD)
        for k in range(0, len(spread), 1 << 12):
            part = spread[k:k + (1 << 12)]
            first, which = ranges(start[part], start[part] + count[part])
            # hashed segment by segment, so that the arrays stay as long as the segments
            sizes = count[part].astype(np.int64) + length - 1
            at, _ = ranges(start[part], start[part] + sizes)
            shift = (np.cumsum(sizes) - sizes)[which] + first - start[part][which]
            own = raw[at]
            one = word_hashes(own, shift, shift + length)
            two = word_hashes((own * np.uint8(167)) ^ np.uint8(0x5A), shift, shift + length)
            yield _string_rows(one.view(np.int64), two.view(np.int64), keys[row[part]][which], place[part][which] + first - start[part][which],
                               np.ones(len(first), np.int32), pa.nulls(len(first), pa.binary()), numbers[row[part]][which])


STRINGS = "gram long, second long, key long, place int, count int, data binary, row long"


def _string_rows(gram, second, key, place, count, data, row) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(gram), pa.array(second), pa.array(key), pa.array(place.astype(np.int32)), pa.array(count.astype(np.int32)), data, pa.array(row)],
                                      ["gram", "second", "key", "place", "count", "data", "row"])


FOUND = "key long, place int, count int, row long"


def _found(key, place, row, with_row: bool) -> pa.RecordBatch:
    key, place, count, row = joined_runs(key, place, np.ones(len(key), np.int64), row)
    arrays = [pa.array(key), pa.array(place.astype(np.int32)), pa.array(count.astype(np.int32))] + [pa.array(row)] * with_row
    return pa.RecordBatch.from_arrays(arrays, ["key", "place", "count"] + ["row"] * with_row)


def _sort_chunks(batches: Iterator[pa.RecordBatch], length: int, with_row: bool = False) -> Iterator[pa.RecordBatch]:
    """Suffix arrays over a stream sorted by gram: whole grams, about CHUNK_BYTES at a time."""
    held: list[pa.RecordBatch] = []
    size = 0

    def settle(last: bool):
        nonlocal held, size
        table = pa.Table.from_batches(held).combine_chunks()
        gram = table["gram"].to_numpy()
        cut = len(gram) if last else int(np.flatnonzero(gram != gram[-1])[-1]) + 1 if (gram != gram[-1]).any() else 0
        rest = table.slice(cut)
        held = rest.combine_chunks().to_batches()
        size = rest["data"].nbytes if rest.num_rows else 0
        if cut:
            part = table.slice(0, cut).combine_chunks().to_batches()[0]
            data, offsets = utf8(part.column(5))
            yield _found(*_compare(*(np.asarray(part.column(k)).astype(np.int64) for k in (2, 3, 4, 6)), data, np.diff(offsets), length), with_row)

    for batch in batches:
        held.append(batch)
        size += column(batch, "data").nbytes
        if size >= CHUNK_BYTES:
            yield from settle(False)
    if held:
        yield from settle(True)


def repeated_strings(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, crowd: int = CROWD) -> tuple[DataFrame, DataFrame]:
    """``(rows, found)``: the rows as (key, row, doc_id, text) and, by key and row, the runs of string
    starts (place, count) that also start earlier. ``key`` gives the order; ``row`` is a 64-bit hash
    of the text, which tells rows apart that share a key and is the same in every pass (rows alike
    in both have the same runs)."""
    if length < GRAM:
        raise ValueError(f"strings of at least {GRAM} bytes")
    tables = Steps(docs)
    rows = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("key"), F.xxhash64(F.col(text_col)).alias("row"), F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))

    def scan(batches):
        for batch in batches:
            if batch.num_rows:
                yield from _scan(batch, length)

    found = rows.select("key", "row", "text").mapInArrow(scan, ROWS)
    ordered = found.repartition("gram").sortWithinPartitions("gram", "content", "key", "place", "row")
    passed = tables.write(ordered.mapInArrow(lambda batches: _sorted_stream(batches, crowd), ROWS))
    listed = passed.filter(F.col("kind") != REPEAT).groupBy("key", "row").agg(F.collect_list(F.struct("place", "count", "gram", "kind")).alias("segments"))
    strings = rows.select("key", "row", "text").join(listed, ["key", "row"]).select("key", "row", "text", "segments").mapInArrow(lambda batches: _segment_texts(batches, length), STRINGS)
    strings = tables.write(strings)
    compared = (strings.filter("data is not null").repartition("gram").sortWithinPartitions("gram")
                .mapInArrow(lambda batches: _sort_chunks(batches, length, True), FOUND))
    single = strings.filter("data is null").select("gram", "second", "key", "place", "row")
    least = single.groupBy("gram", "second").agg(F.min(F.struct("key", "place")).alias("first"), F.count("*").alias("n")).filter("n > 1")
    spread = single.join(least, ["gram", "second"]).filter(F.struct("key", "place") > F.col("first")).select("key", "place", F.lit(1).alias("count"), "row")
    whole = passed.filter(F.col("kind") == REPEAT).select("key", "place", "count", "row")
    return rows, whole.unionAll(compared).unionAll(spread)


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, crowd: int = CROWD, with_bytes: bool = False) -> DataFrame:
    """Per row: ``doc_id, n_bytes, n_removed, n_spans`` (maximal removed runs), ``kept_sha256``, and with
    ``with_bytes`` the ``kept`` bytes and the removed ``spans`` (start, end). A null text has no
    bytes. Rows that repeat an id are one document: a string that starts at the same place of such
    rows does not start earlier, but each row is cut by its own text. Rows without an id come after
    all others, as one document."""
    rows, found = repeated_strings(docs, id_col, text_col, length, crowd)
    listed = found.groupBy("key", "row").agg(F.collect_list(F.struct("place", "count")).alias("runs"))
    id_type = dict(rows.dtypes)["doc_id"]
    schema = f"doc_id {id_type}, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept binary, spans array<struct<start:long,end:long>>" * with_bytes

    def cut(batches):
        for batch in batches:
            if batch.num_rows:
                yield _cut(batch, length, with_bytes)

    return rows.join(listed, ["key", "row"], "left").select("key", "text", "doc_id", "runs").mapInArrow(cut, schema)


def _cut(batch: pa.RecordBatch, length: int, with_bytes: bool) -> pa.RecordBatch:
    raw, offsets = utf8(column(batch, "text"))
    lists = column(batch, "runs")
    removed, spans, digests, kept, cuts = [], [], [], [], []
    for k, run in enumerate(lists):
        data = raw[offsets[k]:offsets[k + 1]]
        start, end = np.zeros(0, np.int64), np.zeros(0, np.int64)
        if run.is_valid and len(run):
            place, count = (np.asarray(run.values.field(x)).astype(np.int64) for x in ("place", "count"))
            by = np.argsort(place, kind="stable")
            place = place[by]
            far = np.maximum.accumulate(place + count[by] + length - 1)
            new = np.ones(len(place), bool)
            new[1:] = place[1:] > far[:-1]
            start = place[new]
            end = far[np.append(np.flatnonzero(new)[1:], len(place)) - 1]
        stays = np.ones(len(data), bool)
        for a, b in zip(start, end, strict=True):
            stays[a:b] = False
        rest = data[stays].tobytes() if len(start) else data.tobytes()
        removed.append(int((end - start).sum()))
        spans.append(len(start))
        digests.append(hashlib.sha256(rest).hexdigest())
        if with_bytes:
            kept.append(rest)
            cuts.append((start, end))
    arrays = [column(batch, "doc_id"), pa.array(np.diff(offsets)), pa.array(removed, pa.int64()), pa.array(spans, pa.int64()), pa.array(digests, pa.string())]
    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    if with_bytes:
        ends = [np.concatenate([c[k] for c in cuts]) for k in (0, 1)]
        arrays += [pa.array(kept, pa.binary()), list_array(np.array(spans), pa.StructArray.from_arrays([pa.array(x, pa.int64()) for x in ends], ["start", "end"]))]
        names += ["kept", "spans"]
    return pa.RecordBatch.from_arrays(arrays, names)
