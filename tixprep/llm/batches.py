"""Arrow batch helpers shared by the operators that work on whole texts inside tasks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

# How many bytes of text one numpy step looks at; longer texts are a step of their own.
STEP_BYTES = 1 << 20


def arrow_map(df: DataFrame, fn, schema: str) -> DataFrame:
    """``df.mapInArrow`` with ``fn(batch) -> batch`` applied to every non-empty batch.

    An empty input still yields the schema: Spark then simply sees no batch."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                out = fn(batch)
                if out is not None and out.num_rows:
                    yield out
    return df.mapInArrow(run, schema)


def column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


def utf8(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column and its len+1 offsets; a null is an empty text."""
    if pa.types.is_null(col.type):
        return np.zeros(0, np.uint8), np.zeros(len(col) + 1, np.int64)
    if col.null_count:
        col = pc.fill_null(col, "")
    wide = pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type)
    _, where, data = col.buffers()
    offsets = np.frombuffer(where, np.int64 if wide else np.int32)[col.offset:col.offset + len(col) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0]:offsets[-1]], offsets - offsets[0]


def steps(offsets: np.ndarray, limit: int = STEP_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``limit`` bytes each (a single longer row is its own range)."""
    n, i = len(offsets) - 1, 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, "right")) - 1)
        yield i, j
        i = j


_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def lower_ascii(raw: np.ndarray) -> np.ndarray:
    """A-Z to a-z, all other bytes as they are."""
    return _LOWER[raw]


def word_spans(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the runs of ``inside`` bytes, cut at row bounds, and words per row."""
    n = len(inside)
    if n == 0:
        z = np.zeros(0, np.int64)
        return z, z, np.zeros(len(offsets) - 1, np.int64)
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    before = np.empty(n, bool)
    before[0], before[1:] = False, inside[:-1]
    starts = np.flatnonzero(inside & (~before | edge[:-1]))
    after = np.empty(n, bool)
    after[-1], after[:-1] = False, inside[1:]
    ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
    return starts, ends, np.diff(np.searchsorted(starts, offsets))


_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    size = STEP_BYTES if n <= STEP_BYTES else n
    if size not in _powers:
        up, down = np.full(size, _BASE), np.full(size + 1, _INVERSE)
        up[0] = down[0] = 1
        tables = np.multiply.accumulate(up), np.multiply.accumulate(down)
        if size > STEP_BYTES:
            return tables
        _powers[size] = tables
    return _powers[size]


def mix(h: np.ndarray) -> np.ndarray:
    """Finalizer that spreads every input bit (multiply and shift, as in public 64-bit hashes)."""
    h = h ^ (h >> np.uint64(31))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(32))


def word_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit fingerprint of each span raw[start:end]: a polynomial read off one running sum."""
    if len(starts) == 0:
        return np.zeros(0, np.uint64)
    up, down = _power_tables(len(raw))
    total = np.empty(len(raw) + 1, np.uint64)
    total[0] = 0
    np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * up[:len(raw)], out=total[1:])
    return mix((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def ranges(lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All integers of the ranges [lo, hi) in order, and which range each comes from."""
    n = (hi - lo).astype(np.int64)
    which = np.repeat(np.arange(len(n)), n)
    first = np.cumsum(n) - n
    return np.arange(n.sum()) - first[which] + np.asarray(lo)[which], which


def list_array(lengths: np.ndarray, values: pa.Array) -> pa.ListArray:
    offsets = np.zeros(len(lengths) + 1, np.int32)
    np.cumsum(lengths, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values)
