"""Packing token streams into sequences by multiway differencing (Karmarkar-Karp).

Each task tokenizes its rows, cuts off whole sequences, and fills a bucket with the remainders
(cut evenly so that no piece is longer than ``piece_limit``). A full bucket is partitioned into
windows: the two partial partitions with the largest spread merge, the fullest windows of one with
the emptiest of the other, until one is left whose windows are nearly equal. Should a window exceed
the capacity, the number of windows rises and the bucket is partitioned again.

Nothing shuffles: buckets are made of the rows a task reads, in their order, so a lost task gives
the same rows again. Sequence ids hold the partition in their upper bits."""

from __future__ import annotations

import heapq
import json
import re
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F
from tokenizers import Tokenizer, pre_tokenizers

from tixprep.llm.batches import column, ranges, steps, utf8, word_hashes, word_spans

CAPACITY = 2048
PIECE_LIMIT = 512
# Tokens of remainders that are partitioned together (about 200 windows).
BUCKET_TOKENS = 400 * 1024
# Words and parts whose ids a worker remembers; each memory starts anew when it is full.
REMEMBERED_WORDS = 600_000
REMEMBERED_PARTS = 150_000
# New parts encoded in one call.
PARTS_AT_ONCE = 20_000

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def differencing(sizes: np.ndarray, windows: int) -> np.ndarray:
    """Window of each size such that the window sums are nearly equal."""
    n = len(sizes)
    if windows == 1 or n == 0:
        return np.zeros(n, np.int64)
    sums: list = []
    for x in sizes:
        row = np.zeros(windows, np.int64)
        row[-1] = x
        sums.append(row)
    heap = [(-int(x), i) for i, x in enumerate(sizes)]
    heapq.heapify(heap)
    merges = []
    while len(heap) > 1:
        a, b = heapq.heappop(heap)[1], heapq.heappop(heap)[1]
        total = sums[a] + sums[b][::-1]  # opposing imbalances: fullest beside emptiest
        by = np.argsort(total, kind="stable")
        total = total[by]
        sums[a] = sums[b] = None
        sums.append(total - total[0])
        merges.append((a, b, by))
        heapq.heappush(heap, (int(total[0] - total[-1]), len(sums) - 1))
    placed = {heap[0][1]: np.arange(windows)}
    out = np.zeros(n, np.int64)
    for k in range(len(merges) - 1, -1, -1):
        a, b, by = merges[k]
        window = np.empty(windows, np.int64)
        window[by] = placed.pop(n + k)
        for part, own in ((a, window), (b, window[::-1])):
            if part < n:
                out[part] = own[-1]
            else:
                placed[part] = own
    return out


def windows_of(sizes: np.ndarray, capacity: int = CAPACITY) -> np.ndarray:
    """Window of each size, no window above ``capacity``; the count starts at the least possible
    and rises by what overflows."""
    count = max(1, -(-int(sizes.sum()) // capacity))
    while True:
        window = differencing(sizes, count)
        over = np.maximum(np.bincount(window, weights=sizes, minlength=count) - capacity, 0).sum()
        if over == 0:
            return window
        count += max(1, int(over // capacity))


# What a tokenizer file must say for texts to be looked up word by word.
_WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_WORD_NORMALIZERS = ["NFC", "Replace", "Lowercase"]
# Letters and signs (up to Latin Extended-A) on which NFC and lower case leave no doubt, and the word
# pattern written out for them; other words go to the tokenizer whole.
_ODD = re.compile("[^!-~\u00a1-\u012f\u0131-\u017f]")
_PARTS = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zªµºß-öø-ſ]+|[0-9²³¹¼½¾]|[^\na-zªµºß-öø-ſ0-9²³¹¼½¾]+")


class Encoder:
    """Token ids of whole texts. For a tokenizer that drops white space and marks word ends, the ids
    of a text are those of its words in turn, and those of a word the ids of its parts: seen words and
    parts are looked up, new parts are encoded together. Words are known by their 64-bit fingerprints
    (two of a million words share one with odds of 1 to 37 million). Any other tokenizer gets the
    texts whole."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.tokenizer = Tokenizer.from_file(path)
        normalizers = [x["type"] for x in (spec.get("normalizer") or {}).get("normalizers", [])]
        splits = [x for x in (spec.get("pre_tokenizer") or {}).get("pretokenizers", []) if x["type"] == "Split"]
        suffix = spec["model"].get("end_of_word_suffix")
        self.by_words = bool(suffix) and normalizers == _WORD_NORMALIZERS and [x["pattern"].get("Regex") for x in splits] == [_WORD_PATTERN]
        if self.by_words:
            self.parts_only = Tokenizer(self.tokenizer.model)
            self.parts_only.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
            self.ends = np.zeros(self.tokenizer.get_vocab_size() + 1, bool)
            self.ends[[i for w, i in self.tokenizer.get_vocab().items() if w.endswith(suffix)]] = True
            # words with the string of an added token are left to the whole tokenizer, as other odd ones are
            self.added = [t["content"].lower() for t in spec.get("added_tokens", [])]
            self.parts: dict[str, bytes] = {}
            self._forget()

    def _forget(self) -> None:
        self.hashes, self.first, self.length = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.uint32)

    def _learn_parts(self, parts: list[str]) -> None:
        for k in range(0, len(parts), PARTS_AT_ONCE):
            some = parts[k:k + PARTS_AT_ONCE]
            ids = np.array(self.parts_only.encode_batch_fast([" ".join(some)], add_special_tokens=False)[0].ids, np.uint32)
            ends = np.flatnonzero(self.ends[ids]) + 1
            if len(ends) != len(some):
                raise ValueError("the tokenizer's parts do not end with its end mark")
            data = ids.tobytes()
            at = 0
            for part, end in zip(some, ends.tolist(), strict=True):
                self.parts[part] = data[4 * at:4 * end]
                at = end

    def _ids_of(self, words: list[bytes]) -> list[bytes]:
        """The ids of each word, as bytes."""
        texts = b"\n".join(words).decode("utf-8", "replace").split("\n")  # words hold no white space
        low = "\n".join(texts).lower()
        split = list(map(_PARTS.findall, low.split("\n")))
        odd = [k for k, t in enumerate(texts) if _ODD.search(t)]
        if any(x in low for x in self.added):
            odd = sorted({*odd, *(k for k, t in enumerate(texts) if any(x in t.lower() for x in self.added))})
        for k in odd:
            split[k] = ()
        new = list({p: None for p in chain.from_iterable(split) if p not in self.parts})
        if new:
            if len(self.parts) + len(new) > REMEMBERED_PARTS:
                self.parts = {}
                new = list(dict.fromkeys(chain.from_iterable(split)))
            self._learn_parts(new)
        get = self.parts.__getitem__
        data = [get(x[0]) if len(x) == 1 else b"".join(map(get, x)) for x in split]
        for k, e in zip(odd, self.tokenizer.encode_batch([texts[k] for k in odd], add_special_tokens=False), strict=True):
            data[k] = np.array(e.ids, np.uint32).tobytes()
        return data

    def encode(self, raw: np.ndarray, offsets: np.ndarray, end_id: int | None) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all rows in turn (each followed by ``end_id``), and the number per row."""
        if self.by_words:
            ids, per = self._encode_words(raw, offsets)
        else:
            data = raw.tobytes()
            texts = [data[a:b].decode("utf-8", "replace") for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
            found = [np.array(e.ids, np.uint32) for e in self.tokenizer.encode_batch(texts, add_special_tokens=False)]
            ids, per = np.concatenate([np.zeros(0, np.uint32), *found]), np.array([len(x) for x in found], np.int64)
        if end_id is not None:
            ids = np.insert(ids, np.cumsum(per), np.uint32(end_id))
            per = per + 1
        return ids, per

    def _encode_words(self, raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        starts, ends, n_words = word_spans(~_SPACE[raw], offsets)
        seen, at, which = np.unique(word_hashes(raw, starts, ends), return_index=True, return_inverse=True)
        place = np.searchsorted(self.hashes, seen)
        new = np.ones(len(seen), bool)
        inner = place < len(self.hashes)
        new[inner] = self.hashes[place[inner]] != seen[inner]
        if new.any():
            if len(self.hashes) and len(self.hashes) + new.sum() > REMEMBERED_WORDS:
                self._forget()
                place, new = np.zeros(len(seen), np.int64), np.ones(len(seen), bool)
            data = raw.tobytes()
            found = self._ids_of([data[a:b] for a, b in zip(starts[at[new]].tolist(), ends[at[new]].tolist(), strict=True)])
            length = np.array([len(x) >> 2 for x in found], np.int64)
            self.hashes = np.insert(self.hashes, place[new], seen[new])
            self.first = np.insert(self.first, place[new], len(self.ids) + np.cumsum(length) - length)
            self.length = np.insert(self.length, place[new], length)
            self.ids = np.concatenate([self.ids, np.frombuffer(b"".join(found), np.uint32)])
            place = np.searchsorted(self.hashes, seen)
        length = self.length[place][which]
        first = self.first[place][which]
        total = np.concatenate([[0], np.cumsum(length)])
        last = np.cumsum(n_words)
        return self.ids[ranges(first, first + length)[0]], total[last] - total[last - n_words]


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


class _Bucket:
    """Pieces of one task: whole sequences leave at once, remainders wait for the partitioning."""

    def __init__(self, capacity: int, piece_limit: int, with_ids: bool):
        self.capacity, self.limit, self.with_ids = capacity, piece_limit, with_ids
        self.next_id = TaskContext.get().partitionId() << 33 if TaskContext.get() else 0
        self.waiting: list[tuple] = []
        self.tokens = 0

    def _row(self, doc, start, ids, total, sequence, offset):
        return (doc, start, len(ids), zlib.crc32(ids.astype("<u4").tobytes()), total, sequence, offset,
                *([ids.astype(np.int32)] if self.with_ids else []))

    def add(self, doc, ids: np.ndarray) -> Iterator[tuple]:
        total, whole = len(ids), len(ids) // self.capacity * self.capacity
        for start in range(0, whole, self.capacity):
            yield self._row(doc, start, ids[start:start + self.capacity], total, self.next_id, 0)
            self.next_id += 1
        rest = total - whole
        parts = -(-rest // self.limit)
        start = whole
        for k in range(parts):
            size = rest // parts + (k < rest % parts)
            self.waiting.append((doc, start, ids[start:start + size].copy(), total))
            start += size
        self.tokens += rest

    def flush(self) -> Iterator[tuple]:
        if not self.waiting:
            return
        sizes = np.array([len(w[2]) for w in self.waiting], np.int64)
        window = windows_of(sizes, self.capacity)
        used = np.zeros(window.max() + 1, np.int64)
        names = np.cumsum(np.bincount(window) > 0) - 1 + self.next_id
        for (doc, start, ids, total), w in zip(self.waiting, window, strict=True):
            yield self._row(doc, start, ids, total, int(names[w]), int(used[w]))
            used[w] += len(ids)
        self.next_id = int(names[-1]) + 1
        self.waiting, self.tokens = [], 0


PIECES = "start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def pack(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", end_id: int | None = 1,
         capacity: int = CAPACITY, piece_limit: int = PIECE_LIMIT, bucket_tokens: int = BUCKET_TOKENS, with_ids: bool = False) -> DataFrame:
    """One row per piece: ``doc_id``, ``start`` (its document's ids before it), ``length``,
    ``ids_crc32``, ``doc_tokens``, ``sequence_id``, ``offset`` in the sequence (gapless from 0), and
    with ``with_ids`` the ``ids`` themselves. A null or empty text is its end id alone (no piece if
    ``end_id`` is None); repeated rows are packed one by one; an empty table gives no rows."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    schema = f"doc_id {dict(rows.dtypes)['doc_id']}, {PIECES}" + ", ids array<int>" * with_ids
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", *["ids"] * with_ids]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, out, id_type = _Bucket(capacity, piece_limit, with_ids), [], pa.int64()

        def rows_out():
            cols = list(zip(*out, strict=True))
            types = [id_type, *[pa.int64()] * 6, *[pa.list_(pa.int32())] * with_ids]
            made = pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(cols, types, strict=True)], names)
            out.clear()
            return made

        for batch in batches:
            ids_col = column(batch, "doc_id")
            id_type = ids_col.type
            raw, offsets = utf8(column(batch, "text"))
            for i, j in steps(offsets):
                ids, per = encoder(tokenizer_path).encode(raw[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i], end_id)
                last = np.cumsum(per)
                for doc, a, b in zip(ids_col.slice(i, j - i).to_pylist(), last - per, last, strict=True):
                    out.extend(bucket.add(doc, ids[a:b]))
                    if bucket.tokens >= bucket_tokens:
                        out.extend(bucket.flush())
                if len(out) >= 4096 or (with_ids and out):
                    yield rows_out()
        out.extend(bucket.flush())
        if out:
            yield rows_out()

    return rows.mapInArrow(run, schema)
