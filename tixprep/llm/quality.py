"""Quality scores: random-indexing word vectors, pooled per text, and a two-layer network.

Every token (a run of letters and digits, or of one repeated sign) falls into one of ``BUCKETS``
hash buckets, each with a fixed sparse random index vector. The vector of a bucket is the sum of the
index vectors of all tokens within ``REACH`` places of its own, over all texts. A text is the mean
and spread of its tokens' unit vectors and its length. The network is trained on a bounded sample of
labelled rows (``sample_rows``, those with the smallest hash of their id); its logits are divided
by a temperature fitted on a part of the sample kept aside.

Scale: each task sums its own vectors and hands on one table of fixed size (BUCKETS x WIDTH), the
tables of all tasks are summed in streams; the result, like the network, has a size that does not
depend on the data and is broadcast. Texts never shuffle."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from tixprep.llm.batches import arrow_map, column, steps, utf8, word_hashes

BUCKETS = 1 << 14
WIDTH = 32
NONZERO = 4
REACH = 2
SAMPLE_ROWS = 20_000
HIDDEN = 32
_BLOCK = 512  # buckets per row of a handed-on table

_KIND = np.full(256, 2, np.uint8)
_KIND[[9, 10, 11, 12, 13, 32]] = 0
for _a, _b in ((0x30, 0x3A), (0x41, 0x5B), (0x61, 0x7B), (0x80, 0x100)):
    _KIND[_a:_b] = 1


def tokens(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of every token in order, and the number of tokens per row."""
    n = len(raw)
    if n == 0:
        return np.zeros(0, np.int64), np.zeros(len(offsets) - 1, np.int64)
    kind = _KIND[raw]
    new = np.ones(n, bool)
    new[1:] = (kind[1:] != kind[:-1]) | ((kind[1:] == 2) & (raw[1:] != raw[:-1]))
    inner = offsets[(offsets > 0) & (offsets < n)]
    new[inner] = True
    starts = np.flatnonzero(new)
    ends = np.append(starts[1:], n)
    keep = kind[starts] > 0
    starts, ends = starts[keep], ends[keep]
    bucket = (word_hashes(raw, starts, ends) % np.uint64(BUCKETS)).astype(np.int64)
    return bucket, np.diff(np.searchsorted(starts, offsets))


def index_vectors() -> tuple[np.ndarray, np.ndarray]:
    """Places and signs of the non-zero entries of every bucket's index vector."""
    rng = np.random.default_rng(7)
    places = rng.random((BUCKETS, WIDTH)).argsort(axis=1)[:, :NONZERO]
    return places.astype(np.int64), rng.choice([-1.0, 1.0], (BUCKETS, NONZERO))


def add_contexts(total: np.ndarray, bucket: np.ndarray, counts: np.ndarray, index) -> None:
    """Adds the index vectors of all neighbours within REACH places in the same row."""
    places, signs = index
    row = np.repeat(np.arange(len(counts)), counts)
    for gap in range(1, REACH + 1):
        same = row[gap:] == row[:-gap]
        left, right = bucket[:-gap][same], bucket[gap:][same]
        for own, other in ((left, right), (right, left)):
            for k in range(NONZERO):
                total += np.bincount(own * WIDTH + places[other, k], weights=signs[other, k], minlength=BUCKETS * WIDTH)


def word_vectors(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """Unit vector of every bucket (zero for buckets without tokens), learnt from all rows."""
    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, index, seen = np.zeros(BUCKETS * WIDTH), index_vectors(), False
        for batch in batches:
            raw, offsets = utf8(column(batch, "text"))
            for i, j in steps(offsets):
                bucket, counts = tokens(raw[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])
                if len(bucket) > 1:
                    add_contexts(total, bucket, counts, index)
                    seen = True
        if seen:
            yield _table(total)

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for block, data in zip(column(batch, "block").to_pylist(), column(batch, "data").to_pylist(), strict=True):
                part = np.frombuffer(data, np.float64)
                sums[block] = sums[block] + part if block in sums else part
        if sums:
            yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array([v.tobytes() for v in sums.values()], pa.binary())], ["block", "data"])

    schema = "block int, data binary"
    parts = docs.select(F.col(text_col).alias("text")).mapInArrow(partial, schema)
    rows = parts.repartition("block").mapInArrow(summed, schema).collect()
    total = np.zeros((BUCKETS, WIDTH))
    for r in rows:
        total[r["block"] * _BLOCK:(r["block"] + 1) * _BLOCK] = np.frombuffer(r["data"], np.float64).reshape(-1, WIDTH)
    norm = np.linalg.norm(total, axis=1, keepdims=True)
    return (total / np.maximum(norm, 1e-9)).astype(np.float32)


def _table(total: np.ndarray) -> pa.RecordBatch:
    blocks = total.reshape(-1, _BLOCK * WIDTH)
    used = np.flatnonzero(blocks.any(axis=1))
    return pa.RecordBatch.from_arrays(
        [pa.array(used, pa.int32()), pa.array([blocks[k].tobytes() for k in used], pa.binary())], ["block", "data"])


# Likeness of tokens 1 to ECHOES places apart is pooled too: repeated words stand out.
ECHOES = 4
FEATURES = 2 * WIDTH + ECHOES + 1


def pooled(col: pa.Array, vectors: np.ndarray) -> np.ndarray:
    """Mean and standard deviation of the token vectors, mean likeness of tokens a few places
    apart, and log length, of every text."""
    raw, offsets = utf8(col)
    out = np.zeros((len(col), FEATURES))
    for i, j in steps(offsets, 1 << 18):
        bucket, counts = tokens(raw[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])
        some = np.flatnonzero(counts)
        if len(some) == 0:
            continue
        first = (np.cumsum(counts) - counts)[some]
        v = vectors[bucket]
        n = counts[some][:, None]
        mean = np.add.reduceat(v, first, axis=0, dtype=np.float64) / n
        square = np.add.reduceat(v * v, first, axis=0, dtype=np.float64) / n
        row = np.repeat(np.arange(j - i), counts)
        echo = np.zeros((len(some), ECHOES))
        for gap in range(1, ECHOES + 1):
            same = row[gap:] == row[:-gap]
            like = np.einsum("ij,ij->i", v[gap:][same], v[:-gap][same])
            echo[:, gap - 1] = np.bincount(row[gap:][same], weights=like, minlength=j - i)[some] / n[:, 0]
        out[i + some] = np.hstack([mean, np.sqrt(np.maximum(square - mean * mean, 0)), echo, np.log1p(n)])
    return out


@dataclass
class Network:
    """Standardized features, one hidden tanh layer, one logit divided by the temperature."""

    centre: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    temperature: float = 1.0

    def logits(self, x: np.ndarray) -> np.ndarray:
        return np.tanh((x - self.centre) / self.scale @ self.w1 + self.b1) @ self.w2 + self.b2

    def scores(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x) / self.temperature, -35, 35)))


def _loss(logit: np.ndarray, y: np.ndarray) -> float:
    return float(np.mean(np.logaddexp(0, logit) - y * logit))


def train(x: np.ndarray, y: np.ndarray, seed: int = 11, epochs: int = 40, batch: int = 128, rate: float = 0.01, decay: float = 1e-4) -> Network:
    """Fits the network by Adam on four fifths of the rows, its temperature on the rest. With rows of
    one class only, or none, every score is that class's smoothed share (0.5 without rows)."""
    rng = np.random.default_rng(seed)
    if len(y) < 10 or y.min() == y.max():
        share = (y.sum() + 0.5) / (len(y) + 1.0)
        return Network(np.zeros(FEATURES), np.ones(FEATURES), np.zeros((FEATURES, 1)), np.zeros(1), np.zeros(1), float(np.log(share / (1 - share))))
    by = rng.permutation(len(y))
    cut = len(y) // 5
    x_fit, y_fit, x_cal, y_cal = x[by[cut:]], y[by[cut:]], x[by[:cut]], y[by[:cut]]
    centre, scale = x_fit.mean(axis=0), x_fit.std(axis=0) + 1e-6
    z = (x_fit - centre) / scale
    params = [rng.normal(0, FEATURES ** -0.5, (FEATURES, HIDDEN)), np.zeros(HIDDEN), rng.normal(0, HIDDEN ** -0.5, HIDDEN), np.zeros(1)]
    first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    t = 0
    for _ in range(epochs):
        order = rng.permutation(len(z))
        for k in range(0, len(order), batch):
            rows = order[k:k + batch]
            h = np.tanh(z[rows] @ params[0] + params[1])
            error = (1 / (1 + np.exp(-np.clip(h @ params[2] + params[3], -35, 35))) - y_fit[rows]) / len(rows)
            back = np.outer(error, params[2]) * (1 - h * h)
            grads = [z[rows].T @ back + decay * params[0], back.sum(axis=0), h.T @ error + decay * params[2], np.array([error.sum()])]
            t += 1
            for p, g, m, v in zip(params, grads, first, second, strict=True):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                p -= rate * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
    net = Network(centre, scale, params[0], params[1], params[2], float(params[3][0]))
    logit = net.logits(x_cal)
    grid = np.exp(np.linspace(np.log(0.25), np.log(8), 200))
    net.temperature = float(min(grid, key=lambda g: _loss(logit / g, y_cal)))
    return net


def held_out(id_col: str = "doc_id"):
    """Rows whose labels are never learnt from."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 3 == 1, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
        sample_rows: int = SAMPLE_ROWS) -> tuple[np.ndarray, Network]:
    """Word vectors of all texts and the network trained on the sample. Labels other than 0 and 1,
    held-out rows and labels without a document are not used; of repeated labels the least counts."""
    vectors = word_vectors(docs, text_col)
    usable = (labels.filter(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull() & ~held_out(id_col))
              .groupBy(F.col(id_col).alias("sample_id")).agg(F.min(label_col).cast("double").alias("y")))
    sample = usable.orderBy(F.xxhash64("sample_id"), "sample_id").limit(sample_rows)
    docs_only = docs.select(F.col(id_col).alias("doc"), F.col(text_col).alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(vectors)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        x = pooled(column(batch, "text"), shared.value)
        return pa.RecordBatch.from_arrays([column(batch, "id"), column(batch, "y"), pa.array([r.tobytes() for r in x], pa.binary())], ["id", "y", "x"])

    # the sample has at most sample_rows rows of two numbers: a proven bound for the broadcast. Of an id that
    # many rows repeat one feature row is learnt from, that of the least text
    rows = (docs_only.join(F.broadcast(sample), docs_only["doc"] == sample["sample_id"])
            .groupBy("doc", "y").agg(F.min(F.coalesce("text", F.lit(""))).alias("text")).select(F.col("doc").cast("string").alias("id"), "y", "text"))
    found = sorted((r["id"], r["y"], bytes(r["x"])) for r in arrow_map(rows, run, "id string, y double, x binary").collect())
    x = np.array([np.frombuffer(r[2]) for r in found]).reshape(-1, FEATURES)
    return vectors, train(x, np.array([r[1] for r in found]))


def quality_scores(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", **fit_options) -> DataFrame:
    """Per row: ``doc_id, held_out, score, predicted``. A null text is an empty one; repeated rows each
    get a row; ids without a label are scored like all others."""
    shared = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, id_col, text_col, **fit_options))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        vectors, net = shared.value
        score = net.scores(pooled(column(batch, "text"), vectors))
        return pa.RecordBatch.from_arrays([column(batch, "doc_id"), column(batch, "held_out"), pa.array(score), pa.array((score >= 0.5).astype(np.int32))],
                                          ["doc_id", "held_out", "score", "predicted"])

    rows = docs.select(F.col(id_col).alias("doc_id"), held_out(id_col).alias("held_out"), F.col(text_col).alias("text"))
    return arrow_map(rows, run, f"doc_id {dict(rows.dtypes)['doc_id']}, held_out boolean, score double, predicted int")


def keep_good(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", **fit_options) -> DataFrame:
    """The rows whose score is 0.5 or more, all columns as they are."""
    shared = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, id_col, text_col, **fit_options))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        vectors, net = shared.value
        return batch.filter(pa.array(net.scores(pooled(column(batch, text_col), vectors)) >= 0.5))

    return arrow_map(docs, run, T.StructType(docs.schema.fields))
