"""Pearson correlations of many columns by block products.

Columns are centred by their means; a missing cell is 0 with a mask of 0. Every task adds up four products of
blocks of columns (values with values, values and squares with the other's mask, mask with mask), which give the
correlation over the rows where both columns are present. Work per batch is matrix products; a task holds one
table of sums a pair of blocks and hands it on once, and the sums are aggregated by (block, block)."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLOCK = 128          # columns of a block
HELD_BYTES = 128 << 20  # sums that a task holds before it hands them on


def wide_correlation(df: DataFrame, cols: Sequence[str], block: int = BLOCK) -> DataFrame:
    """(column_a, column_b, r) of all ordered pairs of numeric ``cols``: null for fewer than two common rows or a constant
    column. Null and not-a-number cells are missing; infinite values give no number."""
    cols = list(cols)
    if not cols:
        return df.sparkSession.createDataFrame([], "column_a string, column_b string, r double")
    values = df.select(*[F.nanvl(F.col(f"`{c}`").cast("double"), F.lit(None).cast("double")).alias(f"c{i}") for i, c in enumerate(cols)])
    found = values.agg(F.array(*[F.avg(c) for c in values.columns]).alias("m")).first()["m"]  # one number a column
    means = np.array([0.0 if m is None or not np.isfinite(m) else m for m in found])
    blocks = range(-(-len(cols) // block))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple[int, int], np.ndarray] = {}

        def taken() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array([k[0] for k in sums], pa.int32()), pa.array([k[1] for k in sums], pa.int32()),
                                              pa.array([v.tobytes() for v in sums.values()], pa.binary())], ["a", "b", "data"])
            sums.clear()
            return out
        for batch in batches:
            x = np.column_stack([c.to_numpy(zero_copy_only=False).astype(float) for c in batch.columns])
            there = ~np.isnan(x)
            x = np.where(there, x - means, 0.0)
            m = there.astype(float)
            for i in blocks:
                p, pm = x[:, i * block:(i + 1) * block], m[:, i * block:(i + 1) * block]
                for j in range(i, len(blocks)):
                    q, qm = x[:, j * block:(j + 1) * block], m[:, j * block:(j + 1) * block]
                    part = np.stack([p.T @ q, p.T @ qm, pm.T @ q, (p * p).T @ qm, pm.T @ (q * q), pm.T @ qm])
                    sums[i, j] = sums[i, j] + part if (i, j) in sums else part
            if sum(v.nbytes for v in sums.values()) > HELD_BYTES:
                yield taken()
        if sums:
            yield taken()

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, total = None, None

        def rows() -> pa.RecordBatch:
            i, j = key
            na, nb = min(block, len(cols) - i * block), min(block, len(cols) - j * block)
            xy, x, y, xx, yy, n = total.reshape(6, na, nb)
            scale = [np.square(means[k * block:k * block + w]) for k, w in ((i, na), (j, nb))]
            with np.errstate(all="ignore"):
                vx, vy = xx - x * x / n, yy - y * y / n
                r = (xy - x * y / n) / np.sqrt(vx * vy)
                # no spread beyond the rounding of the values themselves
                flat = (vx <= 1e-24 * n * (scale[0][:, None] + xx / n)) | (vy <= 1e-24 * n * (scale[1][None, :] + yy / n))
            r = np.where((n < 2) | flat, np.nan, np.clip(r, -1, 1))
            names = np.array(cols, dtype=object)
            a, b = np.repeat(names[i * block:i * block + na], nb), np.tile(names[j * block:j * block + nb], na)
            r = r.ravel()
            if i != j:
                a, b, r = np.append(a, b), np.append(b, a), np.append(r, r)
            return pa.RecordBatch.from_arrays([pa.array(a, pa.string()), pa.array(b, pa.string()), pa.array(r, pa.float64(), from_pandas=True)], ["column_a", "column_b", "r"])
        for batch in batches:
            for a, b, data in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                part = np.frombuffer(data)
                if key == (a, b):
                    total = total + part
                else:
                    if key is not None:
                        yield rows()
                    key, total = (a, b), part
        if key is not None:
            yield rows()

    parts = values.mapInArrow(run, "a int, b int, data binary")
    return parts.repartition("a", "b").sortWithinPartitions("a", "b").mapInArrow(finish, "column_a string, column_b string, r double")
