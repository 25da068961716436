"""Near-duplicate documents by SimHash fingerprints and pigeonhole blocks.

A fingerprint holds one bit per majority vote over the 64-bit hashes of all word shingles (repeats
included). Two fingerprints that differ in at most ``max_bits`` bits leave at least
``blocks - max_bits`` of the blocks untouched, so every close pair shares one of the keys made of
that many blocks; the join on those keys finds it and the bit count of the XOR verifies it.

Scale: texts never shuffle, only (id, fingerprint) rows do. Equal fingerprints are one row before
anything is joined, so exact copies cost nothing. A key that more than ``block_limit`` different
fingerprints share is not joined pairwise: its fingerprints meet at the points one flipped bit
away (two fingerprints differ in at most 2 bits exactly if they share such a point), which gives
the same components from 65 rows per fingerprint."""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F, types as T

from tixprep.llm.batches import arrow_map, column, utf8
from tixprep.llm.components import connected_components
from tixprep.llm.tables import Steps, free_name

SEED = 42
# Shingles whose bits are counted at once (64 bytes each), so that a huge text stays small in memory.
VOTES_AT_ONCE = 1 << 16


def fingerprint(text: bytes, width: int = 3) -> int:
    """Majority vote per bit over XXH64 of the shingles; a text without words gives 0."""
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends, at = [], -1
    for w in words:
        at += len(w) + 1
        ends.append(at)
    if len(words) <= width:
        return xxhash.xxh64_intdigest(joined, SEED)
    digest = xxhash.xxh64_intdigest
    starts = [0, *(e + 1 for e in ends[:-width])]
    hashes = np.fromiter((digest(joined[a:b], SEED) for a, b in zip(starts, ends[width - 1:], strict=True)), np.uint64, len(starts))
    votes = np.zeros(64, np.int64)
    for i in range(0, len(hashes), VOTES_AT_ONCE):
        bits = np.unpackbits(hashes[i:i + VOTES_AT_ONCE].astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
        votes += bits.sum(axis=0, dtype=np.uint32)
    return int.from_bytes(np.packbits(votes * 2 > len(hashes)).tobytes(), "big")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3) -> DataFrame:
    """``(doc_id, fp)`` of every row; ``fp`` is the fingerprint as a signed 64-bit integer. A null
    text has no words (fingerprint 0)."""
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        raw, offsets = utf8(column(batch, "text"))
        data = raw.tobytes()
        fp = np.array([fingerprint(data[a:b], width) for a, b in zip(offsets[:-1], offsets[1:], strict=True)], np.uint64)
        return pa.RecordBatch.from_arrays([column(batch, "doc_id"), pa.array(fp.view(np.int64))], ["doc_id", "fp"])
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return arrow_map(rows, run, "doc_id long, fp long")


def _block_masks(max_bits: int, blocks: int) -> list[int]:
    """Masks of all key choices: ``blocks - max_bits`` of the blocks, as signed 64-bit integers."""
    cuts = [64 * i // blocks for i in range(blocks + 1)]
    whole = [((1 << cuts[i + 1]) - 1) ^ ((1 << cuts[i]) - 1) for i in range(blocks)]
    signed = lambda m: m - (1 << 64) if m >> 63 else m
    return [signed(sum(pick)) for pick in combinations(whole, blocks - max_bits)]


def close_pairs(classes: DataFrame, max_bits: int = 2, blocks: int = 5, block_limit: int = 100) -> DataFrame:
    """Links ``(a, b)`` between nodes of ``classes(fp, node)`` (one row per fingerprint) such that
    the components equal those of all pairs within ``max_bits`` bits."""
    if max_bits != 2:
        raise ValueError("crowded blocks are resolved by points one bit away, which is exact for 2 bits only")
    masks = _block_masks(max_bits, blocks)
    keys = classes.select("fp", "node", F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(m)) for m in masks])).alias("part", "key"))
    keys = Steps(classes).write(keys)
    sizes = keys.groupBy("part", "key").count().filter("count > 1")
    joined = keys.join(sizes, ["part", "key"])
    small = joined.filter(F.col("count") <= block_limit)
    left = small.select("part", "key", F.col("fp").alias("fp_a"), F.col("node").alias("a"))
    right = small.select("part", "key", F.col("fp").alias("fp_b"), F.col("node").alias("b"))
    pairs = (left.join(right, ["part", "key"]).filter("a < b")
             .filter(F.bit_count(F.col("fp_a").bitwiseXOR(F.col("fp_b"))) <= max_bits).select("a", "b"))
    crowded = joined.filter(F.col("count") > block_limit).select("fp", "node").distinct()
    flips = [F.col("fp")] + [F.col("fp").bitwiseXOR(F.lit(m)) for m in [*(1 << i for i in range(63)), -(1 << 63)]]
    points = crowded.select("node", F.explode(F.array(*flips)).alias("point"))
    lowest = points.groupBy("point").agg(F.min("node").alias("low"), F.count("*").alias("n")).filter("n > 1")
    meets = points.join(lowest, "point").filter("node <> low").select(F.col("low").alias("a"), F.col("node").alias("b"))
    return pairs.unionAll(meets).distinct()


def _groups(fps: DataFrame, max_bits: int, steps: Steps) -> DataFrame:
    """(fp, component): the smallest fingerprint (as a signed integer) that each fingerprint reaches. Fingerprints
    themselves are linked, so rows that share an id but no text do not bring their groups together."""
    classes = steps.write(fps.select("fp", F.col("fp").alias("node")).distinct())
    groups = connected_components(close_pairs(classes, max_bits))
    return steps.write(classes.join(groups, "node", "left").select("fp", F.coalesce("component", "node").alias("component")))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3, max_bits: int = 2) -> DataFrame:
    """One row per input row: ``doc_id, fingerprint`` (16 hex digits) and ``component_id``, the
    smallest id of a row reachable over links of at most ``max_bits`` differing bits. Repeated rows each
    get a row; rows of one id and different texts each belong to their own text's group, which may then carry the same
    smallest id; a null id gets its fingerprint's component (null if no row of the group has an id); an empty
    table gives no rows."""
    steps = Steps(docs)
    fps = steps.write(fingerprints(docs, id_col, text_col, width))
    of = _groups(fps, max_bits, steps)
    named = fps.groupBy("fp").agg(F.min("doc_id").alias("least")).join(of, "fp")
    least = named.groupBy("component").agg(F.min("least").alias("component_id"))
    whole = steps.write(of.join(least, "component").select("fp", "component_id"))
    return fps.join(whole, "fp", "left").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3, max_bits: int = 2) -> DataFrame:
    """One row of each group of near copies, all columns as they are: that with the smallest id, of
    several rows of that id in the group that with the smallest fingerprint (as a signed integer), and of those that with the least
    text (of equal texts any one). A row without an id stays and never stands for a group. Texts are written once
    with their fingerprints and shuffle once, by id and fingerprint."""
    steps = Steps(docs)
    fp, key = free_name(docs, "fp"), id_col

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        raw, offsets = utf8(column(batch, text_col))
        data = raw.tobytes()
        found = np.array([fingerprint(data[a:b], width) for a, b in zip(offsets[:-1], offsets[1:], strict=True)], np.uint64)
        return pa.RecordBatch.from_arrays([*batch.columns, pa.array(found.view(np.int64))], [*batch.schema.names, fp])
    rows = steps.write(arrow_map(docs, run, T.StructType([*docs.schema.fields, T.StructField(fp, T.LongType())])))
    named = rows.filter(F.col(key).isNotNull())
    seen = steps.write(named.select(F.col(key).alias("id"), F.col(fp).alias("fp")).distinct())
    first = seen.join(_groups(seen, max_bits, steps), "fp").groupBy("component").agg(F.min(F.struct("id", "fp")).alias("first"))
    keep = first.select(F.col("first.id").alias(key), F.col("first.fp").alias(fp))
    best = (named.join(keep, [key, fp], "left_semi").groupBy(key, fp)
            .agg(F.min_by(F.struct(*[F.col(f"`{c}`") for c in docs.columns]), F.coalesce(text_col, F.lit(""))).alias("row")).select("row.*"))
    return best.select(*[F.col(f"`{c}`") for c in docs.columns]).unionByName(rows.filter(F.col(key).isNull()).drop(fp))
