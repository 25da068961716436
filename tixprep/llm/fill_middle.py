"""Fill-in-the-middle texts by rotation of blocks, and their exact inverse.

A text is cut into units (a run of ASCII letters, or one other code point); its two cuts come from
the digest of a seed and its id. The text's bytes are written into one bytearray with the sentinels
before their segments, ``<P>``prefix``<M>``middle``<S>``suffix, and two neighbouring blocks change
places there by a three-reversal rotation: ``<M>``middle with ``<S>``suffix gives the form ``psm``,
everything before ``<S>`` with ``<S>``suffix gives ``spm``. ``restore`` finds the sentinels, turns the
same rotation back and takes the sentinels out. A text that holds a sentinel stays ``plain``, so
the sentinels of a text that was turned are the only ones in it.

Scale: every row on its own, no shuffle; memory is a batch and one text."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from tixprep.llm.batches import arrow_map, column, steps, utf8

# --- fixed values (must equal the contract's) ----------------------------------------------
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
PLAIN_FROM = 90  # h3 % 100 from here on: left as it is
SPM_BELOW = 20   # h4 % 100 below this: suffix first

_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = True


def draws(id_col: Column, seed: int = 1) -> list[Column]:
    """The first four 8-digit groups of the hex sha256 of ``seed:id`` (a null id: nothing after the colon)."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(id_col.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long").alias(f"h{k + 1}") for k in range(4)]


def unit_starts(raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Byte position of every unit of every row, in order."""
    letter = _LETTER[raw]
    new = (raw & 0xC0) != 0x80
    new[1:] &= ~(letter[1:] & letter[:-1])
    new[offsets[:-1][np.diff(offsets) > 0]] = True
    return np.flatnonzero(new)


def reverse(view: np.ndarray, lo: int, hi: int) -> None:
    """Turns view[lo:hi] round in place, the outer halves changing places."""
    half = (hi - lo) // 2
    left = view[lo:lo + half].copy()
    view[lo:lo + half] = view[hi - half:hi][::-1]
    view[hi - half:hi] = left[::-1]


def rotate(view: np.ndarray, lo: int, mid: int, hi: int) -> None:
    """Exchanges the blocks view[lo:mid] and view[mid:hi] in place by three reversals."""
    reverse(view, lo, mid)
    reverse(view, mid, hi)
    reverse(view, lo, hi)


def turned(text: bytes, a: int, b: int, form: str) -> bytearray:
    """The text with sentinels, its segments [0, a), [a, b), [b, end) in the order of ``form``."""
    out = bytearray(text)
    out[b:b] = SUFFIX
    out[a:a] = MIDDLE
    out[0:0] = PREFIX
    view = np.frombuffer(out, np.uint8)
    middle, suffix = a + len(PREFIX), b + len(PREFIX) + len(MIDDLE)
    rotate(view, middle if form == "psm" else 0, suffix, len(out))
    return out


def turned_back(text: bytes, form: str) -> bytearray:
    """The text that ``turned`` was given."""
    out = bytearray(text)
    view = np.frombuffer(out, np.uint8)
    middle, suffix = out.index(MIDDLE), out.index(SUFFIX)
    if form == "psm":  # <P> prefix <S> suffix <M> middle
        rotate(view, suffix, middle, len(out))
    else:              # <S> suffix <P> prefix <M> middle
        rotate(view, 0, out.index(PREFIX), len(out))
    del view           # a bytearray that is looked at cannot change its length
    for mark in (PREFIX, MIDDLE, SUFFIX):
        at = out.index(mark)
        del out[at:at + len(mark)]
    return out


def _turn(batch: pa.RecordBatch) -> pa.RecordBatch:
    rows = batch.num_rows
    h = [np.array(column(batch, f"h{k}")) for k in (1, 2, 3, 4)]
    raw, offsets = utf8(column(batch, "text"))
    units, forms, outputs = np.zeros(rows, np.int64), [], []
    chars: list[list[int | None]] = [[], []]
    for i, j in steps(offsets):
        piece, where = raw[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i]
        starts = unit_starts(piece, where)
        lead = np.append(0, np.cumsum((piece & 0xC0) != 0x80))
        first = np.searchsorted(starts, where)
        units[i:j] = np.diff(first)
        for k in range(i, j):
            lo, hi, n = where[k - i], where[k - i + 1], units[k]
            text = piece[lo:hi].tobytes()
            if not text or PREFIX in text or SUFFIX in text or MIDDLE in text or h[2][k] % 100 >= PLAIN_FROM:
                forms.append("plain")
                outputs.append(text)
                chars[0].append(None)
                chars[1].append(None)
                continue
            form = "spm" if h[3][k] % 100 < SPM_BELOW else "psm"
            cuts = sorted((h[0][k] % (n + 1), h[1][k] % (n + 1)))
            a, b = (starts[first[k - i] + c] if c < n else hi for c in cuts)
            forms.append(form)
            outputs.append(bytes(turned(text, int(a - lo), int(b - lo), form)))
            chars[0].append(int(lead[a] - lead[lo]))
            chars[1].append(int(lead[b] - lead[a]))
    return pa.RecordBatch.from_arrays(
        [column(batch, "doc_id"), pa.array(units), pa.array(forms), pa.array(chars[0], pa.int64()), pa.array(chars[1], pa.int64()),
         pa.array(outputs, pa.binary())], ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"])


def fill_in_middle(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: int = 1) -> DataFrame:
    """Per row: ``doc_id, n`` (units), ``form`` (plain, psm, spm), ``prefix_chars, middle_chars`` (null if
    plain) and ``output``, the turned text.

    A null text is an empty one, which is plain; rows that repeat an id are cut by the same draws,
    each in its own text; a null id has draws of its own. Other columns are not read. An empty table
    gives an empty result."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), *draws(F.col(id_col), seed))
    out = arrow_map(rows, _turn, f"doc_id {dict(rows.dtypes)['doc_id']}, n long, form string, prefix_chars long, middle_chars long, output binary")
    return out.withColumn("output", F.col("output").cast("string"))


def restore(turned_docs: DataFrame, output_col: str = "output", form_col: str = "form", as_col: str = "text") -> DataFrame:
    """All columns and, as ``as_col``, the text rebuilt from output and form alone (null if either is)."""
    if as_col in turned_docs.columns:
        raise ValueError(f"column {as_col} is there already")

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        raw, offsets = utf8(column(batch, output_col))
        forms = column(batch, form_col).to_pylist()
        given = column(batch, output_col).is_valid().to_pylist()
        texts = []
        for k, form in enumerate(forms):
            text = raw[offsets[k]:offsets[k + 1]].tobytes()
            texts.append(None if form is None or not given[k] else text if form == "plain" else bytes(turned_back(text, form)))
        return pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.binary())], [*batch.schema.names, as_col])

    out = arrow_map(turned_docs, run, T.StructType([*turned_docs.schema.fields, T.StructField(as_col, T.BinaryType())]))
    return out.withColumn(as_col, F.col(as_col).cast("string"))
