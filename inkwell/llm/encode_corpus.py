"""Problem 6: the whole corpus as token ids, by a tree of joins.

encode(text) is a monoid over pieces of the text: a text is cut in the middle, both halves are encoded by
recursion, and the join encodes a window around the cut again. Each side of the window begins with a few
characters and doubles until a cut point (see tokenizing) lies in it; from there on outwards the tokens
are proved to be the same in the whole text as in the half, whatever the other half holds. A side without
any cut point grows to the whole of its half. Decoding concatenates up the same tree: the ids in order
give back the bytes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from inkwell.llm.tokenizing import TOKENIZER_DIR, Encoder, encoder

#: A text of at most so many characters is a leaf of the tree.
LEAF_CHARS = 256
#: Characters on either side of a join that the window begins with.
WINDOW_CHARS = 16


def _last_cut_point(text: str, lo: int, hi: int) -> int:
    """The last cut point in [lo, hi], its character before it in [lo, hi] too; -1 if there is none."""
    while (p := text.rfind(" ", lo + 1, hi + 1)) >= 0:
        if not text[p - 1].isspace():
            return p
        hi = p - 1
    return -1


def _first_cut_point(text: str, lo: int, hi: int) -> int:
    """The first cut point in [lo, hi); -1 if there is none."""
    while (p := text.find(" ", lo, hi)) >= 0:
        if not text[p - 1].isspace():
            return p
        lo = p + 1
    return -1


def window_around(text: str, lo: int, mid: int, hi: int, window: int = WINDOW_CHARS) -> tuple[int, int]:
    """[start, end) around mid, each side grown until it ends at a cut point or at the part's end."""
    start = end = -1
    size = window
    while start < 0:
        start = _last_cut_point(text, max(lo, mid - size), mid)
        if start < 0 and mid - size <= lo:
            start = lo
        size *= 2
    size = window
    while end < 0:
        end = _first_cut_point(text, mid, min(hi, mid + size))
        if end < 0 and mid + size >= hi:
            end = hi
        size *= 2
    return start, end


def join(enc: Encoder, text: str, lo: int, mid: int, hi: int, left: np.ndarray, right: np.ndarray, window: int = WINDOW_CHARS) -> np.ndarray:
    """Tokens of text[lo:hi] from those of text[lo:mid] and text[mid:hi]."""
    start, end = window_around(text, lo, mid, hi, window)
    if start == end:
        return np.concatenate([left, right])
    keep = _tokens_of(enc, left[::-1], len(text[start:mid].encode()))
    drop = _tokens_of(enc, right, len(text[mid:end].encode()))
    again = np.asarray(enc.encode(text[start:end]), dtype=np.int32)
    return np.concatenate([left[: len(left) - keep], again, right[drop:]])


def _tokens_of(enc: Encoder, ids: np.ndarray, n_bytes: int) -> int:
    """How many of the first ids make up n_bytes, which end at a token's end, as a cut point does."""
    if n_bytes == 0:
        return 0
    ends = np.cumsum(enc.byte_lengths[ids[:n_bytes]])
    k = int(np.searchsorted(ends, n_bytes))
    if k == len(ends) or ends[k] != n_bytes:
        raise AssertionError("a token lies across a cut point")
    return k + 1


def encode_tree(enc: Encoder, text: str, leaf: int = LEAF_CHARS) -> np.ndarray:
    def part(lo: int, hi: int) -> np.ndarray:
        if hi - lo <= leaf:
            return np.asarray(enc.encode(text[lo:hi]), dtype=np.int32)
        mid = (lo + hi) // 2
        return join(enc, text, lo, mid, hi, part(lo, mid), part(mid, hi))

    return part(0, len(text))


def encode_corpus(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokenizer: str = "byte_bpe_50k", folder: str = TOKENIZER_DIR, leaf_chars: int = LEAF_CHARS) -> DataFrame:
    """(id, ids ARRAY<INT>) of every row, without special tokens.

    Null and empty texts give an empty list; rows with a null id and repeated rows are kept as they
    are; texts of any length are encoded whole; other columns are ignored; no rows give no rows.
    Nothing is shuffled and nothing gathered: each text is encoded where it is read.
    """
    data = docs.select(F.col(id_col).alias("k"), F.col(text_col).alias("t"))
    kind = pa.list_(pa.int32())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer, folder)
        for b in batches:
            parts: list = []
            offsets = np.zeros(b.num_rows + 1, dtype=np.int32)
            for i, text in enumerate(b.column(1).to_pylist()):
                ids = encode_tree(enc, text or "", leaf_chars)
                offsets[i + 1] = offsets[i] + len(ids)
                parts.append(ids)
            values = np.concatenate(parts) if parts else np.zeros(0, np.int32)
            ids_column = pa.ListArray.from_arrays(pa.array(offsets), pa.array(values)).cast(kind)
            yield pa.RecordBatch.from_arrays([b.column(0), ids_column], names=[id_col, "ids"])

    schema = T.StructType([T.StructField(id_col, data.schema["k"].dataType), T.StructField("ids", T.ArrayType(T.IntegerType()))])
    return data.mapInArrow(run, schema)
