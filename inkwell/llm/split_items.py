"""Problem 1: oversized texts cut at natural boundaries, by dynamic programming.

A cut lies at the end of a paragraph, line, sentence or word. Where such ends lie too far apart for any
piece, a cut may also lie between two characters as they are seen (never between a letter and its
marks), or, if even these are too far apart, between any two. The piece after a cut begins up to `overlap`
characters before it, at a word start. Over all cuts of a text, the programme takes the ones with the
least sum of cut penalties and of squared deviations from equal sizes, no piece being longer than the limit.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LIMIT = 1200
OVERLAP = 150

#: Penalties of a cut; the deviation of a piece from the equal size counts once its square.
PENALTY = {"paragraph": 0.0, "line": 0.08, "sentence": 0.15, "word": 0.8, "character": 6.0}

_SPACE = re.compile(r"\s+")
#: A character as it is seen: a letter with its marks, a joined emoji.
_SEEN = regex.compile(r"\X")
_SENTENCE = re.compile(r"[.!?…][\"'’”“»)\]]*$")

PIECES = "item_kind STRING, item_id STRING, pos INT, pieces ARRAY<STRUCT<start: INT, end: INT, text: STRING>>"


def boundaries(text: str, limit: int, overlap: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All ends of possible pieces in order (0 and the text's length among them), their penalties, and all starts."""
    ends, cost, starts = [0], [0.0], []
    for m in _SPACE.finditer(text):
        at, nxt = m.start(), m.end()
        if nxt < len(text):
            starts.append(nxt)
        if at == 0 or nxt == len(text):
            continue
        run = m.group()
        lines = run.count("\n") or run.count("\r")
        if lines > 1:
            kind = "paragraph"
        elif lines:
            kind = "line"
        elif _SENTENCE.search(text, max(0, at - 4), at) and not (text[nxt].islower() or text[nxt].isdigit()):
            kind = "sentence"
        else:
            kind = "word"
        ends.append(at)
        cost.append(PENALTY[kind])
    ends.append(len(text))
    cost.append(0.0)
    ends, cost = np.asarray(ends, dtype=np.int64), np.asarray(cost)
    step = limit - overlap
    if (np.diff(ends) > step).any():
        more: list[int] = []
        for i in np.nonzero(np.diff(ends) > step)[0]:
            lo, hi = int(ends[i]), int(ends[i + 1])
            seen = [lo, *(m.start() for m in _SEEN.finditer(text, lo, hi) if m.start() > lo), hi]
            for x, y in zip(seen, seen[1:]):  # a letter with more marks than a piece holds is cut anywhere
                more += range(x + 1, y) if y - x > step else ()
            more += seen[1:-1]
            starts += seen[1:-1]
        ends = np.concatenate([ends, more]).astype(np.int64)
        cost = np.concatenate([cost, np.full(len(more), PENALTY["character"])])
        order = np.argsort(ends, kind="stable")
        ends, cost = ends[order], cost[order]
        starts.sort()
    return ends, cost, np.asarray(starts, dtype=np.int64)


def next_starts(ends: np.ndarray, starts: np.ndarray, overlap: int) -> np.ndarray:
    """Where the piece after each end begins: the first start in the last `overlap` characters.

    In a stretch without one it begins exactly `overlap` characters before the end.
    """
    lowest = np.maximum(ends - overlap, 0)
    k = np.searchsorted(starts, lowest)
    first = np.where(k < len(starts), starts[np.minimum(k, len(starts) - 1)] if len(starts) else 0, np.iinfo(np.int64).max)
    return np.where(lowest == 0, 0, np.where(first < ends, first, lowest))


def split(text: str, limit: int = LIMIT, overlap: int = OVERLAP) -> list[tuple[int, int]]:
    """[start, end) of the pieces of text; one piece if it is within the limit."""
    if not 0 <= overlap < limit:
        raise ValueError("the overlap must be less than the limit")
    n = len(text)
    if n <= limit:
        return [(0, n)]
    ends, penalty, words = boundaries(text, limit, overlap)
    begins = next_starts(ends, words, overlap)
    begins[0] = 0
    count = -(-(n - overlap) // (limit - overlap))
    size = (n + (count - 1) * overlap) / count
    # with x of an end and y of a begin, a piece costs (x - y)^2; x^2 is the same for all its begins, and
    # y^2 is added to the cost of what lies before the begin once
    x, y = ends / size - 1.0, begins / size
    before = np.full(len(ends), np.inf)
    before[0] = y[0] ** 2
    came = [0] * len(ends)
    first = np.searchsorted(begins, ends - limit).tolist()  # begins never decreases
    twice, rest = (2 * x).tolist(), (x * x + penalty + y * y).tolist()
    for j in range(1, len(ends)):
        lo = first[j]
        total = before[lo:j] - twice[j] * y[lo:j]
        k = int(total.argmin())
        before[j], came[j] = total[k] + rest[j], lo + k
    pieces, j = [], len(ends) - 1
    while j:
        i = came[j]
        pieces.append((int(begins[i]), int(ends[j])))
        j = i
    return pieces[::-1]


def split_items(items: DataFrame, limit: int = LIMIT, overlap: int = OVERLAP) -> DataFrame:
    """PIECES of each row (item_kind, item_id, pos, text) whose text is longer than the limit.

    The pieces cover the text: each begins at most `overlap` characters before the end of the one
    before it and nothing lies between two. Shorter, empty and null texts are no cases. Rows are
    taken as they come (repeated rows give repeated results); other columns are ignored.
    """
    long = items.select("item_kind", "item_id", F.col("pos").cast("int").alias("pos"), "text").where(F.length("text") > limit)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("text", pa.string())]))
        for b in batches:
            for lo in range(0, b.num_rows, 500):
                part = b.slice(lo, 500)
                cuts = [[{"start": s, "end": e, "text": t[s:e]} for s, e in split(t, limit, overlap)] for t in part.column(3).to_pylist()]
                yield pa.RecordBatch.from_arrays([*part.columns[:3], pa.array(cuts, kind)], names=["item_kind", "item_id", "pos", "pieces"])

    return long.mapInArrow(run, PIECES)


def _long_only(text: Column, limit: int) -> Column:
    return F.when(F.length(text) > limit, text)


def archive_items(corpus: DataFrame, chunks: DataFrame, limit: int = LIMIT) -> DataFrame:
    """The long paragraphs of the articles and the long chunks, in their latest states, once each.

    Only texts over the limit travel; the others are null before the rows are compared by version.
    Null keys are left out; rows of equal version are ordered by their texts.
    """
    texts = F.transform(F.col("full_text_paragraphs.text"), lambda t, i: F.struct(i.cast("int").alias("pos"), _long_only(t, limit).alias("text")))
    kept = F.filter(texts, lambda x: x["text"].isNotNull())
    articles = corpus.where("article_id IS NOT NULL").groupBy("article_id").agg(F.max(F.struct("ingested_at", kept.alias("kept"))).alias("s"))
    paragraphs = articles.select(F.lit("paragraph").alias("item_kind"), F.col("article_id").alias("item_id"), F.explode("s.kept").alias("p")).select("item_kind", "item_id", "p.pos", "p.text")
    newest = chunks.where("chunk_id IS NOT NULL").groupBy("chunk_id").agg(F.max(F.struct("ingested_at", _long_only(F.col("text"), limit).alias("text"))).alias("s"))
    whole = newest.select(F.lit("chunk").alias("item_kind"), F.col("chunk_id").alias("item_id"), F.lit(0).alias("pos"), F.col("s.text"))
    return paragraphs.unionByName(whole.where("text IS NOT NULL"))


def archive_pieces(corpus: DataFrame, chunks: DataFrame, limit: int = LIMIT, overlap: int = OVERLAP) -> DataFrame:
    return split_items(archive_items(corpus, chunks, limit), limit, overlap)
