"""Questions to cited context: top-k search, promoted articles, windows around hits, prompts."""

from __future__ import annotations

import itertools
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from inkwell.functions.templates import fill, or_label
from inkwell.functions.text import estimated_tokens
from inkwell.plans.publication import Publication, Wording

#: Hits of a question, chunks on either side of a hit, hits that promote an article.
TOP_N = 10
WINDOW = 1
PROMOTE = 3
#: Questions that are compared with all vectors at once, in one pass over them; more are taken in blocks.
BLOCK = 2_000


def search(index: DataFrame, queries: DataFrame, top_n: int = TOP_N, where: Column | None = None) -> DataFrame:
    """(query_id, rank, chunk_id, distance): the nearest vectors of each query by cosine distance.

    index has chunk_id, embedding and what `where` asks for, which is applied before the ranking;
    queries has query_id, embedding. Distances are rounded to 9 decimals, equal ones ordered by chunk_id.
    Vectors that are null, of another length than the query's, without length, or that hold nulls or NaN
    have none. BLOCK queries are one matrix; a batch of vectors is one product with it, and only its own
    best rows of each query go on. More queries are more such passes, whose rows are united.
    """
    kind = queries.schema["query_id"].dataType.simpleString()
    rows = (index if where is None else index.where(where)).select(F.col("chunk_id").cast("string"), F.col("embedding").cast("array<double>"))
    best, names = None, []
    few = queries.select("query_id", "embedding").toLocalIterator()
    while block := list(itertools.islice(few, BLOCK)):
        one = rows.mapInArrow(_nearest(block, len(names), top_n), "q INT, chunk_id STRING, distance DOUBLE")
        best = one if best is None else best.unionByName(one)
        names += [(len(names) + i, r.query_id) for i, r in enumerate(block)]
    ids = index.sparkSession.createDataFrame(names, f"q INT, query_id {kind}")
    if best is None:
        best = rows.where("false").select(F.lit(0).alias("q"), "chunk_id", F.lit(0.0).alias("distance"))
    best = best.withColumn("rank", F.row_number().over(Window.partitionBy("q").orderBy("distance", "chunk_id"))).where(F.col("rank") <= top_n)
    return best.join(F.broadcast(ids), "q").select("query_id", "rank", "chunk_id", "distance")


def _nearest(queries: list[Row], begin: int, top_n: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The best rows of each batch for these queries, numbered from `begin`."""
    vectors: dict[int, list[np.ndarray]] = {}
    numbers: dict[int, list[int]] = {}
    for i, r in enumerate(queries, begin):
        v = np.array([np.nan if x is None else x for x in r.embedding or []], dtype=np.float64)
        n = np.sqrt((v * v).sum()) if len(v) else 0.0
        if n > 0:
            vectors.setdefault(len(v), []).append(v / n)
            numbers.setdefault(len(v), []).append(i)
    by_dim = {dim: (numbers[dim], np.array(v)) for dim, v in vectors.items()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lists = b.column(1)
            sizes = np.diff(lists.offsets.to_numpy())
            flat = lists.values.to_numpy(zero_copy_only=False).astype(np.float64)
            begin = lists.offsets.to_numpy()[:-1]
            names = np.array(b.column(0).to_pylist(), dtype=object)
            for dim, (number, q) in by_dim.items():
                at = np.nonzero((sizes == dim) & np.asarray(lists.is_valid()))[0]
                m = flat[begin[at][:, None] + np.arange(dim)[None]]
                length = np.sqrt((m * m).sum(1))
                ok = length > 0
                m, ids = m[ok] / length[ok, None], names[at[ok]]
                if not len(m):
                    continue
                distance = np.round(1 - q @ m.T, 9) + 0.0
                k = min(top_n, len(m))
                least = np.partition(distance, k - 1, axis=1)[:, k - 1]
                qi, vi = np.nonzero(distance <= least[:, None])
                order = np.lexsort((ids[vi].astype(str), distance[qi, vi], qi))
                qi, vi = qi[order], vi[order]
                place = np.arange(len(qi)) - np.searchsorted(qi, qi)
                qi, vi = qi[place < k], vi[place < k]
                yield pa.RecordBatch.from_arrays([pa.array(np.array(number)[qi].astype(np.int32)), pa.array(ids[vi], pa.string()), pa.array(distance[qi, vi])], names=["q", "chunk_id", "distance"])

    return run


def merged_spans(spans: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """(keys, lo, hi, dist) of spans united where they overlap or follow on each other; the least distance."""
    w = Window.partitionBy(*keys).orderBy("lo", "hi")
    before = F.max("hi").over(w.rowsBetween(Window.unboundedPreceding, -1))
    s = spans.withColumn("new", F.when(before.isNull() | (F.col("lo") > before + 1), 1).otherwise(0)).withColumn("span", F.sum("new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return s.groupBy(*keys, "span").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.min("dist").alias("dist")).drop("span")


def caption_spans(captions: DataFrame, body: DataFrame, window: int = WINDOW) -> DataFrame:
    """captions with lo and hi: body chunks around the middle of those on the caption's pages; null if none.

    captions and body share article_id; pages overlap within an article, so the join is by its key.
    """
    keys = [c for c in captions.columns]
    b = body.select(F.col("article_id").alias("b_article"), F.col("chunk_index").alias("b_index"), F.col("page_start").alias("b_start"), F.col("page_end").alias("b_end"))
    near = captions.join(b, (F.col("article_id") == F.col("b_article")) & (F.col("b_start") <= F.col("page_end")) & (F.col("b_end") >= F.col("page_start")), "left")
    on = F.sort_array(F.collect_list("b_index"))
    g = near.groupBy(*keys).agg(on.alias("on"))
    mid = F.get("on", F.floor(F.size("on") / 2).cast("int"))
    return g.select(*keys, F.greatest(F.get("on", F.lit(0)), mid - window).alias("lo"), F.least(F.get("on", F.size("on") - 1), mid + window).alias("hi"))


def citation(wording: Wording, journal: Column, year: Column, issue: Column, title: Column, author: Column, start: Column, end: Column) -> Column:
    pages = F.when(start == end, fill(wording.on_page, {"page": start})).otherwise(fill(wording.on_pages, {"start": start, "end": end}))
    return fill(wording.cited, {"journal": journal, "year": year, "issue": issue, "title": title, "author": or_label(author, wording.nobody), "pages": pages})


def context_blocks(hits: DataFrame, chunks: DataFrame, corpus: DataFrame, publication: Publication, window: int = WINDOW, promote: int = PROMOTE) -> DataFrame:
    """(query_id, block_no, mode, n_hits, citation, text, best_distance): what a question gets to read.

    hits: query_id, rank, chunk_id, distance. An article with `promote` hits is given whole, with its
    captions. Others are given as windows of body chunks around their hits, merged; a caption hit opens
    the body chunks on its pages and is appended to its window, or stands alone. Nearest first.
    """
    meta = chunks.select("chunk_id", "article_id", "chunk_type", "chunk_index", "journal", "year", "issue", "title", "author", "page_start", "page_end", F.col("text").alias("hit_text"))
    h = hits.join(meta, "chunk_id")
    by = ["query_id", "article_id"]
    heads = h.groupBy(*by).agg(F.count(F.lit(1)).alias("n_hits"), F.min("distance").alias("best"), F.min("rank").alias("first_rank"), F.min_by(F.struct("journal", "year", "issue", "title", "author"), "rank").alias("m"))
    arts = corpus.select("article_id", "pdf_page_start", "pdf_page_end", "full_text", "captions_text")
    whole = heads.where(F.col("n_hits") >= promote).join(arts, "article_id")
    with_captions = F.when(F.coalesce(F.col("captions_text"), F.lit("")) != "", F.concat(F.lit(f"\n\n{publication.wording.captions}\n\n"), F.col("captions_text"))).otherwise("")
    full = whole.select("query_id", F.lit("full_article").alias("mode"), "n_hits", "m", F.col("pdf_page_start").alias("ps"), F.col("pdf_page_end").alias("pe"), F.concat(F.coalesce("full_text", F.lit("")), with_captions).alias("text"), F.col("best").alias("best_distance"), "first_rank", F.lit(-1).alias("win"))
    few = h.join(heads.where(F.col("n_hits") < promote).select(*by), by)
    body = chunks.where("chunk_type = 'body'")
    caps = caption_spans(few.where("chunk_type = 'caption'").select(*by, "chunk_id", "rank", "distance", "page_start", "page_end", "hit_text"), body, window)
    spans = few.where("chunk_type <> 'caption'").select(*by, (F.col("chunk_index") - window).alias("lo"), (F.col("chunk_index") + window).alias("hi"), F.col("distance").alias("dist"))
    spans = spans.unionByName(caps.where("lo IS NOT NULL").select(*by, "lo", "hi", F.col("distance").alias("dist")))
    wins = merged_spans(spans, ("query_id", "article_id"))
    inside = wins.withColumn("chunk_index", F.explode(F.sequence("lo", "hi"))).join(body.select("article_id", "chunk_index", "page_start", "page_end", "text"), ["article_id", "chunk_index"])
    part = F.struct(F.lit(0).alias("k"), F.col("chunk_index").alias("i"), "text", "page_start", "page_end")
    pieces = inside.select(*by, "lo", "hi", "dist", part.alias("p"))
    held = caps.where("lo IS NOT NULL").select(*by, F.col("lo").alias("clo"), F.col("hi").alias("chi"), "rank", "hit_text", "page_start", "page_end").join(wins, by).where("lo <= clo AND chi <= hi")
    cap_part = F.struct(F.lit(1).alias("k"), F.col("rank").alias("i"), F.col("hit_text").alias("text"), "page_start", "page_end")
    alone = caps.where("lo IS NULL").select(*by, F.col("rank").cast("int").alias("lo"), F.lit(-1).alias("hi"), F.col("distance").alias("dist"), cap_part.alias("p"))
    parts = pieces.unionByName(held.select(*by, "lo", "hi", "dist", cap_part.alias("p"))).unionByName(alone)
    w = parts.groupBy(*by, "lo", "hi", "dist").agg(F.sort_array(F.collect_list("p")).alias("ps"))
    texts = F.transform(F.filter("ps", lambda x: x["k"] == 0), lambda x: x["text"])
    caption_texts = F.transform(F.filter("ps", lambda x: x["k"] == 1), lambda x: x["text"])
    text = F.array_join(F.concat(texts, F.when(F.size(caption_texts) > 0, F.concat(F.array(F.lit(publication.wording.captions)), caption_texts)).otherwise(F.array().cast("array<string>"))), "\n\n")
    windows = w.join(heads, by).select("query_id", F.lit("window").alias("mode"), "n_hits", "m", F.array_min("ps.page_start").alias("ps"), F.array_max("ps.page_end").alias("pe"), text.alias("text"), F.col("dist").alias("best_distance"), "first_rank", F.col("lo").alias("win"))
    every = full.unionByName(windows)
    cite = citation(publication.wording, F.col("m.journal"), F.col("m.year"), F.col("m.issue"), F.col("m.title"), F.col("m.author"), F.col("ps"), F.col("pe"))
    no = F.row_number().over(Window.partitionBy("query_id").orderBy("best_distance", "first_rank", "win")) - 1
    return every.select("query_id", no.alias("block_no"), "mode", "n_hits", cite.alias("citation"), "text", "best_distance")


def prompts(blocks: DataFrame, questions: DataFrame, publication: Publication) -> DataFrame:
    """(query_id, prompt, n_sources, est_tokens): the sources in order, then the question."""
    tag = F.when(F.col("mode") == "full_article", publication.wording.whole).otherwise(publication.wording.part)
    one = F.concat(F.lit(f"--- {publication.wording.source} "), F.col("block_no") + 1, F.lit(" ["), tag, F.lit("] ---\n"), F.col("citation"), F.lit("\n\n"), F.col("text"))
    ctx = blocks.groupBy("query_id").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("block_no", one.alias("t")))), lambda x: x["t"]), "\n\n").alias("context"), F.count(F.lit(1)).alias("n_sources"))
    j = questions.select("query_id", "question").join(ctx, "query_id", "left")
    nothing = F.concat(F.lit("Question: "), F.col("question"), F.lit("\n\nContext: (retrieval found no relevant excerpts)"))
    prompt = F.coalesce(F.concat(F.col("context"), F.lit("\n\n---\n\nQuestion: "), F.col("question")), nothing)
    return j.select("query_id", prompt.alias("prompt"), F.coalesce("n_sources", F.lit(0)).alias("n_sources"), estimated_tokens(prompt).alias("est_tokens"))
