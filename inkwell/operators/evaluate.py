"""Figures on an archive: quality flags, lengths, duplicates, and how well vectors separate and find."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from inkwell.functions.templates import joined
from inkwell.functions.text import is_blank
from inkwell.functions.vectors import cosine
from inkwell.operators import index, retrieval
from inkwell.session import cut


def flag_counts(articles: DataFrame) -> DataFrame:
    """(flag, n, percent of all articles)."""
    all_articles = articles.agg(F.count(F.lit(1)).alias("n_all"))
    n = articles.select(F.explode("quality_flags").alias("flag")).groupBy("flag").agg(F.count(F.lit(1)).alias("n"))
    return n.join(F.broadcast(all_articles), F.lit(True)).select("flag", "n", F.round(100 * F.col("n") / F.col("n_all"), 4).alias("percent"))


def flags_by_issue(articles: DataFrame) -> DataFrame:
    """(issue_label, flag, n), with totals over issues, flags and both as nulls."""
    e = articles.select(joined(F.col("journal"), F.col("year"), F.col("issue")).alias("issue_label"), F.explode("quality_flags").alias("flag"))
    return e.cube("issue_label", "flag").agg(F.count(F.lit(1)).alias("n"))


def flagged_titles(articles: DataFrame) -> DataFrame:
    """(title, article_id, flags, n_chars) of flagged articles whose title no other flagged one has."""
    f = articles.where(F.size("quality_flags") > 0).withColumn("n", F.count(F.lit(1)).over(Window.partitionBy("title")))
    return f.where("n = 1").select("title", "article_id", F.array_join("quality_flags", ",").alias("flags"), F.length("full_text").alias("n_chars"))


def flagged_share(articles: DataFrame, chunks: DataFrame) -> DataFrame:
    """(articles, flagged, empty, chunks, flagged_chunks, percent): how much of an archive its flagged articles make up."""
    a = articles.select("article_id", (F.size("quality_flags") > 0).alias("flagged"), is_blank(F.col("full_text")).alias("empty"))
    c = chunks.groupBy("article_id").agg(F.count(F.lit(1)).alias("n"))
    j = a.join(c, "article_id", "left")
    n, of_flagged = F.coalesce(F.sum("n"), F.lit(0).cast("bigint")), F.coalesce(F.sum(F.when(F.col("flagged"), F.col("n"))), F.lit(0).cast("bigint"))
    return j.agg(F.count(F.lit(1)).alias("articles"), F.count_if("flagged").alias("flagged"), F.count_if("empty").alias("empty"), n.alias("chunks"), of_flagged.alias("flagged_chunks"), F.round(100 * F.try_divide(of_flagged, n), 4).alias("percent"))


def issue_health(articles: DataFrame) -> DataFrame:
    """(issue_label, articles, flagged, empty)."""
    label = joined(F.col("journal"), F.col("year"), F.col("issue"))
    return articles.groupBy(label.alias("issue_label")).agg(F.count(F.lit(1)).alias("articles"), F.count_if(F.size("quality_flags") > 0).alias("flagged"), F.count_if(is_blank(F.col("full_text"))).alias("empty"))


def length_histogram(chunks: DataFrame, step: int = 200, most: int = 3000) -> DataFrame:
    """(chunk_type, bucket, n): lengths by buckets, the last one open."""
    b = F.least(F.floor(F.length("text") / step) * step, F.lit(most)).cast("int")
    return chunks.where("text IS NOT NULL").groupBy("chunk_type", b.alias("bucket")).agg(F.count(F.lit(1)).alias("n"))


def length_stats(chunks: DataFrame) -> DataFrame:
    n = F.length("text")
    return chunks.where("text IS NOT NULL").groupBy("chunk_type").agg(F.count(F.lit(1)).alias("n"), F.min(n).alias("least"), F.max(n).alias("most"), F.round(F.avg(n), 4).alias("mean"), F.median(n).alias("middle"))


def duplicate_ids(chunks: DataFrame) -> DataFrame:
    return chunks.groupBy("chunk_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def counts_by(rows: DataFrame, *keys: str) -> DataFrame:
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.count_if(is_blank(F.col("text"))).alias("n_blank"))


def sampled_pairs(vectors: DataFrame, n: int = 2000, seed: int = 42) -> DataFrame:
    """(kind, a, b, similarity): pairs of one article and of different ones, n of each kind, drawn by hash.

    A vector is paired with the next one of its article, and with the next one of all that is not of its
    article, in the order of hashes. Rows: chunk_id, article_id, embedding. Ids are drawn first, of each
    article as many as could be wanted; the vectors of the pairs are joined after.
    """
    v = vectors.select("chunk_id", "article_id", F.md5(F.concat_ws("/", "chunk_id", F.lit(seed))).alias("h"))
    own = Window.partitionBy("article_id").orderBy("h", "chunk_id")
    same = v.withColumn("no", F.row_number().over(own)).where(F.col("no") <= n + 1).withColumn("b", F.lead("chunk_id").over(own))
    same = same.where("b IS NOT NULL").orderBy("h", "chunk_id").limit(n).select(F.lit("same").alias("kind"), F.col("chunk_id").alias("a"), "b")
    w = Window.orderBy("h", "chunk_id")  # of the 2 n vectors of least hash
    few = v.orderBy("h", "chunk_id").limit(2 * n).withColumns({"b": F.lead("chunk_id").over(w), "ba": F.lead("article_id").over(w)})
    diff = few.where("ba <> article_id").orderBy("h", "chunk_id").limit(n).select(F.lit("different").alias("kind"), F.col("chunk_id").alias("a"), "b")
    pairs = cut(same.unionByName(diff))
    one = vectors.select(F.col("chunk_id").alias("a"), F.col("embedding").alias("va")).join(F.broadcast(pairs), "a")  # 2 n pairs at most
    both = vectors.select(F.col("chunk_id").alias("b"), F.col("embedding").alias("vb")).join(F.broadcast(one), "b")
    return both.select("kind", "a", "b", cosine(F.col("va"), F.col("vb")).alias("similarity"))


def separation(pairs: DataFrame) -> DataFrame:
    """(kind, n, mean, middle, sd, least, most, above): sd of the population; above: share over the median of different."""
    mid = pairs.where("kind = 'different'").agg(F.median("similarity").alias("m"))
    p = pairs.join(F.broadcast(mid), F.lit(True))
    s = F.col("similarity")
    return p.groupBy("kind").agg(F.count(F.lit(1)).alias("n"), F.avg(s).alias("mean"), F.median(s).alias("middle"), F.stddev_pop(s).alias("sd"), F.min(s).alias("least"), F.max(s).alias("most"), F.avg((s > F.col("m")).cast("double")).alias("above"))


def hit_rate(hits: DataFrame, expected: DataFrame, chunks: DataFrame, k: int = 5) -> DataFrame:
    """(n, found, rate): questions with a title among the first k hits that contains the expected words."""
    t = chunks.select("chunk_id", "title")
    ok = F.lower("title").contains(F.lower(F.col("expect")))
    by = hits.where(F.col("rank") <= k).join(t, "chunk_id").join(expected, "query_id", "right").groupBy("query_id").agg(F.coalesce(F.bool_or(ok), F.lit(False)).alias("found"))
    return by.agg(F.count(F.lit(1)).alias("n"), F.count_if("found").alias("found"), F.round(F.avg(F.col("found").cast("double")), 6).alias("rate"))


def hash_sample(rows: DataFrame, key: str, n: int, seed: int = 0) -> DataFrame:
    """n rows, the same ones each time: those whose key and seed have the least MD5."""
    return rows.orderBy(F.md5(F.concat_ws("/", key, F.lit(seed))), key).limit(n)


def most_common(rows: DataFrame, key: str, order: Column, k: int) -> DataFrame:
    """The k most frequent values; of equal ones the first met."""
    return rows.groupBy(key).agg(F.count(F.lit(1)).alias("n"), F.min(order).alias("at")).orderBy(F.desc("n"), "at").limit(k).select(key, "n")


def compare_models(chunks: DataFrame, questions: DataFrame, models: dict[str, int], k: int = 5) -> DataFrame:
    """(model, n, found, rate) of each model: chunks and questions embedded, titles searched for among the first k.

    questions: query_id, question, expect (words of the title). models: name and dimension.
    """
    every = None
    for m, dim in models.items():
        ix = index.embed(chunks.select("chunk_id", "embedding_text"), model=m, dim=dim)
        q = index.embed(questions.select("query_id", "question"), "question", m, True, dim)
        one = hit_rate(retrieval.search(ix, q, k), questions.select("query_id", "expect"), chunks, k).select(F.lit(m).alias("model"), "n", "found", "rate")
        every = one if every is None else every.unionByName(one)
    if every is None:
        raise ValueError("no models")
    return every
