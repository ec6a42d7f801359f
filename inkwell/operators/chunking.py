"""Articles to chunks: covers left out, long paragraphs cut, paragraphs packed with an overlap."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkwell.functions.templates import fill, joined, or_label
from inkwell.functions.text import is_blank, sentences, strip, words
from inkwell.plans.publication import Publication

#: Fixed values, in characters.
TARGET = 1200
OVERLAP = 150
LEAST = 200


def let(value: Column, use) -> Column:
    """use(value), the value being computed once however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


_PART = "struct<page:int,text:string>"


def without_covers(paragraphs: Column, total_pages: Column, skip_first: int, skip_last: int) -> Column:
    """Paragraphs of the pages after the first and before the last ones; all if the number of pages is unknown."""
    kept = F.filter(paragraphs, lambda p: (p["page"] > skip_first) & (p["page"] <= total_pages - skip_last))
    return F.when(F.coalesce(total_pages, F.lit(0)) == 0, paragraphs).otherwise(kept)


def cut_paragraph(text: Column, limit: int = TARGET) -> Column:
    """ARRAY<STRING>: a text within the limit as it is; else sentences packed, and long sentences by words.

    A sentence joins the piece if their lengths together are within the limit, the space between not
    counted. Words of a long sentence are packed with the space counted; their last piece stays open for
    the next sentence. A word over the limit stays whole.
    """
    start = F.struct(F.array().cast("array<string>").alias("out"), F.lit("").alias("cur"))

    def flush(acc: Column) -> Column:
        return F.when(acc["cur"] == "", acc["out"]).otherwise(F.array_append(acc["out"], strip(acc["cur"])))

    def by_word(acc: Column, w: Column) -> Column:
        full = (acc["cur"] != "") & (F.length(acc["cur"]) + F.length(w) + 1 > limit)
        return F.struct(F.when(full, flush(acc)).otherwise(acc["out"]).alias("out"), F.when(full | (acc["cur"] == ""), w).otherwise(F.concat_ws(" ", acc["cur"], w)).alias("cur"))

    def by_sentence(acc: Column, s: Column) -> Column:
        emptied = F.struct(flush(acc).alias("out"), F.lit("").alias("cur"))
        long = F.aggregate(words(s), emptied, by_word)
        full = (acc["cur"] != "") & (F.length(acc["cur"]) + F.length(s) > limit)
        packed = F.struct(F.when(full, flush(acc)).otherwise(acc["out"]).alias("out"), F.when(full, s).otherwise(strip(F.concat(acc["cur"], F.lit(" "), s))).alias("cur"))
        return F.when(F.length(s) > limit, long).otherwise(packed)

    cut = F.aggregate(sentences(text), start, by_sentence, flush)
    return F.when(F.length(text) <= limit, F.array(text)).otherwise(cut)


def pack(paragraphs: Column, target: int = TARGET, overlap: int = OVERLAP, least: int = LEAST) -> Column:
    """ARRAY<STRUCT<page_start, page_end, text>> of ARRAY<STRUCT<page, text>>.

    A chunk is closed when the next paragraph (with 2 for the break) would pass the target. The next
    chunk begins with as many whole last paragraphs as the overlap holds; their lengths count without
    breaks. A last chunk under `least` characters goes to the end of the one before it.
    """
    parts = F.flatten(F.transform(paragraphs, lambda p: F.transform(cut_paragraph(p["text"], target), lambda t: F.struct(p["page"].cast("int").alias("page"), t.alias("text")))))
    none = F.array().cast(f"array<{_PART}>")
    start = F.struct(F.array().cast(f"array<array<{_PART}>>").alias("done"), none.alias("cur"), F.lit(0).alias("len"))

    def tail(cur: Column) -> Column:
        first = F.struct(none.alias("kept"), F.lit(0).alias("len"), F.lit(True).alias("go"))

        def back(acc: Column, p: Column) -> Column:
            fits = acc["go"] & (acc["len"] + F.length(p["text"]) <= overlap)
            return F.struct(F.when(fits, F.concat(F.array(p), acc["kept"])).otherwise(acc["kept"]).alias("kept"), F.when(fits, acc["len"] + F.length(p["text"])).otherwise(acc["len"]).alias("len"), fits.alias("go"))

        return F.aggregate(F.reverse(cur), first, back)

    def add(acc: Column, p: Column) -> Column:
        n = F.length(p["text"])
        full = (F.size(acc["cur"]) > 0) & (acc["len"] + n + 2 > target)
        closed = let(tail(acc["cur"]), lambda rest: F.struct(F.array_append(acc["done"], acc["cur"]).alias("done"), F.array_append(rest["kept"], p).alias("cur"), (rest["len"] + n + 2).alias("len")))
        return F.when(full, closed).otherwise(F.struct(acc["done"].alias("done"), F.array_append(acc["cur"], p).alias("cur"), (acc["len"] + n + 2).alias("len")))

    groups = F.aggregate(parts, start, add, lambda acc: F.when(F.size(acc["cur"]) > 0, F.array_append(acc["done"], acc["cur"])).otherwise(acc["done"]))
    chunks = F.transform(groups, lambda g: F.struct(F.array_min(g["page"]).alias("page_start"), F.array_max(g["page"]).alias("page_end"), F.array_join(g["text"], "\n\n").alias("text")))
    return let(chunks, lambda c: _with_tail(c, least))


def _with_tail(chunks: Column, least: int) -> Column:
    def join(acc: Column, c: Column) -> Column:
        n = F.size(acc)
        prev = F.get(acc, n - 1)
        longer = F.struct(prev["page_start"].alias("page_start"), c["page_end"].alias("page_end"), F.concat(prev["text"], F.lit("\n\n"), c["text"]).alias("text"))
        return F.concat(F.slice(acc, F.lit(1), F.greatest(n - 1, F.lit(0))), F.array(longer))

    last = F.get(chunks, F.size(chunks) - 1)
    head = F.slice(chunks, F.lit(1), F.greatest(F.size(chunks) - 1, F.lit(0)))
    return F.when((F.size(chunks) > 1) & (F.length(last["text"]) < least), join(head, last)).otherwise(chunks)


def chunk_articles(articles: DataFrame, publication: Publication, journal_name: Column | None = None, skip_first: int | None = None, skip_last: int | None = None) -> DataFrame:
    """Chunks of articles, body and captions numbered apart. An article with a blank full_text has none.

    Each article is one row and its chunks are folded in place: nothing is shuffled.
    """
    first = publication.covers[0] if skip_first is None else skip_first
    last = publication.covers[1] if skip_last is None else skip_last
    name = F.lit(publication.title) if journal_name is None else journal_name
    none = F.array().cast(f"array<{_PART}>")
    a = articles.where(~is_blank(F.col("full_text")))

    def of(column: str, kind: str, label: str) -> Column:
        kept = F.filter(without_covers(F.coalesce(F.col(column), none), F.col("total_pdf_pages"), first, last), lambda p: p["text"].isNotNull())
        return F.transform(pack(kept), lambda c, i: F.struct(F.lit(kind).alias("chunk_type"), i.cast("int").alias("chunk_index"), F.lit(label).alias("label"), c["page_start"].alias("page_start"), c["page_end"].alias("page_end"), c["text"].alias("text")))

    a = a.withColumn("_all", F.concat(of("full_text_paragraphs", "body", "chunk"), of("captions_paragraphs", "caption", "caption")))
    a = a.select("article_id", "journal", "year", "issue", "title", "author", name.alias("journal_name"), F.explode("_all").alias("c"))
    out = a.select(joined(F.col("article_id"), F.col("c.label"), F.col("c.chunk_index")).alias("chunk_id"), "c.chunk_type", "c.chunk_index", "journal", "year", "issue", "article_id", "title", "author", "c.page_start", "c.page_end", "c.text", "journal_name")
    values = {"journal": F.col("journal_name"), "author": or_label(F.col("author"), publication.wording.nobody)} | {c: F.col(c) for c in ("year", "issue", "title", "text")}
    return out.withColumn("embedding_text", fill(publication.wording.embedded, values)).drop("journal_name")
