"""Queries over the tables of a folder, by name. Their SQL is in catalogue_sql."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from inkwell.functions import fonts, labels, templates, text
from inkwell.operators import articles, chunking, diagnose, evaluate, index, layout, page_map, retrieval, toc, typography, vector_index
from inkwell.operators.common import BLOCK, ISSUE, latest, with_box
from inkwell.plans import publication
from inkwell.session import scratch_table, table, written

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}

KEYWORD, NUMBERED, ADAPTIVE = publication.SERIF_SANS, publication.NUMBERED_PAGES, publication.ADAPTIVE


def query(f: Query) -> Query:
    _QUERIES[f.__name__] = f
    return f


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    from inkwell.plans import catalogue_sql, fold_sql

    return {k: v for k, v in (catalogue_sql.SQL | fold_sql.SQL).items() if k in _QUERIES}


# --- tables in their latest states ------------------------------------------------


def blocks(spark: SparkSession, d: str, *columns: str) -> DataFrame:
    """Blocks with their key and the columns named."""
    return latest(table(spark, d, "blocks"), BLOCK, "extracted_at", columns)


def page_blocks(spark: SparkSession, d: str, *columns: str) -> DataFrame:
    """Blocks with what page labels need and the columns named, written once for all that read them."""
    return written(blocks(spark, d, "text", "font", "font_size", "bbox", *columns), "blocks")


def corpus(spark: SparkSession, d: str, *columns: str) -> DataFrame:
    return latest(table(spark, d, "corpus"), ["article_id"], "ingested_at", columns)


def chunks(spark: SparkSession, d: str, *columns: str) -> DataFrame:
    return latest(table(spark, d, "chunks"), ["chunk_id"], "ingested_at", columns)


def contents(spark: SparkSession, d: str) -> DataFrame:
    """Contents entries as the articles' titles stand in them: (issue, toc_pos, printed_page, title, author)."""
    c = table(spark, d, "corpus").select("article_id", *ISSUE, F.col("printed_page_start").alias("printed_page"), "title", "author").distinct().where("title IS NOT NULL")
    number = F.regexp_extract("article_id", "([0-9]+)$", 1).try_cast("int")
    return c.select(*ISSUE, number.alias("toc_pos"), "printed_page", "title", "author")


def contents_spans(spark: SparkSession, d: str) -> DataFrame:
    """Typeset spans of a contents page: a bold number, the title, and the author in another colour."""
    e = contents(spark, d)

    def span(at: int, value: Column, font: str, color: int) -> Column:
        return F.struct((F.col("toc_pos") * 3 + at).alias("pos"), value.alias("text"), F.lit(font).alias("font"), F.lit(9.0).alias("size"), F.lit(color).alias("color"))

    arms = F.array(span(0, F.col("printed_page"), "Serifa-Bold", 0), span(1, F.col("title"), "Serifa-Regular", 0), span(2, F.col("author"), "Serifa-Regular", 255))
    return e.select(*ISSUE, F.lit(3).alias("page"), F.explode(arms).alias("s")).select(*ISSUE, "page", "s.*").where("text IS NOT NULL")


# --- text, labels, fonts ------------------------------------------------------------


@query
def clean_text(spark, d):
    return table(spark, d, "documents").select("doc_id", F.md5(text.clean(F.col("text"))).alias("cleaned"))


@query
def word_breaks(spark, d):
    """Blocks set in a column of 30 characters with hyphens: how often the first break is one within a word, by journal."""
    b = blocks(spark, d, "text").where(F.length("text") > 30)
    first, rest = F.concat(F.left("text", F.lit(30)), F.lit("- ")), F.substring("text", 31, 1_000_000)
    return b.groupBy("journal").agg(F.count_if(text.breaks_word(first, rest)).alias("n"), F.count(F.lit(1)).alias("n_blocks"))


@query
def glued_pages(spark, d):
    """Pages with their blocks' texts glued: characters and cut words made whole."""
    b = blocks(spark, d, "text").groupBy(*ISSUE, "page").agg(F.sort_array(F.collect_list(F.struct("block_id", "text"))).alias("b"))
    return b.select(*ISSUE, "page", F.md5(text.glue(F.transform("b", lambda x: x["text"]))).alias("glued"))


@query
def font_styles(spark, d):
    b = blocks(spark, d, "font", "font_size")
    return b.groupBy(fonts.family(F.col("font")).alias("family"), fonts.half_points(F.col("font_size")).alias("size"), fonts.is_bold(F.col("font")).alias("bold")).agg(F.count(F.lit(1)).alias("n"))


@query
def figure_labels(spark, d):
    t = F.col("text")
    return blocks(spark, d, "text").groupBy("journal").agg(F.count_if(fonts.is_figure_label(t)).alias("n_labels"), F.count_if(fonts.opens_caption(t)).alias("n_captions"))


@query
def roman_round_trip(spark, d):
    r = table(spark, d, "blocks").select(F.col("page").alias("n")).distinct().withColumn("roman", labels.to_roman(F.col("n")))
    return r.select("n", "roman", labels.roman_value(F.lower("roman")).alias("value"))


@query
def canonical_labels(spark, d):
    return corpus(spark, d, "printed_page_start").select("article_id", labels.canonical_label(F.col("printed_page_start")).alias("label"), labels.page_value(F.col("printed_page_start")).alias("first_page"))


@query
def sentence_counts(spark, d):
    return table(spark, d, "documents").where("text IS NOT NULL").select("doc_id", F.size(text.sentences(F.col("text"))).alias("n_sentences"))


@query
def title_matches(spark, d):
    """Headings of an issue that are like a contents title of it."""
    c = contents(spark, d).select(*ISSUE, "toc_pos", "title")
    h = blocks(spark, d, "type", "text").where("type IN ('title', 'heading')").select(*BLOCK, "text")
    return h.join(c, list(ISSUE)).where(text.same_title(F.col("title"), F.col("text"))).select(*BLOCK, "toc_pos")


@query
def token_totals(spark, d):
    c = chunks(spark, d, "journal", "text", "embedding_text")
    return c.groupBy("journal").agg(F.sum(text.estimated_tokens(F.col("text"))).alias("est_tokens"), F.sum(text.estimated_tokens(F.col("embedding_text"))).alias("est_embedding_tokens"))


# --- typography -----------------------------------------------------------------------


@query
def document_stats(spark, d):
    return typography.document_stats(blocks(spark, d, "text", "font", "font_size"))


@query
def classify_absolute(spark, d):
    return typography.classify(blocks(spark, d, "type", "text", "font", "font_size"), KEYWORD).groupBy("journal", "type", "new_type").agg(F.count(F.lit(1)).alias("n"))


@query
def classify_adaptive(spark, d):
    return typography.classify(written(blocks(spark, d, "type", "text", "font", "font_size"), "blocks"), ADAPTIVE).groupBy("journal", "type", "new_type").agg(F.count(F.lit(1)).alias("n"))


@query
def style_histogram(spark, d):
    return typography.style_histogram(blocks(spark, d, "text", "font", "font_size"))


@query
def dominant_font(spark, d):
    """The dominant font of each page, its blocks taken as spans."""
    s = blocks(spark, d, "text", "font", "font_size").select(*ISSUE, "page", F.col("block_id").alias("pos"), "text", "font", F.col("font_size").alias("size"))
    return typography.dominant_font(s, (*ISSUE, "page"))


@query
def footer_candidates(spark, d):
    return typography.footer_candidates(blocks(spark, d, "text", "font_size", "bbox"))


@query
def style_samples(spark, d):
    return typography.style_samples(blocks(spark, d, "text", "font", "font_size"), 3)


@query
def issues_in_order(spark, d):
    """Issues of each journal and year, numbers first and by value."""
    at = F.row_number().over(Window.partitionBy("journal", "year").orderBy(*templates.issue_order(F.col("issue"))))
    return table(spark, d, "blocks").select(*ISSUE).distinct().withColumn("place", at)


@query
def group_overview(spark, d):
    b = page_blocks(spark, d, "type")
    e = written(articles.ranges(articles.resolved(contents(spark, d), page_map.page_map(b, NUMBERED)), page_map.last_pages(b)), "entries")
    return diagnose.group_view(b, e, NUMBERED)


@query
def flagged_share(spark, d):
    return evaluate.flagged_share(corpus(spark, d, "quality_flags", "full_text"), chunks(spark, d, "article_id"))


@query
def numbered_pages(spark, d):
    return typography.numbered_pages(blocks(spark, d, "text"))


@query
def suggested_rules(spark, d):
    return typography.suggested_rules(blocks(spark, d, "text", "font", "font_size"))


@query
def other_families(spark, d):
    return typography.other_families(written(blocks(spark, d, "text", "font", "font_size"), "blocks"))


@query
def contact_blocks(spark, d):
    """Blocks with an address of the archive's hosts."""
    return typography.lines_with(blocks(spark, d, "text"), ".EXAMPLE").select(*BLOCK)


@query
def junk_blocks(spark, d):
    b = with_box(blocks(spark, d, "text", "font", "font_size", "bbox"))
    junk = NUMBERED.is_junk(publication.Line.of_block(F.lit(1000.0)))
    return b.groupBy("journal").agg(F.count_if(junk).alias("n_junk"), F.count(F.lit(1)).alias("n"))


#: With marks of boilerplate, and running text that is body text in whatever size.
MARKED = publication.replace(NUMBERED, name="marked", boilerplate=((".example", "1"), ("no such mark",)), always_body="^[a-z]+ [a-z]+ ")


@query
def marked_blocks(spark, d):
    b = with_box(blocks(spark, d, "text", "font", "font_size", "bbox"))
    line = publication.Line.of_block(F.lit(1000.0))
    return b.groupBy("journal").agg(F.count_if(MARKED.is_junk(line)).alias("n_junk"), F.count_if(MARKED.block_type(line) == "body").alias("n_body"))


# --- page numbers ---------------------------------------------------------------------


@query
def page_labels(spark, d):
    return page_map.page_labels(page_blocks(spark, d), NUMBERED)


@query
def page_labels_keyword(spark, d):
    return page_map.page_labels(page_blocks(spark, d), KEYWORD)


@query
def page_runs(spark, d):
    return page_map.runs(page_map.page_labels(page_blocks(spark, d), NUMBERED))


@query
def extended_runs(spark, d):
    b = page_blocks(spark, d)
    return page_map.extended(page_map.runs(page_map.page_labels(b, NUMBERED)), page_map.last_pages(b))


@query
def label_to_page(spark, d):
    return page_map.page_map(page_blocks(spark, d), NUMBERED)


@query
def unlabelled_pages(spark, d):
    return page_map.unlabelled_pages(page_blocks(spark, d), NUMBERED)


@query
def lone_runs(spark, d):
    return page_map.lone_runs(page_blocks(spark, d), NUMBERED)


# --- contents and articles --------------------------------------------------------------


@query
def toc_pages(spark, d):
    return toc.toc_pages(contents_spans(spark, d), KEYWORD)


@query
def toc_style_pairs(spark, d):
    return toc.style_pairs(contents_spans(spark, d)).select(*ISSUE, "number_style.family", "number_style.size", F.col("text_style.family").alias("text_family"), F.col("text_style.size").alias("text_size"), "n")


@query
def toc_entries(spark, d):
    return toc.entries(contents_spans(spark, d), KEYWORD)


#: Two sizes of entries, authors in colour, the printer's lines and notes among the titles.
TWO_STYLES = publication.replace(publication.SERIF_SANS, name="two-styles", contents=publication.Contents(authors_in_colour=True, imprint=("© ",), passed_over=("overleaf",)))


def two_style_spans(spark: SparkSession, d: str) -> DataFrame:
    """A contents over two pages, every third entry in a smaller size, with notes and imprints; on a third page large numbers that begin no entry."""
    e = contents(spark, d)
    n = F.col("toc_pos")
    size = F.when(n % 3 == 0, 8.0).otherwise(9.0)

    def span(at: int, value: Column, font: str, size: Column, color: int = 0, page: Column | None = None) -> Column:
        return F.struct((3 + n % 2 if page is None else page).alias("page"), (n * 10 + at).alias("pos"), value.alias("text"), F.lit(font).alias("font"), size.alias("size"), F.lit(color).alias("color"))

    arms = F.array(
        span(0, F.col("printed_page"), "Serifa-Bold", size), span(1, F.when(n % 7 == 2, F.concat("title", F.lit(", © Press 1999"))).otherwise(F.col("title")), "Serifa-Regular", size), span(2, F.col("author"), "Serifa-Regular", size, 255),
        span(3, F.when(n % 4 == 1, "see overleaf"), "Serifa-Regular", size), span(4, F.when(n % 5 == 0, "7"), "Okraj-Black", F.lit(30.0), 0, F.lit(5)), span(5, F.when(n % 5 == 0, "NEWS"), "Okraj-Light", F.lit(14.0), 0, F.lit(5)))
    return e.select(*ISSUE, F.explode(arms).alias("s")).select(*ISSUE, "s.*").where("text IS NOT NULL")


@query
def two_style_entries(spark, d):
    return toc.entries(two_style_spans(spark, d), TWO_STYLES)


@query
def two_style_pairs(spark, d):
    s = toc.entry_styles(two_style_spans(spark, d))
    return s.select(*ISSUE, "number_style.family", "number_style.size", F.col("text_style.size").alias("text_size"))


@query
def two_style_pages(spark, d):
    return toc.toc_pages(two_style_spans(spark, d), TWO_STYLES)


@query
def resolved_entries(spark, d):
    return articles.resolved(contents(spark, d), page_map.page_map(page_blocks(spark, d), NUMBERED))


@query
def unresolved_entries(spark, d):
    return articles.unresolved(contents(spark, d), page_map.page_map(page_blocks(spark, d), NUMBERED))


@query
def nearby_labels(spark, d):
    return page_map.nearby_labels(contents(spark, d), page_map.page_map(page_blocks(spark, d), NUMBERED))


@query
def article_ranges(spark, d):
    b = page_blocks(spark, d)
    e = articles.ranges(articles.resolved(contents(spark, d), page_map.page_map(b, NUMBERED)), page_map.last_pages(b))
    return e.select(*ISSUE, "toc_pos", "group_no", "in_group", "pdf_page_start", "pdf_page_end")


@query
def blocks_in_ranges(spark, d):
    b = page_blocks(spark, d)
    e = articles.ranges(articles.resolved(contents(spark, d), page_map.page_map(b, NUMBERED)), page_map.last_pages(b))
    return b.join(articles.page_groups(e), [*ISSUE, "page"]).groupBy(*ISSUE, "group_no").agg(F.count(F.lit(1)).alias("n_blocks"))


@query
def boundary_cuts(spark, d):
    b = page_blocks(spark, d, "type")
    e = articles.ranges(articles.resolved(contents(spark, d), page_map.page_map(b, NUMBERED)), page_map.last_pages(b))
    return articles.boundary_cuts(articles.content_blocks(b, NUMBERED), e)


@query
def reading_order(spark, d):
    return layout.reading_order(with_box(blocks(spark, d, "bbox"))).select(*BLOCK, "column_no", "reading_pos")


@query
def merged_frames(spark, d):
    b = with_box(blocks(spark, d, "text", "font", "font_size", "bbox")).select(*ISSUE, "page", F.col("block_id").alias("pos"), "text", "font", F.col("font_size").alias("size"), "x0", "y0", "x1", "y1")
    return layout.merged_frames(b)


@query
def style_groups(spark, d):
    """Lines of each page by groups of one size."""
    b = blocks(spark, d, "text", "font_size").groupBy(*ISSUE, "page").agg(F.sort_array(F.collect_list(F.struct("block_id", "text", F.col("font_size").alias("size")))).alias("b"))
    g = layout.style_groups(F.transform("b", lambda x: F.struct(x["text"].alias("text"), x["size"].alias("size"))))
    return b.select(*ISSUE, "page", F.posexplode(g).alias("line", "style_group"))


@query
def assembled_articles(spark, d):
    b = page_blocks(spark, d, "type")
    a = articles.assemble(b, contents(spark, d), page_map.page_map(b, NUMBERED), NUMBERED)
    return a.select("article_id", *ISSUE, "title", "author", "pdf_page_start", "pdf_page_end", F.array_join("quality_flags", ",").alias("flags"), F.size("full_text_paragraphs").alias("n_paragraphs"), F.length("full_text").alias("n_chars"), F.length("captions_text").alias("n_caption_chars"))


@query
def merged_paragraphs(spark, d):
    """Body blocks of an issue in block order, cut words made whole."""
    b = blocks(spark, d, "type", "text").where("type = 'body'").withColumn("pos", F.struct("page", "block_id"))
    return articles.merged_paragraphs(b, ISSUE).select(*ISSUE, F.size("paragraphs").alias("n"), F.md5(F.array_join("paragraphs.text", "\n\n")).alias("text_md5"))


# --- chunks -----------------------------------------------------------------------------


@query
def cover_filter(spark, d):
    kept = chunking.without_covers(F.col("full_text_paragraphs"), F.col("total_pdf_pages"), 2, 2)
    return corpus(spark, d, "full_text_paragraphs", "total_pdf_pages").select("article_id", F.size(kept).alias("n_kept"), F.size("full_text_paragraphs").alias("n_all"))


@query
def long_paragraphs_cut(spark, d):
    p = corpus(spark, d, "full_text_paragraphs").select("article_id", F.posexplode("full_text_paragraphs.text").alias("pos", "text")).where(F.length("text") > chunking.TARGET)
    return p.select("article_id", "pos", F.posexplode(chunking.cut_paragraph(F.col("text"))).alias("piece_no", "piece"))


@query
def article_chunks(spark, d):
    return chunking.chunk_articles(corpus(spark, d, *ISSUE, "title", "author", "total_pdf_pages", "full_text", "full_text_paragraphs", "captions_paragraphs"), KEYWORD, F.col("journal"))


@query
def embedding_texts(spark, d):
    c = chunks(spark, d, *ISSUE, "title", "author", "text").join(table(spark, d, "journals").select("journal", "journal_name"), "journal")
    values = {"journal": F.col("journal_name"), "author": templates.or_label(F.col("author"), KEYWORD.wording.nobody)} | {n: F.col(n) for n in ("year", "issue", "title", "text")}
    return c.select("chunk_id", F.md5(templates.fill(KEYWORD.wording.embedded, values)).alias("header_md5"))


@query
def body_and_captions(spark, d):
    c = chunks(spark, d, "journal", "chunk_type", "text")
    both = c.where("chunk_type = 'body'").unionByName(c.where("chunk_type = 'caption'"))
    return both.groupBy("journal", "chunk_type").agg(F.count(F.lit(1)).alias("n"), F.sum(F.length("text")).alias("chars"))


# --- index and retrieval ------------------------------------------------------------------


@query
def index_metadata(spark, d):
    return index.metadata(chunks(spark, d, *ISSUE, "chunk_type", "chunk_index", "article_id", "title", "author", "page_start", "page_end", "text")).drop("text")


@query
def pending_chunks(spark, d):
    return index.pending(chunks(spark, d, "journal").select("chunk_id", "journal"), table(spark, d, "vectors"))


@query
def upserted_chunks(spark, d):
    """The latest chunks of years before 2000 brought into an index that holds all first states."""
    t = table(spark, d, "chunks").where("chunk_id IS NOT NULL")
    old = t.groupBy("chunk_id").agg(F.min_by(F.struct("article_id", "text"), F.struct("ingested_at", "text")).alias("s")).select("chunk_id", "s.*")
    new = chunks(spark, d, "year", "article_id", "text").where(F.col("year").try_cast("int") < 2000).select("chunk_id", "article_id", "text")
    return index.upserted(old, new).select("chunk_id", "article_id", F.md5("text").alias("text_md5"))


@query
def misaligned_ids(spark, d):
    return index.misaligned(table(spark, d, "chunks"), table(spark, d, "vectors"))


@query
def vector_topk(spark, d):
    e = table(spark, d, "embeddings").select(F.col("vec_id").cast("string").alias("chunk_id"), "embedding", "vec_id")
    q = e.where("vec_id % 100 = 0").select(F.col("vec_id").alias("query_id"), "embedding")
    return retrieval.search(e, q)


@query
def vector_topk_filtered(spark, d):
    e = table(spark, d, "embeddings").select(F.col("vec_id").cast("string").alias("chunk_id"), "embedding", "vec_id", "label")
    q = e.where("vec_id % 100 = 0").select(F.col("vec_id").alias("query_id"), "embedding")
    return retrieval.search(e, q, 5, F.col("label") == 3)


def _indexed(spark: SparkSession, d: str) -> tuple[str, DataFrame]:
    """(an index of all embeddings, every hundredth of them as questions)."""
    e = table(spark, d, "embeddings").select(F.col("vec_id").cast("string").alias("chunk_id"), "embedding", "vec_id", "label")
    path = scratch_table(spark, "lists")
    vector_index.build(e, path)
    return path, e.where("vec_id % 100 = 0").select(F.col("vec_id").alias("query_id"), "embedding")


@query
def indexed_topk(spark, d):
    path, q = _indexed(spark, d)
    return vector_index.search(spark, path, q, exact=True)


@query
def indexed_topk_filtered(spark, d):
    path, q = _indexed(spark, d)
    return vector_index.search(spark, path, q, 5, F.col("label") == 3, exact=True)


def journal_questions(spark: SparkSession, d: str) -> DataFrame:
    """One question per journal: the text and vector of its chunk with the least id among those with a vector."""
    v = latest(table(spark, d, "vectors"), ["chunk_id"], "embedded_at").where("size(embedding) = 64")
    c = chunks(spark, d, "journal", "text").select("chunk_id", "journal", "text")
    return c.join(v, "chunk_id").groupBy(F.col("journal").alias("query_id")).agg(F.min_by(F.struct("text", "embedding"), "chunk_id").alias("s")).select("query_id", F.col("s.text").alias("question"), "s.embedding")


def journal_hits(spark: SparkSession, d: str, questions: DataFrame | None = None) -> DataFrame:
    v = latest(table(spark, d, "vectors"), ["chunk_id"], "embedded_at").where("size(embedding) = 64")
    known = v.join(table(spark, d, "chunks").select("chunk_id").distinct(), "chunk_id")
    return retrieval.search(known, journal_questions(spark, d) if questions is None else questions)


@query
def question_hits(spark, d):
    return journal_hits(spark, d)


@query
def hits_by_article(spark, d):
    h = journal_hits(spark, d).join(chunks(spark, d, "article_id").select("chunk_id", "article_id"), "chunk_id")
    return h.groupBy("query_id", "article_id").agg(F.count(F.lit(1)).alias("n_hits"), F.min("distance").alias("best"), (F.count(F.lit(1)) >= retrieval.PROMOTE).alias("promoted"))


@query
def merged_page_spans(spark, d):
    """Page spans of an article's body chunks, united where they touch."""
    s = chunks(spark, d, "chunk_type", "article_id", "page_start", "page_end").where("chunk_type = 'body'").select("article_id", F.col("page_start").alias("lo"), F.col("page_end").alias("hi"), F.lit(0.0).alias("dist"))
    return retrieval.merged_spans(s, ("article_id",)).drop("dist")


@query
def caption_windows(spark, d):
    c = written(chunks(spark, d, "chunk_type", "chunk_index", "article_id", "page_start", "page_end"), "chunks")
    caps = c.where("chunk_type = 'caption'").select("chunk_id", "article_id", "page_start", "page_end")
    return retrieval.caption_spans(caps, c.where("chunk_type = 'body'")).select("chunk_id", "lo", "hi")


@query
def context_blocks(spark, d):
    return _context(spark, d, journal_questions(spark, d))


def _context(spark: SparkSession, d: str, questions: DataFrame) -> DataFrame:
    """Hits and the chunks they are shown with have several readers, so they are written once, as far as they are used."""
    hits = written(journal_hits(spark, d, questions), "hits")
    shown = chunks(spark, d, *ISSUE, "chunk_type", "chunk_index", "article_id", "title", "author", "page_start", "page_end", "text")
    return retrieval.context_blocks(hits, written(shown, "chunks"), corpus(spark, d, "pdf_page_start", "pdf_page_end", "full_text", "captions_text"), KEYWORD)


@query
def prompts(spark, d):
    questions = written(journal_questions(spark, d), "questions")
    return retrieval.prompts(_context(spark, d, questions), questions, KEYWORD)


@query
def citations(spark, d):
    c = chunks(spark, d, *ISSUE, "title", "author", "page_start", "page_end").join(table(spark, d, "journals").select("journal", "journal_name"), "journal")
    return c.select("chunk_id", retrieval.citation(KEYWORD.wording, *[F.col(x) for x in ("journal_name", "year", "issue", "title", "author", "page_start", "page_end")]).alias("citation"))


@query
def hash_embeddings(spark, d):
    e = index.embed(table(spark, d, "documents").select("doc_id", "text"), "text")
    return e.select("doc_id", F.posexplode("embedding").alias("bucket", "x")).where("x <> 0").select("doc_id", "bucket", F.round(F.col("x").cast("double"), 6).alias("value"))


# --- figures ----------------------------------------------------------------------------------


@query
def quality_flag_counts(spark, d):
    return evaluate.flag_counts(corpus(spark, d, "quality_flags"))


@query
def flags_by_issue(spark, d):
    return evaluate.flags_by_issue(corpus(spark, d, *ISSUE, "quality_flags"))


@query
def flagged_unique_titles(spark, d):
    return evaluate.flagged_titles(corpus(spark, d, "title", "quality_flags", "full_text"))


@query
def issue_health(spark, d):
    return evaluate.issue_health(corpus(spark, d, *ISSUE, "quality_flags", "full_text"))


@query
def length_histogram(spark, d):
    return evaluate.length_histogram(chunks(spark, d, "chunk_type", "text"))


@query
def chunk_length_stats(spark, d):
    return evaluate.length_stats(chunks(spark, d, "chunk_type", "text"))


@query
def duplicate_ids(spark, d):
    return evaluate.duplicate_ids(table(spark, d, "chunks"))


@query
def chunks_per_year(spark, d):
    return evaluate.counts_by(chunks(spark, d, "journal", "year", "text"), "journal", "year")


@query
def similarity_separation(spark, d):
    v = table(spark, d, "embeddings").select(F.col("vec_id").cast("string").alias("chunk_id"), F.col("label").alias("article_id"), "embedding")
    s = evaluate.separation(evaluate.sampled_pairs(v))
    return s.select("kind", "n", *[F.round(c, 6).alias(c) for c in ("mean", "middle", "sd", "least", "most", "above")])


@query
def hit_rate_at_k(spark, d):
    e = table(spark, d, "embeddings").select(F.col("vec_id").cast("string").alias("chunk_id"), "embedding", "vec_id", F.col("label").cast("string").alias("title"))
    q = e.where("vec_id % 100 = 0").select(F.col("vec_id").alias("query_id"), "embedding", F.col("title").alias("expect"))
    hits = retrieval.search(e, q, 6).where(F.col("chunk_id") != F.col("query_id").cast("string"))  # a question isn't its own answer
    place = F.row_number().over(Window.partitionBy("query_id").orderBy("rank"))
    return evaluate.hit_rate(hits.withColumn("rank", place), q, e)


@query
def model_comparison(spark, d):
    """A model without parameters on titles: each journal's question is a title, to be found among its own chunks."""
    c = written(chunks(spark, d, "journal", "title", "embedding_text"), "chunks")
    q = c.where("title IS NOT NULL").groupBy(F.col("journal").alias("query_id")).agg(F.min("title").alias("question")).withColumn("expect", F.col("question"))
    return evaluate.compare_models(c, q, {"hash": 64})


@query
def truncated_texts(spark, d):
    """Texts over 1,500 characters, which an embedder with that limit would cut."""
    e = index.embed(chunks(spark, d, "embedding_text").select("chunk_id", "embedding_text"), max_chars=1500)
    return index.truncation_report(e.select("chunk_id", "truncated")).select("n", "n_truncated", F.array_join("ids", ",").alias("ids"))


@query
def common_titles(spark, d):
    return evaluate.most_common(corpus(spark, d, "title").where("title IS NOT NULL"), "title", F.col("article_id"), 20)


@query
def article_sample(spark, d):
    """Twenty articles drawn by hash."""
    return evaluate.hash_sample(corpus(spark, d, "title").select("article_id", "title"), "article_id", 20, 7)


@query
def event_windows(spark, d):
    from inkwell.streaming.ingest import windowed_counts

    return windowed_counts(table(spark, d, "events"))


# --- flagship -----------------------------------------------------------------------------------


def flagship(spark: SparkSession, d: str) -> DataFrame:
    """Journal questions to prompts over the archive: search, promotion, windows, citations."""
    return prompts(spark, d)
