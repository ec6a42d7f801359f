"""Fonts of documents: the body style, block types, histograms and what rules could be."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from inkwell.functions import fonts
from inkwell.functions.text import preview, strip, words
from inkwell.operators.common import ISSUE, with_box
from inkwell.plans.publication import Line, Publication


def document_stats(blocks: DataFrame, keys: tuple[str, ...] = ISSUE) -> DataFrame:
    """(keys, body_family, body_size): the style that sets the most characters, the first met of equal ones.

    Sizes are halves of points. A document without text has size 10.0 and an empty family.
    """
    n = F.coalesce(F.length(strip(F.col("text"))), F.lit(0))
    styled = blocks.select(*keys, fonts.family(F.col("font")).alias("family"), fonts.half_points(F.col("font_size")).alias("size"), n.alias("n"), F.struct("page", "block_id").alias("at"))
    by_style = styled.groupBy(*keys, "family", "size").agg(F.sum("n").alias("n"), F.min(F.when(F.col("n") > 0, F.col("at"))).alias("at"))
    best = F.max_by(F.struct("family", "size"), F.struct("n", -F.col("at.page"), -F.col("at.block_id")))
    return by_style.groupBy(*keys).agg(F.max("n").alias("chars"), best.alias("s")).select(
        *keys, F.when(F.col("chars") > 0, F.col("s.family")).otherwise("").alias("body_family"), F.coalesce(F.when(F.col("chars") > 0, F.nullif(F.col("s.size"), F.lit(0.0))), F.lit(10.0)).alias("body_size"))


def classify(blocks: DataFrame, publication: Publication, keys: tuple[str, ...] = ISSUE) -> DataFrame:
    """blocks with new_type. Body text that opens like a caption is a caption.

    The adaptive kind joins one row of statistics per document, on the document's key.
    """
    line = Line(F.col("text"), F.col("font"), F.col("font_size"))
    if publication.types.needs_body_style:
        s = document_stats(blocks, keys)
        blocks = blocks.join(s, list(keys))
        kind = publication.block_type(line, F.col("body_size"), F.col("body_family"))
    else:
        kind = publication.block_type(line)
    return blocks.withColumn("new_type", F.when((kind == "body") & fonts.opens_caption(F.col("text")), "caption").otherwise(kind))


def dominant_font(spans: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """(keys, font, size) of spans (keys, pos, text, font, size): the font with the most characters, the size of the first span."""
    w = spans.groupBy(*keys, "font").agg(F.coalesce(F.sum(F.length("text")), F.lit(0)).alias("n"), F.min("pos").alias("pos"), F.min_by("size", "pos").alias("size"))
    return w.groupBy(*keys).agg(F.max_by("font", F.struct("n", -F.col("pos"))).alias("font"), F.min_by("size", "pos").alias("size"))


def style_histogram(blocks: DataFrame, keys: tuple[str, ...] = ISSUE) -> DataFrame:
    """Characters and their share by (family, size, bold) within each document."""
    n = F.coalesce(F.length(strip(F.col("text"))), F.lit(0))
    h = blocks.where(n > 0).groupBy(*keys, fonts.family(F.col("font")).alias("family"), fonts.half_points(F.col("font_size")).alias("size"), fonts.is_bold(F.col("font")).alias("bold")).agg(F.sum(n).alias("chars"))
    return h.withColumn("share", F.round(F.col("chars") / F.sum("chars").over(Window.partitionBy(*keys)), 6))


def footer_candidates(blocks: DataFrame, keys: tuple[str, ...] = ("journal",), max_size: float = 12.0, max_words: int = 6, edge: float = 0.1, top: int = 20) -> DataFrame:
    """(keys, place, line, n_pages): short small texts near the upper or lower edge that come back on many pages.

    On at least 3 and a tenth of the document's pages, of the `top` most frequent ones; equal ones by
    text. A page is as high as its lowest box; a text without a box is at no edge.
    """
    t = strip(F.col("text"))
    b = with_box(blocks)
    b = b.withColumn("height", F.max("y1").over(Window.partitionBy(*ISSUE, "page")))
    pages = b.groupBy(*keys).agg(F.count_distinct("year", "issue", "page").alias("pages"))
    near = (F.col("y0") >= F.col("height") * (1 - edge)) | (F.col("y1") <= F.col("height") * edge)
    short = b.where((t != "") & near & (F.col("font_size") < max_size) & (F.size(words(F.col("text"))) <= max_words))
    seen = short.groupBy(*keys, t.alias("line")).agg(F.count_distinct("year", "issue", "page").alias("n_pages"))
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc("n_pages"), "line"))
    seen = seen.withColumn("place", place).where(F.col("place") <= top)
    return seen.join(pages, list(keys)).where((F.col("n_pages") >= 3) & (F.col("n_pages") >= F.col("pages") * 0.1)).select(*keys, "place", "line", "n_pages")


def style_samples(blocks: DataFrame, n: int = 20, chars: int = 60, keys: tuple[str, ...] = ISSUE) -> DataFrame:
    """(keys, family, size, bold, no, text): the first n texts set in each style, cut short."""
    t = strip(F.col("text"))
    style = [fonts.family(F.col("font")).alias("family"), fonts.half_points(F.col("font_size")).alias("size"), fonts.is_bold(F.col("font")).alias("bold")]
    no = F.row_number().over(Window.partitionBy(*keys, "family", "size", "bold").orderBy("page", "block_id"))
    s = blocks.where(t != "").select(*keys, *style, "page", "block_id", preview(t, chars).alias("text")).withColumn("no", no)
    return s.where(F.col("no") <= n).drop("page", "block_id")


def numbered_pages(blocks: DataFrame, keys: tuple[str, ...] = ("journal",)) -> DataFrame:
    """(keys, pages, with_number, advice): pages that hold a bare number, and how footers should be found."""
    bare = F.col("text").rlike(r"(?U)^\s*[0-9]{1,4}\s*$")
    by_page = blocks.groupBy(*keys, "year", "issue", "page").agg(F.max(F.coalesce(bare, F.lit(False))).alias("bare"))
    s = by_page.groupBy(*keys).agg(F.count(F.lit(1)).alias("pages"), F.count_if("bare").alias("with_number"))
    return s.withColumn("advice", F.when(F.col("with_number") >= 0.4 * F.col("pages"), "position").otherwise("keyword"))


def suggested_rules(blocks: DataFrame, keys: tuple[str, ...] = ISSUE) -> DataFrame:
    """(keys, family, body, title_from, heading_from, subheading_from, cover_from): sizes of a hand-made set of rules, to 1 decimal."""
    s = document_stats(blocks, keys)
    size = F.col("body_size")
    at = {"title_from": 1.7, "heading_from": 1.18, "subheading_from": 1.05, "cover_from": 3.0}
    return s.select(*keys, F.col("body_family").alias("family"), size.alias("body"), *[F.round(size * f, 1).alias(n) for n, f in at.items()])


def other_families(blocks: DataFrame, keys: tuple[str, ...] = ISSUE, top: int = 3) -> DataFrame:
    """(keys, place, family, chars): the most used families beside that of the body text."""
    h = style_histogram(blocks, keys).groupBy(*keys, "family").agg(F.sum("chars").alias("chars"))
    rest = h.join(document_stats(blocks, keys), list(keys)).where("family <> body_family")
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc("chars"), "family"))
    return rest.select(*keys, place.alias("place"), "family", "chars").where(F.col("place") <= top)


def lines_with(blocks: DataFrame, needle: str) -> DataFrame:
    """Blocks whose text holds a string, case not told apart."""
    return blocks.where(F.lower("text").contains(needle.lower()))
