"""Printed contents: pages that hold them, styles of their entries, entries with titles and authors.

Spans are (issue, page, pos, text, font, size, color) in the order of typesetting.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from inkwell.functions import fonts, labels
from inkwell.functions.text import clean, cut_imprint, is_blank, strip
from inkwell.operators.common import ISSUE
from inkwell.plans.publication import Publication

#: How many pages are searched, entries of a contents page, shares of the best.
SEARCH_PAGES = 8
MIN_ENTRIES = 5
PEER_RATIO = 0.4


def style(font: Column, size: Column) -> Column:
    return F.struct(fonts.family(font).alias("family"), fonts.half_points(size).alias("size"))


def toc_pages(spans: DataFrame, publication: Publication) -> DataFrame:
    """(issue, page, n): of the first pages those with at least 5 entries and two fifths of the fullest's.

    page counts from 1; an issue without such a page has no row.
    """
    start = ~is_blank(F.col("text")) & labels.page_value(F.col("text")).isNotNull() & publication.contents.may_number(F.col("font"))
    n = spans.where(F.col("page") <= SEARCH_PAGES).groupBy(*ISSUE, "page").agg(F.count_if(start).alias("n"))
    best = F.max("n").over(Window.partitionBy(*ISSUE))
    return n.withColumn("best", best).where((F.col("best") >= MIN_ENTRIES) & (F.col("n") >= F.greatest(F.lit(float(MIN_ENTRIES)), F.col("best") * PEER_RATIO))).select(*ISSUE, "page", "n")


def style_pairs(spans: DataFrame) -> DataFrame:
    """(issue, number_style, text_style, n): styles of numbers and of the text right after them.

    Of numbers in a row the last one counts.
    """
    s = spans.where(~is_blank(F.col("text"))).withColumns({"number": labels.page_value(F.col("text")).isNotNull(), "style": style(F.col("font"), F.col("size"))})
    w = Window.partitionBy(*ISSUE).orderBy("page", "pos")
    pairs = s.withColumns({"was_number": F.lag("number").over(w), "before": F.lag("style").over(w)}).where("was_number AND NOT number")
    return pairs.groupBy(*ISSUE, F.col("before").alias("number_style"), F.col("style").alias("text_style")).agg(F.count(F.lit(1)).alias("n"))


def entry_styles(spans: DataFrame) -> DataFrame:
    """(issue, number_style, text_style): the pairs at least two fifths as frequent as the most frequent."""
    p = style_pairs(spans)
    return p.withColumn("best", F.max("n").over(Window.partitionBy(*ISSUE))).where(F.col("n") >= F.col("best") * PEER_RATIO).select(*ISSUE, "number_style", "text_style")


def entries(spans: DataFrame, publication: Publication) -> DataFrame:
    """(issue, toc_pos, printed_page, title, author) of contents spans.

    A number begins an entry; the spans up to the next one are its text. With authors, the title ends
    where the colour first changes. A title with semicolons is several entries of one page. Entries
    without a title are left out.
    """
    s = spans.withColumns({"raw": F.col("text"), "text": clean(F.col("text"))}).where("text <> ''").withColumn("value", labels.page_value(F.col("text")))
    if publication.contents.by_frequent_styles:
        own = entry_styles(spans).groupBy(*ISSUE).agg(F.collect_set("number_style").alias("numbers"), F.collect_set("text_style").alias("texts"))
        s = s.join(own, list(ISSUE), "left").withColumn("style", style(F.col("font"), F.col("size")))
        starts = F.when(F.col("numbers").isNull(), publication.contents.may_number(F.col("font"))).otherwise(F.array_contains("numbers", F.col("style")))
        keep = F.col("texts").isNull() | F.array_contains("texts", F.col("style"))
    else:
        starts, keep = publication.contents.may_number(F.col("font")), F.lit(True)
    for m in publication.contents.passed_over:
        keep = keep & ~F.col("text").contains(m)
    w = Window.partitionBy(*ISSUE).orderBy("page", "pos")
    s = s.withColumn("start", F.coalesce(F.col("value").isNotNull() & starts, F.lit(False))).withColumn("entry", F.sum(F.col("start").cast("int")).over(w))
    heads = s.where("start").select(*ISSUE, "entry", F.col("value").alias("printed_page"))
    body = s.where(~F.col("start") & (F.col("entry") > 0) & keep)
    inner = Window.partitionBy(*ISSUE, "entry").orderBy("page", "pos")
    other = F.col("color") != F.first("color").over(inner)
    body = body.withColumn("other", F.coalesce(other, F.lit(False))).withColumn("in_author", F.max("other").over(inner) if publication.contents.authors_in_colour else F.lit(False))

    def text(of: Column) -> Column:
        ordered = F.sort_array(F.collect_list(F.when(of, F.struct("page", "pos", "text"))))
        return clean(F.array_join(F.transform(ordered, lambda x: x["text"]), " "))

    e = body.groupBy(*ISSUE, "entry").agg(text(~F.col("in_author")).alias("title"), F.nullif(text(F.col("in_author")), F.lit("")).alias("author"))
    e = heads.join(e, [*ISSUE, "entry"]).select(*ISSUE, "entry", "printed_page", "author", F.posexplode(F.split("title", ";")).alias("part", "title"))
    e = e.withColumns({"title": cut_imprint(strip(F.col("title")), publication.contents.imprint), "author": cut_imprint(F.col("author"), publication.contents.imprint)}).where("title <> ''")
    pos = F.row_number().over(Window.partitionBy(*ISSUE).orderBy("entry", "part")) - 1
    return e.select(*ISSUE, pos.alias("toc_pos"), "printed_page", "title", "author")
