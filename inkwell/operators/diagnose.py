"""Views for looking into an archive: groups of entries, spans of pages, contents pages, digests of stages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkwell.functions import labels
from inkwell.functions.text import preview, strip
from inkwell.operators import articles
from inkwell.operators.common import ISSUE
from inkwell.plans.publication import Publication


def group_view(blocks: DataFrame, entries: DataFrame, publication: Publication) -> DataFrame:
    """(issue, group_no, pages, n_entries, titles, n_blocks, n_headings, split_y): what each start page's entries have to share."""
    ordered = articles.content_blocks(blocks, publication)
    mine = articles.assigned(ordered, entries)
    key = [*ISSUE, "group_no"]
    groups = entries.groupBy(*key).agg(
        F.min("pdf_page_start").alias("pdf_page_start"), F.max("pdf_page_end").alias("pdf_page_end"), F.count(F.lit(1)).alias("n_entries"),
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("in_group", "title"))), lambda x: x["title"]), " | ").alias("titles"))
    sizes = mine.groupBy(*key).agg(F.count(F.lit(1)).alias("n_blocks"), F.count_if(F.col("type").isin("title", "heading")).alias("n_headings"))
    cuts = articles.boundary_cuts(ordered, entries).select(*key, "split_y")
    held = groups.join(sizes, key, "left").join(cuts, key, "left")
    return held.withColumns({c: F.coalesce(c, F.lit(0).cast("bigint")) for c in ("n_blocks", "n_headings")})


def span_view(spans: DataFrame, first: int, last: int, chars: int = 60) -> DataFrame:
    """(issue, page, pos, size, font, color, text) of the spans on pages first to last, texts cut short."""
    return spans.where(F.col("page").between(first, last) & F.col("text").isNotNull()).select(*ISSUE, "page", "pos", "size", "font", "color", preview(strip(F.col("text")), chars).alias("text"))


def contents_view(spans: DataFrame, publication: Publication) -> DataFrame:
    """(issue, page, pos, number, may_begin, font, size, text): how contents spans look to the reader of entries."""
    number = labels.page_value(F.col("text"))
    begins = number.isNotNull() & publication.contents.may_number(F.col("font"))
    return spans.where("text IS NOT NULL").select(*ISSUE, "page", "pos", number.alias("number"), F.coalesce(begins, F.lit(False)).alias("may_begin"), "font", "size", "text")


def digest(rows: DataFrame) -> str:
    """One string for the rows of a table, in whatever order and partitions they come: equal tables, equal digests.

    The number of rows and the sum of 60 bits of each row's SHA-256 as JSON with its columns by name.
    """
    one = F.sha2(F.to_json(F.struct(*sorted(rows.columns)), {"ignoreNullFields": "false"}), 256)
    part = F.conv(F.substring(one, 1, 15), 16, 10).cast("decimal(38,0)")
    n, total = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum(part), F.lit(0).cast("decimal(38,0)"))).first()
    return f"{n}-{int(total):x}"
