"""Problem 3: lines that a source prints on page after page, by bitmaps of pages.

A line as it is printed is a variant. Each variant's pages are a compressed bitmap of its source: 64-bit
words, of which only those with a bit set are kept, as rows (source, variant, container, word). A
container is an issue and page div 64; the bit is page mod 64. The bitmaps of the variants of a line
(case, white space, numbers) are united; the cardinality is the sum of bit_count over the union. All of it
is partial aggregation on numbers: a line on a third of all pages is one row per task and container. A
block's line is deleted where the united bitmap of its standing line has the block's page, which is a
lookup by (source, line, container).

The texts are read and their lines keyed once, into a narrow table of numbers in the shared folder, which
the bitmaps and the lookup are made from.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkwell.session import written

MIN_PAGES = 3
MIN_SHARE = 0.05

#: White space that doesn't tell lines apart: space, tab, U+00A0, U+2009. Fixed values.
_SPACES = "[ \\t\\u00a0\\u2009]+"


def lines_of(text: Column) -> Column:
    """What stands between line breaks; null for a null text, one empty line for an empty one."""
    return F.split(text, "\r\n|\n", -1)


def line_variant(line: Column) -> Column:
    """A line but for white space."""
    return F.trim(F.regexp_replace(line, _SPACES, " "))


def line_key(variant: Column) -> Column:
    """What all variants of a line have in common: case and numbers are not told apart.

    Upper case goes first, so that a letter without a capital of its own (as sharp s) is the same as
    what it is printed as in capitals.
    """
    # the numbers are replaced in between, as lower(upper(x)) would be simplified to lower(x)
    return F.lower(F.regexp_replace(F.upper(variant), "[0-9]+", "0"))


def _wide(text: Column) -> list[Column]:
    return [F.xxhash64(text).alias("line"), F.hash(text).alias("line2")]


def line_table(blocks: DataFrame, source: str = "journal", page_key: tuple[str, ...] = ("year", "issue", "page")) -> DataFrame:
    """One row per line that isn't blank, written once: source, page, container, block_id, line_no, and the hashes of variant and line."""
    *issue, page = page_key
    lines = blocks.select(
        F.col(source).alias("source"), *[F.col(c).alias(f"i{n}") for n, c in enumerate(issue)], F.col(page).alias("page"), F.col("block_id").alias("block_id"),
        F.xxhash64(*[F.coalesce(F.col(c).cast("string"), F.lit("\0")) for c in issue], F.floor(F.col(page) / 64)).alias("container"),
        F.posexplode(lines_of(F.col("text"))).alias("line_no", "variant"),
    ).withColumn("shown", line_variant(F.col("variant"))).where("shown <> ''")
    return written(lines.withColumn("key", line_key(F.col("shown"))).select("source", *[f"i{n}" for n in range(len(issue))], "page", "block_id", "line_no", "container", F.xxhash64("variant").alias("variant"), *_wide(F.col("key"))), "lines")


def _bit() -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), F.pmod(F.coalesce(F.col("page"), F.lit(-1)), F.lit(64)).cast("int"))


def variant_bitmaps(lines: DataFrame) -> DataFrame:
    """(source, line, line2, variant, container, word): the bitmap of each variant of a line."""
    return lines.select("source", "line", "line2", "variant", "container", _bit().alias("bit")).groupBy("source", "line", "line2", "variant", "container").agg(F.bit_or("bit").alias("word"))


def united(bitmaps: DataFrame) -> DataFrame:
    """(source, line, line2, container, word): the union of the bitmaps of each line's variants."""
    return bitmaps.groupBy("source", "line", "line2", "container").agg(F.bit_or("word").alias("word"))


def standing_lines(bitmaps: DataFrame, blocks: DataFrame, source: str = "journal", page_key: tuple[str, ...] = ("year", "issue", "page"), min_pages: int = MIN_PAGES, min_share: float = MIN_SHARE) -> DataFrame:
    """(source, line, line2, n_pages) of the united bitmaps with at least min_pages pages and min_share of the source's.

    Pages are counted from distinct (issue, page) of the blocks, with or without text. The share is
    compared in whole numbers of pages: n_pages >= min_share * pages.
    """
    pages = blocks.select(F.col(source).alias("source"), *[F.col(c) for c in page_key]).distinct().groupBy("source").agg(F.count(F.lit(1)).alias("pages"))
    counts = bitmaps.groupBy("source", "line", "line2").agg(F.sum(F.bit_count("word")).alias("n_pages"))
    often = counts.where(F.col("n_pages") >= min_pages)
    return often.join(pages, often["source"].eqNullSafe(pages["source"])).where(F.col("n_pages") >= F.lit(min_share) * F.col("pages") - 1e-9).select(often["source"], "line", "line2", "n_pages")


def _same_line(a: DataFrame, b: DataFrame) -> Column:
    return (a["line"] == b["line"]) & (a["line2"] == b["line2"]) & a["source"].eqNullSafe(b["source"])


def standing_places(blocks: DataFrame, source: str = "journal", page_key: tuple[str, ...] = ("year", "issue", "page"), min_pages: int = MIN_PAGES, min_share: float = MIN_SHARE) -> DataFrame:
    """(source, page key, block_id, line_no) of each place of a standing line, once.

    Null sources are a source of their own; null texts and blank lines have no place; rows delivered
    twice count once. No blocks give no rows.
    """
    places = line_table(blocks, source, page_key)
    words = written(united(variant_bitmaps(places)), "bitmaps")
    lines = standing_lines(words, blocks, source, page_key, min_pages, min_share)
    words = words.join(lines, _same_line(words, lines), "left_semi")
    held = F.call_function("shiftright", words["word"], F.pmod(F.coalesce(places["page"], F.lit(-1)), F.lit(64)).cast("int")).bitwiseAND(F.lit(1)) == 1
    hit = places.join(words, _same_line(places, words) & (places["container"] == words["container"]) & held, "left_semi")
    return hit.select(F.col("source").alias(source), *[F.col(f"i{n}").alias(c) for n, c in enumerate(page_key[:-1])], F.col("page").alias(page_key[-1]), "block_id", "line_no").distinct()


def without_standing_lines(blocks: DataFrame, source: str = "journal", page_key: tuple[str, ...] = ("year", "issue", "page"), version: str = "extracted_at", min_pages: int = MIN_PAGES, min_share: float = MIN_SHARE) -> DataFrame:
    """(source, page key, block_id, text, n_removed): each block once, its standing lines taken out.

    A line goes with the break after it, the last line with the one before it; all other characters stay
    as they are. A null text stays null; a text of standing lines only becomes empty. Of rows with one
    key the latest is taken (rows delivered twice are equal).
    """
    keys = [source, *page_key, "block_id"]
    places = standing_places(blocks, source, page_key, min_pages, min_share)
    state = F.struct(F.col(version), F.col("text"))
    rows = blocks.select(*keys, state.alias("state"), F.lit(None).cast("int").alias("gone"))
    # blocks and places meet in one aggregation by the block's key, so a text is moved once
    both = rows.unionByName(places.select(*keys, F.lit(None).cast(rows.schema["state"].dataType).alias("state"), F.col("line_no").alias("gone")))
    one = both.groupBy(*keys).agg(F.max("state").alias("state"), F.collect_set("gone").alias("gone"))
    lines = F.split("state.text", "(?<=\n)", -1)  # each with its break
    kept = F.array_join(F.filter(lines, lambda line, i: ~F.array_contains(F.col("gone"), i)), "")
    kept = F.when(F.array_contains(F.col("gone"), F.size(lines) - 1), F.regexp_replace(kept, "\r?\n\\z", "")).otherwise(kept)
    return one.select(*keys, F.when(F.size("gone") == 0, F.col("state.text")).otherwise(kept).alias("text"), F.size("gone").alias("n_removed"))
