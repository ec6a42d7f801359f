"""Contents entries and blocks to articles: resolved pages, ranges, boundary pages, shared pages, texts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from inkwell.functions import labels
from inkwell.functions.templates import joined
from inkwell.functions.text import breaks_word, common_length, is_blank, match_key, same_title, strip, without_break
from inkwell.operators import layout
from inkwell.operators.common import ISSUE, with_box
from inkwell.operators.page_map import last_pages
from inkwell.plans.publication import Line, Publication
from inkwell.session import written

BODY_TYPES = ("title", "heading", "other", "body")


def resolved(toc: DataFrame, label_to_page: DataFrame) -> DataFrame:
    """toc with pdf_page_start, for the labels that lead to a page."""
    t = toc.withColumn("label", labels.canonical_label(F.col("printed_page")))
    return t.join(label_to_page.withColumnRenamed("page", "pdf_page_start"), [*ISSUE, "label"]).drop("label")


def unresolved(toc: DataFrame, label_to_page: DataFrame) -> DataFrame:
    """The entries whose label leads nowhere."""
    return toc.withColumn("label", labels.canonical_label(F.col("printed_page"))).join(label_to_page, [*ISSUE, "label"], "left_anti")


def ranges(entries: DataFrame, last: DataFrame) -> DataFrame:
    """entries with group_no (0-based, entries of one start page together), place in it, and pdf_page_end."""
    w = Window.partitionBy(*ISSUE)
    e = entries.withColumn("group_no", F.dense_rank().over(w.orderBy("pdf_page_start")) - 1)
    e = e.withColumn("in_group", F.row_number().over(Window.partitionBy(*ISSUE, "group_no").orderBy("toc_pos")) - 1)
    groups = e.select(*ISSUE, "group_no", "pdf_page_start").distinct().withColumn("next", F.lead("pdf_page_start").over(w.orderBy("group_no")))
    groups = groups.join(last, list(ISSUE)).select(*ISSUE, "group_no", F.coalesce(F.col("next") - 1, F.col("last_page")).alias("pdf_page_end"))
    return e.join(groups, [*ISSUE, "group_no"])


def content_blocks(blocks: DataFrame, publication: Publication) -> DataFrame:
    """Blocks that are not junk, with boxes and their place on the page."""
    b = with_box(blocks)
    height = b.groupBy(*ISSUE).agg(F.max("y1").alias("height"))
    b = b.join(height, list(ISSUE))
    junk = publication.is_junk(Line.of_block())
    return layout.reading_order(b.where(~junk))


def page_groups(entries: DataFrame) -> DataFrame:
    """(issue, page, group_no): each page of each group's range. Ranges don't overlap, so this joins by equality."""
    first = entries.groupBy(*ISSUE, "group_no").agg(F.min("pdf_page_start").alias("a"), F.max("pdf_page_end").alias("b"))
    return first.where("b >= a").select(*ISSUE, "group_no", F.col("a").alias("start"), F.explode(F.sequence("a", "b")).alias("page"))


def boundary_cuts(ordered: DataFrame, entries: DataFrame) -> DataFrame:
    """(issue, group_no, page, split_y) for each group's first page, but for the first group's.

    The upper edge of the author's line of the group's first entry, else of its heading; null if neither
    is on the page.
    """
    first = entries.where("in_group = 0 AND group_no > 0").select(*ISSUE, "group_no", F.col("pdf_page_start").alias("page"), "title", "author")
    near = first.join(ordered.where("type IN ('other', 'title', 'heading')").select(*ISSUE, "page", "type", "text", "y0", "reading_pos"), [*ISSUE, "page"], "left")
    by_author = (F.col("type") == "other") & ~is_blank(F.col("author")) & same_title(F.col("author"), F.col("text"))
    by_title = F.col("type").isin("title", "heading") & same_title(F.col("title"), F.col("text"))
    found = near.groupBy(*ISSUE, "group_no", "page").agg(
        F.min_by(F.when(by_author, F.col("y0")), F.when(by_author, F.col("reading_pos"))).alias("ya"), F.min_by(F.when(by_title, F.col("y0")), F.when(by_title, F.col("reading_pos"))).alias("yt"))
    return found.select(*ISSUE, "group_no", "page", F.coalesce("ya", "yt").alias("split_y"))


def assigned(ordered: DataFrame, entries: DataFrame) -> DataFrame:
    """Ordered blocks with the group they belong to; what ends above a group's cut is the group's before it.

    Pages before the first group belong to none and are left out.
    """
    cuts = boundary_cuts(ordered, entries).select(*ISSUE, "page", "split_y")
    b = ordered.join(page_groups(entries), [*ISSUE, "page"]).join(cuts, [*ISSUE, "page"], "left")
    above = (F.col("page") == F.col("start")) & (F.col("group_no") > 0) & (F.col("y1") <= F.col("split_y"))
    return b.withColumn("group_no", F.when(above, F.col("group_no") - 1).otherwise(F.col("group_no"))).drop("start", "split_y")


_GROUP = (*ISSUE, "group_no")
_HEADS = ("title", "heading")


def heading_places(entries: DataFrame, blocks: DataFrame) -> DataFrame:
    """(group, in_group, place): the group_pos of the heading that each entry of a shared page begins at; null if none.

    As many headings as entries: one each, in order. Else each entry takes the first heading like its
    title from the last one taken on. A heading that was taken already goes on to an entry only if it
    has a longer stretch in common with its title than with that of the entry that took it.
    """
    heads = blocks.where(F.col("type").isin(*_HEADS)).select(*_GROUP, "group_pos", "text")
    like = entries.join(heads, list(_GROUP)).where(same_title(F.col("title"), F.col("text")))
    like = like.select(*_GROUP, "in_group", F.struct("group_pos", common_length(match_key(F.col("title")), match_key(F.col("text"))).alias("score")).alias("c")).groupBy(*_GROUP, "in_group").agg(F.sort_array(F.collect_list("c")).alias("like"))
    one = entries.join(like, [*_GROUP, "in_group"], "left").groupBy(*_GROUP).agg(F.sort_array(F.collect_list(F.struct("in_group", "like"))).alias("e"))
    one = one.join(heads.groupBy(*_GROUP).agg(F.sort_array(F.collect_list("group_pos")).alias("heads")), list(_GROUP), "left")
    start = F.struct(F.array().cast("array<int>").alias("places"), F.lit(0).alias("at"), F.lit(-1).alias("score"))

    def take(acc: Column, e: Column) -> Column:
        first = F.get(F.filter(e["like"], lambda c: c["group_pos"] >= acc["at"]), F.lit(0))
        taken = F.coalesce((first["group_pos"] > acc["at"]) | (first["score"] > acc["score"]), F.lit(False))
        return F.struct(
            F.array_append(acc["places"], F.when(taken, first["group_pos"].cast("int"))).alias("places"),
            F.when(taken, first["group_pos"].cast("int")).otherwise(acc["at"]).alias("at"), F.when(taken, first["score"]).otherwise(acc["score"]).alias("score"))

    by_title = F.aggregate("e", start, take, lambda acc: acc["places"])
    places = F.when(F.size("heads") == F.size("e"), F.transform("heads", lambda h: h.cast("int"))).otherwise(by_title)
    return one.select(*_GROUP, F.explode(F.arrays_zip(F.col("e.in_group").alias("in_group"), places.alias("place"))).alias("z")).select(*_GROUP, "z.in_group", "z.place")


def shared_pages(entries: DataFrame, blocks: DataFrame) -> DataFrame:
    """The entries of groups of several (group, in_group, title, author, unverified) with lo, hi, flags and titles.

    Each entry that has a heading gets the blocks from there to the next entry's heading, the first of
    them what lies before it too; titles of the entries in between are kept as absorbed. An entry without
    a heading gets no blocks. If none of a group has one, the group is one article with all titles.
    """
    size = blocks.groupBy(*_GROUP).agg(F.count(F.lit(1)).cast("int").alias("n_blocks"))
    e = entries.join(heading_places(entries, blocks), [*_GROUP, "in_group"]).join(size, list(_GROUP), "left").withColumn("n_blocks", F.coalesce("n_blocks", F.lit(0)))
    group = Window.partitionBy(*_GROUP)
    order = group.orderBy("in_group")
    e = e.withColumns({
        "n_own": F.count("place").over(group), "run": F.count("place").over(order.rowsBetween(Window.unboundedPreceding, 0)),
        "next": F.first("place", True).over(order.rowsBetween(1, Window.unboundedFollowing))})
    nothing, none = F.array().cast("array<string>"), F.lit(None).cast("array<string>")
    unsure = F.when(F.col("unverified"), F.array(F.lit("boundary_page_unverified"))).otherwise(nothing)
    titles = F.transform(F.sort_array(F.collect_list(F.struct("in_group", "title"))), lambda x: x["title"])
    lost = e.where("place IS NULL AND run > 0").groupBy(*_GROUP, "run").agg(titles.alias("absorbed_titles"))
    own = e.where("place IS NOT NULL").join(lost, [*_GROUP, "run"], "left")
    first = F.col("run") == 1
    kept = own.select(
        *_GROUP, "in_group", "title", "author", F.when(first, 0).otherwise(F.col("place")).alias("lo"), F.coalesce("next", "n_blocks").alias("hi"),
        F.concat(F.when(first, unsure).otherwise(nothing), F.when(F.col("absorbed_titles").isNotNull(), F.array(F.lit("absorbed_unmatched_siblings"))).otherwise(nothing)).alias("quality_flags"),
        none.alias("original_titles"), "absorbed_titles")
    empty = e.where("place IS NULL AND n_own > 0").select(
        *_GROUP, "in_group", "title", "author", F.lit(0).alias("lo"), F.lit(0).alias("hi"), F.array(F.lit("heading_not_found_empty")).alias("quality_flags"), none.alias("original_titles"), none.alias("absorbed_titles"))
    author = F.min_by(F.nullif("author", F.lit("")), F.when(F.nullif("author", F.lit("")).isNotNull(), F.col("in_group")))
    merged = e.where("n_own = 0").groupBy(*_GROUP).agg(titles.alias("t"), author.alias("author"), F.max("n_blocks").alias("hi"), F.bool_or("unverified").alias("unverified"))
    merged = merged.select(
        *_GROUP, F.lit(0).alias("in_group"), F.array_join("t", "; ").alias("title"), "author", F.lit(0).alias("lo"), "hi",
        F.concat(F.array(F.lit("merged_fallback")), unsure).alias("quality_flags"), F.col("t").alias("original_titles"), none.alias("absorbed_titles"))
    return kept.unionByName(empty).unionByName(merged)


def article_entries(entries: DataFrame, blocks: DataFrame, cuts: DataFrame) -> DataFrame:
    """All entries with lo..hi in their group's blocks (hi null: to the end), flags, original and absorbed titles."""
    unverified = cuts.where("split_y IS NULL").select(*_GROUP, F.lit(True).alias("unverified"))
    e = entries.withColumn("n", F.count(F.lit(1)).over(Window.partitionBy(*_GROUP))).join(unverified, list(_GROUP), "left")
    e = e.select(*ISSUE, F.col("group_no").cast("int"), F.col("in_group").cast("int"), "title", "author", F.coalesce("unverified", F.lit(False)).alias("unverified"), "n")
    flag = F.when(F.col("unverified"), F.array(F.lit("boundary_page_unverified"))).otherwise(F.array().cast("array<string>"))
    none = F.lit(None).cast("array<string>")
    single = e.where("n = 1").select(*_GROUP, "in_group", "title", "author", F.lit(0).alias("lo"), F.lit(None).cast("int").alias("hi"), flag.alias("quality_flags"), none.alias("original_titles"), none.alias("absorbed_titles"))
    return single.unionByName(shared_pages(e.where("n > 1").drop("n"), blocks))


def merged_paragraphs(parts: DataFrame, keys: tuple[str, ...], order: str = "pos") -> DataFrame:
    """(keys, paragraphs ARRAY<STRUCT<page, text>>) of parts (keys, order, page, text): cut words made whole.

    A part that goes on with the word cut at the end of the part before belongs to its paragraph, which
    keeps the first part's page.
    """
    p = parts.where(~is_blank(F.col("text"))).withColumn("text", strip(F.col("text")))
    w = Window.partitionBy(*keys).orderBy(order)
    p = p.withColumn("new", F.when(F.coalesce(breaks_word(F.lag("text").over(w), F.col("text")), F.lit(False)), 0).otherwise(1)).withColumn("para", F.sum("new").over(w))
    joined_text = F.aggregate(F.transform(F.sort_array(F.collect_list(F.struct(order, "text"))), lambda x: x["text"]), F.lit(""), lambda a, t: F.concat(without_break(a), t))
    one = p.groupBy(*keys, "para").agg(F.min_by("page", order).alias("page"), joined_text.alias("text"))
    return one.groupBy(*keys).agg(F.transform(F.sort_array(F.collect_list(F.struct("para", "page", "text"))), lambda x: F.struct(x["page"].alias("page"), x["text"].alias("text"))).alias("paragraphs"))


def assemble(blocks: DataFrame, toc: DataFrame, label_to_page: DataFrame, publication: Publication) -> DataFrame:
    """Articles of blocks (one row per block), contents entries and page labels.

    article_id, issue, title, author, printed_page_start, pages, flags, full_text and captions_text with
    their paragraphs. An issue without blocks, or without an entry that leads to a page, has none.
    """
    last = last_pages(blocks)
    # each of these has several readers; written once, they also keep the plans behind them short
    entries = written(ranges(resolved(toc, label_to_page), last), "entries")
    ordered = written(content_blocks(blocks, publication), "ordered")
    mine = assigned(ordered, entries)
    w = Window.partitionBy(*ISSUE, "group_no").orderBy("page", "reading_pos")
    # a boundary page's blocks of the group before come after that group's own
    mine = written(mine.withColumn("group_pos", F.row_number().over(w) - 1), "assigned")
    shared = article_entries(entries, mine, boundary_cuts(ordered, entries))
    at = F.row_number().over(Window.partitionBy(*ISSUE).orderBy("group_no", "in_group")) - 1
    pages = entries.groupBy(*ISSUE, "group_no").agg(F.min_by("printed_page", "in_group").alias("printed_page_start"), F.min("pdf_page_start").alias("pdf_page_start"), F.max("pdf_page_end").alias("pdf_page_end"))
    arts = shared.withColumn("art_no", at).join(pages, [*ISSUE, "group_no"]).join(last.withColumnRenamed("last_page", "total_pdf_pages"), list(ISSUE))
    arts = written(arts.withColumn("article_id", joined(F.col("journal"), F.col("year"), F.col("issue"), F.col("art_no"))), "articles")
    held = mine.join(arts.select(*ISSUE, "group_no", "article_id", "lo", "hi"), [*ISSUE, "group_no"]).where((F.col("group_pos") >= F.col("lo")) & (F.col("hi").isNull() | (F.col("group_pos") < F.col("hi"))))
    held = layout.reading_order(held.drop("column_no"), ("article_id", "page"), "group_pos", "article_pos").withColumn("pos", F.struct("page", "article_pos"))
    body = merged_paragraphs(held.where(F.col("type").isin(*BODY_TYPES)), ("article_id",)).withColumnRenamed("paragraphs", "full_text_paragraphs")
    captions = merged_paragraphs(held.where("type = 'caption'"), ("article_id",)).withColumnRenamed("paragraphs", "captions_paragraphs")
    empty = F.array().cast("array<struct<page:int,text:string>>")
    out = arts.join(body, "article_id", "left").join(captions, "article_id", "left")
    full, caps = (F.coalesce(F.col(c), empty) for c in ("full_text_paragraphs", "captions_paragraphs"))
    out = out.withColumns({"full_text_paragraphs": full, "captions_paragraphs": caps})
    return out.select(
        "article_id", *ISSUE, "title", "author", "printed_page_start", "pdf_page_start", "pdf_page_end", "total_pdf_pages", "quality_flags", "original_titles", "absorbed_titles",
        F.array_join("full_text_paragraphs.text", "\n\n").alias("full_text"), "full_text_paragraphs", F.array_join("captions_paragraphs.text", "\n\n").alias("captions_text"), "captions_paragraphs")
