"""Raw lines and frames of a page to logical blocks in reading order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from inkwell.functions.text import glue, is_blank
from inkwell.operators.common import ISSUE

#: Fixed values, in points.
SIZE_TOLERANCE = 3.0
COLUMN_X_TOLERANCE = 4.0
MERGE_Y_GAP = 6.0
COLUMN_GAP = 40


def style_groups(lines: Column, tolerance: float = SIZE_TOLERANCE) -> Column:
    """ARRAY<INT>: the group of each line of ARRAY<STRUCT<text, size>>; null for blank lines before any text.

    A group goes on as long as sizes stay near that of its first line; blank lines stay with it.
    """
    start = F.struct(F.array().cast("array<int>").alias("groups"), F.lit(None).cast("double").alias("size"), F.lit(-1).alias("g"))

    def add(acc: Column, x: Column) -> Column:
        blank = is_blank(x["text"])
        same = blank | (F.abs(x["size"] - acc["size"]) <= tolerance)
        new = ~blank & ~F.coalesce(same, F.lit(False))
        g = acc["g"] + new.cast("int")
        return F.struct(F.array_append(acc["groups"], F.when(g >= 0, g)).alias("groups"), F.when(new, x["size"]).otherwise(acc["size"]).alias("size"), g.alias("g"))

    return F.aggregate(lines, start, add, lambda acc: acc["groups"])


def frames_of_spans(spans: DataFrame, keys: tuple[str, ...] = (*ISSUE, "page")) -> DataFrame:
    """Frames for merged_frames of spans (SPANS): the lines of a raw block, cut where the type size jumps.

    A line's text is its spans' texts without a separator, its size that of its first span; x0 to y1 of a
    span are those of its line. A picture is a frame without text.
    """
    fonts = F.collect_list(F.struct("pos", "font", F.coalesce(F.length("text"), F.lit(0)).alias("n")))
    lines = spans.groupBy(*keys, "raw_block", "kind", "line").agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("pos", F.coalesce("text", F.lit("")).alias("text")))), lambda s: s["text"]), "").alias("text"), F.min_by("size", "pos").alias("size"),
        F.sort_array(fonts).alias("fonts"), F.min("pos").alias("pos"), F.min("x0").alias("x0"), F.min("y0").alias("y0"), F.max("x1").alias("x1"), F.max("y1").alias("y1"))
    one = F.sort_array(F.collect_list(F.struct("pos", "text", "size", "fonts", "x0", "y0", "x1", "y1")))
    blocks = lines.groupBy(*keys, "raw_block", "kind").agg(F.min("pos").alias("first"), one.alias("lines"))
    groups = style_groups(F.transform("lines", lambda x: F.struct(x["text"].alias("text"), x["size"].alias("size"))))
    each = blocks.withColumn("g", groups).select(*keys, "raw_block", "kind", "first", F.posexplode(F.arrays_zip("lines", "g")).alias("i", "z"))
    each = each.where("kind = 'image' OR z.g IS NOT NULL").select(*keys, "raw_block", "kind", "first", F.coalesce("z.g", F.lit(0)).alias("g"), "i", "z.lines.*")
    parts = F.transform(F.sort_array(F.collect_list(F.struct("i", "text"))), lambda x: x["text"])
    names = F.flatten(F.transform(F.sort_array(F.collect_list(F.struct("i", "fonts"))), lambda x: x["fonts"]))
    f = each.groupBy(*keys, "raw_block", "kind", "first", "g").agg(glue(parts).alias("text"), names.alias("fonts"), F.min_by("size", "i").alias("size"), F.min("x0").alias("x0"), F.min("y0").alias("y0"), F.max("x1").alias("x1"), F.max("y1").alias("y1"))
    distinct = F.array_distinct(F.transform("fonts", lambda y: y["font"]))
    sums = F.transform(distinct, lambda name, i: F.struct(F.aggregate(F.filter("fonts", lambda y: y["font"].eqNullSafe(name)), F.lit(0), lambda s, y: s + y["n"]).alias("n"), (-i).alias("i"), name.alias("font")))
    return f.select(*keys, F.struct("first", "g").alias("pos"), F.when(F.col("kind") == "text", F.col("text")).alias("text"), F.array_max(sums)["font"].alias("font"), "size", "x0", "y0", "x1", "y1")


_ENTRY = "struct<kind:string,text:string,size:double,fonts:array<struct<font:string,n:int>>,x0:double,y0:double,x1:double,y1:double>"


def merged_frames(frames: DataFrame, keys: tuple[str, ...] = (*ISSUE, "page")) -> DataFrame:
    """(keys, block_id, text, font, font_size, x0, y0, x1, y1) of frames (keys, pos, text, font, size, x0, y0, x1, y1).

    A frame joins the text before it if it is in the same column (left edges within 4 pt, right edges
    within 12), begins at most 6 pt below its end, and is of a size within 3 pt. A frame without text
    (a picture, an empty frame) keeps a number and ends the block before it. One fold per page; a page
    is the unit of work and its frames are few.
    """
    x = F.struct("pos", "text", F.col("size").cast("double").alias("size"), "font", "x0", "y0", "x1", "y1")
    page = frames.groupBy(*keys).agg(F.sort_array(F.collect_list(x)).alias("frames"))
    none = F.lit(None).cast(_ENTRY)
    start = F.struct(F.array().cast(f"array<{_ENTRY}>").alias("done"), none.alias("open"))

    def closed(acc: Column) -> Column:
        return F.when(acc["open"].isNull(), acc["done"]).otherwise(F.array_append(acc["done"], acc["open"]))

    def entry(f: Column, kind: str) -> Column:
        own = F.array(F.struct(f["font"].alias("font"), F.length(f["text"]).alias("n")))
        return F.struct(F.lit(kind).alias("kind"), f["text"].alias("text"), f["size"].alias("size"), own.alias("fonts"), *[f[c].alias(c) for c in ("x0", "y0", "x1", "y1")]).cast(_ENTRY)

    def add(acc: Column, f: Column) -> Column:
        o = acc["open"]
        joins = (F.abs(o["x0"] - f["x0"]) <= COLUMN_X_TOLERANCE) & (F.abs(o["x1"] - f["x1"]) <= 3 * COLUMN_X_TOLERANCE) & (f["y0"] - o["y1"] <= MERGE_Y_GAP) & (F.abs(o["size"] - f["size"]) <= SIZE_TOLERANCE)
        both = F.struct(
            o["kind"].alias("kind"), glue(F.array(o["text"], f["text"])).alias("text"), o["size"].alias("size"),
            F.concat(o["fonts"], F.array(F.struct(f["font"].alias("font"), F.length(f["text"]).alias("n")))).alias("fonts"), o["x0"].alias("x0"), o["y0"].alias("y0"), F.greatest(o["x1"], f["x1"]).alias("x1"), f["y1"].alias("y1")).cast(_ENTRY)
        empty = F.struct(F.array_append(closed(acc), entry(f, "image")).alias("done"), none.alias("open"))
        return F.when(is_blank(f["text"]), empty).when(F.coalesce(joins, F.lit(False)), F.struct(acc["done"].alias("done"), both.alias("open"))).otherwise(F.struct(closed(acc).alias("done"), entry(f, "text").alias("open")))

    done = page.select(*keys, F.aggregate("frames", start, add, closed).alias("entries"))
    e = done.select(*keys, F.posexplode("entries").alias("block_id", "e")).where("e.kind = 'text'")
    names = F.array_distinct(F.transform("e.fonts", lambda y: y["font"]))
    sums = F.transform(names, lambda name, i: F.struct(F.aggregate(F.filter("e.fonts", lambda y: y["font"].eqNullSafe(name)), F.lit(0), lambda s, y: s + F.coalesce(y["n"], F.lit(0))).alias("n"), (-i).alias("i"), name.alias("font")))
    return e.select(*keys, "block_id", F.regexp_replace("e.text", r"(?U)^\s+|\s+$", "").alias("text"), F.array_max(sums)["font"].alias("font"), F.round("e.size", 2).alias("font_size"), *[F.round(f"e.{c}", 1).alias(c) for c in ("x0", "y0", "x1", "y1")])


def reading_order(blocks: DataFrame, keys: tuple[str, ...] = (*ISSUE, "page"), before: str = "block_id", order: str = "reading_pos") -> DataFrame:
    """blocks with column_no and the place in reading order: by column, then from the top.

    Left edges more than 40 pt from the next one to the left begin a column. Blocks without a box come
    last. Ties keep the order given by `before`.
    """
    x = blocks.withColumn("_x", F.bround("x0"))
    w = Window.partitionBy(*keys).orderBy("_x")
    jump = F.when(F.col("_x") - F.lag("_x").over(w) > COLUMN_GAP, 1).otherwise(0)
    x = x.withColumn("_jump", jump).withColumn("column_no", F.sum("_jump").over(w.rangeBetween(Window.unboundedPreceding, 0)))
    at = F.row_number().over(Window.partitionBy(*keys).orderBy(F.col("_x").isNull(), "column_no", "y0", before)) - 1
    return x.withColumn(order, at).drop("_x", "_jump")
