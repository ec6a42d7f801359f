"""Printed page numbers: labels on pages, runs of constant offset, gaps filled, labels to pages."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from inkwell.functions import labels
from inkwell.operators.common import ISSUE, with_box
from inkwell.plans.publication import Line, Publication

MAX_EXTEND = 5


def page_labels(blocks: DataFrame, publication: Publication) -> DataFrame:
    """(issue, page, label): the first label on a running line of each page."""
    b = with_box(blocks)
    height = b.groupBy(*ISSUE).agg(F.max("y1").alias("height"))
    b = b.join(height, list(ISSUE))
    lines = b.where(publication.running.holds(Line.of_block())).select(
        *ISSUE, "page", "block_id", labels.label_in(F.col("text"), publication.running.no_labels, publication.running.words).alias("label"))
    return lines.where("label IS NOT NULL").groupBy(*ISSUE, "page").agg(F.min_by("label", F.struct("block_id", "label")).alias("label"))


def runs(found: DataFrame) -> DataFrame:
    """(issue, run, scheme, offset, value_min, value_max): labels in page order with one scheme and page - value."""
    v = found.withColumn("v", labels.label_value(F.col("label"))).where("v IS NOT NULL").select(*ISSUE, "page", "v.scheme", "v.value", (F.col("page") - F.col("v.value")).alias("offset"))
    w = Window.partitionBy(*ISSUE).orderBy("page")
    same = (F.lag("scheme").over(w) == F.col("scheme")) & (F.lag("offset").over(w) == F.col("offset"))
    v = v.withColumn("new", F.when(same, 0).otherwise(1)).withColumn("run", F.sum("new").over(w))
    return v.groupBy(*ISSUE, "run").agg(F.first("scheme").alias("scheme"), F.first("offset").alias("offset"), F.min("value").alias("value_min"), F.max("value").alias("value_max"))


def extended(found_runs: DataFrame, last_pages: DataFrame, most: int = MAX_EXTEND) -> DataFrame:
    """Runs grown by up to `most` values on either side, never over another run, page 1 or the last page.

    In page order each run takes first what lies before it, after the one before has taken what lies
    behind; a gap of g pages therefore gives min(most, g) to the earlier run and of the rest up to
    `most` to the later one.
    """
    w = Window.partitionBy(*ISSUE).orderBy("first", "run")
    r = found_runs.withColumns({"first": F.col("value_min") + F.col("offset"), "last": F.col("value_max") + F.col("offset")})
    r = r.join(last_pages, list(ISSUE))
    before = F.col("first") - F.coalesce(F.lag("last").over(w), F.lit(0)) - 1
    taken = F.when(F.lag("last").over(w).isNull(), 0).otherwise(F.least(F.lit(most), before))
    after = F.coalesce(F.lead("first").over(w) - 1, F.col("last_page")) - F.col("last")
    back = F.greatest(F.lit(0), F.least(F.lit(most), before - taken, F.col("value_min") - 1))
    forward = F.greatest(F.lit(0), F.least(F.lit(most), after, F.col("last_page") - F.col("last")))
    return r.select(*ISSUE, "run", "scheme", "offset", (F.col("value_min") - back).alias("value_min"), (F.col("value_max") + forward).alias("value_max"))


def last_pages(blocks: DataFrame) -> DataFrame:
    return blocks.groupBy(*ISSUE).agg(F.max("page").alias("last_page"))


def label_pages(grown: DataFrame) -> DataFrame:
    """(issue, label, page): each value of each run; of a label on two pages the later run's holds."""
    each = grown.select(*ISSUE, "run", "scheme", "offset", F.explode(F.sequence("value_min", "value_max")).alias("value"))
    lab = each.select(*ISSUE, labels.to_label(F.col("scheme"), F.col("value")).alias("label"), (F.col("value") + F.col("offset")).alias("page"), "run")
    return lab.groupBy(*ISSUE, "label").agg(F.max_by("page", F.struct("run", "page")).alias("page"))


def page_map(blocks: DataFrame, publication: Publication) -> DataFrame:
    """(issue, label, page) of every label of an issue, gaps filled. Issues without labels have no rows."""
    return label_pages(extended(runs(page_labels(blocks, publication)), last_pages(blocks)))


def unlabelled_pages(blocks: DataFrame, publication: Publication) -> DataFrame:
    """(issue, page) of pages that no label leads to."""
    pages = blocks.select(*ISSUE, "page").distinct()
    return pages.join(page_map(blocks, publication), [*ISSUE, "page"], "left_anti")


def lone_runs(blocks: DataFrame, publication: Publication) -> DataFrame:
    """(issue, n_runs, n_lone, suspicious): runs, those of one page, and whether these are over 2 and over a fifth."""
    r = runs(page_labels(blocks, publication)).groupBy(*ISSUE).agg(F.count(F.lit(1)).alias("n_runs"), F.count_if(F.col("value_min") == F.col("value_max")).alias("n_lone"))
    return r.withColumn("suspicious", F.col("n_lone") > F.greatest(F.lit(2.0), F.col("n_runs") * 0.2))


def nearby_labels(toc: DataFrame, label_to_page: DataFrame, reach: int = 3) -> DataFrame:
    """(issue, toc_pos, printed_page, delta, page): which labels up to `reach` away from an entry's lead somewhere.

    For entries whose label is a number; delta 0 is the entry's own label. Entries without any have no row.
    """
    v = labels.label_value(labels.canonical_label(F.col("printed_page")))
    t = toc.select(*ISSUE, "toc_pos", "printed_page", v.alias("v")).where("v IS NOT NULL").withColumn("delta", F.explode(F.sequence(F.lit(-reach), F.lit(reach))))
    t = t.withColumn("label", labels.to_label(F.col("v.scheme"), F.col("v.value") + F.col("delta"))).where(F.col("v.value") + F.col("delta") > 0)
    return t.join(label_to_page, [*ISSUE, "label"]).select(*ISSUE, "toc_pos", "printed_page", "delta", "page")
