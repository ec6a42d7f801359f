"""Spans to blocks, contents, page map, articles and chunks: the whole build of an archive as DataFrames."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkwell.operators import articles, chunking, layout, page_map, toc, typography
from inkwell.operators.common import ISSUE
from inkwell.plans.publication import Publication
from inkwell.session import written


@dataclass
class Archive:
    blocks: DataFrame
    toc: DataFrame
    labels: DataFrame
    articles: DataFrame
    chunks: DataFrame
    unresolved: DataFrame


def blocks_of_spans(spans: DataFrame, publication: Publication) -> DataFrame:
    """Typed blocks (BLOCKS) of spans (SPANS)."""
    b = layout.merged_frames(layout.frames_of_spans(spans)).withColumn("bbox", F.array("x0", "y0", "x1", "y1"))
    return typography.classify(b, publication).select(*ISSUE, "page", "block_id", F.col("new_type").alias("type"), "text", "font", "font_size", "bbox")


def contents_of_spans(spans: DataFrame, publication: Publication) -> DataFrame:
    """Contents entries: of the pages that the publication names (counted from 0), else of those found."""
    s = spans.where("kind = 'text'").select(*ISSUE, "page", "pos", "text", "font", "size", "color")
    if publication.contents.pages:
        s = s.where(F.col("page").isin(*[p + 1 for p in publication.contents.pages]))
    else:
        s = s.join(toc.toc_pages(s, publication).select(*ISSUE, "page"), [*ISSUE, "page"], "left_semi")
    return toc.entries(s, publication)


def build(spans: DataFrame, publication: Publication, skip_first: int | None = None, skip_last: int | None = None) -> Archive:
    """All stages. Every stage has several readers and is written once."""
    blocks = written(blocks_of_spans(spans, publication), "blocks")
    contents = written(contents_of_spans(spans, publication), "contents")
    labels = written(page_map.page_map(blocks, publication), "labels")
    arts = written(articles.assemble(blocks, contents, labels, publication), "articles")
    return Archive(blocks, contents, labels, arts, chunking.chunk_articles(arts, publication, None, skip_first, skip_last), articles.unresolved(contents, labels))
