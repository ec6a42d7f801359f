"""Helpers of several operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: What tells one issue from another, and one block.
ISSUE = ("journal", "year", "issue")
BLOCK = (*ISSUE, "page", "block_id")


def latest(df: DataFrame, keys: Sequence[str], version: str, columns: Sequence[str] | None = None) -> DataFrame:
    """One row per key, of the greatest version: keys, version and the wanted columns, of which alone the scan reads.

    Rows of equal version are ordered by the wanted columns in the table's order, so the choice is the same
    each time. Without columns all are wanted.
    """
    rest = [c for c in df.columns if c not in keys and c != version and (columns is None or c in columns)]
    s = F.struct(F.col(version), *[F.col(c) for c in rest])
    return df.groupBy(*keys).agg(F.max(s).alias("_s")).select(*keys, "_s.*")


def with_box(blocks: DataFrame) -> DataFrame:
    """bbox as x0, y0, x1, y1; null where it is missing."""
    return blocks.withColumns({n: F.get("bbox", i) for i, n in enumerate(("x0", "y0", "x1", "y1"))})


def first_by(value: str, order: Column | Sequence[str]) -> Column:
    o = order if isinstance(order, Column) else F.struct(*order)
    return F.min_by(value, o)
