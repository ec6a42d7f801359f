"""Texts by template: chunk headers, citations, labels of issues and articles."""

from __future__ import annotations

import string
from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F


def fill(template: str, values: Mapping[str, Column]) -> Column:
    """A template with {names}; null values come out empty."""
    parts: list[Column] = []
    for text, name, _, _ in string.Formatter().parse(template):
        if text:
            parts.append(F.lit(text))
        if name:
            parts.append(F.coalesce(values[name].cast("string"), F.lit("")))
    return F.concat(*parts) if parts else F.lit("")


def or_label(value: Column, label: str | Column) -> Column:
    """The label for a null or empty value."""
    return F.coalesce(F.nullif(value, F.lit("")), label if isinstance(label, Column) else F.lit(label))


def joined(*parts: Column) -> Column:
    """Parts that are not null and not empty, with '-' between."""
    return F.concat_ws("-", *[F.nullif(p.cast("string"), F.lit("")) for p in parts])


def issue_order(issue: Column) -> list[Column]:
    """Numbers first, by value, then names."""
    return [issue.try_cast("int").asc_nulls_last(), issue.asc()]


def duration(seconds: Column) -> Column:
    """'1h02m' or '3m20s'; '?' for null, NaN and infinity."""
    s = F.when(F.abs(seconds) < 1e15, seconds).cast("bigint")
    h, m = F.floor(s / 3600), F.floor(s / 60)
    return F.when(s.isNull(), "?").when(h > 0, F.format_string("%dh%02dm", h, m % 60)).otherwise(F.format_string("%dm%02ds", m, s % 60))
