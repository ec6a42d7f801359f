"""Printed page labels: arabic and roman numbers, ranges, labels in running lines."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from inkwell.functions.text import clean, strip, words

#: Roman symbols by value, largest first.
ROMAN = (("M", 1000), ("CM", 900), ("D", 500), ("CD", 400), ("C", 100), ("XC", 90), ("L", 50), ("XL", 40), ("X", 10), ("IX", 9), ("V", 5), ("IV", 4), ("I", 1))

#: Labels have 1 to 4 digits or 1 to 10 roman letters; a range has a hyphen or a dash.
_LETTERS = "(?i:[ivxlcdm])"
_ARABIC = r"^[0-9]{1,4}$"
_ROMAN = f"^{_LETTERS}{{1,10}}$"
_ANY_ROMAN = f"^{_LETTERS}+$"
_RANGE = rf"^({_LETTERS}+|[0-9]+)\s*[-–]\s*({_LETTERS}+|[0-9]+)$"


def roman_value(text: Column) -> Column:
    """Value of a roman number by taking the largest symbols first; what can't be taken counts nothing."""
    table = F.array(*[F.struct(F.lit(f"^(?:{s})*").alias("re"), F.lit(len(s)).alias("len"), F.lit(v).alias("v")) for s, v in ROMAN])
    start = F.struct(F.upper(strip(F.coalesce(text, F.lit("")))).alias("rest"), F.lit(0).alias("total"))

    def take(acc: Column, x: Column) -> Column:
        n = F.length(F.call_function("regexp_extract", acc["rest"], x["re"], F.lit(0)))
        return F.struct(F.substring(acc["rest"], n + 1, F.length(acc["rest"])).alias("rest"), (acc["total"] + F.call_function("div", n, x["len"]).cast("int") * x["v"]).alias("total"))

    return F.aggregate(table, start, take, lambda acc: acc["total"])


def to_roman(n: Column) -> Column:
    """The usual roman number; empty for 0, null for null and negative numbers."""
    def digit(place: int, one: str, five: str, ten: str) -> Column:
        forms = ["", one, one * 2, one * 3, one + five, five, five + one, five + one * 2, five + one * 3, one + ten]
        return F.get(F.array(*[F.lit(x) for x in forms]), F.floor(n / place).cast("int") % 10)

    return F.when(n >= 0, F.concat(F.repeat(F.lit("M"), F.floor(n / 1000).cast("int")), digit(100, "C", "D", "M"), digit(10, "X", "L", "C"), digit(1, "I", "V", "X")))


def label_value(label: Column) -> Column:
    """STRUCT(scheme, value) of a label of 1-4 digits or 1-10 roman letters; null for others."""
    return F.when(label.rlike(_ARABIC), F.struct(F.lit("arabic").alias("scheme"), label.try_cast("int").alias("value"))).when(
        label.rlike(_ROMAN), F.struct(F.lit("roman").alias("scheme"), roman_value(label).alias("value")))


def to_label(scheme: Column, value: Column) -> Column:
    return F.when(scheme == "arabic", value.cast("string")).otherwise(to_roman(value))


def canonical_label(label: Column) -> Column:
    """'032' is '32', 'cxxxiii' is 'CXXXIII'; others stay, without white space at the ends."""
    t = strip(label)
    v = label_value(t)
    return F.when(v.isNull(), t).otherwise(to_label(v["scheme"], v["value"]))


def page_value(text: Column) -> Column:
    """The page that a contents number stands for, the first one of a range; null if it is none.

    Roman numbers come in capitals, digits as printed.
    """
    t = clean(text)
    first = F.regexp_extract(t, _RANGE, 1)
    return (
        F.when(t.rlike(r"(?U)^\d+$"), t).when(t.rlike(_ANY_ROMAN), F.upper(t)).when(first.rlike(_ANY_ROMAN), F.upper(first)).when(first != "", first)
    )


def label_in(text: Column, skip: Sequence[str] = (), keywords: Sequence[str] | None = None) -> Column:
    """The first word of a running line that is a label; null if none, or if no keyword stands in it."""
    skipped = F.array(*[F.lit(s) for s in skip]).cast("array<string>")
    found = F.get(F.filter(words(text), lambda w: ~F.array_contains(skipped, w) & ~w.contains("/") & (w.rlike(_ARABIC) | w.rlike(_ROMAN))), 0)
    label = F.when(found.rlike(_ROMAN), F.upper(found)).otherwise(found)
    if not keywords:
        return label
    low = F.lower(text)
    held = F.lit(False)
    for k in keywords:
        held = held | low.contains(k.lower())
    return F.when(held, label)
