"""Text functions as Column expressions. White space and letters are Unicode's, as (?U) asks for."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Prefixes of contents titles that the printed heading leaves out.
TITLE_PREFIXES = ("recenze:", "k výuce:", "upoutávka na knihu:", "zaujalo nás:", "biozvěst:")

#: Fixed value: capitals that may begin a sentence after ., ! or ?.
SENTENCE_CAPITALS = "A-ZÁČĎÉĚÍŇÓŘŠŤÚŮÝŽ"

_BREAK_TAIL = r"(?U)(\w)\s*-\s*$"


def strip(text: Column) -> Column:
    """Without white space at both ends."""
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def is_blank(text: Column) -> Column:
    """Null, empty or white space only."""
    return text.isNull() | ~text.rlike(r"(?U)\S")


def breaks_word(before: Column, after: Column) -> Column:
    """Whether a word cut by a line-end hyphen goes on: a hyphen after a letter, then a small letter."""
    return before.rlike(_BREAK_TAIL) & after.rlike(r"(?U)^\s*\p{Ll}")


def without_break(before: Column) -> Column:
    """The text without its line-end hyphen."""
    return F.regexp_replace(before, _BREAK_TAIL, "$1")


def glue(parts: Column, separator: str = " ") -> Column:
    """One text of an array of parts, cut words made whole; blank and null parts are skipped."""
    start = F.lit("")

    def add(done: Column, part: Column) -> Column:
        p = strip(part)
        return (
            F.when(is_blank(part), done).when(done == "", p).when(breaks_word(done, p), F.concat(without_break(done), p)).otherwise(F.concat(done, F.lit(separator), p))
        )

    return F.aggregate(parts, start, add)


def without_controls(text: Column) -> Column:
    """Control characters become spaces."""
    return F.regexp_replace(text, r"[\x00-\x1f\x7f]", " ")


def clean(text: Column) -> Column:
    """Control characters and runs of white space become one space, none at the ends."""
    return strip(F.regexp_replace(without_controls(text), r"(?U)\s+", " "))


def cut_imprint(text: Column, markers: Sequence[str]) -> Column:
    """What stands before the first marker in turn, without blanks, commas and semicolons at the ends."""
    for m in markers:
        text = F.substring_index(text, m, 1)
    return F.call_function("trim", text) if not markers else F.regexp_replace(text, r"^[ ,;]+|[ ,;]+$", "")


def match_key(text: Column) -> Column:
    """A title for comparison: small letters, none of the contents' prefixes."""
    low = F.lower(strip(text))
    return strip(F.regexp_replace(low, "^(?:" + "|".join(TITLE_PREFIXES) + ")", ""))


def shingles(text: Column, size: int | Column) -> Column:
    """All substrings of `size` characters; an empty array for shorter texts."""
    n, size = F.length(text), F.lit(size) if isinstance(size, int) else size
    return F.when(n >= size, F.transform(F.sequence(F.lit(1), F.greatest(n - size + 1, F.lit(1))), lambda i: F.substring(text, i, size))).otherwise(F.array().cast("array<string>"))


def same_title(a: Column, b: Column, least_common: int = 15) -> Column:
    """Equal, one within the other, or with a common stretch of least_common characters; never if one is empty.

    A common stretch of that length is a common shingle, so no character table is needed.
    """
    x, y = match_key(a), match_key(b)
    common = F.arrays_overlap(shingles(x, least_common), shingles(y, least_common))
    return F.coalesce((x != "") & (y != "") & ((x == y) | y.contains(x) | x.contains(y) | common), F.lit(False))


def common_length(a: Column, b: Column) -> Column:
    """Length of the longest common stretch of two strings; 0 if one is empty or null.

    A stretch of some length in common means one of each shorter length, so the length is found by
    halving: 20 steps are enough for a million characters.
    """
    start = F.struct(F.lit(0).alias("lo"), F.coalesce(F.least(F.length(a), F.length(b)), F.lit(0)).alias("hi"))

    def halve(acc: Column, _: Column) -> Column:
        mid = F.floor((acc["lo"] + acc["hi"] + 1) / 2).cast("int")
        held = F.coalesce(F.arrays_overlap(shingles(a, mid), shingles(b, mid)), F.lit(False))
        nearer = F.when(held, F.struct(mid.alias("lo"), acc["hi"].alias("hi"))).otherwise(F.struct(acc["lo"].alias("lo"), (mid - 1).alias("hi")))
        return F.when(acc["lo"] >= acc["hi"], acc).otherwise(nearer)

    return F.aggregate(F.sequence(F.lit(1), F.lit(20)), start, halve, lambda acc: acc["lo"])


def sentences(text: Column) -> Column:
    """Cut at white space after ., ! or ? and before a capital of SENTENCE_CAPITALS."""
    return F.split(text, r"(?<=[.!?])(?U)\s+(?-U)(?=[" + SENTENCE_CAPITALS + "])", -1)


def words(text: Column) -> Column:
    """Between white space; an empty array for a blank text."""
    return F.filter(F.split(text, r"(?U)\s+", -1), lambda w: w != "")


def preview(text: Column, chars: int) -> Column:
    """The first characters, with '...' if there are more."""
    return F.when(F.length(text) > chars, F.concat(F.left(text, F.lit(chars)), F.lit("..."))).otherwise(text)


def estimated_tokens(text: Column, chars_per_token: float = 2.3) -> Column:
    """Characters by characters per token, half to even; 0 for null."""
    return F.coalesce(F.bround(F.length(text) / F.lit(chars_per_token)).cast("bigint"), F.lit(0).cast("bigint"))
