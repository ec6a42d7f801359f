"""Font names and the shapes of captions and figure labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from inkwell.functions.text import SENTENCE_CAPITALS, strip, words

#: Style words after the family name.
STYLE_WORDS = ("Bold", "Italic", "Oblique", "Light", "Medium", "Regular", "Roman", "Semibold", "SemiBold", "Black", "Thin", "ExtraBold", "Condensed")
#: Units of a scale bar and words of a colour-scale legend.
UNITS = ("mm", "cm", "km", "μm", "µm", "nm", "m")
LEGEND_WORDS = ("do", "nad", "pod", "až")

#: What a number in a figure, a bracketed unit and the numbers that open a caption look like.
_NUMBER = r"-?[0-9]+[.,]?[0-9]*"
_BRACKETED = r"^\[[^\[\]]{1,6}\]$"
_CAPTION_NUMBERS = r"^[0-9]+(?:\s*(?:a|až|,|-|–)\s*[0-9]+)*\s+"
_CAPTION_LEAST = 20


def family(font: Column) -> Column:
    """Without a subset prefix and without style words; empty for null."""
    bare = F.regexp_replace(F.coalesce(font, F.lit("")), r"^[A-Z]{6}\+", "")
    return F.regexp_replace(bare, r"(?i)[-,](?:[0-9]+pt)?(?:" + "|".join(STYLE_WORDS) + ")+.*$", "")


def half_points(size: Column) -> Column:
    """Rounded to half points, halves to even."""
    return F.bround(size * 2) / 2


def is_bold(font: Column) -> Column:
    return F.coalesce(F.lower(font).contains("bold"), F.lit(False))


def is_figure_label(text: Column) -> Column:
    """Whether a text is only a scale bar, a unit, numbers, a legend of numbers, or single characters."""
    t = strip(F.coalesce(text, F.lit("")))
    tokens = words(t)

    def every(pattern: str) -> Column:
        return F.forall(tokens, lambda w: w.rlike(pattern))

    legend = F.forall(tokens, lambda w: w.rlike(f"^{_NUMBER}(?:[–-]{_NUMBER})?$") | F.lower(w).isin(*LEGEND_WORDS))
    single = F.forall(tokens, lambda w: F.length(F.regexp_replace(w, r"\.+$", "")) == 1)
    bar = t.rlike(r"(?iu)^(?:[0-9.,]+\s*(?:" + "|".join(UNITS) + r")\s*)+$") | t.rlike(_BRACKETED)
    return (t != "") & (bar | every(f"^{_NUMBER}\\.?$") | legend | single)


def opens_caption(text: Column) -> Column:
    """Whether a text of more than 20 characters begins with figure numbers and a capital."""
    t = strip(text)
    return F.coalesce((F.length(t) > _CAPTION_LEAST) & t.rlike(_CAPTION_NUMBERS + f"[{SENTENCE_CAPITALS}]"), F.lit(False))
