"""What differs between publications, as data: one small record for each stage that asks, compiled to Columns."""

from __future__ import annotations

from dataclasses import dataclass, field, replace
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from inkwell.functions import fonts
from inkwell.functions.text import words


def _sure(test: Column) -> Column:
    """A test that comes out false where it can't be told."""
    return F.coalesce(test, F.lit(False))


def _any(tests) -> Column:
    return _sure(reduce(or_, tests, F.lit(False)))


@dataclass(frozen=True)
class Line:
    """What rules may ask of a block: its text, its type, and its box on a page of some height."""

    text: Column
    font: Column
    size: Column
    x0: Column | None = None
    y0: Column | None = None
    x1: Column | None = None
    y1: Column | None = None
    height: Column | None = None

    @classmethod
    def of_block(cls, height: Column | None = None) -> Line:
        """Of the columns that blocks with boxes have."""
        return cls(*map(F.col, ("text", "font", "font_size", "x0", "y0", "x1", "y1")), F.col("height") if height is None else height)


# --- printed contents -----------------------------------------------------------------


@dataclass(frozen=True)
class Contents:
    """How a printed contents is set: where, which numbers begin an entry, and what in it is no title."""

    pages: tuple[int, ...] = ()  # counted from 0; none: they are searched for
    number_fonts: tuple[str, ...] = ()
    bold_numbers: bool | None = None
    by_frequent_styles: bool = True
    authors_in_colour: bool = False
    imprint: tuple[str, ...] = ()  # from here on it is the printer's
    passed_over: tuple[str, ...] = ()  # spans with one of these

    def may_number(self, font: Column) -> Column:
        test = _any(font.startswith(f) for f in self.number_fonts) if self.number_fonts else F.lit(True)
        return test if self.bold_numbers is None else test & (_sure(font.contains("Bold")) == F.lit(self.bold_numbers))


# --- running lines, which page labels stand on ----------------------------------------


@dataclass(frozen=True)
class RunningLines:
    """Small lines that come back on every page. This kind has none; the others say where they stand."""

    fonts: tuple[str, ...] = ()
    under: float = 12.0
    no_labels: tuple[str, ...] = ()  # words that look like a label and aren't

    @property
    def words(self) -> tuple[str, ...]:
        return ()

    def stands(self, b: Line) -> Column:
        return F.lit(False)

    def holds(self, b: Line) -> Column:
        in_font = _any(b.font.startswith(f) for f in self.fonts) if self.fonts else F.lit(True)
        return _sure((b.size < self.under) & in_font & self.stands(b))


@dataclass(frozen=True)
class AtTheEdge(RunningLines):
    """Few words at the top or bottom of the page; edges are shares of the page's height."""

    bottom: float = 0.90
    top: float = 0.08
    most_words: int = 5

    def stands(self, b: Line) -> Column:
        edge = (b.y0 >= b.height * self.bottom) | (b.y1 <= b.height * self.top)
        return (b.height > 0) & edge & (F.size(words(b.text)) <= self.most_words)


@dataclass(frozen=True)
class WithAWord(RunningLines):
    """One of these words stands in the line, in whatever case."""

    known: tuple[str, ...] = ()

    @property
    def words(self) -> tuple[str, ...]:
        return self.known

    def stands(self, b: Line) -> Column:
        return _any(F.lower(b.text).contains(w.lower()) for w in self.known)


# --- block types ------------------------------------------------------------------------


@dataclass(frozen=True)
class Band:
    """Sizes from low to high, both included, that make a block one type."""

    kind: str
    low: float = 0.0
    high: float | None = None
    bold: bool | None = None

    def holds(self, size: Column, bold: Column) -> Column:
        tests = [size >= self.low]
        tests += [] if self.high is None else [size <= self.high]
        tests += [] if self.bold is None else [bold == F.lit(self.bold)]
        return _sure(reduce(and_, tests))


@dataclass(frozen=True)
class Face:
    """Bands of one kind of face, and what a block in it is that fits none."""

    bands: tuple[Band, ...] = ()
    otherwise: str = "body"
    labels_figures: bool = False
    names: tuple[str, ...] = ()

    def branches(self, inside: Column, size: Column, bold: Column, text: Column) -> list[tuple[Column, str]]:
        out = [(inside & b.holds(size, bold), b.kind) for b in self.bands]
        if self.labels_figures:
            out.append((inside & fonts.is_figure_label(text), "annotation"))
        return [*out, (inside, self.otherwise)]


@dataclass(frozen=True)
class ByPoints:
    """Sizes in points, by the first face that a font's name begins with. Fonts of no face are body text."""

    faces: tuple[Face, ...] = ()
    needs_body_style = False

    def branches(self, b: Line, body_size: Column | None, body_family: Column | None) -> list[tuple[Column, str]]:
        name = F.regexp_replace(F.coalesce(b.font, F.lit("")), r"^[A-Z]{6}\+", "")
        return [x for f in self.faces for x in f.branches(_any(name.startswith(n) for n in f.names), b.size, fonts.is_bold(b.font), b.text)]


@dataclass(frozen=True)
class ByRatio:
    """Sizes as ratios to the body text's, for its own family and for all others."""

    own: Face = Face()
    others: Face = Face(otherwise="caption", labels_figures=True)
    needs_body_style = True

    def branches(self, b: Line, body_size: Column | None, body_family: Column | None) -> list[tuple[Column, str]]:
        if body_size is None or body_family is None:
            raise ValueError("ratios need the document's body size and family")
        ratio, same, bold = F.coalesce(F.try_divide(b.size, body_size), F.lit(1.0)), fonts.family(b.font) == body_family, fonts.is_bold(b.font)
        return [*self.own.branches(_sure(same), ratio, bold, b.text), *self.others.branches(_sure(~same), ratio, bold, b.text)]


#: Bounds of type sizes relative to the body text.
TITLE_RATIO, HEADING_RATIO, BOLD_HEADING_RATIO, FOREIGN_TITLE_RATIO = 1.7, 1.18, 0.95, 2.2

RATIOS = ByRatio(
    Face((Band("title", TITLE_RATIO), Band("heading", HEADING_RATIO, TITLE_RATIO), Band("heading", BOLD_HEADING_RATIO, HEADING_RATIO, True))),
    Face((Band("title", FOREIGN_TITLE_RATIO),), "caption", True),
)


# --- wording ------------------------------------------------------------------------------

#: The texts that chunks are embedded with and sources are cited by.
EMBEDDED = "Magazine: {journal}\nYear: {year}\nIssue: {issue}\nArticle: {title}\nAuthors: {author}\nText: {text}"
EMBEDDED_WITHOUT_YEAR = "Magazine: {journal}\nIssue: {issue}\nArticle: {title}\nAuthors: {author}\nText: {text}"
CITED = "{title} ({journal} {year}/{issue}, {pages}), authors: {author}"
CITED_WITHOUT_YEAR = "{title} ({journal} {issue}, {pages}), authors: {author}"
UNKNOWN_AUTHOR = "unknown"
ONE_PAGE, MORE_PAGES = "PDF p. {page}", "PDF pp. {start}-{end}"
CAPTIONS, WHOLE_ARTICLE, EXCERPT, SOURCE = "Figure captions:", "FULL ARTICLE", "excerpt", "Source"


@dataclass(frozen=True)
class Wording:
    embedded: str = EMBEDDED
    cited: str = CITED
    nobody: str = UNKNOWN_AUTHOR
    on_page: str = ONE_PAGE
    on_pages: str = MORE_PAGES
    captions: str = CAPTIONS
    whole: str = WHOLE_ARTICLE
    part: str = EXCERPT
    source: str = SOURCE
    instructions: str = ""  # a file with what a language model is told before the sources

    def read_instructions(self) -> str:
        if not self.instructions:
            raise ValueError("the publication names no file of instructions")
        with open(self.instructions, encoding="utf-8") as f:
            return f.read()


# --- a publication ----------------------------------------------------------------------------


@dataclass(frozen=True)
class Publication:
    name: str
    title: str = ""
    language: str = "en"
    files: str = r"(\d{4})-(\d+)\.pdf$"  # groups: year and issue, or the issue alone
    contents: Contents = field(default_factory=Contents)
    running: RunningLines = field(default_factory=AtTheEdge)
    boilerplate: tuple[tuple[str, ...], ...] = ()  # a block with all strings of one group
    always_body: str = ""  # a pattern of running text that is no heading, whatever its size
    types: ByPoints | ByRatio = RATIOS
    covers: tuple[int, int] = (2, 2)  # first and last pages that no chunk is made of
    wording: Wording = field(default_factory=Wording)

    def is_junk(self, b: Line) -> Column:
        """A running line, boilerplate, or a lone number in a tiny box."""
        lone = b.text.rlike(r"(?U)^\s*\d+\s*$") & (b.x1 - b.x0 < 15) & (b.y1 - b.y0 < 15)
        marked = _any(reduce(and_, [b.text.contains(m) for m in group]) for group in self.boilerplate if group)
        return self.running.holds(b) | marked | _sure(lone)

    def block_type(self, b: Line, body_size: Column | None = None, body_family: Column | None = None) -> Column:
        """One CASE expression: running text, then the branches of the type rules in order."""
        first = _sure(b.text.rlike("(?iu)" + self.always_body)) if self.always_body else F.lit(False)
        case = F.when(first, F.lit("body"))
        for test, kind in self.types.branches(b, body_size, body_family):
            case = case.when(test, F.lit(kind))
        return case.otherwise(F.lit("body"))


ADAPTIVE = Publication("adaptive")

#: Issues numbered through, without years.
NO_YEAR = replace(ADAPTIVE, name="no-year", files=r"(\d{1,3})\.pdf$", wording=Wording(embedded=EMBEDDED_WITHOUT_YEAR, cited=CITED_WITHOUT_YEAR))

_SERIF_SANS = ByPoints((
    Face((Band("title", 18, bold=True), Band("heading", 12, 18, True), Band("other", 11.5, 12.5, False)), names=("Serifa",)),
    Face((Band("other", 7, 7),), "caption", True, ("Grota",)),
))

#: A serif face for the text, a sans one for what is around it; running lines by the address in them.
SERIF_SANS = Publication(
    "serif-sans", contents=Contents((2,), ("Serifa",), True, by_frequent_styles=False, authors_in_colour=True),
    running=WithAWord(under=10.0, known=(".example",)), types=_SERIF_SANS)

#: As SERIF_SANS, but with a bare number anywhere on the page as its label.
NUMBERED_PAGES = replace(SERIF_SANS, name="numbered-pages", running=AtTheEdge(under=10.0, bottom=0.0, most_words=1))

_KNOWN = {p.name: p for p in (ADAPTIVE, NO_YEAR, SERIF_SANS, NUMBERED_PAGES)}


def register(publication: Publication) -> Publication:
    _KNOWN[publication.name] = publication
    return publication


def available() -> list[str]:
    return sorted(_KNOWN)


def get(name: str) -> Publication:
    if name not in _KNOWN:
        raise KeyError(f"no publication {name!r}; there are {', '.join(available())}")
    return _KNOWN[name]
