import pytest
from pyspark.sql import functions as F

from inkwell.functions import fonts, labels, templates, text, vectors


def values(spark, rows, schema, *cols):
    return [tuple(r) for r in spark.createDataFrame(rows, schema).select(*cols).collect()]


@pytest.mark.parametrize("parts, want", [
    (["dlouhodo-", "bé řešení"], "dlouhodobé řešení"), (["nerovnoměr - ", "ný"], "nerovnoměrný"), (["1990 –", "2000"], "1990 – 2000"), (["Jan-", "Petr"], "Jan- Petr"),
    (["foo", "-", "bar"], "foobar"), ([None, " ", "a ", " b"], "a b"), ([], ""), (["é-", " è"], "éè")])
def test_glue(spark, parts, want):
    assert values(spark, [(parts,)], "p array<string>", text.glue(F.col("p"))) == [(want,)]


def test_clean_and_strip(spark):
    rows = [("\x07 a\t b  c \x7f",), (None,), ("",)]
    assert values(spark, rows, "t string", text.clean(F.col("t"))) == [("a b c",), (None,), ("",)]


def test_cut_imprint(spark):
    assert values(spark, [(" Title, © Press 2014",), ("Plain;",)], "t string", text.cut_imprint(F.col("t"), ("© Press", "www."))) == [("Title",), ("Plain",)]


def test_sentences(spark):
    rows = [("One two. Three? four! Éva five.  Žába.",), ("no end",), ("A. Ö b. Á c",)]
    got = values(spark, rows, "t string", text.sentences(F.col("t")))
    assert got == [(["One two.", "Three? four!", "Éva five.", "Žába."],), (["no end"],), (["A. Ö b.", "Á c"],)]


def brute_common(a, b):
    return max((k for i in range(len(a)) for k in range(len(a) - i + 1) if a[i : i + k] in b), default=0)


def test_common_length(spark):
    import random

    rng = random.Random(5)
    rows = [("".join(rng.choice("abc") for _ in range(rng.randint(0, 30))), "".join(rng.choice("abc") for _ in range(rng.randint(0, 30)))) for _ in range(200)]
    rows += [("", ""), ("é😀x", "😀x"), ("same", "same")]
    got = values(spark, rows, "a string, b string", "a", "b", text.common_length(F.col("a"), F.col("b")))
    assert all(n == brute_common(a, b) for a, b, n in got)
    assert values(spark, [(None, "a")], "a string, b string", text.common_length(F.col("a"), F.col("b"))) == [(0,)]


def test_same_title(spark):
    rows = [("Recenze: Velké knihy o přírodě", "velké knihy o přírodě"), ("Abc", "xx abc yy"), ("The wandering stone of the north", "A wandering stone of the"), ("short one", "another"), ("", "x"), (None, "x")]
    assert [r[0] for r in values(spark, rows, "a string, b string", text.same_title(F.col("a"), F.col("b")))] == [True, True, True, False, False, False]


def test_preview_and_tokens(spark):
    rows = [("abcdef",), ("abc",), (None,)]
    assert values(spark, rows, "t string", text.preview(F.col("t"), 3), text.estimated_tokens(F.col("t"))) == [("abc...", 3), ("abc", 1), (None, 0)]


def roman_of(n):
    out = ""
    for s, v in labels.ROMAN:
        while n >= v:
            out, n = out + s, n - v
    return out


def greedy(s):
    s, total = s.strip().upper(), 0
    for symbol, v in labels.ROMAN:
        while s.startswith(symbol):
            s, total = s[len(symbol) :], total + v
    return total


def test_roman_numbers(spark):
    import random

    rng = random.Random(1)
    rows = [(n, roman_of(n), "".join(rng.choice("IVXLCDMivxz") for _ in range(rng.randint(0, 8)))) for n in range(1, 2500, 7)]
    for n, r, odd, made, back, greedy_value in values(spark, rows, "n int, r string, odd string", "n", "r", "odd", labels.to_roman(F.col("n")), labels.roman_value(F.lower("r")), labels.roman_value(F.col("odd"))):
        assert made == r and back == n and greedy_value == greedy(odd)


def test_labels(spark):
    rows = [("032",), ("cxxxiii",), (" 7 ",), ("12345",), ("MIX-up",), (None,), ("XXXI–II",), ("285-6",), ("\x07 22",), ("CXLVIiI",)]
    got = values(spark, rows, "t string", labels.canonical_label(F.col("t")), labels.page_value(F.col("t")))
    assert got == [("32", "032"), ("CXXXIII", "CXXXIII"), ("7", "7"), ("12345", "12345"), ("MIX-up", None), (None, None), ("XXXI–II", "XXXI"), ("285-6", "285"), ("\x07 22", "22"), ("CXLVIII", "CXLVIII")]


def test_label_in_running_line(spark):
    rows = [("host.example 262 name 6/2014",), ("name 6/2014 cxlviii host.example",), ("nothing here",), (None,)]
    assert [r[0] for r in values(spark, rows, "t string", labels.label_in(F.col("t"), ("host.example",), ("name",)))] == ["262", "CXLVIII", None, None]


def test_fonts(spark):
    rows = [("ABCDEF+TextfaceCE-BoldItalic", 8.76), ("RobotoSerif-20ptRegular", 9.25), ("Arial,Bold", 9.75), (None, None), ("Plain", 9.0)]
    got = values(spark, rows, "f string, s double", fonts.family(F.col("f")), fonts.half_points(F.col("s")), fonts.is_bold(F.col("f")))
    assert got == [("TextfaceCE", 9.0, True), ("RobotoSerif", 9.0, False), ("Arial", 10.0, True), ("", None, False), ("Plain", 9.0, False)]


@pytest.mark.parametrize("t, want", [
    ("10 km", True), ("1,5 µm 3 µm", True), ("[mg/l]", True), ("[seven c]", False), ("4 8 15 16", True), ("-7. 8.", True), ("pod -3 až 7", True), ("do 2 2–5 nad 9", True), ("do nad", True), ("x y Z.", True), ("…", True), ("..", False), ("terra incognita", False), ("  ", False), (None, False), ("3 lamps", False)])
def test_figure_labels(spark, t, want):
    assert values(spark, [(t,)], "t string", fonts.is_figure_label(F.col("t"))) == [(want,)]


def test_captions(spark):
    rows = [("7 Lamps on a shelf in the hall",), ("3 až 5 Éclairage d'une salle",), ("12, 13 – 14 Tři lampy na polici",), ("7 lamps on a shelf in the hall",), ("7. Lamps on a shelf in the hall",), ("7 Lamps on a shelf",), (None,)]
    assert [r[0] for r in values(spark, rows, "t string", fonts.opens_caption(F.col("t")))] == [True, True, True, False, False, False, False]


def test_templates(spark):
    rows = [("A", None, "2014", "6")]
    got = values(spark, rows, "t string, a string, y string, i string", templates.fill("{t} ({y}/{i}) {a}!", {"t": F.col("t"), "a": F.col("a"), "y": F.col("y"), "i": F.col("i")}), templates.or_label(F.col("a"), "unknown"), templates.joined(F.lit(""), F.col("i"), F.lit(3)))
    assert got == [("A (2014/6) !", "unknown", "6-3")]
    assert [r[0] for r in values(spark, [(3725.0,), (200.0,), (float("nan"),), (None,)], "s double", templates.duration(F.col("s")))] == ["1h02m", "3m20s", "?", "?"]


def test_vectors(spark):
    got = values(spark, [([3.0, 4.0], [4.0, 3.0]), ([0.0, 0.0], [1.0, 0.0])], "a array<float>, b array<float>", vectors.dot(F.col("a"), F.col("b")), vectors.cosine(F.col("a"), F.col("b")))
    assert got[0][0] == 24.0 and abs(got[0][1] - 0.96) < 1e-9 and got[1] == (0.0, None)
    e = values(spark, [("a b a",), ("",), (None,)], "t string", vectors.hash_embedding(F.coalesce(F.col("t"), F.lit("")), 8))
    assert abs(sum(x * x for x in e[0][0]) - 1) < 1e-6 and e[1][0] == [0.0] * 8
    assert values(spark, [("q",)], "t string", vectors.prefixed(F.col("t"), "intfloat/multilingual-e5-base", True)) == [("query: q",)]
