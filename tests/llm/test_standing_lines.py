import random
import re

from inkwell.llm import standing_lines as S


def key(line):
    line = re.sub("[ \t  ]+", " ", line).strip(" ")
    return re.sub("[0-9]+", "0", line.upper().lower())


def brute(rows):
    pages, seen, places = {}, {}, set()
    for j, y, i, p, b, t in rows:
        pages.setdefault(j, set()).add((y, i, p))
        for n, line in enumerate(re.split("\r\n|\n", t) if t is not None else []):
            if key(line):
                seen.setdefault((j, key(line)), set()).add((y, i, p))
                places.add((j, y, i, p, b, n, key(line)))
    return {x[:6] for x in places if len(seen[x[0], x[6]]) >= 3 and len(seen[x[0], x[6]]) >= 0.05 * len(pages[x[0]])}


def table(spark, rows):
    return spark.createDataFrame([(*r, 1, "c", "v") for r in rows], "journal string, year string, issue string, page int, block_id int, text string, extracted_at int, container string, variant string")


def make(seed=1):
    rng = random.Random(seed)
    rows = []
    for j in ("a", "b", None):
        for p in range(90):
            for b in range(3):
                lines = [f"text {rng.random()}".translate(str.maketrans("0123456789", "qwertyuiop")) for _ in range(2)]
                if rng.random() < 0.3:
                    lines.insert(rng.randint(0, 2), rng.choice(["Page 7", "PAGE  12", " page 3\t", "Straße", "STRASSE"]))
                if rng.random() < 0.02:
                    lines.append("rare line")
                rows.append((j, rng.choice(["", "1990", None]), "1", p, b, rng.choice(["\n", "\r\n"]).join(lines)))
    rows += [("a", "", "1", 5, 9, None), ("a", "", "1", 6, 9, ""), ("a", "", "1", 6, 10, "\n \n")]
    return rows + rows[:50]


def test_against_brute_force(spark):
    rows = make()
    got = {tuple(r) for r in S.standing_places(table(spark, rows)).collect()}
    assert got == brute(rows)
    assert any(r[0] is None for r in got)


def test_clean_texts(spark):
    rows = make(2)
    gone = brute(rows)
    want = {}
    for j, y, i, p, b, t in rows:
        lines = re.split("\r\n|\n", t) if t is not None else None
        drop = {x[5] for x in gone if x[:5] == (j, y, i, p, b)}
        if drop:
            breaks = [*re.findall("\r\n|\n", t), ""]
            kept = "".join(x + br for n, (x, br) in enumerate(zip(lines, breaks)) if n not in drop)
            t = re.sub("\r?\n\\Z", "", kept) if len(lines) - 1 in drop else kept
        want[j, y, i, p, b] = t
    got = S.without_standing_lines(table(spark, rows)).collect()
    assert len(got) == len(want)
    assert {tuple(r)[:5]: r.text for r in got} == want


def test_bitmaps_are_of_variants_and_only_their_union_reaches_the_threshold(spark):
    """Each variant is on two pages, the line on six; a bitmap of one variant stays under the threshold."""
    rows = [("a", "", "1", p, 0, ["NOTICE 1", " notice 2", "Notice\t3"][p % 3] + f"\r\nown {chr(97 + p)}\r\nend {chr(97 + p)}") for p in range(6)]
    t = table(spark, rows)
    lines = S.line_table(t)
    by_variant = S.variant_bitmaps(lines)
    assert by_variant.selectExpr("bit_count(word) AS n").where("n = 2").count() == 3
    assert {(r.page, r.line_no) for r in S.standing_places(t).collect()} == {(p, 0) for p in range(6)}
    double = S.without_standing_lines(table(spark, rows + [("a", "", "1", 9, 0, "x\n\n\nnotice 7")])).where("page = 9").first()
    assert (double.text, double.n_removed) == ("x\n\n", 1)
    assert {r.text for r in S.without_standing_lines(t).collect()} == {f"own {chr(97 + p)}\r\nend {chr(97 + p)}" for p in range(6)}


def test_empty_table(spark):
    assert S.standing_places(table(spark, [])).count() == 0
    assert S.without_standing_lines(table(spark, [])).count() == 0
