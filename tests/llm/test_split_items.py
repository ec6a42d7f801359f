import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from inkwell.llm import split_items as S


def check(text, limit, overlap):
    cuts = S.split(text, limit, overlap)
    assert cuts[0][0] == 0 and cuts[-1][1] == len(text)
    assert all(0 < e - s <= limit for s, e in cuts)
    for (_, e0), (s1, e1) in zip(cuts, cuts[1:]):
        assert e0 - overlap <= s1 <= e0 < e1
    return cuts


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet="ab .\n\r\tÉ?😀", max_size=400), st.integers(5, 60), st.integers(0, 4))
def test_pieces_cover_the_text(text, limit, overlap):
    if text:
        check(text, limit, overlap)


def test_least_cost_of_all_cuts():
    rng = random.Random(3)
    for _ in range(20):
        text = "".join(rng.choice(["ab ", "c. D", "\n", "\n\n", "efg ", "h! I"]) for _ in range(60))
        limit, overlap = 60, 10
        ends, pen, words = S.boundaries(text, limit, overlap)
        begins = S.next_starts(ends, words, overlap)
        begins[0] = 0
        n = len(text)
        if n <= limit:
            continue
        count = -(-(n - overlap) // (limit - overlap))
        size = (n + (count - 1) * overlap) / count
        best = {0: 0.0}
        for j in range(1, len(ends)):  # every predecessor, one by one
            best[j] = min((best[i] + ((ends[j] - begins[i]) / size - 1) ** 2 + pen[j] for i in range(j) if i in best and ends[j] - begins[i] <= limit), default=np.inf)
        cuts = S.split(text, limit, overlap)
        at = {int(e): p for e, p in zip(ends, pen)}
        cost = sum(((e - s) / size - 1) ** 2 + at[e] for s, e in cuts)
        assert abs(cost - best[len(ends) - 1]) < 1e-9


def test_cuts_lie_at_natural_ends():
    text = " ".join(f"Sentence number {i} goes on for a while here." for i in range(80))
    cuts = check(text, 1200, 150)
    assert all(text[e - 1] == "." for _, e in cuts)
    assert all(text[s - 1] == " " for s, _ in cuts[1:])


def test_text_without_ends_is_cut_between_characters():
    cuts = check("x" * 5000, 1200, 150)
    assert all(s1 == e0 - 150 for (_, e0), (s1, _) in zip(cuts, cuts[1:]))
    check(" " * 5000, 1200, 150)


def test_letters_keep_their_marks():
    import regex

    for unit in ("e\u0301", "\U0001f469\u200d\U0001f680", "\U0001f1e8\U0001f1ff"):
        text = unit * 900
        whole = {m.start() for m in regex.finditer(r"\X", text)} | {len(text)}
        assert all(s in whole and e in whole for s, e in check(text, 1200, 150))
    check("e" + "\u0301" * 5000 + " end", 1200, 150)  # a letter larger than any piece


def test_every_word_end_is_offered():
    text = "One sentence here. " + "w " * 300
    ends, _, _ = S.boundaries(text, 60, 10)
    assert len(ends) == 2 + 3 + 299  # both ends of the text, three in the sentence, one after each w but the last
    ends, _, _ = S.boundaries("x" * 50 + " " + "y" * 80, 60, 10)
    assert ends.tolist() == [0, 50, *range(51, 132)]


def test_overlap_must_be_under_the_limit():
    with pytest.raises(ValueError):
        S.split("abc", 10, 10)


def test_archive(spark):
    long = "word " * 400
    c = spark.createDataFrame(
        [("a1", [(1, "short"), (2, long), (3, None)], 1, "z"), ("a1", [(1, "short"), (2, long), (3, None)], 2, "z"), ("a2", None, 1, "z"), (None, [(1, long)], 1, "z"), ("a3", [], 1, "z")],
        "article_id string, full_text_paragraphs array<struct<page:int,text:string>>, ingested_at int, pos string")
    k = spark.createDataFrame([("k1", long, 1, 5), ("k1", "now short", 2, 5), ("k2", "old", 1, 5), ("k2", long, 2, 5), ("k2", long, 2, 5), ("k3", None, 1, 5), ("k4", "", 1, 5)], "chunk_id string, text string, ingested_at int, item_kind int")
    rows = S.archive_pieces(c, k).collect()
    assert sorted((r.item_kind, r.item_id, r.pos) for r in rows) == [("chunk", "k2", 0), ("paragraph", "a1", 1)]
    assert all(p.text == long[p.start : p.end] for r in rows for p in r.pieces)
    assert S.archive_pieces(c.limit(0), k.limit(0)).count() == 0
