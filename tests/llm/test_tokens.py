import inspect
import random

from hypothesis import given, settings
from hypothesis import strategies as st

from inkwell.llm import encode_corpus as E
from inkwell.llm import mixture as M
from inkwell.llm import token_budget as B
from inkwell.llm.tokenizing import encoder, fingerprint, load

ALPHABET = "ab'sétlv 12.,!\n\r\t  \x85\x1c­​中文😀ﷺ<|>_"
TEXTS = st.text(alphabet=ALPHABET, max_size=120) | st.text(max_size=60) | st.sampled_from(["<|endoftext|>", "don't  we'll 'RE", "a" * 300, " " * 50, "x \n y", "foo \x1cbar", "日本語" * 40])


@settings(max_examples=300, deadline=None)
@given(TEXTS)
def test_words_between_cut_points(text):
    text = text.encode("utf-8", "ignore").decode()
    e = encoder("byte_bpe_50k")
    assert e.encode(text) == load("byte_bpe_50k").encode_ordinary(text)
    assert e.count(text) == len(e.encode(text))


@settings(max_examples=300, deadline=None)
@given(st.lists(TEXTS, min_size=1, max_size=12).map("".join), st.integers(1, 40))
def test_tree_of_joins(text, leaf):
    text = text.encode("utf-8", "ignore").decode()
    e = encoder("byte_bpe_50k")
    ids = E.encode_tree(e, text, leaf).tolist()
    assert ids == load("byte_bpe_50k").encode_ordinary(text)
    assert e.encoding.decode(ids) == text


def test_windows_grow_only_to_a_cut_point():
    text = "aaa " * 50 + "x" * 300 + " bbb" * 50
    assert E.window_around(text, 0, 202, len(text)) == (199, 500)  # inside the long word: to its ends
    assert E.window_around(text, 0, 42, len(text)) == (39, 43)
    assert E.window_around(text, 0, 43, len(text)) == (43, 43)  # at a cut point: the halves are only set side by side
    assert E.window_around("x" * 900, 0, 450, 900) == (0, 900)  # no cut point: both halves whole
    assert E.window_around(" " * 900, 0, 450, 900) == (0, 900)


def test_corpus(spark):
    rows = [(1, "Hello <|endoftext|> world", "x", 1), (2, None, "x", 1), (3, "", "x", 1), (4, "dlouhé slovo " * 5000, "x", 1), (4, "again", "x", 1), (None, "null id", "x", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, k string, ids int")
    got = [(r.doc_id, r.ids) for r in E.encode_corpus(df).collect()]
    plain = load("byte_bpe_50k").encode_ordinary
    assert sorted(map(str, got)) == sorted(str((i, plain(t) if t else [])) for i, t, *_ in rows)
    assert E.encode_corpus(df.limit(0)).count() == 0


def budget_rows(spark, rows):
    return spark.createDataFrame(rows, "chunk_id string, journal string, lang string, text string, embedding_text string, ingested_at int, k string")


def test_budget_of_latest_states(spark):
    n = encoder("byte_bpe_50k").count
    df = budget_rows(spark, [
        ("a", "j1", "en_GB", "old words", None, 1, ""), ("a", "j1", "EN", "new words here", "Text: new", 2, ""), ("a", "j1", "EN", "new words here", "Text: new", 2, ""),
        ("b", "j1", None, None, "only this", 1, ""), ("c", "j2", "cs-CZ", "", "", 1, ""), ("d", None, "cs", "new words here", None, None, ""), (None, "j1", "en", "lost", "lost", 1, "")])
    journals = spark.createDataFrame([("j1", "botany"), ("j2", None)], "journal string, domain string")
    got = {(r.dimension, r.slice): (r.n_docs, r.tokens_text, r.tokens_embedding_text) for r in B.chunk_budget(df, journals).collect()}
    new = n("new words here")
    assert got[("journal", "j1")] == (2, new, n("Text: new") + n("only this"))
    assert got[("journal", None)] == (1, new, 0)
    assert got[("language", "en")] == (1, new, n("Text: new"))
    assert got[("language", "und")] == (1, 0, n("only this"))
    assert got[("language", "cs")] == (2, new, 0)
    assert got[("domain", "botany")][0] == 2 and got[("domain", None)][0] == 2
    assert B.chunk_budget(df.limit(0), journals).count() == 0


def test_signed_deltas(spark, tmp_path):
    from pyspark.sql import functions as F

    def budget(tokenizer="byte_bpe_50k"):
        return B.Budget(spark, str(tmp_path / "state"), {"journal": F.col("journal")}, ["text"], tokenizer)

    v1 = budget_rows(spark, [("a", "j1", "en", "one two three", None, 1, ""), ("b", "j1", "en", "four five", None, 1, ""), ("b", "j1", "en", "an older state", None, 0, ""), ("c", "j2", "en", "six", None, 1, ""), ("e", "j3", "en", "gone", None, 1, ""), ("f", "j3", "en", None, None, 1, "")])
    v2 = budget_rows(spark, [("a", "j1", "en", "one two three", None, 1, ""), ("b", "j1", "en", "four five and more", None, 2, ""), ("c", "j1", "en", "six", None, 2, ""), ("d", "j2", "en", "one two three", None, 1, "")])
    n = encoder("byte_bpe_50k").count
    one = budget()
    one.update(v1, "chunk_id", "ingested_at")
    assert one.encoded.value == 4  # not the older state
    two = budget()  # another run over the same folder
    two.update(v2, "chunk_id", "ingested_at")
    assert two.encoded.value == 1  # only the changed text
    delta = {r.journal: (r.n_docs, r.tokens_text) for r in two.delta().collect()}
    assert delta == {"j1": (1, n("four five and more") - n("four five") + n("six")), "j2": (0, n("one two three") - n("six")), "j3": (-2, -n("gone"))}
    fresh = B.Budget(spark, str(tmp_path / "fresh"), {"journal": F.col("journal")}, ["text"])
    fresh.update(v2, "chunk_id", "ingested_at")
    assert sorted(map(tuple, two.cube().collect())) == sorted(map(tuple, fresh.cube().collect()))
    two.update(v2, "chunk_id", "ingested_at")
    assert two.encoded.value == 1 and two.delta().count() == 0
    # another tokenizer's counts are no counts of this one
    other = budget("byte_bpe_multi_50k")
    other.update(v2, "chunk_id", "ingested_at")
    assert other.counts().count() == 3 and {r.tokenizer for r in other.counts().collect()} == {fingerprint("byte_bpe_multi_50k")}
    m = encoder("byte_bpe_multi_50k").count
    assert {r.journal: r.tokens_text for r in other.cube().collect()} == {"j1": sum(map(m, ("one two three", "four five and more", "six"))), "j2": m("one two three")}


def test_a_failed_update_has_not_happened(spark, tmp_path, monkeypatch):
    from pyspark.sql import functions as F

    v1 = budget_rows(spark, [("a", "j1", "en", "one two", None, 1, "")])
    v2 = budget_rows(spark, [("a", "j1", "en", "one two three four", None, 2, "")])
    b = B.Budget(spark, str(tmp_path / "s"), {"journal": F.col("journal")}, ["text"])
    b.update(v1, "chunk_id", "ingested_at")
    monkeypatch.setattr(B, "add_cubes", lambda *a: 1 / 0)
    try:
        b.update(v2, "chunk_id", "ingested_at")
    except ZeroDivisionError:
        pass
    monkeypatch.undo()
    n = encoder("byte_bpe_50k").count
    assert [r.tokens_text for r in b.cube().collect()] == [n("one two")]
    b.update(v2, "chunk_id", "ingested_at")
    assert [r.tokens_text for r in b.cube().collect()] == [n("one two three four")]


def test_budget_goes_on_from_a_state(spark, tmp_path):
    rows = [(f"c{i}", f"j{i % 2}", "en", f"text {i} of some length", f"e {i}", i, "") for i in range(40)]
    journals = spark.createDataFrame([("j0", "d"), ("j1", "d")], "journal string, domain string")
    root = str(tmp_path / "state")
    B.chunk_budget(budget_rows(spark, rows[:30]), journals, root=root).collect()
    later = budget_rows(spark, rows[5:] + [("c7", "j1", "en", "changed", None, 99, "")])
    assert sorted(map(str, B.chunk_budget(later, journals, root=root).collect())) == sorted(map(str, B.chunk_budget(later, journals).collect()))
    d = B.chunk_deltas(later).collect()
    assert {r.update_no for r in d} == {1, 2, 3} and sum(r.n_docs for r in d if r.journal == "j0") == 0


def test_flight_keeps_both_totals():
    rng = random.Random(1)
    units = [[0.37, rng.choice([5, 5, 40, 300]), i] for i in range(500)]
    want = 0.37 * 500, 0.37 * sum(u[1] for u in units)
    out = list(M.flight(iter(units), rng))
    assert len(out) == 500 and sum(0 < u[0] < 1 for u in out) <= 2
    assert abs(sum(u[0] for u in out) - want[0]) < 1e-6 and abs(sum(u[0] * u[1] for u in out) - want[1]) < 1e-3


def test_rates():
    t = {"a": (0.5, 1), "b": (0.3, 2), "c": (0.18, 1), "tiny": (0.02, 3), "none": (0.0, 1)}
    n = {"a": 1000, "b": 100, "c": 500, "tiny": 1}
    r = M.source_rates(t, n)
    used = {s: r[s] * n[s] for s in r}
    assert abs(used["b"] - 200) < 1e-6 and used["tiny"] == 3  # b is the first exhausted, tiny gives all it may
    assert abs(used["a"] / used["b"] - 5 / 3) < 1e-6
    assert M.source_rates(t, {}) == {}
    big = M.source_rates(t, n, total=10_000)
    assert all(abs(big[s] - t[s][1]) < 1e-9 for s in big)


def test_mixture(spark):
    rng = random.Random(2)
    docs = [(i, "word " * rng.randint(20, 300), rng.choice(["a", "a", "a", "b", "c", "x"]), 0) for i in range(1500)] + [(9001, None, "a", 0), (9002, "", "b", 0), (9003, "lost", None, 0)]
    df = spark.createDataFrame(docs, "doc_id long, text string, source string, tokens int").repartition(5)
    targets = spark.createDataFrame([("a", 0.3, 1), ("b", 0.4, 3), ("c", 0.28, 2), ("nowhere", 0.02, 4)], "source string, target_share double, max_repeats int")
    m = M.mix(df, targets)
    rows = m.collect()
    assert all(0 <= r.copies <= {"a": 1, "b": 3, "c": 2}[r.source] for r in rows)
    assert len(rows) == len({r.doc_id for r in rows}) == sum(1 for i, t, s, _ in docs if t and s in ("a", "b", "c"))
    rep = {r.source: r for r in M.mix_report(m, targets).collect()}
    for s, w in (("a", 0.3), ("b", 0.4), ("c", 0.28)):
        assert abs(rep[s].reached_share - w / 0.98) < 0.002
    assert rep["nowhere"].copies == 0
    assert M.mix(df.limit(0), targets).count() == 0


def test_a_scarce_source_keeps_its_share():
    """Its share is under 5 %, and only a smaller total lets it be reached; by mix's default none is given up."""
    t, n = {"a": (0.95, 1), "tiny": (0.03, 1), "nowhere": (0.02, 1)}, {"a": 50_000, "tiny": 760}
    r = M.source_rates(t, n, None, inspect.signature(M.mix).parameters["give_up"].default)
    assert r["tiny"] == 1 and abs(r["a"] * n["a"] / n["tiny"] - 0.95 / 0.03) < 1e-6


def test_mixture_of_few_documents(spark):
    """One, two or three documents, string ids, repeated rows, a source with a null share."""
    targets = spark.createDataFrame([("a", 0.6, 2), ("b", 0.4, 1), ("c", None, None)], "source string, target_share double, max_repeats int")
    for docs in ([("x1", "one", "a")], [("x1", "one two", "a"), ("x2", "three", "b")], [("x1", "one two", "a"), ("x1", "one two", "a"), ("x3", "three four five six", "b"), ("x4", "t", "c")], [(None, "one two", "a"), ("x", "y " * 500, "a")]):
        rows = M.mix(spark.createDataFrame(docs, "doc_id string, text string, source string"), targets).collect()
        assert len(rows) == len(docs)
        assert all(0 <= r.copies <= {"a": 2, "b": 1, "c": 0}[r.source] for r in rows)
