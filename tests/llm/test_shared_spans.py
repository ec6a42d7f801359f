import random

from inkwell.llm import shared_spans as S


def brute(texts, span):
    """Runs of characters that lie in a window of another record."""
    owners = {}
    for k, t in texts.items():
        for i in range(len(t or "") - span + 1):
            owners.setdefault(t[i : i + span], set()).add(k)
    out = set()
    for k, t in texts.items():
        mark = [False] * len(t or "")
        for i in range(len(t or "") - span + 1):
            if len(owners[t[i : i + span]]) > 1:
                mark[i : i + span] = [True] * span
        i = 0
        while i < len(mark):
            if mark[i]:
                j = i
                while j < len(mark) and mark[j]:
                    j += 1
                out.add((k, i, j))
                i = j
            else:
                i += 1
    return out


def found(spark, rows, span, phrase):
    df = spark.createDataFrame(rows, "chunk_id string, text string, ingested_at int, rec string, lo string")
    return {tuple(r) for r in S.shared_spans(df, span=span, phrase=phrase).collect()}


def test_against_brute_force(spark):
    rng = random.Random(5)
    shared = ["".join(rng.choice("abcdé😀 ") for _ in range(rng.randint(15, 60))) for _ in range(6)]
    texts = {}
    for n in range(60):
        parts = ["".join(rng.choice("abcdefgh ") for _ in range(rng.randint(0, 40))) for _ in range(3)]
        s = rng.choice(shared)
        parts.insert(rng.randint(0, 3), s[rng.randint(0, 5) : len(s) - rng.randint(0, 5)])
        texts[f"k{n}"] = "".join(parts)
    texts |= {"null": None, "empty": "", "short": "abc", "same": "a" * 90, "more": "a" * 50, "copy": texts["k3"]}
    rows = [(k, t, 1, "x", "y") for k, t in texts.items()]
    rows += [("k1", texts["k1"], 1, "x", "y"), ("k2", texts["k5"] * 2, 0, "x", "y")]  # delivered twice; an older state
    assert found(spark, rows, 20, 8) == brute(texts, 20)


def test_a_passage_in_a_third_of_all_records(spark):
    rng = random.Random(6)
    hot = "".join(rng.choice("abcdefgh ") for _ in range(70))
    texts = {f"k{n}": "".join(rng.choice("ijklmnop ") for _ in range(50)) + (hot if n % 3 == 0 else "") + "".join(rng.choice("qrstuv") for _ in range(9)) for n in range(600)}
    assert found(spark, [(k, t, 1, "", "") for k, t in texts.items()], 20, 8) == brute(texts, 20)


def test_text_longer_than_a_part(spark, monkeypatch):
    monkeypatch.setattr(S, "_PART", 100)
    rng = random.Random(7)
    t = "".join(rng.choice("abcdefgh ") for _ in range(1000))
    texts = [t, t[300:420] + "zz"]
    got = [(int(r), int(a)) for rows, at, _ in S.find_anchors(texts, 20, 8) for r, a in zip(rows, at)]
    monkeypatch.setattr(S, "_PART", 200_000)
    assert set(got) == {(int(r), int(a)) for rows, at, _ in S.find_anchors(texts, 20, 8) for r, a in zip(rows, at)}


def test_empty_table_and_shares(spark):
    assert found(spark, [], 20, 8) == set()
    rows = [("a", "x" * 10 + "0123456789" * 3, 1), ("b", "0123456789" * 3, 1), ("c", None, 1)]
    df = spark.createDataFrame(rows, "chunk_id string, text string, ingested_at int")
    got = {r.chunk_id: r.n_chars for r in S.shared_shares(df).collect()}
    assert got == {"a": 40, "b": 30, "c": 0}


def test_an_older_state_in_another_batch_at_another_offset(spark):
    """Two batches hold old states and partners, a third the latest states, in which the passage has moved."""
    rng = random.Random(8)

    def other(n):
        return "".join(rng.choice("ijklmnop ") for _ in range(n))

    first, second, texts = [], [], {}
    for n in range(40):
        passage = "".join(rng.choice("abcdefgh ") for _ in range(40))
        x, y = other(30) + passage + other(5), other(3) + passage + other(9)
        first += [(f"x{n}", passage + other(5), 1), (f"y{n}", y, 1)]
        second.append((f"x{n}", x, 2))
        texts |= {f"x{n}": x, f"y{n}": y}
    names = "chunk_id string, text string, ingested_at int"
    df = spark.createDataFrame(spark.sparkContext.parallelize(first + second, 3), names)
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # else all texts are one batch in the second step
    try:
        got = {tuple(r) for r in S.shared_spans(df, span=20, phrase=8).collect()}
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert got == brute(texts, 20)


def test_without_phrases_in_the_automata_nothing_is_found(spark):
    rows = [("a", "x" + "0123456789" * 3, 1, "", ""), ("b", "0123456789" * 3 + "y", 1, "", "")]
    assert found(spark, rows, 20, 8) == {("a", 1, 31), ("b", 0, 30)}
    none = [r for r in S._windows(iter([pa_batch([(0, 1, 5, "0123456789" * 3), (0, 1, 6, "0123456789" * 3)])]), 20, 8)]
    assert none == []  # documents of a shard without a phrase have no window
    some = [r for r in S._windows(iter([pa_batch([(0, 0, 0, "01234567"), (0, 1, 5, "0123456789" * 3), (0, 1, 6, "0123456789" * 3)])]), 20, 8)]
    assert sum(r.num_rows for r in some) > 0


def pa_batch(rows):
    import pyarrow as pa

    return pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], names=["shard", "kind", "rec", "t"])


def test_small_batches_and_many_shards(spark):
    """Keys that go on over many batches and partitions, families of one phrase, partners in other shards."""
    rng = random.Random(11)
    hot = ["".join(rng.choice("abcdefgh ") for _ in range(45)) for _ in range(3)]
    texts = {}
    for n in range(150):
        s = rng.choice(hot)
        texts[f"k{n}"] = "".join(rng.choice("ijklmnop ") for _ in range(rng.randint(0, 30))) + s[rng.randint(0, 15) :] + rng.choice(["", s[:30]]) + "".join(rng.choice("qrstuv") for _ in range(9))
    df = spark.createDataFrame([(k, t, 1) for k, t in texts.items()], "chunk_id string, text string, ingested_at int").repartition(7)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "5")
    try:
        hits = S.shared_windows(df, "chunk_id", "text", "ingested_at", 20, 8, shard_phrases=4)
        got = {(r.rec, i) for r in hits.collect() for i in range(r.lo, r.hi + 1)}
        names = {r.rec: r.chunk_id for r in df.selectExpr("xxhash64(chunk_id) AS rec", "chunk_id").collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    owners = {}
    for k, t in texts.items():
        for i in range(len(t) - 19):
            owners.setdefault(t[i : i + 20], set()).add((k, i))
    assert {(names[r], i) for r, i in got} == {x for o in owners.values() if len({k for k, _ in o}) > 1 for x in o}


def test_letters_decide_where_hashes_are_equal():
    assert S._same_letters("abcdef", 0, 3, "zbcdez", 0, 3) == [(1, 1), (2, 2)]
    assert S._same_letters("abcdef", 0, 3, "abcdef", 0, 3) == [(0, 3)]
