import json

import pytest
from pyspark.sql import functions as F

from inkwell import __main__ as cli
from inkwell.operators import index, layout
from inkwell.operators.diagnose import digest
from inkwell.plans import pipeline, publication
from inkwell.sources import files, schemas
from inkwell.streaming import ingest


def span(page, raw, line, pos, text, font="Serifa", size=9.0, color=0, y=0.0, kind="text"):
    return ("j", "2000", "1", page, raw, kind, line, pos, text, font, size, color, 10.0, y, 200.0, y + 10)


def issue():
    s = []
    for i, (n, t, who) in enumerate([("101", "The first one", "Ann"), ("102", "Second thoughts", "Bea"), ("104", "Third time", "Cyd")]):
        s += [span(3, i, 0, 3 * i, n, "Serifa-Bold", 9.0, 0, 20.0 * i), span(3, i, 0, 3 * i + 1, t, "Serifa", 9.0, 0, 20.0 * i), span(3, i, 0, 3 * i + 2, who, "Serifa", 9.0, 7, 20.0 * i)]
    for page, head in ((4, "The first one"), (5, "Second thoughts"), (6, None), (7, "Third time")):
        at = 0
        if head:
            s.append(span(page, 0, 0, 0, head, "Serifa-Bold", 18.0, 0, 10.0))
            at = 1
        s += [span(page, at, 0, 5, f"Text of page {page} with a bro-", y=40.0), span(page, at, 1, 6, "ken word and more to read.", y=50.0), span(page, at + 1, 0, 7, None, kind="image", y=70.0), span(page, at + 2, 0, 8, str(97 + page), y=200.0)]
    return s


GOLDEN = {"blocks": "14-726a65887bcfb00b", "toc": "3-277ccf14784a9c76", "labels": "7-32364280adaea906", "articles": "3-13ee8e66be1f8fe5", "chunks": "3-1fe74981dc2ed845"}


def test_spans_to_chunks(spark):
    p = publication.register(publication.replace(publication.NUMBERED_PAGES, name="test", covers=(3, 0)))
    built = pipeline.build(spark.createDataFrame(issue(), schemas.SPANS), p)
    got = {r.article_id: r for r in built.articles.collect()}
    assert [(k, r.title, r.author, r.pdf_page_start, r.pdf_page_end) for k, r in sorted(got.items())] == [("j-2000-1-0", "The first one", "Ann", 4, 4), ("j-2000-1-1", "Second thoughts", "Bea", 5, 6), ("j-2000-1-2", "Third time", "Cyd", 7, 7)]
    assert got["j-2000-1-1"].full_text.startswith("Second thoughts\n\nText of page 5 with a broken word")
    assert built.unresolved.count() == 0
    chunks = built.chunks.collect()
    assert {c.article_id for c in chunks} == set(got) and all(c.embedding_text.endswith(c.text) for c in chunks)
    # the stages of this issue, as they have been since these digests were taken
    assert {n: digest(getattr(built, n)) for n in GOLDEN} == GOLDEN
    types = {(r.page, r.block_id): r.type for r in built.blocks.collect()}
    assert types[4, 0] == "title" and types[4, 1] == "body" and (4, 2) not in types


def test_a_raw_block_is_cut_where_the_size_jumps(spark):
    s = [span(1, 0, 0, 0, "tail of a review", y=10.0), span(1, 0, 1, 1, "Next heading", "Serifa-Bold", 15.0, y=20.0), span(1, 0, 1, 2, " goes on", "Serifa", 15.0, y=20.0)]
    got = layout.frames_of_spans(spark.createDataFrame(s, schemas.SPANS)).orderBy("pos").collect()
    assert [(r.text, r.size, r.font) for r in got] == [("tail of a review", 9.0, "Serifa"), ("Next heading goes on", 15.0, "Serifa-Bold")]


def test_issues_by_name(spark, tmp_path):
    for n in ("mag-2014-6.pdf", "mag-2015-1.PDF", "notes.pdf"):
        (tmp_path / n).write_bytes(b"%PDF")
    found, skipped = files.find_issues(spark, str(tmp_path), publication.ADAPTIVE)
    assert [(r.year, r.issue) for r in found.collect()] == [("2014", "6")] and skipped.count() == 1
    spans, errors = files.read_spans(found, "j", lambda content: iter([{"page": 1, "raw_block": 0, "kind": "text", "line": 0, "pos": 0, "text": content.decode(), "font": "F", "size": 9.0, "color": 0, "x0": 0.0, "y0": 0.0, "x1": 1.0, "y1": 1.0}]))
    assert [(r.year, r.text) for r in spans.collect()] == [("2014", "%PDF")] and errors.count() == 0

    def broken(content):
        raise ValueError("no page")

    spans, errors = files.read_spans(found, "j", broken)
    assert spans.count() == 0 and [r.error for r in errors.collect()] == ["ValueError: no page"]


def test_json_and_vectors(spark, tmp_path):
    import numpy as np

    df = spark.createDataFrame([("a", None), ("é", "x")], "chunk_id string, text string")
    files.write_lines(df, str(tmp_path / "l"))
    assert files.read_lines(spark, str(tmp_path / "l"), "chunk_id string, text string").count() == 2
    files.export_json(df, str(tmp_path / "one.json"))
    assert {"chunk_id": "é", "text": "x"} in json.loads((tmp_path / "one.json").read_text())
    assert files.read_json(spark, str(tmp_path / "one.json"), "chunk_id string, text string").count() == 2
    np.save(tmp_path / "v.npy", np.eye(3, dtype="float32"))
    (tmp_path / "i.json").write_text('["a", "b", "c"]')
    v = files.read_npy(spark, str(tmp_path / "v.npy"), str(tmp_path / "i.json"))
    assert {r.chunk_id: r.embedding for r in v.collect()}["b"] == [0.0, 1.0, 0.0]
    assert files.write_npy(v.where("chunk_id <> 'b'"), str(tmp_path / "w.npy"), str(tmp_path / "w.json")) == 2
    assert np.load(tmp_path / "w.npy").tolist() == [[1.0, 0.0, 0.0], [0.0, 0.0, 1.0]] and json.loads((tmp_path / "w.json").read_text()) == ["a", "c"]
    assert files.write_npy(v.limit(0), str(tmp_path / "w.npy"), str(tmp_path / "w.json")) == 0
    (tmp_path / "i.json").write_text('["a"]')
    with pytest.raises(ValueError):
        files.read_npy(spark, str(tmp_path / "v.npy"), str(tmp_path / "i.json"))


def test_tables_are_exchanged_or_stay(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    one, two = (spark.createDataFrame([(x,)], "x string") for x in ("one", "two"))
    files.replace_table(spark, one, path)
    files.replace_table(spark, spark.read.parquet(path).unionByName(two), path)  # reads what it replaces
    assert sorted(r.x for r in spark.read.parquet(path).collect()) == ["one", "two"]
    real = files._renamed

    def fails_at_the_second(fs, a, b):
        if b.getName() == "t":
            raise OSError("gone")
        real(fs, a, b)

    monkeypatch.setattr(files, "_renamed", fails_at_the_second)
    with pytest.raises(OSError):
        files.replace_table(spark, one, path)
    monkeypatch.undo()
    files.recover_table(spark, path)
    assert spark.read.parquet(path).count() == 2 and not (tmp_path / "t.old").exists()


def test_no_local_folder_on_a_cluster(spark):
    from inkwell import session

    class Context:
        master = "spark://host:7077"

        class _jsc:
            class _sc:
                class _dir:
                    @staticmethod
                    def isDefined():
                        return False

                @classmethod
                def getCheckpointDir(cls):
                    return cls._dir

            @classmethod
            def sc(cls):
                return cls._sc

        @staticmethod
        def getConf():
            return {}

    class Session:
        sparkContext = Context

        class conf:
            @staticmethod
            def get(name, default=None):
                return default

    with pytest.raises(ValueError):
        session.shared_dir(Session)


CHUNK = {"chunk_type": "body", "chunk_index": 0, "journal": "j", "year": "2000", "issue": "1", "article_id": "a", "title": "T", "page_start": 1, "page_end": 2}


def test_stream_of_chunks(spark, tmp_path):
    source, folder = tmp_path / "in", tmp_path / "index"
    source.mkdir()
    for n, rows in enumerate([[("a", "one"), ("b", "one")], [("b", "two"), ("c", "two")], [("b", "a third"), ("d", "new")]]):
        (source / f"{n}.json").write_text("\n".join(json.dumps(CHUNK | {"chunk_id": k, "text": t}) for k, t in rows))
        ingest.upsert_stream(spark, str(source), str(folder), str(tmp_path / "cp")).awaitTermination()
        if n == 1:
            assert {(r.chunk_id, r.text) for r in ingest.current(spark, str(folder)).collect()} == {("a", "one"), ("b", "two"), ("c", "two")}
            ingest.compact(spark, str(folder))
    want = {("a", "one"), ("b", "a third"), ("c", "two"), ("d", "new")}
    assert {(r.chunk_id, r.text) for r in ingest.current(spark, str(folder)).collect()} == want
    for _ in range(2):
        ingest.compact(spark, str(folder))
        assert {(r.chunk_id, r.text) for r in ingest.current(spark, str(folder)).collect()} == want
    assert ingest.current(spark, str(tmp_path / "nowhere")) is None


def test_digest(spark):
    a = spark.createDataFrame([(1, "x", [1]), (2, None, [])], "n int, t string, l array<int>")
    assert digest(a) == digest(a.orderBy("t").repartition(3).select("l", "t", "n"))
    assert digest(a) != digest(a.unionByName(a)) and digest(a) != digest(a.where("n = 1")) and digest(a.where("false")) == "0-0"
    assert digest(a.where("n = 2")) != digest(a.where("n = 2").withColumn("t", F.lit("")))


def test_command_line(spark, tmp_path, capsys, monkeypatch):
    monkeypatch.setattr(cli, "get_spark", lambda *a: spark)
    d = str(tmp_path)
    art = spark.createDataFrame([("a-1", "j", "2000", "1", "Moths", None, "1", 1, 2, 9, [], None, None, "Moths fly at night.", [(3, "Moths fly at night.")], "", [])], schemas.ARTICLES)
    art.write.parquet(f"{d}/corpus")
    cli.main(["build-chunks", "--input", f"{d}/corpus", "--output", f"{d}/chunks"])
    build = ["build-embeddings", "--input", f"{d}/chunks", "--output", f"{d}/vectors", "--checkpoint-every", "1", "--batch-size", "2"]
    for _ in range(2):  # the second run has nothing left to do
        cli.main(build)
    assert spark.read.parquet(f"{d}/vectors").count() == 1
    index.register_embedder("other", 3, lambda: lambda texts: [[1.0, 0.0, 0.0]] * len(texts))
    with pytest.raises(index.OtherModel):
        cli.main([*build, "--model", "other"])
    with pytest.raises(KeyError):
        cli.main([*build, "--model", "nobody knows it"])
    for _ in range(2):
        cli.main(["build-index", "--chunks", f"{d}/chunks", "--vectors", f"{d}/vectors", "--output", f"{d}/index"])
    assert spark.read.parquet(f"{d}/index").count() == 1
    common = ["--chunks", f"{d}/chunks", "--corpus", f"{d}/corpus", "--vectors", f"{d}/vectors", "--query", "moths at night"]
    cli.main(["context", *common])
    cli.main(["answer", *common, "--dry-run"])
    (tmp_path / "told.txt").write_text("Answer from the sources only.")
    publication.register(publication.replace(publication.ADAPTIVE, name="told", wording=publication.Wording(instructions=f"{d}/told.txt")))
    cli.main(["answer", *common, "--publication", "told"])
    cli.main(["query-index", "--index", f"{d}/index", "--query", "moths", "--year", "2000"])
    cli.main(["inspect-chunks", "--chunks", f"{d}/chunks"])
    cli.main(["quality-flags", "--corpus", f"{d}/corpus", "--chunks", f"{d}/chunks"])
    (tmp_path / "q.json").write_text('{"query_id": "1", "question": "moths at night", "expect": "Moths"}')
    cli.main(["compare-models", "--chunks", f"{d}/chunks", "--questions", f"{d}/q.json"])
    out = capsys.readouterr().out
    assert "Answer from the sources only.\n\n--- Source 1" in out and "PDF p. 3" in out and "Question: moths at night" in out and "a-1-chunk-0" in out and "hash\t1 of 1" in out
    # a changed text is embedded again, and the index takes the new vector
    changed = spark.read.parquet(f"{d}/chunks").withColumn("embedding_text", F.lit("Beetles"))
    changed.write.parquet(f"{d}/chunks2")
    cli.main([*build[:2], f"{d}/chunks2", *build[3:]])
    kept = spark.read.schema(schemas.KEPT_VECTORS).parquet(f"{d}/vectors")
    assert kept.count() == 2 and index.current_vectors(kept, changed).count() == 1


def test_answers_come_in_pieces(capsys):
    def ask(told, prompt, most):
        yield from ("Moths ", "fly", cli.End("length"))

    assert cli.stream_answer(ask, "", "", 10) == "length" and "length" in cli.NOTICES
    assert capsys.readouterr().out == "Moths fly\n"


def test_stages_by_command(spark, tmp_path, capsys, monkeypatch):
    """Stage by stage over tables gives what one run gives; a second run gives the same digests; one broken file stops nothing."""
    monkeypatch.setattr(cli, "get_spark", lambda *a: spark)
    publication.register(publication.replace(publication.NUMBERED_PAGES, name="stages", covers=(3, 0), title="j"))
    folder = tmp_path / "in"
    folder.mkdir()
    for n in ("mag-2000-1.pdf", "mag-2000-2.pdf", "mag-2000-10.pdf"):
        (folder / n).write_bytes(b"broken" if "-2." in n else b"%PDF")
    fields = ("page", "raw_block", "kind", "line", "pos", "text", "font", "size", "color", "x0", "y0", "x1", "y1")

    rows = [dict(zip(fields, s[3:])) for s in issue()]

    def parse(content):
        if content == b"broken":
            raise ValueError("no page")
        return iter(rows)

    real = files.read_spans
    monkeypatch.setattr(files, "read_spans", lambda issues, journal: real(issues, journal, parse))
    d, p = str(tmp_path), ["--publication", "stages"]
    for run in ("one", "two"):
        cli.main(["run-all", "--input", str(folder), "--output", f"{d}/{run}", *p])
    out = capsys.readouterr().out.splitlines()
    assert out[:2] == ["j-2000-1 3", "j-2000-10 3"] and "broken files: 1" in out and len({x for x in out if x.startswith("digest")}) == 1
    cli.main(["extract-blocks", "--input", str(folder), "--output", f"{d}/b", *p])
    cli.main(["create-toc", "--input", str(folder), "--output", f"{d}/t", "--toc-page", "2", *p])
    cli.main(["build-page-map", "--blocks", f"{d}/b", "--output", f"{d}/m", *p])
    tables = ["--blocks", f"{d}/b", "--toc", f"{d}/t", "--page-map", f"{d}/m"]
    cli.main(["assign-articles", *tables, "--output", f"{d}/a", "--issue", "10", *p])
    articles = {n: spark.read.schema(schemas.ARTICLES).parquet(f"{d}/{n}") for n in ("one/articles", "two/articles", "a")}
    assert digest(articles["one/articles"]) == digest(articles["two/articles"])
    assert digest(articles["a"]) == digest(articles["one/articles"].where("issue = '10'")) != "0-0"
    capsys.readouterr()
    cli.main(["diag-groups", *tables, *p])
    cli.main(["diag-pages", "--toc", f"{d}/t", "--page-map", f"{d}/m", *p])
    cli.main(["diag-spans", "--input", str(folder), "--first", "3", "--last", "3", *p])
    cli.main(["diag-toc", "--input", str(folder), "--first", "3", "--last", "3", *p])
    cli.main(["diag-text", "--blocks", f"{d}/b", "--needle", "BROKEN WORD", *p])
    cli.main(["inspect-fonts", "--blocks", f"{d}/b", *p])
    out = capsys.readouterr().out
    assert "The first one" in out and "broken word" in out and "Serifa-Bold" in out
