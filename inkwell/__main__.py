"""python -m inkwell COMMAND: the stages of an archive and the tools, over tables in folders."""

from __future__ import annotations

import argparse
import sys
import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inkwell.functions import templates
from inkwell.operators import articles, chunking, diagnose, evaluate, index, page_map, retrieval, typography, vector_index
from inkwell.plans import pipeline, publication
from inkwell.session import get_spark, written
from inkwell.sources import files, schemas


def _read(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A Parquet folder, or JSON lines where the name says so."""
    if path.endswith((".jsonl", ".json")):
        return files.read_lines(spark, path, schema)
    return spark.read.schema(schema).parquet(path)


def _questions(spark: SparkSession, text: str, model: str) -> DataFrame:
    q = spark.createDataFrame([(1, text)], "query_id INT, question STRING")
    return index.embed(q, "question", model, query=True).select("query_id", "question", "embedding")


def _context(spark: SparkSession, a: argparse.Namespace) -> tuple[DataFrame, DataFrame]:
    p = publication.get(a.publication)
    chunks, corpus = _read(spark, a.chunks, schemas.CHUNKS), _read(spark, a.corpus, schemas.ARTICLES)
    q = _questions(spark, a.query, a.model)
    index.check_model(spark.read.schema(schemas.KEPT_VECTORS).parquet(a.vectors), a.model, index.embedding_dim(a.model))
    vectors = index.current_vectors(spark.read.schema(schemas.KEPT_VECTORS).parquet(a.vectors), chunks)
    hits = retrieval.search(vectors, q, a.top_n)
    return retrieval.context_blocks(hits, chunks, corpus, p, a.window, a.promote_threshold), q


def _issues(spark: SparkSession, a: argparse.Namespace, p: publication.Publication) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(spans, files whose name doesn't fit, files that couldn't be read) of a folder."""
    issues, skipped = files.find_issues(spark, a.input, p)
    spans, errors = files.read_spans(issues, a.journal_name or p.title or p.name)
    return written(spans, "spans"), skipped, errors


def _at_issue(df: DataFrame, a: argparse.Namespace) -> DataFrame:
    for c in ("year", "issue"):
        if getattr(a, c) is not None:
            df = df.where(F.col(c) == F.lit(str(getattr(a, c))))
    return df


def run_all(spark, a):
    """All stages of a folder of issues; what can't be read is listed and stops nothing."""
    p = publication.get(a.publication)
    spans, skipped, errors = _issues(spark, a, p)
    built = pipeline.build(spans, p, a.skip_first, a.skip_last)
    for name in ("blocks", "toc", "labels", "articles", "chunks", "unresolved"):
        files.write_table(getattr(built, name), f"{a.output}/{name}")
    by_issue = built.articles.groupBy("journal", "year", "issue").agg(F.count(F.lit(1)).alias("articles"))
    for r in by_issue.orderBy("journal", "year", *templates.issue_order(F.col("issue"))).toLocalIterator():
        print("-".join(x for x in (r.journal, r.year, r.issue) if x), r.articles)
    for name, df in (("skipped files", skipped), ("broken files", errors), ("unresolved entries", built.unresolved)):
        print(f"{name}: {df.count()}")
    print("digest:", diagnose.digest(built.chunks))


def extract_blocks(spark, a):
    """Issues to typed blocks."""
    p = publication.get(a.publication)
    spans, _, errors = _issues(spark, a, p)
    files.write_table(pipeline.blocks_of_spans(spans, p), a.output)
    print("broken files:", errors.count())


def create_toc(spark, a):
    """Issues to contents entries; pages count from 0 and are separated by commas."""
    p = publication.get(a.publication)
    if a.toc_page is not None:
        p = publication.replace(p, contents=publication.replace(p.contents, pages=tuple(int(x) for x in a.toc_page.split(","))))
    spans, _, errors = _issues(spark, a, p)
    files.write_table(pipeline.contents_of_spans(spans, p), a.output)
    print("broken files:", errors.count())


def build_page_map(spark, a):
    """Blocks to the pages that printed labels lead to."""
    blocks = _read(spark, a.blocks, schemas.BLOCKS)
    p = publication.get(a.publication)
    files.write_table(page_map.page_map(blocks, p), a.output)
    print("pages without a label:", page_map.unlabelled_pages(blocks, p).count())


def assign_articles(spark, a):
    """Blocks, contents and page labels to articles, of all issues or of one."""
    blocks, toc, labels = (_at_issue(_read(spark, path, schema), a) for path, schema in ((a.blocks, schemas.BLOCKS), (a.toc, schemas.TOC), (a.page_map, schemas.LABELS)))
    files.write_table(articles.assemble(blocks, toc, labels, publication.get(a.publication)), a.output)
    print("unresolved entries:", articles.unresolved(toc, labels).count())


def build_chunks(spark, a):
    out = chunking.chunk_articles(_read(spark, a.input, schemas.ARTICLES), publication.get(a.publication), None, a.skip_first, a.skip_last)
    out.write.mode("overwrite").parquet(a.output)
    evaluate.counts_by(spark.read.parquet(a.output), "chunk_type").show()


def build_embeddings(spark, a):
    """Only chunks without a vector of their text are embedded; a run that was stopped goes on where it was.

    With checkpoint-every so many chunks are embedded and kept at a time.
    """
    chunks = _read(spark, a.input, schemas.CHUNKS)
    found = index.exists(spark, a.output)
    kept = spark.read.schema(schemas.KEPT_VECTORS).parquet(a.output) if found else spark.createDataFrame([], schemas.KEPT_VECTORS)
    index.check_model(kept, a.model, index.embedding_dim(a.model))
    todo = written(index.pending(chunks, kept), "pending")
    n = todo.count()
    parts = -(-n // a.checkpoint_every) if a.checkpoint_every else min(n, 1)
    began = time.monotonic()
    for i in range(parts):
        one = todo.where(F.pmod(F.xxhash64("chunk_id"), F.lit(parts)) == i)
        index.embedded(one, a.model, max_tokens=a.max_tokens, batch_size=a.batch_size).write.mode("append").parquet(a.output)
        spent = time.monotonic() - began
        print(f"{i + 1} of {parts} parts of {n} chunks, {spent * (parts - i - 1) / (i + 1):.0f} s left")


def build_index(spark, a):
    files.recover_table(spark, a.output)
    chunks = _read(spark, a.chunks, schemas.CHUNKS)
    vectors = index.current_vectors(spark.read.schema(schemas.KEPT_VECTORS).parquet(a.vectors), chunks)
    rows = index.metadata(chunks).join(vectors, "chunk_id")
    if not a.overwrite and index.exists(spark, a.output):
        rows = index.upserted(spark.read.parquet(a.output), rows)
    files.replace_table(spark, rows, a.output)
    vector_index.build(spark.read.parquet(a.output), f"{a.output}.lists", index.embedding_dim(a.model))


def context(spark, a):
    blocks, _ = _context(spark, a)
    for r in blocks.orderBy("block_no").toLocalIterator():
        text = r.text if not a.preview_chars else r.text[: a.preview_chars]
        print(f"--- {r.mode}, {r.n_hits} hits, distance {r.best_distance:.3f} ---\n{r.citation}\n\n{text}\n")


def answer(spark, a):
    """The prompt of a question; a language model is reached through a function registered in ANSWERERS.

    The publication's instructions, if it names any, are what the model is told before the sources.
    """
    blocks, q = _context(spark, a)
    p = publication.get(a.publication)
    (r,) = retrieval.prompts(blocks, q, p).collect()
    told = p.wording.read_instructions() if p.wording.instructions else ""
    if a.dry_run or a.llm_model not in ANSWERERS:
        print("\n\n".join(x for x in (f"about {r.est_tokens} tokens", told, r.prompt) if x))
        return
    end = stream_answer(ANSWERERS[a.llm_model], told, r.prompt, a.max_tokens)
    if end in NOTICES:
        print(NOTICES[end], file=sys.stderr)


def stream_answer(ask: Callable[[str, str, int], Iterator[str | End]], told: str, prompt: str, max_tokens: int) -> str:
    """Prints what a model says as it comes; gives how it ended."""
    end = ""
    for part in ask(told, prompt, max_tokens):
        if isinstance(part, End):
            end = part.reason
        else:
            print(part, end="", flush=True)
    print()
    return end


@dataclass(frozen=True)
class End:
    """The last thing an answerer yields: 'done', 'refused' or 'length'."""

    reason: str


NOTICES = {"refused": "The model has refused to answer.", "length": "The answer was cut at the greatest length; raise --max-tokens."}
#: model -> function of instructions, a prompt and the most tokens, which yields pieces of text and then an End.
ANSWERERS: dict[str, Callable[[str, str, int], Iterator[str | End]]] = {}


def query_index(spark, a):
    ix = spark.read.parquet(a.index)
    where = F.lit(True)
    if a.year is not None:
        where = where & (F.col("year") == a.year)
    if a.chunk_type:
        where = where & (F.col("chunk_type") == a.chunk_type)
    hits = vector_index.search(spark, f"{a.index}.lists", _questions(spark, a.query, a.model), a.top_n, where, a.probes, a.exact)
    hits.join(ix.drop("embedding"), "chunk_id").orderBy("rank").select("rank", "distance", "chunk_id", "title", F.left("text", F.lit(200)).alias("text")).show(a.top_n, False)


def check_embeddings(spark, a):
    rows = _read(spark, a.vectors, schemas.VECTORS).join(_read(spark, a.chunks, schemas.CHUNKS).select("chunk_id", "article_id"), "chunk_id")
    evaluate.separation(evaluate.sampled_pairs(rows, a.pairs, a.seed)).show(truncate=False)
    print("ids in one of the two only:", index.misaligned(_read(spark, a.chunks, schemas.CHUNKS), _read(spark, a.vectors, schemas.VECTORS)).count())


def _show(df: DataFrame, *order) -> None:
    """All rows, one a line, streamed through the driver."""
    print("\t".join(df.columns))
    for r in (df.orderBy(*order) if order else df).toLocalIterator():
        print("\t".join("" if x is None else str(x) for x in r))


def compare_models(spark, a):
    """How often each model finds the title expected of a question, and in how many seconds."""
    chunks = written(_read(spark, a.chunks, schemas.CHUNKS).select("chunk_id", "title", "embedding_text"), "chunks")
    questions = _read(spark, a.questions, "query_id STRING, question STRING, expect STRING")
    for m in a.models.split(","):
        began = time.monotonic()
        (r,) = evaluate.compare_models(chunks, questions, {m: index.embedding_dim(m)}, a.top_n).collect()
        print(f"{r.model}\t{r.found} of {r.n}\t{r.rate}\t{time.monotonic() - began:.1f} s")


def inspect_chunks(spark, a):
    c = _read(spark, a.chunks, schemas.CHUNKS)
    _show(evaluate.length_stats(c), "chunk_type")
    _show(evaluate.length_histogram(c), "chunk_type", "bucket")
    _show(evaluate.counts_by(c, "year"), "year")
    _show(evaluate.duplicate_ids(c), "chunk_id")
    _show(evaluate.hash_sample(c, "chunk_id", a.samples, a.seed))


def inspect_fonts(spark, a):
    b = written(_read(spark, a.blocks, schemas.BLOCKS), "blocks")
    _show(typography.style_histogram(b).orderBy(F.desc("chars")).limit(a.top))
    _show(typography.style_samples(b, a.samples), "journal", "year", "issue", "family", "size", "bold", "no")
    _show(typography.suggested_rules(b), "journal", "year", "issue")
    _show(typography.footer_candidates(b), "journal", "place")
    _show(typography.numbered_pages(b), "journal")


def quality_flags(spark, a):
    c = _read(spark, a.corpus, schemas.ARTICLES)
    _show(evaluate.flag_counts(c), F.desc("n"))
    _show(evaluate.flags_by_issue(c), "issue_label", "flag")
    _show(evaluate.issue_health(c), "issue_label")
    _show(evaluate.flagged_titles(c), "title")
    if a.chunks is not None:
        _show(evaluate.flagged_share(c, _read(spark, a.chunks, schemas.CHUNKS)))


def diag_groups(spark, a):
    """What the entries of each start page have to share."""
    blocks, toc, labels = (_at_issue(_read(spark, path, schema), a) for path, schema in ((a.blocks, schemas.BLOCKS), (a.toc, schemas.TOC), (a.page_map, schemas.LABELS)))
    entries = written(articles.ranges(articles.resolved(toc, labels), page_map.last_pages(blocks)), "entries")
    _show(diagnose.group_view(blocks, entries, publication.get(a.publication)), "journal", "year", "issue", "group_no")


def diag_pages(spark, a):
    """Entries whose label leads nowhere, and labels near by that do."""
    toc, labels = _at_issue(_read(spark, a.toc, schemas.TOC), a), _read(spark, a.page_map, schemas.LABELS)
    _show(articles.unresolved(toc, labels), "journal", "year", "issue", "toc_pos")
    _show(page_map.nearby_labels(toc, labels), "journal", "year", "issue", "toc_pos", "delta")


def diag_spans(spark, a):
    """Spans of some pages, as they are typeset."""
    spans, _, _ = _issues(spark, a, publication.get(a.publication))
    _show(diagnose.span_view(spans, a.first, a.last), "journal", "year", "issue", "page", "pos")


def diag_toc(spark, a):
    """Spans of some pages, as contents are read from them."""
    p = publication.get(a.publication)
    spans, _, _ = _issues(spark, a, p)
    _show(diagnose.contents_view(spans.where(F.col("page").between(a.first, a.last)), p), "journal", "year", "issue", "page", "pos")


def diag_text(spark, a):
    """Blocks that hold a string."""
    _show(typography.lines_with(_read(spark, a.blocks, schemas.BLOCKS), a.needle).select("journal", "year", "issue", "page", "block_id", "text"), "journal", "year", "issue", "page", "block_id")


def main(argv: list[str] | None = None) -> None:
    top = argparse.ArgumentParser(prog="inkwell")
    sub = top.add_subparsers(dest="command", required=True)

    def add(f, *options: str, **defaults):
        s = sub.add_parser(f.__name__.replace("_", "-"), help=f.__doc__)
        for o in options:
            s.add_argument(f"--{o}", required=o.replace("-", "_") not in defaults, default=defaults.get(o.replace("-", "_")), type=type(defaults[o.replace("-", "_")]) if defaults.get(o.replace("-", "_")) is not None else (int if o in ("skip-first", "skip-last", "max-tokens") or (o == "year" and f is query_index) else str))
        s.add_argument("--publication", default="adaptive", choices=publication.available())
        s.set_defaults(run=f)
        return s

    for stream in (sys.stdout, sys.stderr):
        if hasattr(stream, "reconfigure"):
            stream.reconfigure(encoding="utf-8", errors="replace")
    skips = {"skip_first": None, "skip_last": None}
    search = {"top_n": retrieval.TOP_N, "window": retrieval.WINDOW, "promote_threshold": retrieval.PROMOTE, "model": "hash"}
    add(run_all, "input", "output", "journal-name", "skip-first", "skip-last", journal_name=None, **skips)
    add(build_chunks, "input", "output", "skip-first", "skip-last", **skips)
    folder = {"journal_name": None}
    one = {"year": None, "issue": None}
    add(extract_blocks, "input", "output", "journal-name", **folder)
    add(create_toc, "input", "output", "journal-name", "toc-page", toc_page=None, **folder)
    add(build_page_map, "blocks", "output")
    add(assign_articles, "blocks", "toc", "page-map", "output", "year", "issue", **one)
    add(build_embeddings, "input", "output", "model", "batch-size", "checkpoint-every", "max-tokens", model="hash", batch_size=32, checkpoint_every=0, max_tokens=None)
    add(build_index, "chunks", "vectors", "output", "model", model="hash").add_argument("--overwrite", action="store_true")
    add(diag_groups, "blocks", "toc", "page-map", "year", "issue", **one)
    add(diag_pages, "toc", "page-map", "year", "issue", **one)
    add(diag_spans, "input", "journal-name", "first", "last", first=1, last=8, **folder)
    add(diag_toc, "input", "journal-name", "first", "last", first=1, last=8, **folder)
    add(diag_text, "blocks", "needle")
    add(compare_models, "chunks", "questions", "models", "top-n", models="hash", top_n=5)
    add(context, "chunks", "corpus", "vectors", "query", "top-n", "window", "promote-threshold", "model", "preview-chars", preview_chars=0, **search)
    add(answer, "chunks", "corpus", "vectors", "query", "top-n", "window", "promote-threshold", "model", "llm-model", "max-tokens", llm_model="", max_tokens=8000, **search).add_argument("--dry-run", action="store_true")
    add(query_index, "index", "query", "year", "chunk-type", "top-n", "model", "probes", year=None, chunk_type=None, top_n=5, model="hash", probes=vector_index.PROBES).add_argument("--exact", action="store_true")
    add(check_embeddings, "chunks", "vectors", "pairs", "seed", pairs=2000, seed=42)
    add(inspect_chunks, "chunks", "samples", "seed", samples=5, seed=0)
    add(inspect_fonts, "blocks", "top", "samples", top=20, samples=20)
    add(quality_flags, "corpus", "chunks", chunks=None)
    a = top.parse_args(argv)
    spark = get_spark("inkwell " + a.command)
    spark.sparkContext.setLogLevel("ERROR")
    a.run(spark, a)


if __name__ == "__main__":
    main()
