"""Problem 4: tokens per source, language and domain, kept up by signed deltas.

Three tables are the operator's state (class Budget). The count table holds one row per content and
tokenizer (hash of the text, fingerprint of the vocabulary -> tokens): a text is encoded only if no row
of it is there. The snapshot holds one small row per live document (key, slices, hashes of its texts).
A new snapshot is compared with the last one; documents that are new, changed or gone give deltas of +1
and -1, which are multiplied by the counts and added to the cube. Texts are never shuffled, only hashes:
those that have no count are told to the readers by a bitmap of bounded size. Where two hashes meet in it
a text is encoded for nothing and its count is left out, so the size changes no result.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from inkwell.llm.bitmaps import Bitmap
from inkwell.llm.tokenizing import TOKENIZER_DIR, encoder, fingerprint
from inkwell.session import scratch_table
from inkwell.sources.generations import Generations

COUNTS_SCHEMA = "content STRING, tokenizer STRING, n_tokens BIGINT"


def content_hash(text: Column) -> Column:
    """128 bits of a text as a string; null for a null text."""
    wide = F.concat(F.hex(F.xxhash64(text)), F.lit("-"), F.hex(F.xxhash64(F.lit(0x5BD1E995), text)))
    return F.when(text.isNotNull(), wide)


def language_key(lang: Column) -> Column:
    """The main part of a language tag in lower case ('en_GB' and 'EN' are 'en'); 'und' for null and blank."""
    main = F.lower(F.regexp_extract(F.trim(lang), "^([A-Za-z]+)", 1))
    return F.when(main.isNull() | (main == ""), F.lit("und")).otherwise(main)


def latest_snapshot(rows: DataFrame, key: str, version: str, slices: dict[str, Column], texts: Sequence[str]) -> DataFrame:
    """One row per key, of its greatest version: key, slices, and h_<text> for each text column.

    Rows of equal version that differ are ordered by their hashes, so the choice is the same each time.
    A null version is older than any other. Rows with a null key are left out.
    """
    hashes = [content_hash(F.col(c)).alias(f"h_{c}") for c in texts]
    small = rows.select(F.col(key).alias("k"), F.struct(F.col(version).alias("v"), *hashes, *[c.alias(n) for n, c in slices.items()]).alias("s"))
    best = small.where(F.col("k").isNotNull()).groupBy("k").agg(F.max("s").alias("s"))
    return best.select("k", *[F.col(f"s.h_{c}") for c in texts], *[F.col(f"s.{n}") for n in slices])


def unseen_contents(snapshot: DataFrame, texts: Sequence[str], known: DataFrame, tokenizer: str, folder: str = TOKENIZER_DIR) -> DataFrame:
    """(content) of the snapshot's texts that have no row in `known` for this tokenizer, each once."""
    contents = snapshot.select(F.explode(F.array(*[F.col(f"h_{c}") for c in texts])).alias("content")).where("content IS NOT NULL").distinct()
    return contents.join(known.where(F.col("tokenizer") == fingerprint(tokenizer, folder)).select("content"), "content", "left_anti")


def count_new(rows: DataFrame, texts: Sequence[str], unseen: DataFrame, tokenizer: str, folder: str = TOKENIZER_DIR, encoded=None) -> DataFrame:
    """Count rows (COUNTS_SCHEMA) of the contents in `unseen`, from whichever of the rows hold them.

    An empty text has 0 tokens. `unseen` is read several times. encoded, if given, is an accumulator that
    the number of encoded texts is added to.
    """
    mark = fingerprint(tokenizer, folder)
    first = F.conv(F.element_at(F.split("content", "-"), 1), 16, -10).cast("bigint").alias("h")
    held = Bitmap.of(unseen.select(first), "h", unseen.count())
    columns = [x for i, c in enumerate(texts) for x in (F.xxhash64(c).alias(f"h{i}"), F.xxhash64(F.lit(0x5BD1E995), c).alias(f"g{i}"), F.col(c).alias(f"t{i}"))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = encoder(tokenizer, folder).count
        for b in batches:
            done: dict[str, int] = {}
            for i in range(len(texts)):
                h, g, t = (b.column(3 * i + j) for j in range(3))
                wanted = held.has(h.to_numpy()) & t.is_valid().to_numpy(zero_copy_only=False)
                at = pa.array(np.nonzero(wanted)[0])
                for x, y, text in zip(*[c.take(at).to_numpy().view(np.uint64).tolist() for c in (h, g)], t.take(at).to_pylist()):
                    content = f"{x:X}-{y:X}"
                    if content not in done:
                        done[content] = count(text)
            if encoded is not None:
                encoded.add(len(done))
            yield pa.RecordBatch.from_arrays([pa.array(done.keys(), pa.string()), pa.array(done.values(), pa.int64())], names=["content", "n_tokens"])

    counted = rows.select(*columns).mapInArrow(run, "content STRING, n_tokens BIGINT").groupBy("content").agg(F.max("n_tokens").alias("n_tokens"))
    return counted.join(unseen, "content", "left_semi").select("content", F.lit(mark).alias("tokenizer"), "n_tokens")


def cube_deltas(before: DataFrame | None, after: DataFrame, counts: DataFrame, slices: Sequence[str], texts: Sequence[str]) -> DataFrame:
    """Signed sums by all slices together: n_docs and tokens_<text>.

    A document that is in both snapshots with the same hashes and slices gives nothing; a changed one
    gives -1 for its old state and +1 for its new one; a removed one gives -1.
    """
    cols = ["k", *[f"h_{c}" for c in texts], *slices]
    signed = after.select(*cols, F.lit(1).alias("sign"))
    if before is not None:
        both = signed.unionByName(before.select(*cols, F.lit(-1).alias("sign")))
        signed = both.groupBy(*cols).agg(F.sum("sign").alias("sign")).where("sign <> 0")
    # first sum the signs by content and slices, so that a text held by many documents is one row
    contents = signed.select(*slices, "sign", F.explode(F.array(*[F.struct(F.lit(c).alias("field"), F.col(f"h_{c}").alias("content")) for c in texts])).alias("s"))
    contents = contents.select(*slices, "sign", "s.field", "s.content").groupBy(*slices, "field", "content").agg(F.sum("sign").alias("sign"))
    found = contents.join(counts.select("content", "n_tokens"), "content", "left")
    tokens = F.col("sign") * F.coalesce(F.col("n_tokens"), F.lit(0))
    sums = found.groupBy(*slices).agg(
        F.coalesce(F.sum(F.when(F.col("field") == texts[0], F.col("sign"))), F.lit(0)).alias("n_docs"),
        *[F.coalesce(F.sum(F.when(F.col("field") == c, tokens)), F.lit(0)).alias(f"tokens_{c}") for c in texts],
    )
    return sums


def add_cubes(cubes: Sequence[DataFrame], slices: Sequence[str], texts: Sequence[str]) -> DataFrame:
    """The sum of cubes and deltas; slices that no document is left in go."""
    whole = cubes[0]
    for c in cubes[1:]:
        whole = whole.unionByName(c)
    sums = [F.sum(n).alias(n) for n in ("n_docs", *[f"tokens_{c}" for c in texts])]
    return whole.groupBy(*slices).agg(*sums).where("n_docs <> 0")


def by_each_slice(cube: DataFrame, slices: Sequence[str], texts: Sequence[str]) -> DataFrame:
    """(dimension, slice, n_docs, tokens_...) for each dimension alone; a null slice stays null."""
    arms = F.array(*[F.struct(F.lit(s).alias("dimension"), F.col(s).cast("string").alias("slice")) for s in slices])
    sums = [F.sum(n).alias(n) for n in ("n_docs", *[f"tokens_{c}" for c in texts])]
    flat = cube.select(F.explode(arms).alias("d"), "n_docs", *[f"tokens_{c}" for c in texts])
    return flat.groupBy("d.dimension", "d.slice").agg(*sums)


class Budget:
    """The state in a folder that all executors share, as generations: an update is whole or hasn't happened."""

    def __init__(self, spark: SparkSession, root: str, slices: dict[str, Column], texts: Sequence[str], tokenizer: str = "byte_bpe_50k", folder: str = TOKENIZER_DIR):
        self.spark, self.slices, self.texts, self.tokenizer, self.folder = spark, slices, list(texts), tokenizer, folder
        self.generations = Generations(spark, f"{root}/{fingerprint(tokenizer, folder)}")  # another vocabulary has a state of its own
        self.encoded = spark.sparkContext.accumulator(0)
        named = ", ".join(f"{n} STRING" for n in slices)
        self._snapshot = f"k STRING, {', '.join(f'h_{c} STRING' for c in self.texts)}, {named}"
        self._cube = f"{named}, n_docs BIGINT, {', '.join(f'tokens_{c} BIGINT' for c in self.texts)}"

    def _last(self, name: str, schema: str) -> DataFrame:
        n = self.generations.last()
        return self.generations.read(name, [n] if n else [], schema)

    def counts(self) -> DataFrame:
        return self.generations.read("counts", self.generations.closed(), COUNTS_SCHEMA)

    def snapshot(self) -> DataFrame:
        return self._last("snapshot", self._snapshot)

    def cube(self) -> DataFrame:
        """(slices, n_docs, tokens_...) of the documents as of the last update."""
        return self._last("cube", self._cube)

    def delta(self, n: int | None = None) -> DataFrame:
        """The signed change that update n, or the last one, made to the cube."""
        return self.generations.read("delta", [n or self.generations.last()], self._cube)

    def update(self, rows: DataFrame, key: str, version: str) -> int:
        """Brings the state to `rows`, which hold all live documents; gives the update's number.

        Only contents without a count are encoded, whichever documents they are in. Documents of the last
        snapshot that aren't in `rows` are removed ones.
        """
        g = self.generations
        n = g.last() + 1
        named = {s: c.cast("string") for s, c in self.slices.items()}
        g.write(n, snapshot=latest_snapshot(rows, key, version, named, self.texts).withColumn("k", F.col("k").cast("string")))
        snapshot = g.read("snapshot", [n], self._snapshot)
        g.write(n, unseen=unseen_contents(snapshot, self.texts, self.counts(), self.tokenizer, self.folder))
        g.write(n, counts=count_new(rows, self.texts, g.read("unseen", [n], "content STRING"), self.tokenizer, self.folder, self.encoded))
        counts = g.read("counts", [*g.closed(), n], COUNTS_SCHEMA)
        g.write(n, delta=cube_deltas(self.snapshot(), snapshot, counts, list(self.slices), self.texts))
        g.write(n, cube=add_cubes([self.cube(), g.read("delta", [n], self._cube)], list(self.slices), self.texts))
        g.close(n)
        return n


_TEXTS = ("text", "embedding_text")
_SLICES = ("journal", "language")


def _archive(chunks: DataFrame, root: str | None, tokenizer: str, folder: str) -> tuple[Budget, DataFrame]:
    """(a budget of chunks, the rows that had come by the middle of the time of delivery)."""
    spark = chunks.sparkSession
    budget = Budget(spark, root or scratch_table(spark, "budget"), {"journal": F.col("journal"), "language": language_key(F.col("lang"))}, _TEXTS, tokenizer, folder)
    at = F.col("ingested_at").cast("double")
    first, last = chunks.agg(F.min(at), F.max(at)).first()
    return budget, chunks.where(at.isNull() | (at <= ((first or 0.0) + (last or 0.0)) / 2))


def chunk_budget(chunks: DataFrame, journals: DataFrame, tokenizer: str = "byte_bpe_50k", folder: str = TOKENIZER_DIR, root: str | None = None) -> DataFrame:
    """Token totals of chunks in their latest state by journal, language and the journal's domain.

    With a `root` that holds the state of an earlier run the budget is brought up to these chunks by one
    update. Otherwise it is built as an archive's would be: one update with what had come by the middle of
    the time of delivery, and a second one with all of it, which counts only what is new.

    Null texts count nothing; a chunk of an unknown journal, or of one without a domain, is in the
    domain slice null; languages are told apart by the main part of their tag, null is 'und'.
    Repeated rows count once. No chunks give no rows.
    """
    budget, earlier = _archive(chunks, root, tokenizer, folder)
    if not budget.generations.last():
        budget.update(earlier, "chunk_id", "ingested_at")
    budget.update(chunks, "chunk_id", "ingested_at")
    domains = journals.groupBy(F.col("journal").alias("j")).agg(F.max("domain").alias("domain"))
    cube = budget.cube().join(domains, F.col("journal") == F.col("j"), "left").drop("j")
    return by_each_slice(cube, [*_SLICES, "domain"], _TEXTS)


def chunk_deltas(chunks: DataFrame, tokenizer: str = "byte_bpe_50k", folder: str = TOKENIZER_DIR, root: str | None = None) -> DataFrame:
    """(update_no, journal, language, n_docs, tokens_...): the signed changes of three updates.

    The first brings in what had come by the middle of the time of delivery, the second the rest and all
    changed states, the third takes the journal of the least name out of the archive.
    """
    budget, earlier = _archive(chunks, root, tokenizer, folder)
    least = chunks.agg(F.min("journal")).first()[0]
    out = None
    for rows in (earlier, chunks, chunks.where(~F.col("journal").eqNullSafe(F.lit(least)))):
        n = budget.update(rows, "chunk_id", "ingested_at")
        delta = budget.delta(n).select(F.lit(n).alias("update_no"), "*")
        out = delta if out is None else out.unionByName(delta)
    return out
