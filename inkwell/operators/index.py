"""The vector index: pending work, upserts by id, metadata, and checks of alignment."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from inkwell.functions.vectors import hash_embedding, prefixed


def metadata(chunks: DataFrame) -> DataFrame:
    """Chunks as the index keeps them: issue and year as numbers, title and author never null.

    A year or issue that is no number is null.
    """
    def number(c: str) -> Column:
        return F.nullif(F.col(c), F.lit("")).try_cast("int").alias(c)

    def text(c: str) -> Column:
        return F.coalesce(F.col(c), F.lit("")).alias(c)

    return chunks.select("chunk_id", "chunk_type", "chunk_index", "journal", number("issue"), number("year"), "article_id", text("title"), text("author"), "page_start", "page_end", "text")


def pending(chunks: DataFrame, vectors: DataFrame) -> DataFrame:
    """Chunks that have no vector yet: what a resumed run has left to do.

    Where vectors hold text_hash (see text_hash), a chunk whose text has changed since is pending too.
    """
    if "text_hash" in vectors.columns:
        c = chunks.withColumn("text_hash", text_hash(F.col("embedding_text")))
        return c.join(vectors.select("chunk_id", "text_hash").distinct(), ["chunk_id", "text_hash"], "left_anti").select(*chunks.columns)
    return chunks.join(vectors.select("chunk_id").distinct(), "chunk_id", "left_anti")


def text_hash(text: Column) -> Column:
    return F.sha2(F.coalesce(text, F.lit("")), 256)


def truncation_report(embedded: DataFrame, samples: int = 5) -> DataFrame:
    """(n, n_truncated, ids): how many texts were cut, and some of their ids, the least ones."""
    few = embedded.where("truncated").orderBy("chunk_id").limit(samples).agg(F.array_sort(F.collect_list("chunk_id")).alias("ids"))
    return embedded.agg(F.count(F.lit(1)).alias("n"), F.count_if("truncated").alias("n_truncated")).join(F.broadcast(few), F.lit(True))


def upserted(old: DataFrame, new: DataFrame, key: str = "chunk_id") -> DataFrame:
    """old with the rows of new in place of those of the same key; rows that new doesn't name stay."""
    return old.join(new.select(key).distinct(), key, "left_anti").unionByName(new)


def misaligned(chunks: DataFrame, vectors: DataFrame) -> DataFrame:
    """(chunk_id, side): ids that only one of the two holds."""
    a, b = chunks.select("chunk_id").distinct(), vectors.select("chunk_id").distinct()
    return a.join(b, "chunk_id", "left_anti").withColumn("side", F.lit("chunks")).unionByName(b.join(a, "chunk_id", "left_anti").withColumn("side", F.lit("vectors")))


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a table was written to the end at path, on whatever file system it is."""
    p = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


#: model -> (dimension, function of a list of texts to an array of vectors of length 1), made once a worker.
EMBEDDERS: dict[str, tuple[int, Callable[[], Callable[[list[str]], np.ndarray]]]] = {}


def register_embedder(name: str, dim: int, load: Callable[[], Callable[[list[str]], np.ndarray]]) -> None:
    EMBEDDERS[name] = (dim, load)


def embedding_dim(model: str, hash_dim: int = 64) -> int:
    """The dimension of a model; an error for one that isn't registered."""
    if model == "hash":
        return hash_dim
    if model not in EMBEDDERS:
        raise KeyError(f"no model {model!r}; there are hash, {', '.join(sorted(EMBEDDERS))}")
    return EMBEDDERS[model][0]


class OtherModel(ValueError):
    """Vectors of one table are of one model and dimension."""


def check_model(vectors: DataFrame, model: str, dim: int) -> None:
    """An error if the table holds vectors of another model or dimension than a run is about to add."""
    other = vectors.where(~(F.col("model").eqNullSafe(F.lit(model)) & F.col("dim").eqNullSafe(F.lit(dim)))).select("model", "dim").first()
    if other is not None:
        raise OtherModel(f"the table holds vectors of {other.model!r} with {other.dim} components, not of {model!r} with {dim}")


def current_vectors(vectors: DataFrame, chunks: DataFrame) -> DataFrame:
    """(chunk_id, embedding): of chunks as they are now, one vector each; those of texts that have changed or gone are left out."""
    now = chunks.select("chunk_id", text_hash(F.col("embedding_text")).alias("text_hash"))
    return vectors.join(now, ["chunk_id", "text_hash"], "left_semi").groupBy("chunk_id").agg(F.first("embedding").alias("embedding"))


def embedded(chunks: DataFrame, model: str = "hash", dim: int = 64, max_tokens: int | None = None, batch_size: int = 32) -> DataFrame:
    """VECTORS rows of chunks: with the model, its dimension and the hash of the text, by which a run can be gone on with."""
    size = embedding_dim(model, dim)
    e = embed(chunks, model=model, dim=dim, max_tokens=max_tokens, batch_size=batch_size)
    return e.select("chunk_id", "embedding", text_hash(F.col("embedding_text")).alias("text_hash"), F.lit(model).alias("model"), F.lit(size).alias("dim"))


def within_tokens(text: Column, most: int) -> tuple[Column, Column]:
    """(the text cut after `most` tokens, whether it was cut). Tokens are words and single marks, as no model's own are at hand."""
    taken = F.regexp_extract(text, rf"(?U)^(?:\s*(?:\w+|[^\w\s])){{0,{most}}}", 0)
    rest = F.substring(text, F.length(taken) + 1, F.length(text))
    cut = rest.rlike(r"(?U)\S")
    return F.when(cut, taken).otherwise(text), cut


def embed(rows: DataFrame, text_col: str = "embedding_text", model: str = "hash", query: bool = False, dim: int = 64, max_chars: int | None = None, max_tokens: int | None = None, batch_size: int = 32) -> DataFrame:
    """rows with embedding ARRAY<FLOAT> and truncated BOOLEAN.

    The prefix that the model wants goes before the text, then texts over max_tokens or max_chars are
    cut. A registered model that names a limit of its own (an attribute max_tokens and a method cut(text,
    most) of what is loaded) cuts by its own tokens. Model 'hash' needs no Python; registered models run
    on Arrow batches, batch_size texts at a time, loaded once per worker.
    """
    embedding_dim(model, dim)
    text = prefixed(F.coalesce(F.col(text_col), F.lit("")), model, query)
    cut = F.lit(False)
    if max_tokens is not None:
        text, cut = within_tokens(text, max_tokens)
    if max_chars is not None:
        text, cut = F.left(text, F.lit(max_chars)), cut | (F.length(text) > max_chars)
    rows = rows.withColumns({"truncated": cut, "_t": text})
    if model == "hash":
        return rows.withColumn("embedding", hash_embedding(F.col("_t"), dim)).drop("_t")
    load = EMBEDDERS[model][1]

    @F.pandas_udf("array<float>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encode = load()
        own = getattr(encode, "max_tokens", None)
        for b in batches:
            texts = b.tolist() if own is None else [encode.cut(t, own) for t in b]
            parts = [np.asarray(encode(texts[i : i + batch_size]), dtype=np.float32) for i in range(0, len(texts), batch_size)]
            yield pd.Series([v for p in parts for v in p])

    return rows.withColumn("embedding", run(F.col("_t"))).drop("_t")


def sentence_transformer(name: str, dim: int) -> None:
    """Registers a model of the package sentence_transformers, where it is installed, with the dimension it has."""
    def load():
        from sentence_transformers import SentenceTransformer

        model = SentenceTransformer(name)
        if model.get_sentence_embedding_dimension() != dim:
            raise ValueError(f"{name!r} has vectors of {model.get_sentence_embedding_dimension()} components, not of {dim}")

        class Encode:
            max_tokens = model.max_seq_length

            def cut(self, text: str, most: int) -> str:
                ids = model.tokenizer(text, truncation=True, max_length=most, add_special_tokens=True)["input_ids"]
                return model.tokenizer.decode(ids, skip_special_tokens=True)

            def __call__(self, texts: list[str]):
                return model.encode(texts, batch_size=len(texts) or 1, normalize_embeddings=True)

        return Encode()

    register_embedder(name, dim, load)
