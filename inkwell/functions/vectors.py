"""Vector arithmetic on arrays in double precision, and a hashing embedder without a model."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from inkwell.functions.text import words

#: Prefixes that some models want before a query and before a passage. Fixed values.
PREFIXES = {"intfloat/multilingual-e5-small": ("query: ", "passage: "), "intfloat/multilingual-e5-base": ("query: ", "passage: "), "intfloat/multilingual-e5-large": ("query: ", "passage: ")}


def model_slug(model: str) -> str:
    """A model's name as a folder's."""
    return model.replace("/", "__")


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def norm(a: Column) -> Column:
    return F.sqrt(F.aggregate(a, F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))


def cosine(a: Column, b: Column) -> Column:
    """Null if a vector has no length."""
    return F.try_divide(dot(a, b), norm(a) * norm(b))


def prefixed(text: Column, model: str, query: bool) -> Column:
    pair = PREFIXES.get(model, ("", ""))
    return F.concat(F.lit(pair[0 if query else 1]), text)


def hash_embedding(text: Column, dim: int = 64) -> Column:
    """Counts of words by hash bucket, of length 1; zeros for a text without words. Deterministic.

    A word's bucket is the first 32 bits of its MD5, which every engine has, modulo the dimension.
    """
    buckets = F.transform(words(F.lower(text)), lambda w: (F.conv(F.substring(F.md5(w), 1, 8), 16, 10).cast("bigint") % dim).cast("int"))
    held = F.struct(buckets.alias("b"), F.size(buckets).alias("n"))

    def counted(x: Column) -> Column:
        # array_remove runs without a lambda per element
        return F.array(*[(x["n"] - F.size(F.array_remove(x["b"], i))).cast("double") for i in range(dim)])

    def scaled(c: Column) -> Column:
        return F.transform(c["c"], lambda x: F.coalesce(F.try_divide(x, c["l"]), F.lit(0.0)).cast("float"))

    counts = F.transform(F.array(held), counted)
    measured = F.transform(counts, lambda c: F.struct(c.alias("c"), norm(c).alias("l")))
    return F.get(F.transform(measured, scaled), F.lit(0))
