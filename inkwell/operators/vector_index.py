"""An inverted index of vectors: lists by nearest centroid, of which a question reads a few.

Vectors of length 1 are put in the list of their nearest centroid; lists are the partitions of a table, so a
question reads the files of its lists only. An exact search reads, besides the nearest lists, all those that
may hold something nearer than what was found: a list's members lie within its radius of its centroid.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from inkwell.operators import retrieval

#: Vectors that centroids are fitted on, about so many or 32 a list; all vectors are indexed.
SAMPLE = 16_384
MOST_LISTS = 4_096
#: Lists that a question reads if it needn't be exact.
PROBES = 16
_LISTS = "list INT, centroid ARRAY<DOUBLE>, radius DOUBLE, n BIGINT"


def _unit(lists: pa.ListArray, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """(places of the vectors that have `dim` components and a length, these at length 1)."""
    begin, sizes = lists.offsets.to_numpy()[:-1], np.diff(lists.offsets.to_numpy())
    at = np.nonzero((sizes == dim) & np.asarray(lists.is_valid()))[0]
    m = lists.values.to_numpy(zero_copy_only=False).astype(np.float64)[begin[at][:, None] + np.arange(dim)[None]]
    length = np.sqrt((m * m).sum(1))
    ok = length > 0
    return at[ok], m[ok] / length[ok, None]


def centroids_of(points: np.ndarray, k: int, rounds: int = 10, seed: int = 3) -> np.ndarray:
    """k centroids by Lloyd's algorithm; one that loses all its points begins again at a far one."""
    distinct = np.unique(points, axis=0)
    if len(distinct) <= k:
        return distinct
    centres = distinct[np.random.default_rng(seed).choice(len(distinct), k, replace=False)]
    for _ in range(rounds):
        gap = _squares(points, centres)
        near = gap.argmin(1)
        sums, n = np.zeros_like(centres), np.bincount(near, minlength=k)
        np.add.at(sums, near, points)
        centres = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], centres)
        lost = np.nonzero(n == 0)[0]
        centres[lost] = points[gap.min(1).argsort()[::-1][: len(lost)]]
    return centres


def _squares(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.maximum((a * a).sum(1)[:, None] + (b * b).sum(1)[None] - 2 * a @ b.T, 0)


def build(vectors: DataFrame, path: str, dim: int = 64, lists: int | None = None, sample: int = SAMPLE) -> None:
    """Writes the index of vectors (chunk_id, embedding, and whatever a search may ask for) to path.

    Null vectors, those of another dimension, without length, or with nulls or NaN are in no list. The
    number of lists, if not given, is the root of the number of vectors.
    """
    spark = vectors.sparkSession
    whole = vectors.where(F.size("embedding") == dim)
    n = whole.count()
    k = lists or int(min(MOST_LISTS, max(1, round(n**0.5))))
    chance = min(1.0, max(sample, 32 * k) / max(n, 1))
    drawn = whole.where(F.pmod(F.xxhash64("chunk_id"), F.lit(1_000_000)) < int(chance * 1_000_000) + 1).select(F.col("embedding").cast("array<double>")).toArrow()
    points = _unit(drawn.column(0).combine_chunks(), dim)[1] if len(drawn) else np.zeros((0, dim))
    centres = centroids_of(points[~np.isnan(points).any(1)], k) if len(points) else points
    schema = f"{', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in vectors.schema)}, list INT, gap DOUBLE"

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at, m = _unit(b.column(b.num_columns - 1), dim)
            ok = ~np.isnan(m).any(1)
            at, m = at[ok], m[ok]
            if len(at) and len(centres):
                gap = _squares(m, centres)
                near = gap.argmin(1)
                held = b.take(pa.array(at))
                yield pa.RecordBatch.from_arrays([*held.columns[:-1], pa.array(near.astype(np.int32)), pa.array(np.sqrt(gap[np.arange(len(at)), near]))], names=[*b.schema.names[:-1], "list", "gap"])

    assigned = whole.withColumn("_v", F.col("embedding").cast("array<double>")).mapInArrow(assign, schema)
    # a list's rows lie in few files; one of a large share of all rows is cut by the hash of its ids
    assigned.repartition("list", F.pmod(F.xxhash64("chunk_id"), F.lit(4))).write.mode("overwrite").partitionBy("list").parquet(f"{path}/vectors")
    kept = spark.read.schema(schema).parquet(f"{path}/vectors").groupBy("list").agg(F.max("gap").alias("radius"), F.count(F.lit(1)).alias("n"))
    known = spark.createDataFrame([(i, c.tolist()) for i, c in enumerate(centres)], "list INT, centroid ARRAY<DOUBLE>")
    kept.join(F.broadcast(known), "list").select("list", "centroid", "radius", "n").write.mode("overwrite").parquet(f"{path}/lists")  # at most MOST_LISTS


def search(spark: SparkSession, path: str, queries: DataFrame, top_n: int = retrieval.TOP_N, where: Column | None = None, probes: int = PROBES, exact: bool = False) -> DataFrame:
    """(query_id, rank, chunk_id, distance), as retrieval.search gives it, from the lists nearest to each query.

    With exact it gives the same rows; else those of the `probes` nearest lists. Queries are taken in
    blocks; of a block only what concerns its lists is read.
    """
    kind = queries.schema["query_id"].dataType.simpleString()
    known = spark.read.schema(_LISTS).parquet(f"{path}/lists").orderBy("list").collect()  # at most MOST_LISTS
    if not known:
        return spark.createDataFrame([], f"query_id {kind}, rank INT, chunk_id STRING, distance DOUBLE")
    numbers, radius = np.array([r.list for r in known], dtype=np.int64), np.array([r.radius for r in known])
    centres = np.array([r.centroid for r in known])
    rows = spark.read.parquet(f"{path}/vectors")
    rows = (rows if where is None else rows.where(where)).select(F.col("chunk_id").cast("string"), F.col("embedding").cast("array<double>"), "list")
    found = spark.createDataFrame([], f"query_id {kind}, chunk_id STRING, distance DOUBLE")
    few = queries.select("query_id", "embedding").toLocalIterator()
    while block := list(itertools.islice(few, retrieval.BLOCK)):
        asked = [(r.query_id, np.array(r.embedding, dtype=np.float64)) for r in block if r.embedding is not None and len(r.embedding) == centres.shape[1] and None not in r.embedding]
        asked = [(i, v / np.sqrt((v * v).sum())) for i, v in asked if (v * v).sum() > 0]
        if not asked:
            continue
        q = np.array([v for _, v in asked])
        gap = np.sqrt(_squares(q, centres))
        order = gap.argsort(1)[:, :probes]
        visited = np.zeros(gap.shape, bool)
        np.put_along_axis(visited, order, True, 1)
        ids = spark.createDataFrame([(n, i) for n, (i, _) in enumerate(asked)], f"q INT, query_id {kind}")
        near = _best(_of_lists(rows, q, visited, numbers, top_n), top_n)
        if exact:
            reach = np.full(len(asked), np.inf)
            for r in near.where(F.col("rank") == top_n).select("q", "distance").collect():  # one a query of the block
                reach[r.q] = np.sqrt(2 * max(r.distance, 0) + 4e-9) + 1e-7
            more = ~visited & (gap - radius[None] <= reach[:, None])
            near = _best(near.drop("rank").unionByName(_of_lists(rows, q, more, numbers, top_n)), top_n)
        found = found.unionByName(near.join(F.broadcast(ids), "q").select("query_id", "chunk_id", "distance"))
    place = F.row_number().over(Window.partitionBy("query_id").orderBy("distance", "chunk_id"))
    return found.select("query_id", place.alias("rank"), "chunk_id", "distance")


def _best(rows: DataFrame, top_n: int) -> DataFrame:
    return rows.withColumn("rank", F.row_number().over(Window.partitionBy("q").orderBy("distance", "chunk_id"))).where(F.col("rank") <= top_n)


def _of_lists(rows: DataFrame, q: np.ndarray, wanted: np.ndarray, numbers: np.ndarray, top_n: int) -> DataFrame:
    """(q, chunk_id, distance): the best of each batch in the lists that a query wants."""
    lists = np.nonzero(wanted.any(0))[0]
    askers = {int(numbers[c]): np.nonzero(wanted[:, c])[0] for c in lists}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            of, names = b.column(2).to_numpy(), np.array(b.column(0).to_pylist(), dtype=object)
            at, m = _unit(b.column(1), q.shape[1])
            held: list[tuple] = []
            for c in np.unique(of[at]).tolist():
                inside = of[at] == c
                who, ids = askers[c], names[at[inside]]
                distance = np.round(1 - q[who] @ m[inside].T, 9) + 0.0
                k = min(top_n, distance.shape[1])
                least = np.partition(distance, k - 1, axis=1)[:, k - 1]
                i, j = np.nonzero(distance <= least[:, None])
                held.append((who[i], ids[j], distance[i, j]))
            if held:
                n, ids, d = (np.concatenate(x) for x in zip(*held))
                order = np.lexsort((ids.astype(str), d, n))
                n, ids, d = n[order], ids[order], d[order]
                kept = np.arange(len(n)) - np.searchsorted(n, n) < top_n
                yield pa.RecordBatch.from_arrays([pa.array(n[kept].astype(np.int32)), pa.array(ids[kept], pa.string()), pa.array(d[kept])], names=["q", "chunk_id", "distance"])

    return rows.where(F.col("list").isin([int(numbers[c]) for c in lists])).mapInArrow(run, "q INT, chunk_id STRING, distance DOUBLE")
