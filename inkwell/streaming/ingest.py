"""New chunks as a stream into the index: an extension, with upserts per micro-batch."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from inkwell.operators.common import latest
from inkwell.sources import schemas
from inkwell.sources.generations import Generations

_DELTA = schemas.CHUNKS + ", came_at TIMESTAMP, generation BIGINT"


def upsert_stream(spark: SparkSession, source: str, index: str, checkpoint: str, file_format: str = "json", compact_every: int = 50) -> StreamingQuery:
    """Reads CHUNKS files as they arrive in `source` and upserts them into the index at `index`.

    A batch writes its own rows only, as a generation; one that is repeated after a failure writes the
    same generation again. Of rows of one chunk_id in a batch that of the youngest file is taken, of equal
    ones the last by text. Every compact_every batches the generations become one table, so a chunk is
    rewritten once in so many batches. Both folders may be any that all executors share.
    """
    rows = spark.readStream.schema(schemas.CHUNKS).format(file_format).load(source).withColumn("came_at", F.col("_metadata.file_modification_time"))

    def write(batch: DataFrame, batch_id: int) -> None:
        g = Generations(batch.sparkSession, index)
        n = batch_id + 1
        new = latest(batch.withColumn("_v", F.struct("came_at", "text")), ["chunk_id"], "_v").select(*batch.columns)
        g.write(n, delta=new.withColumn("generation", F.lit(n).cast("bigint")))
        g.close(n)
        if n % compact_every == 0:
            compact(batch.sparkSession, index)

    return rows.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def _state(spark: SparkSession, index: str) -> tuple[int, DataFrame | None]:
    """(the last closed generation, the newest row of each chunk); what was compacted is read from there."""
    g, whole = Generations(spark, index), Generations(spark, f"{index}/whole")
    base = whole.last()
    later = [n for n in g.closed() if n > base]
    if not later and not base:
        return 0, None
    rows = g.read("delta", later, _DELTA)
    if base:
        rows = whole.read("rows", [base], _DELTA).unionByName(rows)
    newest = F.row_number().over(Window.partitionBy("chunk_id").orderBy(F.desc("generation")))
    return max([base, *later]), rows.withColumn("_n", newest).where("_n = 1").drop("_n")


def compact(spark: SparkSession, index: str) -> None:
    """The generations so far as one table. It holds once it is closed; what it replaces is dropped after that."""
    last, now = _state(spark, index)
    g, whole = Generations(spark, index), Generations(spark, f"{index}/whole")
    if now is not None and last > whole.last():
        whole.write(last, rows=now)
        whole.close(last)
    for n in g.closed():
        if n <= last:
            g.drop(n)
    for n in whole.closed()[:-1]:
        whole.drop(n)


def current(spark: SparkSession, index: str) -> DataFrame | None:
    """The index as of its last whole batch; None before the first."""
    _, now = _state(spark, index)
    return None if now is None else now.drop("came_at", "generation")


def windowed_counts(events: DataFrame, window: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """Rows per window and type of a stream or table of events (ts, event_type), late rows up to `late`."""
    return events.withWatermark("ts", late).groupBy(F.window("ts", window).alias("w"), "event_type").agg(F.count(F.lit(1)).alias("n")).select(F.col("w.start").alias("window_start"), "event_type", "n")
