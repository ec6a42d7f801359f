"""Files in and out: issues by name, JSON, JSON lines, vectors, and PDF pages by an adapter."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inkwell.plans.publication import Publication
from inkwell.sources import schemas


def find_issues(spark: SparkSession, folder: str, publication: Publication, glob: str = "*.pdf") -> tuple[DataFrame, DataFrame]:
    """((path, year, issue) of the files whose name fits the publication, paths of those whose name doesn't).

    A pattern with one group gives the issue and an empty year. Contents are not read.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(folder).select("path", F.element_at(F.split("path", "/"), -1).alias("name"))
    p = "(?i)" + publication.files
    fits = F.col("name").rlike(p)
    import re

    if re.compile(p).groups >= 2:
        year, issue = F.regexp_extract("name", p, 1), F.regexp_extract("name", p, 2)
    else:
        year, issue = F.lit(""), F.regexp_extract("name", p, 1)
    return files.where(fits).select("path", year.alias("year"), issue.alias("issue")), files.where(~fits).select("path")


def read_json(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Whole files that are one array or object."""
    return spark.read.schema(schema).option("multiLine", True).json(path)


def read_lines(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).json(path)


def write_lines(df: DataFrame, path: str, partition_by: tuple[str, ...] = ()) -> None:
    """Null fields are left out."""
    df.write.mode("overwrite").partitionBy(*partition_by).json(path)


def write_table(df: DataFrame, path: str, partition_by: tuple[str, ...] = ("journal",)) -> None:
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)


def replace_table(spark: SparkSession, df: DataFrame, path: str) -> None:
    """df in place of the table at path, which df may read: written beside it whole, then exchanged by renaming.

    The old table is moved aside before the new one takes its place and deleted only then. Where a run
    ended in between, the next one puts back what is there (see recover_table) before it begins.
    """
    recover_table(spark, path)
    new = f"{path}.new"
    df.write.mode("overwrite").parquet(new)
    fs, p = _fs(spark, path)
    if fs.exists(p(path)):
        _renamed(fs, p(path), p(f"{path}.old"))
    _renamed(fs, p(new), p(path))
    fs.delete(p(f"{path}.old"), True)


def recover_table(spark: SparkSession, path: str) -> None:
    """Ends an exchange that was broken off: the old table comes back if no table is there, else it goes."""
    fs, p = _fs(spark, path)
    old = p(f"{path}.old")
    if fs.exists(old):
        if fs.exists(p(path)):
            fs.delete(old, True)
        else:
            _renamed(fs, old, p(path))


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path
    return p(path).getFileSystem(spark._jsc.hadoopConfiguration()), p


def _renamed(fs, a, b) -> None:
    if not fs.rename(a, b):
        raise OSError(f"{a.toString()} could not be renamed to {b.toString()}")


def export_json(df: DataFrame, path: str) -> None:
    """One JSON array in one local file, streamed row by row through the driver; for exchange, not for scale."""
    with open(path, "w", encoding="utf-8") as f:
        f.write("[")
        for i, row in enumerate(df.toJSON().toLocalIterator()):
            f.write((",\n" if i else "\n") + row)
        f.write("\n]\n")


def read_npy(spark: SparkSession, npy: str, ids: str) -> DataFrame:
    """Vectors of a matrix file and its list of ids (JSON); an error if their lengths differ.

    Tasks open both files themselves, so they lie where every executor can open them.
    """
    import numpy as np

    n = len(np.load(npy, mmap_mode="r"))
    if len(_names(ids)) != n:
        raise ValueError(f"{len(_names(ids))} ids for {n} vectors")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, names = np.load(npy, mmap_mode="r"), _names(ids)
        for b in batches:
            at = b.column(0).to_numpy()
            if len(at):
                part = rows[at].astype("float32")
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(at) + 1, dtype=np.int32) * part.shape[1]), pa.array(part.ravel()))
                yield pa.RecordBatch.from_arrays([pa.array([names[i] for i in at]), lists], names=["chunk_id", "embedding"])

    return spark.range(0, n, 1, spark.sparkContext.defaultParallelism).mapInArrow(run, schemas.VECTORS)


def _names(path: str) -> list[str]:
    import json

    with open(path, encoding="utf-8") as f:
        return json.load(f)


def write_npy(vectors: DataFrame, npy: str, ids: str) -> int:
    """Vectors as a matrix file with its list of ids, in the order of ids, row by row through the driver; the number of rows.

    For exchange: what is kept for further work is a table. Vectors of different lengths are an error.
    """
    import json

    import numpy as np

    n = vectors.count()
    names: list[str] = []
    matrix = None
    for r in vectors.select("chunk_id", "embedding").orderBy("chunk_id").toLocalIterator():
        if matrix is None:
            matrix = np.lib.format.open_memmap(npy, "w+", np.float32, (n, len(r.embedding)))
        matrix[len(names)] = r.embedding
        names.append(r.chunk_id)
    if matrix is None:
        np.save(npy, np.zeros((0, 0), np.float32))
    else:
        matrix.flush()
    with open(ids, "w", encoding="utf-8") as f:
        json.dump(names, f, ensure_ascii=False)
    return n


def pymupdf_spans(content: bytes) -> Iterator[dict]:
    """Spans of a PDF, where the package fitz is installed; pages count from 1."""
    import fitz

    with fitz.open(stream=content, filetype="pdf") as doc:
        for page_no, page in enumerate(doc, 1):
            pos = 0
            for raw_block, block in enumerate(page.get_text("dict")["blocks"]):
                key = {"page": page_no, "raw_block": raw_block}
                if block["type"] != 0:
                    yield key | dict(zip(("x0", "y0", "x1", "y1"), block["bbox"])) | {"kind": "image", "pos": pos}
                    pos += 1
                for line_no, line in enumerate(block.get("lines", ())):
                    box = dict(zip(("x0", "y0", "x1", "y1"), line["bbox"]))
                    for span in line["spans"]:
                        yield key | box | {"kind": "text", "line": line_no, "pos": pos, "text": span["text"], "font": span["font"], "size": span["size"], "color": span["color"]}
                        pos += 1


def read_spans(issues: DataFrame, journal: str, parse: Callable[[bytes], Iterator[dict]] = pymupdf_spans) -> tuple[DataFrame, DataFrame]:
    """(SPANS, (path, error)) of find_issues' rows: one file at a time; a broken file is an error row and stops nothing.

    The files are listed and read by the executors; the driver knows their folders only.
    """
    spark = issues.sparkSession
    folders = [r[0] for r in issues.select(F.regexp_replace("path", "/[^/]*$", "")).distinct().collect()]
    paths = spark.read.format("binaryFile").load(folders).select("path", "content").join(issues, "path") if folders else issues.withColumn("content", F.lit(None).cast("binary"))
    schema = schemas.SPANS + ", path STRING, error STRING"
    kinds = {"STRING": pa.string(), "INT": pa.int32(), "DOUBLE": pa.float64()}
    fields = pa.schema([(name, kinds[kind]) for name, kind in (c.split() for c in schema.split(", "))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in b.to_pylist():
                key = {"journal": journal, "year": r["year"], "issue": r["issue"], "path": r["path"]}
                try:
                    rows = [key | s for s in parse(r["content"])]
                except Exception as e:  # whatever a parser meets in a file
                    rows = [key | {"error": f"{type(e).__name__}: {e}"}]
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema=fields)

    all_rows = paths.mapInArrow(run, schema)
    return all_rows.where("error IS NULL").drop("path", "error"), all_rows.where("error IS NOT NULL").select("path", "error")
