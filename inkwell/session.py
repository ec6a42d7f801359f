"""The Spark session and the shared folder for written intermediate tables."""

from __future__ import annotations

import atexit
import os
import re
import shutil
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def get_spark(app: str = "inkwell", cpus: int | None = None) -> SparkSession:
    """A local session for tests and the bench; on a cluster use the session that is there."""
    n = cpus or int(os.environ.get("BENCH_CPUS", "8"))
    spark = (
        SparkSession.builder.master(f"local[{n}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(n))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .getOrCreate()
    )
    ship(spark)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir; where it is unset, a local session (tests) gets one of its own.

    On a cluster a folder of one machine would be a different one for each process, so that is an error.
    """
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if named:
        if not sc._jsc.sc().getCheckpointDir().isDefined():
            sc.setCheckpointDir(named)
        return named
    if not sc._jsc.sc().getCheckpointDir().isDefined():
        if not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        own = tempfile.mkdtemp(prefix="inkwell-")
        atexit.register(shutil.rmtree, own, ignore_errors=True)
        sc.setCheckpointDir("file://" + own)
    return sc._jsc.sc().getCheckpointDir().get()


def scratch_table(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder, as a URI that every process can open; removed when the driver ends."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}")
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    fs.deleteOnExit(path)
    uri = fs.makeQualified(path).toUri().toString()
    return uri.replace("file:/", "file:///", 1) if uri.startswith("file:/") and not uri.startswith("file://") else uri


def cut(df: DataFrame) -> DataFrame:
    """df written once to the shared folder: lineage ends there and lost executors cost nothing."""
    shared_dir(df.sparkSession)
    return df.checkpoint()


def written(df: DataFrame, name: str = "rows") -> DataFrame:
    """df as a table in the shared folder: compressed, by columns, and read again only as far as it is used."""
    path = scratch_table(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ship(spark: SparkSession) -> None:
    """Gives the workers this package, once a session, for clusters where it isn't installed."""
    sc = spark.sparkContext
    if getattr(sc, "_inkwell_shipped", False):
        return
    root = Path(__file__).resolve().parent
    folder = tempfile.mkdtemp(prefix="inkwell-code-")  # on the driver, which serves it to the executors to the end
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    with zipfile.ZipFile(f"{folder}/inkwell.zip", "w") as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, f.relative_to(root.parent))
    sc.addPyFile(f"{folder}/inkwell.zip")
    sc._inkwell_shipped = True


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
