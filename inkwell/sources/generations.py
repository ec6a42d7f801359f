"""Tables of a folder that change together: numbered generations, of which the last closed one holds.

A generation is written whole and then closed by an empty file beside it, through Hadoop's file system, so
the folder may be any that all executors share. A run that fails leaves no mark and what held goes on to hold.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


class Generations:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.root).getFileSystem(spark._jsc.hadoopConfiguration())

    def closed(self) -> list[int]:
        """Numbers of the closed generations, ascending."""
        found = self._fs.globStatus(self._path(f"{self.root}/_closed-*"))
        return sorted(int(f.getPath().getName().removeprefix("_closed-")) for f in found or [])

    def last(self) -> int:
        """0 before the first."""
        return max(self.closed(), default=0)

    def at(self, n: int, name: str) -> str:
        return f"{self.root}/{n}/{name}"

    def write(self, n: int, **tables: DataFrame) -> None:
        """Writes the tables of generation n; one that was left open by a failure is written again."""
        for name, df in tables.items():
            df.write.mode("overwrite").parquet(self.at(n, name))

    def close(self, n: int) -> None:
        self._fs.create(self._path(f"{self.root}/_closed-{n}"), True).close()

    def read(self, name: str, numbers: list[int], schema: str) -> DataFrame:
        """The rows of all these generations together; none of them, no rows."""
        paths = [self.at(n, name) for n in numbers if self._fs.exists(self._path(self.at(n, name)))]
        reader = self.spark.read.schema(schema)
        return reader.parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def drop(self, n: int) -> None:
        self._fs.delete(self._path(f"{self.root}/_closed-{n}"), False)
        self._fs.delete(self._path(f"{self.root}/{n}"), True)
