"""Tables written between the phases of a job, in the folder that all executors share."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_FREE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_own_dir: list[str] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir. Where none is named a local master gets a temporary one, as in tests; a
    cluster must name one, as its executors do not see each other's folders."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    if not re.fullmatch(r"local(\[[^-]*\])?", spark.sparkContext.master):
        raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    if not _own_dir:
        _own_dir.append("file://" + tempfile.mkdtemp(prefix="acopio-"))
    return _own_dir[0]


def shuffled(df: DataFrame) -> DataFrame:
    """df, to be joined without being sent to every task: Spark takes a written table, and all that is derived from it row
    by row, to be as large as its compressed files, so it would gather millions of rows in the driver."""
    return df.hint("merge")


class Scratch:
    """Tables of one run: they cut lineage and outlive lost executors. Its folder goes when the driver ends."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.root = spark, f"{shared_dir(spark).rstrip('/')}/acopio/{name}-{uuid.uuid4().hex}"
        path, system = self._at("")
        system.mkdirs(path)
        system.deleteOnExit(path)  # results are read lazily, so their tables must outlive the call

    def write(self, df: DataFrame, name: str) -> DataFrame:
        """Runs df once, frees its shuffle files and gives the table to read."""
        path, schema = f"{self.root}/{name}", df.schema
        with self.freeing():
            df.write.option("compression", "zstd").mode("overwrite").parquet(path)
        return self.spark.read.schema(schema).parquet(path)

    @contextmanager
    def freeing(self) -> Iterator[None]:
        before = self.spark.conf.get(_FREE, None)
        self.spark.conf.set(_FREE, "true")
        try:
            yield
        finally:
            if before is None:
                self.spark.conf.unset(_FREE)
            else:
                self.spark.conf.set(_FREE, before)

    def drop(self, name: str) -> None:
        """Deletes a table that nothing reads any more."""
        path, system = self._at(name)
        system.delete(path, True)

    def _at(self, name: str) -> tuple:
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}".rstrip("/"))
        return path, path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
