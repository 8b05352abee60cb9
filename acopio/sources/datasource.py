"""Person files as a Spark data source: ``spark.read.format("person_files")`` and, for files that go on arriving,
``spark.readStream.format("person_files")``, both with what a plain file reader lacks: files are dealt to tasks by their
bytes, and a stream's offset names the last file of each moment, so that files of one moment are neither lost nor read
twice. ``read_persons`` and ``stream_persons`` put a source's spec on top.

Options: ``path``, a folder or files on any file system that pyarrow knows (a URI, or a local path); ``bytes_per_task``
(default 64 MB).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition
from pyspark.sql.functions import udtf
from pyspark.sql.types import StructType

from .readers import CSV_ERRORS, csv_rows
from .specs import persons

SCHEMA = "url string, body binary"
_ROWS = pa.schema([("url", pa.string()), ("body", pa.binary())])


@dataclass
class Files(InputPartition):
    paths: list[str]


def _system(path: str) -> tuple[fs.FileSystem, str, str]:
    """The file system, the path in it, and what its paths begin with as URIs."""
    if "://" not in path and not path.startswith("file:"):
        return fs.LocalFileSystem(), path, "file:"
    system, inside = fs.FileSystem.from_uri(path)
    return system, inside, path[: len(path) - len(inside)] if path.endswith(inside) else ""


def _listed(path: str) -> list[tuple[int, str, int]]:
    """Time of change in nanoseconds, path and bytes of each file under path, in this order; files that are hidden or in
    a hidden folder, as those still being written, don't count."""
    system, inside, _ = _system(path)
    found = system.get_file_info(inside)
    infos = [found] if found.type == fs.FileType.File else system.get_file_info(fs.FileSelector(inside, recursive=True))
    shown = lambda i: not any(part.startswith((".", "_")) for part in i.path[len(inside) :].split("/"))
    return sorted((i.mtime_ns or 0, i.path, i.size or 0) for i in infos if i.type == fs.FileType.File and shown(i))


def _dealt(files: list[tuple[int, str, int]], most: int) -> list[Files]:
    """Files in tasks of about so many bytes; a larger file has a task of its own."""
    out, held = [], 0
    for _, path, size in files:
        if not out or held + size > most:
            out, held = [*out, Files([])], 0
        out[-1].paths.append(path)
        held += size
    return out


def _bodies(path: str, part: Files) -> Iterator[pa.RecordBatch]:
    system, _, prefix = _system(path)
    for p in part.paths:
        with system.open_input_stream(p) as f:
            yield pa.RecordBatch.from_arrays([pa.array([prefix + p]), pa.array([f.read()], pa.binary())], schema=_ROWS)


class _Reader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.path, self.most = options["path"], int(options.get("bytes_per_task", 64 << 20))

    def partitions(self) -> list[Files]:
        return _dealt(_listed(self.path), self.most) or [Files([])]

    def read(self, partition: Files) -> Iterator[pa.RecordBatch]:
        return _bodies(self.path, partition)


class _StreamReader(DataSourceStreamReader):
    """An offset is the time of change and the path of the last file there is, in the order of both; it hangs on the
    folder alone, so a restart goes on where the checkpoint says. A file must not change after it is listed, nor arrive
    with a time before one already taken: writers move finished files in."""

    def __init__(self, options: dict[str, str]):
        self.path, self.most = options["path"], int(options.get("bytes_per_task", 64 << 20))

    def initialOffset(self) -> dict:
        return {"time": -1, "path": ""}

    def latestOffset(self) -> dict:
        files = _listed(self.path)
        return {"time": files[-1][0], "path": files[-1][1]} if files else self.initialOffset()

    def partitions(self, start: dict, end: dict) -> list[Files]:
        first, last = ((o["time"], o["path"]) for o in (start, end))
        return _dealt([f for f in _listed(self.path) if first < f[:2] <= last], self.most) or [Files([])]

    def read(self, partition: Files) -> Iterator[pa.RecordBatch]:
        return _bodies(self.path, partition)


class PersonFiles(DataSource):
    @classmethod
    def name(cls) -> str:
        return "person_files"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> DataSourceReader:
        return _Reader(dict(self.options))

    def streamReader(self, schema: StructType) -> DataSourceStreamReader:
        return _StreamReader(dict(self.options))


@udtf(returnType="nth int, record map<string,string>")
class CsvPeople:
    """``SELECT * FROM files, LATERAL csv_people(body, 'NOMBRE')``: the records of a CSV file whose header is searched for,
    as csv_records finds it; a file that can't be read gives none."""

    def eval(self, body: bytes | None, marker: str | None) -> Iterator[tuple[int, dict[str, str]]]:
        try:
            yield from csv_rows(body or b"", marker)
        except CSV_ERRORS:
            return


def register(spark: SparkSession) -> None:
    """Makes ``person_files`` and ``csv_people`` known to a session."""
    spark.dataSource.register(PersonFiles)
    spark.udtf.register("csv_people", CsvPeople)


def read_persons(spark: SparkSession, path: str, source: str, profile: str = "pipeline") -> DataFrame:
    """The persons of a source's files under path."""
    register(spark)
    return persons(spark.read.format("person_files").option("path", path).load(), source, profile)


def stream_persons(spark: SparkSession, path: str, source: str, profile: str = "pipeline", **options: str) -> DataFrame:
    """The persons of files as they arrive."""
    register(spark)
    return persons(spark.readStream.format("person_files").options(path=path, **options).load(), source, profile)
