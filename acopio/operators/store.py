"""Tables kept in buckets by the hash of a key, in versions: a change rewrites the buckets that it touches, nothing else.

A version is one small file that says, for each bucket of each table, which version wrote it. It appears by a rename after
all its data is there, so readers see all of a change or nothing, several tables change together, and a change that is
run again under its number does nothing. Bytes written follow the change: with buckets of about a thousand rows, a
thousand times its rows at most."""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from . import upsert


@dataclass(frozen=True)
class Kept:
    """A table's key and columns."""

    key: str
    schema: StructType


class Store:
    def __init__(self, spark: SparkSession, path: str, tables: dict[str, Kept], buckets: int = 64):
        self.spark, self.path, self.tables, self.buckets = spark, path.rstrip("/"), tables, buckets

    def _at(self, *parts: str):
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path("/".join((self.path, *parts)))
        return path, path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def _names(self, *parts: str) -> list[str]:
        path, system = self._at(*parts)
        return sorted(s.getPath().getName() for s in system.listStatus(path)) if system.exists(path) else []

    def versions(self) -> list[int]:
        return [int(n[:-5]) for n in self._names("versions") if n.endswith(".json") and not n.startswith(".")]

    def _manifest(self, version: int | None) -> dict[str, dict[str, int]]:
        """table -> bucket -> the version that wrote it."""
        if version is None:
            return {name: {} for name in self.tables}
        path, system = self._at("versions", f"{version:020}.json")
        stream = system.open(path)
        try:
            return json.loads(self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def latest(self) -> int | None:
        return max(self.versions(), default=None)

    def bucket(self, key: str) -> Column:
        return F.pmod(F.xxhash64(F.col(key)), F.lit(self.buckets)).cast("int")

    def touched(self, name: str, keys: DataFrame, column: str) -> list[int]:
        """The buckets of a table that hold keys (in a column); as many numbers as there are buckets, at most."""
        return sorted(r[0] for r in keys.select(self.bucket(column)).distinct().collect())

    def read(self, name: str, only: list[int] | None = None, version: int | None = None) -> DataFrame:
        """A table, or some buckets of it, as of the latest version or another one."""
        held = self._manifest(self.latest() if version is None else version)[name]
        paths = [f"{self.path}/{name}/v={v}/_bucket={b}" for b, v in held.items() if only is None or int(b) in set(only)]
        schema = self.tables[name].schema
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def commit(self, version: int, changes: dict[str, tuple[DataFrame, list[int]]]) -> None:
        """changes: for each table that changes the new content of its touched buckets, and which these are."""
        if version in self.versions():
            return
        held = self._manifest(self.latest())
        for name, (rows, touched) in changes.items():
            kept = self.tables[name]
            out = rows.select(*(F.col(f.name).cast(f.dataType) for f in kept.schema)).withColumn("_bucket", self.bucket(kept.key))
            out.repartition("_bucket").write.mode("overwrite").partitionBy("_bucket").parquet(f"{self.path}/{name}/v={version}")
            for b in touched:
                held[name].pop(str(b), None)
            held[name] |= {n.removeprefix("_bucket="): version for n in self._names(name, f"v={version}") if n.startswith("_bucket=")}
        path, system = self._at("versions", f".{uuid.uuid4().hex}")
        stream = system.create(path)
        try:
            stream.write(bytearray(json.dumps(held).encode()))
        finally:
            stream.close()
        system.rename(path, self._at("versions", f"{version:020}.json")[0])

    def vacuum(self, keep: int = 2) -> None:
        """Forgets all versions but the last ones, and deletes buckets that none of those has."""
        versions = sorted(self.versions())
        last = versions[-keep:]
        used = {(name, v, b) for n in last for name, held in self._manifest(n).items() for b, v in held.items()}
        for n in versions[:-keep]:
            path, system = self._at("versions", f"{n:020}.json")
            system.delete(path, False)
        for name in self.tables:
            for folder in (v for v in self._names(name) if v.startswith("v=") and int(v[2:]) <= last[-1]):
                for b in (b for b in self._names(name, folder) if b.startswith("_bucket=")):
                    if (name, int(folder[2:]), b.removeprefix("_bucket=")) not in used:
                        path, system = self._at(name, folder, b)
                        system.delete(path, True)


class PersonStore:
    """Persons in buckets by id, and an index in buckets by key of who holds which id number, and which name and place. A
    batch reads the buckets of its keys and of the rows that these lead to, and writes those that change."""

    def __init__(self, spark: SparkSession, path: str, schema: StructType, buckets: int = 64):
        index = StructType.fromDDL("key string, kind int, id string")
        self.store = Store(spark, path, {"rows": Kept("id", schema), "keys": Kept("key", index)}, buckets)

    def read(self) -> DataFrame:
        return self.store.read("rows")

    @staticmethod
    def _index(rows: DataFrame) -> DataFrame:
        """key, kind, id: the keys of rows beside their ids."""
        held = rows.select("id", *(F.nullif(c, F.lit("")).alias(a) for c, a in (("cedula", "c"), ("nombre", "n"), ("hospital", "h"))))
        return upsert.keys(held, F.col("id").alias("own")).filter("kind > 0").select("key", "kind", F.col("own").alias("id"))

    def load(self, table: DataFrame, version: int = 0) -> None:
        every = list(range(self.store.buckets))
        self.store.commit(version, {"rows": (table, every), "keys": (self._index(table), every)})

    def upsert(self, batch: DataFrame, arrival: str, now: Column, version: int, scratch) -> DataFrame | None:
        """Applies a batch as a version and gives what became of its records; nothing if the version is there already."""
        store = self.store
        if version in store.versions():
            return None
        records = scratch.write(upsert.ready(batch, arrival, [f.name for f in store.tables["rows"].schema]), "incoming")
        sought = upsert.keys(records.select("id", F.col("cedula").alias("c"), F.col("nombre").alias("n"), F.col("hospital").alias("h"))).distinct()
        near = store.read("keys", store.touched("keys", sought.filter("kind > 0"), "key")).join(sought, ["key", "kind"], "left_semi").select("id")
        near = scratch.write(near.union(records.select("id")).distinct(), "near-ids")
        known = store.read("rows", store.touched("rows", near, "id")).join(near, "id", "left_semi")
        known = scratch.write(known, "near-rows")
        rows, outcomes = upsert.upserted(known, records, "arrival", now)
        rows = scratch.write(rows.drop("is_new"), "changed")
        outcomes = scratch.write(outcomes, "outcomes")
        touched = store.touched("rows", rows, "id")
        after = store.read("rows", touched).join(rows.select("id"), "id", "left_anti").unionByName(rows)
        gone, come = self._index(known.join(rows.select("id"), "id", "left_semi")), self._index(rows)
        moved = scratch.write(gone.exceptAll(come).withColumn("come", F.lit(False)).unionByName(come.exceptAll(gone).withColumn("come", F.lit(True))), "moved")
        indexed = store.touched("keys", moved, "key")
        held = store.read("keys", indexed).join(moved.filter("not come"), ["key", "kind", "id"], "left_anti").unionByName(moved.filter("come").drop("come"))
        store.commit(version, {"rows": (after, touched), "keys": (held, indexed)})
        return outcomes


#: Checksums of a batch that are sent to every task; more are shuffled.
SMALL_BATCH = 1_000_000


class SeenStore:
    """The registry of contents (checksum, first_seen) in buckets by checksum. A batch reads the buckets of its checksums
    and writes those in which it has new ones; what is known is neither read as a whole nor shuffled."""

    def __init__(self, spark: SparkSession, path: str, buckets: int = 64):
        self.store = Store(spark, path, {"seen": Kept("checksum", StructType.fromDDL("checksum string, first_seen long"))}, buckets)

    def read(self) -> DataFrame:
        return self.store.read("seen")

    def load(self, known: DataFrame, version: int = 0) -> None:
        self.store.commit(version, {"seen": (known, list(range(self.store.buckets)))})

    def known_of(self, checksums: DataFrame) -> DataFrame:
        """Those of checksums (checksum, once each) that are known."""
        held = self.store.read("seen", self.store.touched("seen", checksums, "checksum")).select("checksum")
        few = checksums.limit(SMALL_BATCH + 1).count() <= SMALL_BATCH
        return held.join(checksums.hint("broadcast") if few else checksums, "checksum", "left_semi")

    def sift(self, pages: DataFrame, arrival: str, version: int, scratch) -> DataFrame:
        """arrival, checksum, is_new of pages (arrival, checksum): not known and the first of the batch. New ones are known
        from then on, as a version; a version that is there already changes nothing."""
        if version in self.store.versions():
            raise ValueError(f"version {version} is there already")
        first = scratch.write(pages.groupBy("checksum").agg(F.min(arrival).alias("first_seen")), "first")
        new = scratch.write(first.join(self.known_of(first.select("checksum")), "checksum", "left_anti"), "new")
        touched = self.store.touched("seen", new, "checksum")
        after = self.store.read("seen", touched).unionByName(new.withColumn("first_seen", F.col("first_seen").cast("long")))
        self.store.commit(version, {"seen": (after, touched)})
        return pages.join(new.select("checksum", F.col("first_seen").alias("_first")), "checksum", "left").select(arrival, "checksum", F.coalesce(F.col(arrival) == F.col("_first"), F.lit(False)).alias("is_new"))
