"""Incremental ingestion: pages once by hash, and guarded merges of each micro-batch. A scheduler starts runs with the
availableNow trigger; the checkpoint holds what was read."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.types import StructType

from ..operators.content import checksum
from ..operators.merge import folded
from ..operators.store import PersonStore, Store
from ..plans.scratch import Scratch


def new_pages(spark: SparkSession, path: str, schema: StructType, body: str = "body", file_format: str = "parquet", known: DataFrame | None = None, within: tuple[str, str] | None = None) -> DataFrame:
    """A stream of pages, each content once, without those whose checksum a table already has (known). within: a time
    column and a delay; state is then kept for so long only, and known must tell what came before. Without it every
    checksum stays in the state."""
    pages = spark.readStream.format(file_format).schema(schema).load(path).withColumn("checksum", checksum(F.col(body)))
    pages = pages if known is None else pages.join(known.select("checksum").distinct(), "checksum", "left_anti")
    return pages.withWatermark(*within).dropDuplicatesWithinWatermark(["checksum"]) if within else pages.dropDuplicates(["checksum"])


def append_once(pages: DataFrame, target: str, checkpoint: str) -> StreamingQuery:
    return pages.writeStream.format("parquet").option("path", target).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


#: Groups that the entities of a guarded stream are dealt to by hash; fixed, as a stream's state is kept by them.
GUARDS = 4096


def guarded(reports: DataFrame, entity: str, kind: str, order: str) -> DataFrame:
    """A stream of reports (entity string, kind string, order long) with accepted and the entity's state after each. The
    state of an entity, its case state, outlives batches and runs; the reports of a batch count in order. Entities are
    handled in GUARDS groups, as calls for each of them cost more than their reports; a batch rewrites the states of the
    groups that it touches. A checkpoint from before the groups cannot be gone on with."""

    def step(_: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        now = dict(zip(*state.get, strict=True)) if state.exists else {}
        rows = pd.concat(list(batches)).sort_values(order, kind="stable")
        accepted, states = [], []
        for who, new in zip(rows[entity], rows[kind], strict=True):
            was = now.get(who)
            ok = not was or was == "desaparecido" or (was != "fallecido" and new != "desaparecido")
            if ok:
                now[who] = new
            accepted.append(ok)
            states.append(now[who])
        state.update((list(now), list(now.values())))
        yield pd.DataFrame({entity: rows[entity], order: rows[order], kind: rows[kind], "accepted": accepted, "state": states})

    made = f"{entity} string, {order} long, {kind} string, accepted boolean, state string"
    dealt = reports.select(entity, order, kind, F.pmod(F.xxhash64(entity), F.lit(GUARDS)).cast("int").alias("_guard"))
    return dealt.groupBy("_guard").applyInPandasWithState(step, made, "entities array<string>, states array<string>", "append", GroupStateTimeout.NoTimeout)


def merge_reports(reports: DataFrame, target: str, checkpoint: str, entity: str, kind: str, order: list[str], columns: list[str]) -> StreamingQuery:
    """Folds each batch of reports into the table of entities at target/batch=N, reading the last finished one; a batch
    that is run again writes the same folder again."""

    def batch(rows: DataFrame, n: int) -> None:
        spark = rows.sparkSession
        fs = spark._jvm.org.apache.hadoop.fs
        at = fs.Path(target)
        system = at.getFileSystem(spark._jsc.hadoopConfiguration())
        done = [int(s.getPath().getName()[6:]) for s in system.listStatus(at) if s.getPath().getName().startswith("batch=") and system.exists(fs.Path(s.getPath(), "_SUCCESS"))] if system.exists(at) else []
        before = max((d for d in done if d < n), default=None)
        new = rows.select(entity, kind, *columns, F.lit(1).alias("_turn"), *order)
        if before is not None:
            old = spark.read.parquet(f"{target}/batch={before}").select(entity, F.col("state").alias(kind), *columns, F.lit(0).alias("_turn"))
            new = new.unionByName(old, allowMissingColumns=True)
        folded(new, entity, kind, ["_turn", *order], columns).select(entity, "state", *columns).write.mode("overwrite").parquet(f"{target}/batch={n}")

    return reports.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def merge_stream(reports: DataFrame, kept: Store, table: str, checkpoint: str, entity: str, kind: str, order: list[str], columns: list[str]) -> StreamingQuery:
    """merge_reports into a table (entity, state, columns) of a store: a batch reads and writes the buckets of its entities
    only, as a version of its own, and does nothing when it is run again. A null entity is an entity like others."""

    def batch(rows: DataFrame, n: int) -> None:
        if n + 1 in kept.versions():
            return
        new = rows.select(entity, kind, *columns, F.lit(1).alias("_turn"), *order)
        new = Scratch(rows.sparkSession, f"merge-{n}").write(new, "batch")  # it is read twice
        touched = kept.touched(table, new, entity)
        old = kept.read(table, touched).select(entity, F.col("state").alias(kind), *columns, F.lit(0).alias("_turn"))
        merged = folded(new.unionByName(old, allowMissingColumns=True), entity, kind, ["_turn", *order], columns)
        kept.commit(n + 1, {table: (merged.select(entity, "state", *columns), touched)})

    return reports.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def upsert_stream(records: DataFrame, kept: PersonStore, checkpoint: str, arrival: str) -> StreamingQuery:
    """Applies each micro-batch of person records to a store as a version of its own. A batch that a restart runs again
    finds its version there; bytes written follow the batch, not the table."""

    def batch(rows: DataFrame, n: int) -> None:
        kept.upsert(rows, arrival, F.current_timestamp(), n + 1, Scratch(rows.sparkSession, f"upsert-{n}"))

    return records.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
