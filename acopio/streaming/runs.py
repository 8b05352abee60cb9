"""Runs as rows: begun, ended with a state that follows from what they counted, or closed after their time is up."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.listener import QueryIdleEvent, QueryProgressEvent, QueryStartedEvent, QueryTerminatedEvent, StreamingQueryListener
from pyspark.sql.types import StructType

from ..operators.content import run_status, stale_closed
from ..operators.store import Kept, Store

_RUN = StructType.fromDDL("run_id string, spider_name string, status string, started_at timestamp, finished_at timestamp, items long, errors long")
#: The name under which a stream observes its counts: Dataset.observe(OBSERVED, items, errors).
OBSERVED = "run"


def counted(rows: DataFrame, error: str) -> DataFrame:
    """A stream that counts its rows and, of these, those with an error, for a listener to see."""
    return rows.observe(OBSERVED, F.count(F.lit(1)).alias("items"), F.count_if(F.col(error).isNotNull()).alias("errors"))


class RunLog:
    """The table of runs. One writer at a time, the driver of the runs."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.store = spark, Store(spark, path, {"runs": Kept("run_id", _RUN)}, buckets=8)

    def read(self) -> DataFrame:
        return self.store.read("runs")

    def put(self, rows: DataFrame) -> None:
        """Replaces or adds rows by run_id; rows may read the log itself."""
        touched = self.store.touched("runs", rows, "run_id")
        if touched:
            after = self.store.read("runs", touched).join(rows.select("run_id"), "run_id", "left_anti").unionByName(rows)
            self.store.commit((self.store.latest() or 0) + 1, {"runs": (after, touched)})

    def begin(self, run_id: str, spider_name: str, at: dt.datetime) -> None:
        self.put(self.spark.createDataFrame([(run_id, spider_name, "running", at, None, 0, 0)], _RUN))

    def end(self, run_id: str, items: int, errors: int, failed: bool, at: dt.datetime) -> None:
        """The run's state: failed if it broke off, else what its counts say. A run that is closed already stays so."""
        rows = self.read().filter((F.col("run_id") == run_id) & (F.col("status") == "running"))
        status = F.lit("failed") if failed else run_status(F.lit(items), F.lit(errors))
        self.put(rows.withColumns({"status": status, "finished_at": F.lit(at), "items": F.lit(items).cast("long"), "errors": F.lit(errors).cast("long")}))

    def close_stale(self, now: dt.datetime, seconds: int = 3600) -> None:
        """Runs that were never ended, as their driver died, fail after so long."""
        rows = self.read().filter("status = 'running'")
        self.put(stale_closed(rows, F.lit(now), seconds).filter("status <> 'running'"))


class RunListener(StreamingQueryListener):
    """Writes a row for each run of a named stream: its counts are those that counted() observes, else its input rows."""

    def __init__(self, log: RunLog):
        self.log, self.seen = log, {}

    def onQueryStarted(self, event: QueryStartedEvent) -> None:
        if event.name:
            self.seen[str(event.runId)] = [0, 0]
            self.log.begin(str(event.runId), event.name, dt.datetime.now())

    def onQueryProgress(self, event: QueryProgressEvent) -> None:
        counts = self.seen.get(str(event.progress.runId))
        if counts is not None:
            row = event.progress.observedMetrics.get(OBSERVED)
            counts[0] += row["items"] if row is not None else event.progress.numInputRows
            counts[1] += row["errors"] if row is not None else 0

    def onQueryIdle(self, event: QueryIdleEvent) -> None:
        pass

    def onQueryTerminated(self, event: QueryTerminatedEvent) -> None:
        counts = self.seen.pop(str(event.runId), None)
        if counts is not None:
            self.log.end(str(event.runId), *counts, failed=event.exception is not None, at=dt.datetime.now())
