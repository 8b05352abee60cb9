"""Content by hash: new or seen, first sightings, runs, their statistics and alerts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def checksum(body: Column) -> Column:
    return F.sha2(body.cast("binary"), 256)


def new_or_seen(pages: DataFrame, arrival: list[str], known: DataFrame | None = None, body: str = "body") -> DataFrame:
    """pages with checksum and is_new: not known (a table of checksums), and the first of its kind by arrival. The first
    arrival of each hash is an aggregate, so a page that comes a million times stays spread over tasks."""
    hashed = pages.withColumn("checksum", checksum(F.col(body)))
    first = hashed.groupBy("checksum").agg(F.min(F.struct(*arrival)).alias("_first"))
    if known is not None:
        first = first.join(known.select("checksum").distinct(), "checksum", "left_anti")
    return hashed.join(first, "checksum", "left").withColumn("is_new", F.coalesce(F.col("_first") == F.struct(*arrival), F.lit(False))).drop("_first")


def registry(pages: DataFrame, seen_at: str, body: str = "body") -> DataFrame:
    """One row a checksum: when it was first seen and how often."""
    return pages.groupBy(checksum(F.col(body)).alias("checksum")).agg(F.min(seen_at).alias("first_seen"), F.count(F.lit(1)).alias("copies"))


def append_new(table: DataFrame, rows: DataFrame, keys: list[str]) -> DataFrame:
    """rows, once a key, whose key the table lacks."""
    return rows.dropDuplicates(keys).join(table.select(*keys), keys, "left_anti")


#: Content types and extensions; a type may stand anywhere in the header, the first hit wins.
EXTENSIONS = {"application/json": "json", "text/html": "html", "application/xml": "xml", "text/xml": "xml", "application/pdf": "pdf", "text/csv": "csv", "text/plain": "txt"}


def extension(content_type: Column) -> Column:
    out = F.lit("bin")
    for kind, ext in reversed(EXTENSIONS.items()):
        out = F.when(content_type.contains(kind), ext).otherwise(out)
    return out


def content_type(ext: Column) -> Column:
    """The type of an extension; of several types the last in the table."""
    out = F.lit("application/octet-stream")
    for kind, e in EXTENSIONS.items():
        out = F.when(ext == e, kind).otherwise(out)
    return out


def objects(pages: DataFrame, known: DataFrame | None = None, body: str = "body", file_type: str = "file_type") -> DataFrame:
    """What is to be stored of pages (spider_name, body, file_type): each new content once a source, under its hash and
    extension: spider_name, name, content_type, body."""
    ext = F.coalesce(F.col(file_type), F.lit("bin"))
    out = pages.withColumn("checksum", checksum(F.col(body)))
    if known is not None:
        out = out.join(known.select("checksum").distinct(), "checksum", "left_anti")
    out = out.select("spider_name", F.concat_ws(".", "checksum", ext).alias("name"), content_type(ext).alias("content_type"), F.col(body).cast("binary").alias("body"))
    return out.dropDuplicates(["spider_name", "name"])


def put_objects(pages: DataFrame, path: str, known: DataFrame | None = None) -> None:
    """Appends the objects of pages to the store at path, a folder for each source."""
    objects(pages, known).write.mode("append").partitionBy("spider_name").parquet(path)


def stored_name(body: Column, content_type: Column) -> Column:
    return F.concat_ws(".", checksum(body), extension(content_type))


def files_of(runs: DataFrame, files: DataFrame) -> DataFrame:
    """The files of each run: runs (checksum and more) with the columns of the files' table."""
    return runs.join(files, "checksum")


def volume_alert(runs: DataFrame, source: str, started: str, status: str, files: str, ratio: float = 0.5) -> DataFrame:
    """Each run with the files of the latest earlier successful run of its source, and whether it has under half."""
    w = Window.partitionBy(source).orderBy(started).rowsBetween(Window.unboundedPreceding, -1)
    before = F.last(F.when(F.col(status) == "success", F.col(files)), ignorenulls=True).over(w)
    return runs.withColumn("previous", before).withColumn("alert", F.coalesce((F.col("previous") > 0) & (F.col(files) < ratio * F.col("previous")), F.lit(False)))


def run_status(items: Column, errors: Column) -> Column:
    """Of a run that came to its end."""
    return F.when(errors == 0, "success").when(items > 0, "partial").otherwise("failed")


def stale_closed(runs: DataFrame, now: Column, seconds: int = 3600) -> DataFrame:
    """runs (status, started_at, finished_at) in which those that are running for over so many seconds have failed by now."""
    stale = (F.col("status") == "running") & (F.col("started_at") < F.timestamp_add("SECOND", F.lit(-seconds), now))
    return runs.withColumns({"status": F.when(stale, "failed").otherwise(F.col("status")), "finished_at": F.when(stale, now).otherwise(F.col("finished_at"))})


def parser_run(files: DataFrame, source: str, records: str, error: str, elapsed: str) -> DataFrame:
    """parser_stats of files with elapsed_s, their seconds, and a row TOTAL over all sources."""
    each = parser_stats(files, source, records, error).join(files.groupBy(source).agg(F.sum(elapsed).alias("elapsed_s")), source)
    sums = each.agg(F.lit("TOTAL").alias(source), *(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in each.columns if c != source))
    return each.unionByName(sums).withColumn("elapsed_s", F.round("elapsed_s", 1))


def parser_stats(files: DataFrame, source: str, records: str, error: str) -> DataFrame:
    return files.groupBy(source).agg(
        F.count(F.lit(1)).alias("files"), F.coalesce(F.sum(records), F.lit(0)).cast("long").alias("records"), F.count_if(F.col(error).isNotNull()).alias("errors"), F.count_if(F.col(error).isNull() & (F.coalesce(F.col(records), F.lit(0)) == 0)).alias("empty")
    )


def write_stats(stats: DataFrame, path: str) -> None:
    """Statistics of a run as JSON lines, with the time of writing."""
    stats.withColumn("timestamp", F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ssXXX")).write.mode("errorifexists").json(path)


def forward_fill(rows: DataFrame, value: str, by: list[str], order: list[str]) -> Column:
    w = Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return F.last(value, ignorenulls=True).over(w)
