"""Queries on the table of persons as it is kept up: upserts in order of arrival, and what they did."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..operators import constraints, content, schedules, store, upsert
from ..operators.constraints import Foreign, Unique
from ..streaming import ingest
from .queries import _P, people, query, table
from .scratch import Scratch

#: Records that share ids, id numbers, names and places with known rows and with one another, in groups of some size; some
#: only with earlier ones of the batch. One id number is that of a seventh of all rows. Both engines read these expressions.
_RECORD = {
    "arrival": "id",
    "id": "CASE WHEN id % 4 = 0 THEN concat('p', id + 1) WHEN id % 4 = 1 THEN NULL WHEN id % 4 = 2 THEN concat('n', CAST(floor(id / 24) AS BIGINT)) ELSE concat('n', id) END",
    "tipo_reporte": "tipo_reporte",
    "nombre": "CASE WHEN id % 17 = 0 THEN ' ' WHEN id % 7 < 3 THEN concat('Nombre ', CAST(floor(id / 20) AS BIGINT)) ELSE nombre END",
    "edad": "edad",
    "cedula": "CASE WHEN id % 5 = 0 THEN NULL WHEN id % 5 = 1 THEN concat(' ', cedula, ' ') WHEN id % 5 = 2 THEN concat('B', CAST(floor(id / 20) AS BIGINT)) WHEN id % 5 = 3 THEN concat('C', CAST(floor(id / 30) AS BIGINT)) ELSE '' END",
    "hospital": "CASE WHEN id % 2 = 0 THEN 'Hospital Central' WHEN id % 4 = 1 THEN 'HOSPITAL CENTRAL' ELSE hospital END",
    "notas": "concat('nota ', id)",
    "spider_name": "'fuente'",
}
_COLUMNS = ["tipo_reporte", "nombre", "edad", "cedula", "hospital", "notas", "spider_name"]
_VARCHAR = {k: (f"CAST({e} AS VARCHAR)" if k != "arrival" else e) for k, e in _RECORD.items()}
_BLANK = lambda c: f"nullif(trim({c}), '')"
_SET = ", ".join(f"CASE WHEN hit AND NOT there THEN r_{c} WHEN hit AND may THEN coalesce(r_{c}, {c}) ELSE {c} END AS {c}" for c in _COLUMNS)
#: One step for each record: its row is looked up among all rows as they are by then. Rows to be are there from the start.
_REPLAY = f"""{_P.replace("WITH people", "WITH RECURSIVE people")}, known AS (SELECT concat('p', id) AS id, tipo_reporte, nombre, edad, cedula, hospital, notas, 'antes' AS spider_name FROM people WHERE id % 3 <> 0),
raw AS (SELECT {", ".join(f"{e} AS {k}" for k, e in _VARCHAR.items())} FROM people WHERE id % 3 = 0),
fit AS (SELECT arrival, {_BLANK("id")} AS id, {", ".join(f"{_BLANK(c)} AS {c}" for c in _COLUMNS)} FROM raw),
named AS (SELECT arrival, coalesce(id, 'fuente:' || substr(md5(concat('fuente:', coalesce(nombre, ''), ':', coalesce(cedula, ''))), 1, 12)) AS id, {", ".join(_COLUMNS)} FROM fit),
rec AS (SELECT row_number() OVER (ORDER BY arrival) AS k, arrival, id AS r_id, {", ".join(f"{c} AS r_{c}" for c in _COLUMNS)} FROM named WHERE nombre IS NOT NULL OR cedula IS NOT NULL),
walk AS (SELECT 0 AS k, id, true AS there, {", ".join(_COLUMNS)}, '2020-01-01 00:00:00' AS created_at, '2020-01-01 00:00:00' AS updated_at, false AS target, NULL::VARCHAR AS how, NULL::VARCHAR AS what FROM known
  UNION ALL SELECT DISTINCT 0, r_id, false, {", ".join("NULL" for _ in _COLUMNS)}, NULL, NULL, false, NULL::VARCHAR, NULL::VARCHAR FROM rec WHERE r_id NOT IN (SELECT id FROM known)
  UNION ALL
  SELECT k, id, there OR hit, {_SET},
    CASE WHEN hit AND NOT there THEN '2024-05-01 00:00:00' ELSE created_at END, CASE WHEN hit AND (NOT there OR may) THEN '2024-05-01 00:00:00' ELSE updated_at END,
    hit, CASE WHEN hit THEN by_ END, CASE WHEN hit THEN CASE WHEN NOT there THEN 'inserted' WHEN may THEN 'updated' ELSE 'blocked' END END
  FROM (SELECT *, id = coalesce(m1, m2, m3, r_id) AS hit, CASE WHEN m1 IS NOT NULL THEN 'id' WHEN m2 IS NOT NULL THEN 'cedula' WHEN m3 IS NOT NULL THEN 'nombre_hospital' END AS by_,
      coalesce(tipo_reporte IS NULL OR tipo_reporte = 'desaparecido' OR (tipo_reporte <> 'fallecido' AND r_tipo_reporte IS DISTINCT FROM 'desaparecido'), false) AS may
    FROM (SELECT r.*, w.* EXCLUDE (k), max(CASE WHEN there AND w.id = r_id THEN w.id END) OVER () AS m1,
        min(CASE WHEN there AND cedula <> '' AND cedula = r_cedula THEN w.id END) OVER () AS m2,
        min(CASE WHEN there AND nombre <> '' AND hospital <> '' AND lower(nombre) = lower(r_nombre) AND lower(hospital) = lower(r_hospital) THEN w.id END) OVER () AS m3
      FROM walk w JOIN rec r ON r.k = w.k + 1)))"""


def _persons_and_records(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    rows = people(spark, sf_dir)
    then = F.lit("2020-01-01 00:00:00").cast("timestamp")
    known = rows.filter("id % 3 <> 0").select(F.expr("concat('p', id)").alias("id"), "tipo_reporte", "nombre", "edad", "cedula", "hospital", "notas", F.lit("antes").alias("spider_name"), then.alias("created_at"), then.alias("updated_at"))
    return known, rows.filter("id % 3 = 0").select(*(F.expr(e).alias(k) for k, e in _RECORD.items()))


def _timed(rows: DataFrame) -> DataFrame:
    return rows.withColumns({c: F.date_format(c, "yyyy-MM-dd HH:mm:ss") for c in ("created_at", "updated_at")})


_AFTER = f"{_REPLAY} SELECT id, {', '.join(_COLUMNS)}, created_at, updated_at FROM walk WHERE there AND k = (SELECT max(k) FROM walk)"


@query(_AFTER)
def persons_upsert(spark, sf_dir):
    known, records = _persons_and_records(spark, sf_dir)
    rows, _ = upsert.upserted(known, records, "arrival", F.lit("2024-05-01 00:00:00").cast("timestamp"))
    return _timed(upsert.applied(known, rows))


@query(f"{_REPLAY} SELECT named.arrival, named.id, walk.id AS pid, how AS matched_by, coalesce(what, 'skipped') AS outcome FROM named LEFT JOIN rec USING (arrival) LEFT JOIN walk ON walk.k = rec.k AND target")
def upsert_outcomes(spark, sf_dir):
    return upsert.upserted(*_persons_and_records(spark, sf_dir), "arrival", F.current_timestamp())[1]


@query(_AFTER)
def persons_store(spark, sf_dir):
    """The table after three batches, each of which rewrites the buckets that it touches."""
    scratch = Scratch(spark, "store")
    known, records = _persons_and_records(spark, sf_dir)
    kept = store.PersonStore(spark, f"{scratch.root}/persons", known.schema, buckets=16)
    kept.load(known)
    cuts = [-1, *(int(x) for x in records.approxQuantile("arrival", [1 / 3, 2 / 3], 0.01)), 2**62]
    for n, (low, high) in enumerate(zip(cuts, cuts[1:], strict=False), 1):
        kept.upsert(records.filter((F.col("arrival") > low) & (F.col("arrival") <= high)), "arrival", F.lit("2024-05-01 00:00:00").cast("timestamp"), n, Scratch(spark, f"batch-{n}"))
    return _timed(kept.read())


#: Schedules by supplier, and when each is due: minute, hour, day, month and day of week (0: Sunday) as SQL has them.
_CRON = {
    "0 */12 * * *": "mi = 0 AND h % 12 = 0",
    "*/15 8-17 * * mon-fri": "mi % 15 = 0 AND h BETWEEN 8 AND 17 AND wd BETWEEN 1 AND 5",
    "5,35 22-2 1 * *": "mi IN (5, 35) AND (h >= 22 OR h <= 2) AND d = 1",
    "10-59/20 6 * feb,MAR 0": "mi IN (10, 30, 50) AND h = 6 AND mo IN (2, 3) AND wd = 0",
    "0 0 29-31/2 * *": "mi = 0 AND h = 0 AND d IN (29, 31)",
    "30 4 1,15 * fri": "mi = 30 AND h = 4 AND d IN (1, 15) AND wd = 5",
    "7 23 * 2-3 5-1/2": "mi = 7 AND h = 23 AND mo IN (2, 3) AND wd IN (5, 0)",
    "60 * * * *": "false", "* * *": "false", "5/10 * * * *": "false", "* * 0 * *": "false", "*/0 * * * *": "false",
}
_CRON_CASE = f"CASE s_suppkey % {len(_CRON)} " + " ".join(f"WHEN {k} THEN '{c}'" for k, c in enumerate(_CRON)) + " END"
_DUE_SQL = "WITH cal AS (SELECT t, minute(t) AS mi, hour(t) AS h, day(t) AS d, month(t) AS mo, dayofweek(t) AS wd FROM (SELECT unnest(generate_series(TIMESTAMP '2024-02-28 11:00:00', TIMESTAMP '2024-03-04 12:00:00', INTERVAL 1 MINUTE)) AS t) WHERE t < TIMESTAMP '2024-03-04 12:00:00')"


@query(f"{_DUE_SQL} SELECT s_name AS name, CAST(t AS VARCHAR) AS due_at FROM supplier JOIN cal ON CASE s_suppkey % {len(_CRON)} " + " ".join(f"WHEN {k} THEN {w}" for k, w in enumerate(_CRON.values())) + " END WHERE s_suppkey % 7 <> 0")
def due_runs(spark, sf_dir):
    """ST3: when the schedules of a table are due within some days."""
    rows = table(spark, sf_dir, "supplier").select(F.col("s_name").alias("name"), F.expr(_CRON_CASE).alias("schedule"), (F.col("s_suppkey") % 7 != 0).alias("enabled"))
    start, end = (F.lit(t).cast("timestamp") for t in ("2024-02-28 11:00:00", "2024-03-04 12:00:00"))
    return schedules.due(rows, start, end).withColumn("due_at", F.date_format("due_at", "yyyy-MM-dd HH:mm:ss"))


_KEYED = (
    Unique("customer", ("c_custkey",), True), Unique("customer", ("c_nationkey", "c_mktsegment")), Unique("orders", ("o_orderkey",), True),
    Foreign("orders", ("o_custkey",), "customer", ("c_custkey",)), Foreign("lineitem", ("l_orderkey",), "orders", ("o_orderkey",)),
)


def _keyed_tables(spark, sf_dir) -> dict[str, DataFrame]:
    """Customers without some keys, orders of some customers that are not there."""
    customer = table(spark, sf_dir, "customer").select(F.expr("nullif(c_custkey % 1000, 7)").alias("c_custkey"), "c_nationkey", "c_mktsegment")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", F.expr("CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE o_custkey + 20 END").alias("o_custkey"))
    return {"customer": customer, "orders": orders, "lineitem": table(spark, sf_dir, "lineitem").select(F.expr("CASE WHEN l_linenumber = 7 THEN -l_orderkey ELSE l_orderkey END").alias("l_orderkey"), "l_linenumber")}


_KEYED_SQL = "WITH c AS (SELECT nullif(c_custkey % 1000, 7) AS k, c_nationkey, c_mktsegment FROM customer), o AS (SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE o_custkey + 20 END AS k FROM orders), l AS (SELECT CASE WHEN l_linenumber = 7 THEN -l_orderkey ELSE l_orderkey END AS k, l_linenumber FROM lineitem)"


@query(f"""{_KEYED_SQL} SELECT 'customer' AS table_name, 'null c_custkey' AS rule, 'null' AS value, count(*) AS n FROM c WHERE k IS NULL HAVING count(*) > 0
UNION ALL SELECT 'customer', 'repeated c_custkey', CAST(k AS VARCHAR), count(*) FROM c WHERE k IS NOT NULL GROUP BY k HAVING count(*) > 1
UNION ALL SELECT 'customer', 'repeated c_nationkey,c_mktsegment', concat(c_nationkey, '|', c_mktsegment), count(*) FROM c WHERE c_nationkey IS NOT NULL AND c_mktsegment IS NOT NULL GROUP BY c_nationkey, c_mktsegment HAVING count(*) > 1
UNION ALL SELECT 'orders', 'orphan o_custkey', CAST(k AS VARCHAR), count(*) FROM o WHERE k IS NOT NULL AND k NOT IN (SELECT k FROM c WHERE k IS NOT NULL) GROUP BY k
UNION ALL SELECT 'lineitem', 'orphan l_orderkey', CAST(k AS VARCHAR), count(*) FROM l WHERE k NOT IN (SELECT o_orderkey FROM o) GROUP BY k""")
def key_violations(spark, sf_dir):
    """What breaks the declared keys of some tables."""
    return constraints.violations(_keyed_tables(spark, sf_dir), _KEYED).withColumnRenamed("table", "table_name")


@query(f"""{_KEYED_SQL}, c2 AS (SELECT * FROM c WHERE c_mktsegment <> 'BUILDING'), lost AS (SELECT k FROM c WHERE c_mktsegment = 'BUILDING' AND k IS NOT NULL AND k NOT IN (SELECT k FROM c2 WHERE k IS NOT NULL)),
o2 AS (SELECT * FROM o WHERE k IS NULL OR k NOT IN (SELECT k FROM lost)), l2 AS (SELECT * FROM l WHERE k NOT IN (SELECT o_orderkey FROM o) OR k IN (SELECT o_orderkey FROM o2))
SELECT 'customer' AS table_name, count(*) AS n, CAST(coalesce(sum(k), 0) AS BIGINT) AS keys FROM c2 UNION ALL SELECT 'orders', count(*), CAST(sum(o_orderkey) AS BIGINT) FROM o2 UNION ALL SELECT 'lineitem', count(*), CAST(sum(k) AS BIGINT) FROM l2""")
def cascading_delete(spark, sf_dir):
    """The tables after some customers were deleted, with their orders and the lines of these."""
    rows = spark.createDataFrame([("BUILDING",)], "c_mktsegment string")
    left = constraints.deleted(_keyed_tables(spark, sf_dir), _KEYED, "customer", rows, Scratch(spark, "delete"))
    count = lambda name, key: left[name].agg(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(key), F.lit(0)).alias("keys"))
    return count("customer", "c_custkey").unionByName(count("orders", "o_orderkey")).unionByName(count("lineitem", "l_orderkey"))


@query("WITH o AS (SELECT doc_id, doc_id % 3 AS part, sha256(coalesce(text, '')) AS checksum FROM documents), s AS (SELECT *, row_number() OVER (PARTITION BY checksum ORDER BY part, doc_id) = 1 AS is_new FROM o) SELECT doc_id, checksum, is_new FROM s WHERE part > 0")
def content_seen_store(spark, sf_dir):
    """Two batches of pages against a registry in buckets."""
    pages = table(spark, sf_dir, "documents").select("doc_id", content.checksum(F.coalesce("text", F.lit(""))).alias("checksum"))
    scratch = Scratch(spark, "seen")
    kept = store.SeenStore(spark, f"{scratch.root}/registry", buckets=16)
    kept.load(pages.filter("doc_id % 3 = 0").groupBy("checksum").agg(F.min("doc_id").alias("first_seen")))
    return kept.sift(pages.filter("doc_id % 3 = 1"), "doc_id", 1, Scratch(spark, "seen-1")).unionByName(kept.sift(pages.filter("doc_id % 3 = 2"), "doc_id", 2, Scratch(spark, "seen-2")))


_RUN_STATES = "WITH r AS (SELECT event_type, CAST(ts AS DATE) AS day, count(*) AS items, count(*) FILTER (WHERE value < 1) AS errors, min(ts) AS started FROM events GROUP BY 1, 2)"


@query(f"{_RUN_STATES} SELECT event_type, CAST(day AS VARCHAR) AS day, CASE WHEN day(day) % 6 = 0 THEN CASE WHEN started < TIMESTAMP '2024-01-20 00:00:00' - INTERVAL 3600 SECOND THEN 'failed' ELSE 'running' END WHEN day(day) % 6 = 1 THEN 'failed' WHEN errors = 0 THEN 'success' ELSE 'partial' END AS status FROM r")
def run_states(spark, sf_dir):
    """ST5: runs by their counts, those that found nothing but errors, and those that never ended and are closed."""
    runs = table(spark, sf_dir, "events").groupBy("event_type", F.to_date("ts").alias("day")).agg(F.count(F.lit(1)).alias("items"), F.count_if(F.col("value") < 1).alias("errors"), F.min("ts").alias("started_at"))
    status = F.when(F.dayofmonth("day") % 6 == 0, "running").when(F.dayofmonth("day") % 6 == 1, content.run_status(F.lit(0), F.lit(1))).otherwise(content.run_status(F.col("items"), F.col("errors")))
    rows = runs.withColumns({"status": status, "finished_at": F.lit(None).cast("timestamp")})
    return content.stale_closed(rows, F.lit("2024-01-20 00:00:00").cast("timestamp")).select("event_type", F.col("day").cast("string").alias("day"), "status")


_STATS = "count(*) AS files, CAST(coalesce(sum(CASE WHEN turn % 3 <> 0 THEN length(text) % 7 END), 0) AS BIGINT) AS records, count(*) FILTER (WHERE turn % 3 = 0) AS errors, count(*) FILTER (WHERE turn % 3 <> 0 AND length(text) % 7 = 0) AS empty, round(sum(length(text) % 8) / 4, 1) AS elapsed_s"


@query(f"SELECT role, {_STATS} FROM conversations GROUP BY 1 UNION ALL SELECT 'TOTAL', {_STATS} FROM conversations")
def parser_run_totals(spark, sf_dir):
    """Statistics of a run with its seconds and the totals."""
    bad = F.col("turn") % 3 == 0
    files = table(spark, sf_dir, "conversations").select("role", F.when(~bad, F.length("text") % 7).alias("records"), F.when(bad, "broken").alias("error"), (F.length("text") % 8 / 4).alias("s"))
    return content.parser_run(files, "role", "records", "error", "s")


@query("SELECT count(*) AS n, CAST(sum(CAST(substr(c, 1, 1) IN ('0', '1', '2', '3') AS INTEGER)) AS BIGINT) AS low FROM (SELECT DISTINCT sha256(html) AS c FROM pages)")
def stream_new_pages(spark, sf_dir):
    """ST1: pages as a stream, each content once over two runs of it."""
    scratch = Scratch(spark, "stream")
    pages = scratch.write(table(spark, sf_dir, "pages").select(F.col("html").alias("body")), "pages")
    for _ in range(2):
        ingest.append_once(ingest.new_pages(spark, f"{scratch.root}/pages", pages.schema), f"{scratch.root}/out", f"{scratch.root}/cp").awaitTermination()
    return spark.read.parquet(f"{scratch.root}/out").agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.substring("checksum", 1, 1).isin("0", "1", "2", "3").cast("int")), F.lit(0)).alias("low"))


_KIND = "CASE o_orderstatus WHEN 'F' THEN CASE WHEN o_orderkey % 10 = 0 THEN 'fallecido' ELSE 'ingresado' END WHEN 'O' THEN 'desaparecido' ELSE 'dado_de_alta' END"


@query(f"WITH r AS (SELECT CAST(o_custkey AS VARCHAR) AS e, o_orderkey, {_KIND} AS kind FROM orders) SELECT e, o_orderkey, coalesce(max(CAST(kind = 'fallecido' AS INT)) OVER p, 0) = 0 AND (kind <> 'desaparecido' OR coalesce(max(CAST(kind <> 'desaparecido' AS INT)) OVER p, 0) = 0) AS accepted FROM r WINDOW p AS (PARTITION BY e ORDER BY o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)")
def stream_guard(spark, sf_dir):
    """ST7: reports as a stream in two parts, one after the other; the state of each entity outlives the first."""
    scratch = Scratch(spark, "guard")
    orders = table(spark, sf_dir, "orders").select(F.col("o_custkey").cast("string").alias("e"), "o_orderkey", F.expr(_KIND).alias("kind"))
    cut = int(orders.agg(F.avg("o_orderkey")).first()[0])
    for low, high in ((-1, cut), (cut, 2**62)):
        orders.filter(F.col("o_orderkey").between(low + 1, high)).write.mode("append").parquet(f"{scratch.root}/in")
        reports = spark.readStream.schema(orders.schema).parquet(f"{scratch.root}/in")
        ingest.append_once(ingest.guarded(reports, "e", "kind", "o_orderkey"), f"{scratch.root}/out", f"{scratch.root}/cp").awaitTermination()
    return spark.read.parquet(f"{scratch.root}/out").select("e", "o_orderkey", "accepted")


_NOTE = "CASE WHEN o_orderkey % 3 > 0 THEN concat('n', o_orderkey) END"


@query(f"WITH r AS (SELECT CAST(o_custkey AS VARCHAR) AS e, o_orderkey, {_NOTE} AS note, {_KIND} AS kind FROM orders), g AS (SELECT *, coalesce(max(CAST(kind = 'fallecido' AS INT)) OVER p, 0) = 0 AND (kind <> 'desaparecido' OR coalesce(max(CAST(kind <> 'desaparecido' AS INT)) OVER p, 0) = 0) AS ok FROM r WINDOW p AS (PARTITION BY e ORDER BY o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)) SELECT e, arg_max(kind, o_orderkey) FILTER (WHERE ok) AS state, arg_max(note, o_orderkey) FILTER (WHERE ok AND note IS NOT NULL) AS note FROM g GROUP BY e")
def stream_merge(spark, sf_dir):
    """ST2: the table of entities after reports came as a stream in three parts; each rewrites the buckets it touches."""
    scratch = Scratch(spark, "merge")
    orders = table(spark, sf_dir, "orders").select(F.col("o_custkey").cast("string").alias("e"), "o_orderkey", F.expr(_NOTE).alias("note"), F.expr(_KIND).alias("kind"))
    kept = store.Store(spark, f"{scratch.root}/kept", {"states": store.Kept("e", StructType.fromDDL("e string, state string, note string"))})
    last = orders.agg(F.max("o_orderkey")).first()[0] or 0
    for k in range(3):
        orders.filter((F.col("o_orderkey") > last * k // 3 - (k == 0)) & (F.col("o_orderkey") <= last * (k + 1) // 3)).write.mode("append").parquet(f"{scratch.root}/in")
        reports = spark.readStream.schema(orders.schema).parquet(f"{scratch.root}/in")
        ingest.merge_stream(reports, kept, "states", f"{scratch.root}/cp", "e", "kind", ["o_orderkey"], ["note"]).awaitTermination()
    return kept.read("states")
