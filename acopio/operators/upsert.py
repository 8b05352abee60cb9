"""Upsert of person records in their order of arrival, each seeing what those before it did.

A record finds the row of its id, else the row that holds its id number, else the row that holds its name and place in any
case. It updates that row's columns with its own non-empty ones if the row's state may change, or becomes a new row. What
a record finds depends on earlier records alone. Time is cut into stretches of about as many records. In a round each
stretch is replayed record by record, all stretches at once, over the rows as the last round's writes leave them at its
start; the assignment of records to rows is the one fixed point of that. A round settles one more stretch at least, in
practice a few, however long the chains inside of it are. A round's joins and aggregates are as large as the batch and the
known rows that share a key with it, never as the whole table.

Nothing of this brings a row's or a key's records into one task, only those of a stretch with the rows that they can meet:
of each key its smallest holders, as many as HOLDERS. Where those run out, a round with more of them follows.

Defined results: empty and blank values count as missing; records with neither name nor id number are skipped; of several
rows that hold a key the smallest id counts, so batches may be cut anywhere; arrival numbers are 0 and more, records that share
one are told apart by their content; columns that the table lacks are ignored.
"""

from __future__ import annotations

import heapq

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import blank_to_null, stable_id
from ..plans.scratch import Scratch

#: Records of a stretch of time, about: a task replays them in a second.
STRETCH = 20_000
#: Rows that hold a key, at most, of which a stretch's task is told at first.
HOLDERS = 120


def with_ids(records: DataFrame, source: str = "spider_name") -> DataFrame:
    """records with an id: their own, else one made of source, name and id number."""
    return records.withColumn("id", F.coalesce(blank_to_null(F.col("id")), stable_id(F.coalesce(source, F.lit("")), F.col("nombre"), F.col("cedula"))))


def _pair(name: Column, place: Column) -> Column:
    """One key of name and place in any case; null without one of them."""
    return F.when(name.isNotNull() & place.isNotNull(), F.to_json(F.array(F.lower(name), F.lower(place))))


#: The keys of a record or row in the order in which they are looked up: id, id number, name and place.
KINDS = ("id", "cedula", "nombre_hospital")


def keys(rows: DataFrame, *keep: str | Column) -> DataFrame:
    """keep, kind (0 to 2) and key of each key that the rows (id, c, n, h) have."""
    return rows.select(*keep, F.posexplode(F.array("id", "c", _pair(F.col("n"), F.col("h")))).alias("kind", "key")).filter("key is not null")


def _versions(writes: DataFrame, stretches: int) -> DataFrame:
    """pid, since, until, c, n, h, state: the rows as they are at the end of each stretch that changes them, given the
    accepted writes (pid, t, _b, c, n, h, state). A version holds at the start of the stretches after since, to until."""
    columns = ["c", "n", "h", "state"]
    ends = writes.groupBy("pid", "_b").agg(*(F.max_by(c, F.when(F.col(c).isNotNull(), F.col("t"))).alias(c) for c in columns))
    w = Window.partitionBy("pid").orderBy("_b")  # a row has one version a stretch, at most
    return ends.select("pid", F.col("_b").alias("since"), F.coalesce(F.lead("_b").over(w), F.lit(stretches)).alias("until"), *(F.last(c, True).over(w).alias(c) for c in columns))


def _met(records: DataFrame, versions: DataFrame, most: int) -> DataFrame:
    """What the records (id, c, n, h, _b) of a stretch can meet at its start: rows (_s, pid, c, n, h, state), for each key
    its smallest holders; of a key that more than most rows hold, also kind, key and the first pid that is left out."""
    span = Window.partitionBy("kind", "key", "since", "until").orderBy("pid")
    held = keys(versions.withColumn("id", F.col("pid")), "pid", "since", "until")
    held = held.withColumn("_n", F.row_number().over(span)).filter(F.col("_n") <= most + 1).drop("_n")
    sought = keys(records, "_b").distinct()
    at = Window.partitionBy("_b", "kind", "key").orderBy("pid")
    first = held.join(sought, ["kind", "key"]).filter("since < _b and _b <= until").withColumn("_n", F.row_number().over(at)).filter(F.col("_n") <= most + 1)
    rows = first.filter(F.col("_n") <= most).select("_b", "pid").distinct().join(versions, "pid").filter("since < _b and _b <= until")
    ends = first.filter(F.col("_n") > most).select(F.col("_b").alias("_s"), "pid", "kind", "key")
    return rows.select(F.col("_b").alias("_s"), "pid", "c", F.lower("n").alias("n"), F.lower("h").alias("h"), "state").unionByName(ends, allowMissingColumns=True)


_DONE = pa.schema([("t", pa.int64()), ("_b", pa.int32()), ("id", pa.string()), ("pid", pa.string()), ("matched_by", pa.string()), ("is_new", pa.bool_()), ("ok", pa.bool_()), ("short", pa.bool_())])
_DONE_SQL = "t long, _b int, id string, pid string, matched_by string, is_new boolean, ok boolean, short boolean"


def _replayed(records: pa.Table, met: pa.Table) -> pa.Table:
    """The records of a stretch, one after another, over the rows that they can meet. short: a key ran out of holders."""
    rows: dict[str, list] = {}  # c, n, h and state of each row
    held: dict[tuple, list[str]] = {}  # the pids that held a key at some time, as heaps
    left = {}

    def kept(pid: str) -> tuple:
        c, n, h, _ = rows[pid]
        return ((1, c) if c is not None else None, (2, n, h) if n is not None and h is not None else None)

    def put(pid: str) -> None:
        for key in filter(None, kept(pid)):
            heapq.heappush(held.setdefault(key, []), pid)

    for r in met.to_pylist():
        if r["kind"] is not None:
            left[r["kind"], r["key"]] = r["pid"]
        else:
            rows[r["pid"]] = [r["c"], r["n"], r["h"], r["state"]]
            put(r["pid"])

    def least(key: tuple, name: str) -> tuple[str | None, bool]:
        pids = held.get(key, [])
        while pids and kept(pids[0])[key[0] - 1] != key:
            heapq.heappop(pids)
        pid, end = pids[0] if pids else None, left.get((key[0], name))
        return pid, end is not None and (pid is None or pid >= end)

    out: dict[str, list] = {n: [] for n in _DONE.names}
    for r in sorted(records.to_pylist(), key=lambda r: r["t"]):
        pid, kind, short = r["id"], 0, False
        if pid not in rows:
            pid = None
            for kind, key, name in ((1, (1, r["c"]), r["c"]), (2, (2, r["n"], r["h"]), r["pair"])):
                if pid is None and name is not None:
                    pid, lacks = least(key, name)
                    short |= lacks
                    if pid is not None:
                        break
        is_new = pid is None
        pid = r["id"] if is_new else pid
        row = rows.setdefault(pid, [None] * 4)
        ok = row[3] in (None, "desaparecido") or (row[3] != "fallecido" and r["tipo_reporte"] != "desaparecido")
        if ok:
            before = () if is_new else kept(pid)
            row[:] = [old if new is None else new for new, old in zip((r["c"], r["n"], r["h"], r["tipo_reporte"]), row, strict=True)]
            if kept(pid) != before:
                put(pid)
        for n, v in zip(_DONE.names, (r["t"], r["_b"], r["id"], pid, None if is_new else KINDS[kind], is_new, ok, short), strict=True):
            out[n].append(v)
    return pa.table(out, schema=_DONE)


def assign(records: DataFrame, known: DataFrame, scratch: Scratch) -> DataFrame:
    """t, id, pid (the id of the row that a record updates or makes), matched_by, is_new, ok. records: t (all different),
    id, nombre, cedula, hospital, tipo_reporte; known: id and the same columns."""
    records = scratch.write(records.select("t", "id", "tipo_reporte", F.col("cedula").alias("c"), F.col("nombre").alias("n"), F.col("hospital").alias("h")), "records")
    stretches = max(1, -(-records.count() // STRETCH))
    cuts = [int(x) for x in records.approxQuantile("t", [k / stretches for k in range(1, stretches)], 0.1 / stretches)] if stretches > 1 else []
    records = records.withColumn("_b", F.size(F.filter(F.array(*map(F.lit, cuts)), lambda x: x < F.col("t"))) if cuts else F.lit(0))
    known = known.select("id", *(F.nullif(c, F.lit("")).alias(a) for c, a in (("tipo_reporte", "state"), ("cedula", "c"), ("nombre", "n"), ("hospital", "h"))))
    near = keys(known, "id").join(keys(records).distinct(), ["kind", "key"], "left_semi").select("id").distinct()
    known = scratch.write(known.join(near, "id", "left_semi"), "near")  # a row's first record finds it by its own keys
    old = known.select(F.col("id").alias("pid"), F.lit(-1).cast("long").alias("t"), F.lit(-1).alias("_b"), "c", "n", "h", "state")
    plain = records.select("t", "_b", "id", "tipo_reporte", "c", F.lower("n").alias("n"), F.lower("h").alias("h"), _pair(F.col("n"), F.col("h")).alias("pair"))

    writes, now, before, settled, most, k = old, None, None, 0, HOLDERS, 0  # first what the known rows alone give
    while True:
        versions = scratch.write(_versions(writes, stretches), f"versions-{k}")
        due = F.col("_b") >= settled  # stretches before it are right
        met = _met(records.filter(due), versions, most)
        done = plain.filter(due).groupBy("_b").cogroup(met.groupBy("_s")).applyInArrow(_replayed, _DONE_SQL)
        last, now = now, scratch.write(done if now is None else done.unionByName(now.filter(~due)), f"round-{k}")
        scratch.drop(f"versions-{k}")
        if last is not None:
            scratch.drop(f"round-{k - 1}")
        *state, short = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("t", "pid", "ok", "is_new").cast("decimal(38,0)")), F.max("short")).first()
        if short:
            most *= 8
        elif state == before or settled + 1 >= stretches:
            return now.select("t", "id", "pid", "matched_by", "is_new", "ok")
        else:
            settled += 1
        before, k = state, k + 1
        writes = old.unionByName(records.join(now.filter("ok").select("t", "pid"), "t").select("pid", "t", "_b", "c", "n", "h", F.col("tipo_reporte").alias("state")))


def ready(batch: DataFrame, arrival: str, columns: list[str]) -> DataFrame:
    """batch as arrival, id and those of columns that it has, blank values null, with ids."""
    some = [c for c in batch.columns if c in columns and c not in ("id", "created_at", "updated_at")]
    fit = batch.select(F.col(arrival).cast("long").alias("arrival"), *(blank_to_null(F.col(c)).alias(c) for c in ["id", *some]))
    return with_ids(fit) if "spider_name" in some else with_ids(fit.withColumn("spider_name", F.lit(None).cast("string"))).drop("spider_name")


def upserted(table: DataFrame, batch: DataFrame, arrival: str, now: Column) -> tuple[DataFrame, DataFrame]:
    """(rows, outcomes). rows: the rows of table (id, the columns of persons, created_at, updated_at) that batch changes or
    adds, as they are afterwards, with is_new; outcomes: for each record of batch its arrival, id, the row's id (pid),
    matched_by and outcome (inserted, updated, blocked, skipped)."""
    scratch = Scratch(batch.sparkSession, "upsert")
    columns = [c for c in table.columns if c in batch.columns and c not in ("id", "created_at", "updated_at")]
    fit = ready(batch, arrival, columns)
    named = F.col("nombre").isNotNull() | F.col("cedula").isNotNull()
    fit = scratch.write(fit, "batch")
    apart = fit.groupBy("arrival").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 1
    # arrival numbers that repeat are told apart by the records' content
    rank = F.row_number().over(Window.partitionBy("arrival").orderBy("id", *columns)) - 1 if apart > 1 else F.lit(0)
    fit = fit.withColumn("t", F.col("arrival") * apart + rank)
    fit = scratch.write(fit, "ranked") if apart > 1 else fit
    known = table.select("id", *(F.col(c) if c in table.columns else F.lit(None).cast("string").alias(c) for c in ("nombre", "cedula", "hospital", "tipo_reporte")))
    assigned = assign(fit.filter(named), known, scratch)

    taken = fit.drop("id").join(assigned.filter("ok").select("t", "pid", "is_new"), "t")
    new = taken.groupBy("pid").agg(*(F.max_by(c, F.when(F.col(c).isNotNull(), F.col("t"))).alias(f"_n_{c}") for c in columns), F.max("is_new").alias("is_new"))
    old = table.join(new.select(F.col("pid").alias("id")), "id", "left_semi")  # what is joined below is as small as the batch
    rows = new.withColumnRenamed("pid", "id").join(old, "id", "left")
    rest = [c for c in table.columns if c not in columns and c not in ("id", "created_at", "updated_at")]
    rows = rows.select("id", *(F.coalesce(f"_n_{c}", c).alias(c) for c in columns), *rest, F.when(F.col("is_new"), now).otherwise(F.col("created_at")).alias("created_at"), now.alias("updated_at"), "is_new")
    what = F.when(~named, "skipped").when(F.col("is_new"), "inserted").when(F.col("ok"), "updated").otherwise("blocked")
    outcomes = fit.join(assigned.select("t", "pid", "matched_by", "is_new", "ok"), "t", "left").select("arrival", "id", "pid", "matched_by", what.alias("outcome"))
    return rows, outcomes


def applied(table: DataFrame, rows: DataFrame) -> DataFrame:
    """The whole table with the rows of upserted in place of the old ones."""
    return table.join(rows.select("id"), "id", "left_anti").unionByName(rows.select(*table.columns))
