"""Matching reports to known persons and merging them under the rule of allowed state changes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.status import may_change
from ..functions.text import blank_to_null, strip


def _key(c: str) -> Column:
    return F.lower(F.trim(F.col(c)))


def cascade(new: DataFrame, known: DataFrame, key: str = "row_id") -> DataFrame:
    """new (key, id, cedula, nombre, hospital) with match_id: the known row of equal id, else of equal id number, else of
    equal name and hospital in any case; the smallest id of several. Each key of known is one row before it is joined."""
    by_id = known.select(F.col("id").alias("id"), F.col("id").alias("m1")).distinct()
    by_number = known.filter(blank_to_null(F.col("cedula")).isNotNull()).groupBy("cedula").agg(F.min("id").alias("m2"))
    by_name = known.filter((F.coalesce("nombre", F.lit("")) != "") & (F.coalesce("hospital", F.lit("")) != "")).groupBy(_key("nombre").alias("_n"), _key("hospital").alias("_h")).agg(F.min("id").alias("m3"))
    rows = new.withColumns({"_n": _key("nombre"), "_h": _key("hospital")})
    out = rows.join(by_id, "id", "left").join(by_number, "cedula", "left").join(by_name, ["_n", "_h"], "left")
    return out.withColumn("match_id", F.coalesce("m1", "m2", "m3")).withColumn("matched_by", F.when(F.col("m1").isNotNull(), "id").when(F.col("m2").isNotNull(), "cedula").when(F.col("m3").isNotNull(), "nombre_hospital")).select(key, "match_id", "matched_by")


def accepted(kind: Column, by: list[str], order: list[str]) -> Column:
    """Whether a report counts, given those before it of its entity: no fallecido came, and it is not desaparecido after
    another state."""
    w = Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    dead = F.coalesce(F.max((kind == "fallecido").cast("int")).over(w), F.lit(0))
    better = F.coalesce(F.max((kind != "desaparecido").cast("int")).over(w), F.lit(0))
    return (dead == 0) & ((kind != "desaparecido") | (better == 0))


def folded(reports: DataFrame, entity: str, kind: str, order: list[str], columns: list[str]) -> DataFrame:
    """One row an entity: the state, the last accepted value of each column, and how many reports counted. Equal to
    applying the reports one by one."""
    rows = reports.withColumn("_ok", accepted(F.col(kind), [entity], order))
    seq = F.struct(*order)
    last = lambda c: F.max_by(F.col(c), F.when(F.col("_ok") & F.col(c).isNotNull(), seq))
    return rows.groupBy(entity).agg(last(kind).alias("state"), *(last(c).alias(c) for c in columns), F.count_if(F.col("_ok")).alias("n_accepted"), F.count(F.lit(1)).alias("n_reports"))


def patched(old: DataFrame, new: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Full outer merge that keeps a non-empty old value and else takes the new one."""
    a, b = old.select(key, *(F.col(c).alias(f"_o_{c}") for c in columns)), new.select(key, *(F.col(c).alias(f"_n_{c}") for c in columns))
    return a.join(b, key, "full").select(key, *(F.coalesce(F.nullif(F.col(f"_o_{c}"), F.lit("")), F.col(f"_n_{c}")).alias(c) for c in columns))


def replaced(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Rows of new, and those of old whose key is not among them."""
    return new.unionByName(old.join(new.select(key), key, "left_anti"), allowMissingColumns=True)


def conflict_preview(names: DataFrame, known: DataFrame, most: int = 5) -> DataFrame:
    """For each name to import, up to most known rows of that name in any case: name, rank, id."""
    hits = names.select("name", _key("name").alias("_k")).distinct().join(known.select("id", _key("nombre").alias("_k")), "_k")
    w = Window.partitionBy("name").orderBy("id")
    return hits.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= most).select("name", "rank", "id")


def import_plan(incoming: DataFrame, known: DataFrame, key: str = "row_id") -> DataFrame:
    """What importing each incoming row (key, nombre, hospital, cedula, tipo_reporte, notas) does to known: key, id (null:
    a new row), matched_by, notas. The row of equal id number, else of equal name and hospital in any case, is updated if
    its state may change; the smallest id of several counts. Without one, every row of the name whose state may change is
    updated, with the state before and the old notes in its notes, and nothing is inserted if the name is known at all.
    Rows without a name are skipped."""
    new = incoming.select(key, *(F.coalesce(F.trim(c), F.lit("")).alias(c) for c in ("nombre", "hospital", "cedula")), F.col("tipo_reporte").alias("new_state"), F.col("notas").alias("new_notes"))
    new = new.filter("nombre <> ''").withColumns({"_n": F.lower("nombre"), "_h": F.lower("hospital")})
    have = known.withColumns({"_n": F.lower("nombre"), "_h": F.lower("hospital")})
    first = F.min(F.struct("id", F.col("tipo_reporte").alias("state")))
    by_number = have.filter(F.col("cedula").isNotNull()).groupBy("cedula").agg(first.alias("a"))
    by_place = have.filter(F.col("_n").isNotNull() & F.col("_h").isNotNull()).groupBy("_n", "_h").agg(first.alias("b"))
    hit = new.withColumn("cedula", F.nullif("cedula", F.lit(""))).withColumn("_h", F.nullif("_h", F.lit("")))
    hit = hit.join(by_number, "cedula", "left").join(by_place, ["_n", "_h"], "left").withColumn("s", F.coalesce("a", "b"))
    sure = hit.filter("s is not null").filter(may_change(F.col("s.state"), F.col("new_state")))
    sure = sure.select(key, F.col("s.id").alias("id"), F.when(F.col("a").isNotNull(), "cedula").otherwise("nombre_hospital").alias("matched_by"), F.col("new_notes").alias("notas"))
    rest = hit.filter("s is null").select(key, "_n", "new_state", "new_notes")
    same = rest.join(have.select("_n", "id", F.col("tipo_reporte").alias("state"), F.col("notas").alias("old_notes")), "_n")
    before = F.when(F.col("state").eqNullSafe(F.col("new_state")), "").otherwise(F.concat(F.lit("[Estado anterior: "), F.coalesce("state", F.lit("None")), F.lit("] ")))
    notes = F.concat(strip(F.concat(before, F.coalesce("new_notes", F.lit("")))), F.when(F.coalesce("old_notes", F.lit("")) != "", F.concat(F.lit(" | "), "old_notes")).otherwise(""))
    named = same.filter(may_change(F.col("state"), F.col("new_state"))).select(key, "id", F.lit("nombre").alias("matched_by"), notes.alias("notas"))
    fresh = rest.join(have.select("_n").distinct(), "_n", "left_anti").select(key, F.lit(None).cast(dict(known.dtypes)["id"]).alias("id"), F.lit("insert").alias("matched_by"), F.col("new_notes").alias("notas"))
    return sure.unionByName(named).unionByName(fresh)


def imported(incoming: DataFrame, known: DataFrame, new_id: Column, now: Column, key: str = "row_id") -> DataFrame:
    """known after importing the rows of incoming by their plan: the columns that both have, created_at and updated_at.

    Each row is planned against the table as it was before; null columns of a row leave what is there. Of several rows
    that hit one, those count that may change its state one after the other by key, and the last of them has its columns;
    of several new ones of a name, in any case, the first by key is inserted, under new_id."""
    columns = [c for c in known.columns if c in incoming.columns and c not in ("id", "notas", "created_at", "updated_at")]
    plan = import_plan(incoming, known, key)
    rows = plan.join(incoming.select(key, *(F.col(c).alias(f"_n_{c}") for c in columns), new_id.alias("_new"), F.lower(F.trim("nombre")).alias("_name")), key)
    hits, state = rows.filter("id is not null"), F.col("_n_tipo_reporte")
    firsts = hits.groupBy("id").agg(F.min(F.when(state == "fallecido", F.col(key))).alias("dead"), F.min(F.when(state != "desaparecido", F.col(key))).alias("better"))
    missing = F.coalesce(state == "desaparecido", F.lit(False))
    ok = (F.col("dead").isNull() | (F.col(key) <= F.col("dead"))) & (~missing | F.col("better").isNull() | (F.col(key) < F.col("better")))
    last = hits.join(firsts, "id").filter(ok).groupBy("id").agg(F.max_by(F.struct(*(f"_n_{c}" for c in columns), F.col("notas").alias("_notes")), key).alias("r"))
    out = known.join(last, "id", "left")
    changed = F.col("r").isNotNull()
    out = out.withColumns({c: F.coalesce(F.col(f"r._n_{c}"), F.col(c)) for c in columns} | {"notas": F.when(changed, F.coalesce("r._notes", "notas")).otherwise(F.col("notas")), "updated_at": F.when(changed, now).otherwise(F.col("updated_at"))}).drop("r")
    fresh = rows.filter("id is null").groupBy("_name").agg(F.min_by(F.struct("_new", "notas", *(f"_n_{c}" for c in columns)), key).alias("r"))
    fresh = fresh.select(F.col("r._new").alias("id"), F.col("r.notas").alias("notas"), *(F.col(f"r._n_{c}").alias(c) for c in columns), now.alias("created_at"), now.alias("updated_at"))
    return out.select(*known.columns).unionByName(fresh, allowMissingColumns=True)


def once(rows: DataFrame, keys: list[str], order: str, any_case: bool = True) -> DataFrame:
    """The first row by order of each composite key, in any case of letters or exactly; null counts as empty."""
    made = {f"_k{i}": (F.upper if any_case else (lambda c: c))(F.coalesce(F.col(k), F.lit(""))) for i, k in enumerate(keys)}
    first = rows.groupBy(*(v.alias(k) for k, v in made.items())).agg(F.min(F.struct(order, F.struct(*rows.columns).alias("row"))).alias("first"))
    return first.select("first.row.*")


def filled(old: DataFrame, new: DataFrame, key: str, column: str, origin: str, first: str, second: str) -> DataFrame:
    """old (key, column, origin and more) completed by new (the same columns, of the origin second): an empty column is
    filled, the origin first becomes both, and keys that old lacks are added."""
    a = old.withColumn("_old", F.lit(True))
    b = new.select(key, *(F.col(c).alias(f"_n_{c}") for c in new.columns if c != key)).withColumn("_new", F.lit(True))
    both = a.join(b, key, "full")
    known, met = F.col("_old").isNotNull(), F.col("_new").isNotNull()
    value = F.when(known & (F.coalesce(F.col(column), F.lit("")) == "") & met, F.col(f"_n_{column}")).when(known, F.col(column)).otherwise(F.col(f"_n_{column}"))
    source = F.when(known & met & (F.col(origin) == first), f"{first} + {second}").when(known, F.col(origin)).otherwise(second)
    others = [c for c in old.columns if c not in (key, column, origin)]
    kept = [F.when(known, F.col(c)).otherwise(F.col(f"_n_{c}") if c in new.columns else F.lit(None)).alias(c) for c in others]
    return both.select(key, *kept, value.alias(column), source.alias(origin))


def resume(wanted: DataFrame, done: DataFrame, key: str) -> DataFrame:
    return wanted.join(done.select(key), key, "left_anti")
