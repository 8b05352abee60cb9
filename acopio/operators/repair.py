"""Repairs as proposed changes (id, field, old_value, new_value, rule_id), applied only by an explicit call."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.compare import compare_names
from ..functions.text import digits, multipart_fields, name_variants, slash_class, suspicious_canonical

#: Names of form fields and the columns they fill.
FORM_FIELDS = {
    "nombre": "nombre", "edad": "edad", "cedula": "cedula", "sexo": "sexo", "foto": "foto_url", "ultima_ubicacion": "ultimo_lugar",
    "reporta_contacto": "telefono_familiar", "descripcion": "descripcion_fisica", "pv_por": "reportero_nombre",
    "pv_contacto": "reportero_telefono", "pv_lugar": "hospital", "pv_salud": "condicion",
}


def variant_classes(people: DataFrame, mark: str | None = None) -> DataFrame:
    """id, nombre, class of rows whose name has a slash."""
    kind = slash_class(F.col("nombre"), mark)
    demoted = F.when((kind == "variantes_ocr") & suspicious_canonical(F.col("nombre")), "canonico_sospechoso").otherwise(kind)
    return people.filter(F.col("nombre").contains("/")).select("id", "nombre", demoted.alias("class"))


def variant_repairs(people: DataFrame, mark: str | None = None) -> DataFrame:
    rows = people.join(variant_classes(people, mark).filter("class = 'variantes_ocr'").select("id"), "id")
    v = name_variants(F.col("nombre"))
    note = F.concat(F.lit("[Variantes de nombre detectadas: "), F.array_join(F.slice(v, F.lit(2), F.size(v)), " | "), F.lit("] "), F.coalesce("notas", F.lit("")))
    changes = F.array(F.struct(F.lit("nombre").alias("field"), F.col("nombre").alias("old_value"), F.get(v, F.lit(0)).alias("new_value")), F.struct(F.lit("notas").alias("field"), F.col("notas").alias("old_value"), note.alias("new_value")))
    return rows.filter(F.size(v) > 1).select("id", F.explode(changes).alias("c")).select("id", "c.*", F.lit("W1").alias("rule_id"))


def multipart_repairs(people: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(changes, ids that cannot be recovered) of rows whose name is a multipart body."""
    bad = people.filter(F.col("nombre").rlike(r"(?i)Content-Disposition:\s*attachment")).withColumn("_f", multipart_fields(F.col("nombre")))
    changes = [
        F.struct(F.lit(c).alias("field"), F.col(c).cast("string").alias("old_value"), F.element_at("_f", f).alias("new_value"))
        for f, c in FORM_FIELDS.items() if c in people.columns
    ]
    good = bad.filter(F.element_at("_f", "nombre").isNotNull()).select("id", F.explode(F.array(*changes)).alias("c")).select("id", "c.*")
    good = good.filter(F.col("new_value").isNotNull() & ((F.col("field") == "nombre") | (F.trim(F.coalesce("old_value", F.lit(""))) == "")))
    return good.withColumn("rule_id", F.lit("W2")), bad.filter(F.element_at("_f", "nombre").isNull()).select("id")


def apply_changes(people: DataFrame, changes: DataFrame) -> DataFrame:
    """people with the proposed values written; the only step that changes anything."""
    fields = [c for c in people.columns if c != "id"]
    new = changes.groupBy("id").agg(F.map_from_entries(F.collect_list(F.struct("field", "new_value"))).alias("_c"))
    kinds = dict(people.dtypes)
    return people.join(new, "id", "left").select("id", *(F.coalesce(F.element_at("_c", c).cast(kinds[c]), F.col(c)).alias(c) for c in fields))


def validated(people: DataFrame, registry: DataFrame) -> DataFrame:
    """id, category, official, score of each row with an id number against the registry (cedula, its key, and nombre);
    entries without a name count as missing."""
    rows = people.filter(F.coalesce("cedula", F.lit("")) != "").withColumn("_d", digits(F.col("cedula")))
    named = registry.filter(F.coalesce("nombre", F.lit("")) != "")
    found = rows.join(named.select(F.col("cedula").alias("_d"), F.col("nombre").alias("official")), "_d", "left")
    out = compare_names(found, "nombre", "official")
    missing = F.col("official").isNull()
    return out.select("id", F.when(missing, "sin_registro").otherwise(F.col("category")).alias("category"), "official", F.when(~missing, F.col("score")).alias("score"))


def with_validation(people: DataFrame, checked: DataFrame) -> DataFrame:
    """people with what validated() found written to cedula_validacion, cedula_nombre_oficial and cedula_similitud; rows
    that were not checked keep what they have."""
    new = checked.select("id", F.col("category").alias("_v"), F.col("official").alias("_o"), F.col("score").alias("_s"))
    out, names = people.join(new, "id", "left"), {"cedula_validacion": ("_v", "string"), "cedula_nombre_oficial": ("_o", "string"), "cedula_similitud": ("_s", "double")}
    for name, (c, kind) in names.items():
        old = F.col(name).cast(kind) if name in people.columns else F.lit(None).cast(kind)
        out = out.withColumn(name, F.when(F.col("_v").isNotNull(), F.col(c)).otherwise(old))
    return out.drop("_v", "_o", "_s")


def lookup(wanted: DataFrame, *registries: DataFrame, key: str = "cedula") -> DataFrame:
    """wanted (key) with the fields of the first registry that has the key, and found. The registries have the key once
    each and the same fields."""
    fields = [c for c in registries[0].columns if c != key]
    out = wanted.select(key)
    for i, r in enumerate(registries):
        out = out.join(r.select(key, F.struct(*fields).alias(f"_r{i}")), key, "left")
    first = F.coalesce(*(F.col(f"_r{i}") for i in range(len(registries))))
    return out.select(key, first.isNotNull().alias("found"), *(first[c].alias(c) for c in fields))


def name_search(registry: DataFrame, part: str, most: int = 50) -> DataFrame:
    """Entries whose name holds the part in any case, those of the smallest keys first."""
    return registry.filter(F.upper("nombre").contains(part.upper())).orderBy("cedula").limit(most)


def validation_stats(rows: DataFrame) -> DataFrame:
    """Rows of each category, zeros among them."""
    kinds = rows.sparkSession.createDataFrame([(k,) for k in ("exacta", "exacta_reordenada", "fonetica", "no_coincide", "sin_registro")], "category string")
    return kinds.join(rows.groupBy("category").agg(F.count(F.lit(1)).alias("n")), "category", "left").select("category", F.coalesce("n", F.lit(0)).cast("long").alias("n"))
