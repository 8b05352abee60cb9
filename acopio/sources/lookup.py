"""Looking ids up in a web registry: a page of results for each id, then a page of details for its first result."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import location_parts, strip

#: Labels of the registry's pages.
NAME, PLACE, SLUG = 'data-label="Nombre"', 'data-label="Ubicaci[oó]n"', "/es/persona_venezuela/"
IDENT, BORN, WHERE = "[Cc][eé]dula", "(?:Fecha de )?Nacimiento", "[Uu]bicaci[oó]n"


def text_after(html: Column, mark: str) -> Column:
    """The first text after a mark and the tags that follow it; empty without one."""
    return strip(F.regexp_extract(html, rf"{mark}[^<>]*(?:>\s*|(?:\s*<[^<>]*>)+\s*)(?:<[^<>]*>\s*)*([^<]+)", 1))


def cell(html: Column, mark: str) -> Column:
    """The text of a table's cell by the attribute that names it; empty without one."""
    return strip(F.regexp_extract(html, rf"{mark}[^<>]*>(?:<[^/<>][^<>]*>)*([^<]*)<", 1))


def search_results(searches: DataFrame, base: str) -> DataFrame:
    """searches (cedula_input, body) with what the first row of results says: found, nombre, place, total, detail_url."""
    rows = F.regexp_extract_all("body", F.lit(r'(?s)<tr class="(?:odd|even)">.*?</tr>'), F.lit(0))
    first = F.get(F.col("_rows"), F.lit(0))
    slug = F.regexp_extract(first, rf'href="{SLUG}([^"]+)"', 1)
    out = searches.withColumn("_rows", rows).withColumn("_slug", F.coalesce(slug, F.lit("")))
    return out.select(
        "cedula_input", (F.col("_slug") != "").alias("found"), cell(first, NAME).alias("nombre"), cell(first, PLACE).alias("place"), F.size("_rows").alias("total"),
        F.when(F.col("_slug") != "", F.concat(F.lit(base + SLUG), "_slug")).alias("detail_url"),
    )


def registry_lookup(ids: DataFrame, searches: DataFrame, details: DataFrame, base: str) -> DataFrame:
    """A row for each of ids (cedula_input): what searches (cedula_input, body) and the pages of details (url, body) that
    they lead to say. Ids without a result, or with one that leads nowhere, have found = false; what a page of details
    lacks is taken from the search."""
    hits = search_results(searches, base).filter("found")
    page = details.select(F.col("url").alias("detail_url"), F.col("body").alias("_page"))
    out = ids.select("cedula_input").join(hits, "cedula_input", "left").join(page, "detail_url", "left")
    text = F.coalesce("_page", F.lit(""))
    known = F.coalesce("found", F.lit(False))
    own = lambda mine, other: F.when(mine != "", mine).otherwise(other)
    place = own(text_after(text, rf"{WHERE}\s*</[^>]+>"), F.coalesce("place", F.lit("")))
    out = out.withColumns({"_where": F.when(known, place), "_born": text_after(text, rf"{BORN}\s*</[^>]+>"), "_ident": text_after(text, rf"{IDENT}\s*</[^>]+>"), "_name": text_after(text, r"<h1")})
    parts = location_parts(F.col("_where"))
    return out.select(
        "cedula_input", known.alias("found"), F.when(known, own(F.col("_name"), F.col("nombre"))).alias("nombre"), F.when(known, F.col("_ident")).alias("cedula_formateada"), F.when(known, F.col("_born")).alias("fecha_nacimiento"),
        F.col("_where").alias("ubicacion"), *(F.when(known, parts[c]).alias(c) for c in ("parroquia", "municipio", "estado")), "detail_url", F.col("total").alias("resultados_total"),
    )
