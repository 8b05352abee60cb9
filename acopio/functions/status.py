"""Case states: how sources' words map to them, what state texts suggest, and which changes are allowed."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

STATES = ("ingresado", "dado_de_alta", "fallecido", "desaparecido")

#: Words of sources, lower-case, for each state.
WORDS = {
    "ingresado": ["ingresado", "hospitalizado", "hospitalized", "admitido", "admitted", "en tratamiento", "internado", "transferido", "trasladado", "atendido", "atendida"],
    "dado_de_alta": ["egresado", "alta", "dado de alta", "discharged", "found", "localizado", "encontrado", "encontrada", "aparecido", "aparecida", "reunited", "believed_alive"],
    "fallecido": ["fallecido", "fallecida", "deceased", "muerto", "muerta", "óbito", "exitus", "believed_dead", "reportado fallecido"],
    "desaparecido": ["desaparecido", "desaparecida", "missing", "no localizado", "sin_contacto", "buscando", "sincontacto", "believed_missing", "search", "buscada", "buscado"],
}
#: Parts of words that suggest a state, in the order in which they are tried.
HINTS = {
    "fallecido": ["fallecid", "muert", "deceas", "óbito", "obito", "exitus"],
    "desaparecido": ["desaparecid", "missing", "no localizado", "sin contacto", "sin_contacto"],
    "dado_de_alta": ["alta", "egresad", "localizad", "encontrad", "aparecid", "discharg"],
    "ingresado": ["ingresad", "hospitaliz", "admitid", "internad", "tratamiento"],
}
#: Raw states that the re-parsing profile reads in its own way, and its default, for each source.
PARSER_WORDS = {
    "aquiestoyvenezuela": ({"desaparecido": "desaparecido", "buscando": "desaparecido", "missing": "desaparecido", "fallecido": "fallecido", "deceased": "fallecido"}, "ingresado"),
    "busquedaunificadavzla": ({"believed_missing": "desaparecido", "believed_dead": "fallecido", "believed_alive": "ingresado", "is_note_author": "ingresado", "information_sought": "desaparecido"}, "desaparecido"),
    "busquedavzla": ({"buscando": "desaparecido"}, "ingresado"),
    "drive_sismo_vzla": ({"fallecido": "fallecido", "fallecida": "fallecido", "deceased": "fallecido"}, "ingresado"),
    "encuentralos": ({"desaparecido": "desaparecido", "fallecido": "fallecido", "deceased": "fallecido"}, "ingresado"),
    "reencuentrohelp": ({"missing": "desaparecido", "found": "ingresado"}, "ingresado"),
    "sismo_ehr": ({"deceased": "fallecido", "alive": "ingresado", "critical": "ingresado", "stable": "ingresado", "discharged": "ingresado"}, "ingresado"),
    "tebusco": ({"missing": "desaparecido", "reunited": "ingresado", "found": "ingresado", "alive": "ingresado", "dead": "fallecido"}, "desaparecido"),
    "ubicame": ({"believed_alive": "ingresado", "believed_missing": "desaparecido", "believed_dead": "fallecido", "information_sought": "desaparecido"}, "ingresado"),
    "ucv_aparecidos": ({"aparecido": "ingresado", "fallecido": "fallecido", "deceased": "fallecido"}, "desaparecido"),
}
#: Sources whose words the re-parsing profile takes in any case.
ANY_CASE = {"aquiestoyvenezuela", "drive_sismo_vzla"}


def _mapped(value: Column, words: dict[str, str], default: Column) -> Column:
    out = default
    for state in dict.fromkeys(words.values()):
        out = F.when(value.isin([w for w, s in words.items() if s == state]), state).otherwise(out)
    return out


def map_status(raw: Column, extra: dict[str, str] | None = None) -> Column:
    """The state of a source's word; unknown and missing words are desaparecido."""
    words = {w: s for s, ws in WORDS.items() for w in ws} | (extra or {})
    return _mapped(F.lower(F.coalesce(raw, F.lit(""))), words, F.lit("desaparecido"))


def parser_status(source: str, raw: Column) -> Column:
    words, default = PARSER_WORDS.get(source, ({}, "ingresado"))
    value = F.coalesce(raw, F.lit(""))
    return _mapped(F.lower(value) if source in ANY_CASE else value, words, F.lit(default))


def suggested_status(text: Column) -> Column:
    """The first state of which the text holds a hint, else null."""
    low, out = F.lower(text), F.lit(None).cast("string")
    for state, hints in reversed(HINTS.items()):
        any_ = F.lit(False)
        for h in hints:
            any_ = any_ | low.contains(h)
        out = F.when(any_, state).otherwise(out)
    return out


def default_state_text(estado: Column, tipo: Column) -> Column:
    return F.coalesce(estado, F.initcap(tipo))


def map_sex(raw: Column) -> Column:
    low = F.lower(raw)
    return F.when(low.isin("m", "masculino", "male", "hombre"), "Masculino").when(low.isin("f", "femenino", "female", "mujer"), "Femenino").otherwise(raw)


def drop_inline_photo(url: Column) -> Column:
    return F.when(~url.startswith("data:"), url)


def may_change(now: Column, new: Column) -> Column:
    """Whether a case in the state now may be updated by a report of the state new."""
    return F.when(now.isNull(), True).when(now == "fallecido", False).when(now == "desaparecido", True).otherwise(F.coalesce(new != "desaparecido", F.lit(True)))
