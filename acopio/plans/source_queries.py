"""Queries that read raw files of every source, made of the test tables, and SQL for the rows that they must give.

A file holds the records of 50 persons in the source's own shape (JSON, XML, CSV, HTML, component stream). The SQL knows
nothing of files: it maps the raw keys to columns by the sources' rules, one profile at a time."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text
from ..functions.status import WORDS
from ..operators import content, merge, repair
from ..sources import datasource, readers, specs
from ..sources import lookup as pages
from ..sources.specs import PERSON
from ..streaming import ingest
from .queries import _P, QUERIES, SQL, people, query, table
from .scratch import Scratch

_ROWS = 50


def _word(*words: str | None) -> str:
    return f"CASE id % {len(words)} " + " ".join(f"WHEN {k} THEN " + ("CAST(NULL AS STRING)" if w is None else f"'{w}'") for k, w in enumerate(words)) + " END"


#: Names and places without characters that markup, quoting or braces would need to escape.
_N = "translate(nombre, '<>&\"{}[]|/', '')"
_H = "translate(hospital, '<>&\"{}[]|/', '')"
_ID = "CAST(id AS STRING)"
_E = "trim(edad)"
_FACES = _word("data:image/png;base64,AA", "http://fotos/1", None)


@dataclass(frozen=True)
class Raw:
    """One source's files: raw keys with their values, and how a record and a file are written."""

    keys: dict[str, str]
    record: Callable[[dict[str, F.Column]], F.Column] | None = None
    head: str = "["
    between: str = ","
    tail: str = "]"
    #: A file's number and body as it is written in the end.
    shape: Callable[[F.Column, F.Column], F.Column] | None = None


def _wrapped(name: str) -> dict[str, str]:
    return {"head": '{"' + name + '":[', "tail": '],"total":1}'}


def _text(*parts) -> F.Column:
    return F.concat(*(F.coalesce(p, F.lit("")) if isinstance(p, F.Column) else F.lit(p) for p in parts))


def _csv_row(keys: dict[str, str]) -> dict:
    quoted = lambda c: _text('"', c, '"')
    return {"record": lambda v: F.concat_ws(",", *(quoted(v[k]) for k in keys)), "head": "TITULO,,\n" + ",".join(keys) + "\n", "between": "\n", "tail": "\n"}


_SHEET = {"N°": _ID, "HOSPITAL": _H, "APELLIDOS Y NOMBRES": _N, "EDAD": _E, "CÉDULA / ID": "cedula", "SEXO": _word("M", "F", "x", None), "TELÉFONO": "telefono_familiar", "DIRECCIÓN / PROCEDENCIA": "ciudad", "OBSERVACIONES": _word("obs", None), "TAB DE ORIGEN": _word("tab", "", None), "DIAGNÓSTICO": _word("fractura", None), "ESTADO": _word("Alta", "fallecida", None)}
_DRIVE = {"APELLIDO(S)": "split_part(" + _N + ", ' ', 1)", "NOMBRE(S)": "split_part(" + _N + ", ' ', 2)", "nombre_final": _word("Zoe Final", None), "CÉDULA/ID": "cedula", "EDAD": _E, "SEXO": _word("M", "F", "masculino", None), "HOSPITAL/CENTRO": _H, "ÁREA/ZONA": _word("A1", None), "PISO/CAMA": _word("P2", "", None), "PROCEDENCIA": "ciudad", "DIAGNÓSTICO/SERVICIO": _word("dx", None, None), "ESTADO/CONDICIÓN": _word("Fallecido", "deceased", "estable", None), "FAMILIAR": "telefono_familiar", "COMENTARIOS": _word("c", None)}
_WORDS = _word("Hospitalizado", "desaparecido", "fallecido", "Encontrado", "xyz", None)


def _person_xml(v: dict) -> F.Column:
    tag = lambda n, c: _text(f"<pfif:{n}>", c, f"</pfif:{n}>")
    return F.concat(F.lit("<pfif:person>"), *(tag(k, v[k]) for k in ("person_record_id", "full_name", "age", "photo_url", "source_name")), F.lit("<pfif:note>"), tag("status", v["note_status"]), tag("text", v["note_text"]), F.lit("</pfif:note></pfif:person>"))


def _xml_shapes(f: F.Column, body: F.Column) -> F.Column:
    """Files by number: as they are, another prefix, cut off, names in CDATA, comments and numeric entities, another
    namespace, persons inside a group."""
    cdata = F.regexp_replace(body, "<pfif:full_name>([^<]*)<", "<pfif:full_name><![CDATA[$1]]><")
    entities = F.replace(F.replace(body, F.lit("<pfif:full_name>"), F.lit("<pfif:full_name>&#88;&#x20;")), F.lit("<pfif:note>"), F.lit("<!-- <pfif:full_name>Nadie</pfif:full_name> --><x:note xmlns:x='http://otro/'><x:status>believed_dead</x:status></x:note><pfif:note>"))
    ghost = F.replace(entities, F.lit("</pfif:pfif>"), F.lit("<!-- <pfif:person><pfif:full_name>Nadie</pfif:full_name></pfif:person> --></pfif:pfif>"))
    group = F.replace(F.replace(body, F.lit('1.4/">'), F.lit('1.4/"><pfif:group>')), F.lit("</pfif:pfif>"), F.lit("</pfif:group></pfif:pfif>"))
    shapes = [body, F.replace(F.replace(body, F.lit("pfif:"), F.lit("p:")), F.lit("xmlns:pfif="), F.lit("xmlns:p=")), F.substr(body, F.lit(1), F.length(body) - 40), cdata, ghost, F.replace(body, F.lit("zesty.ca"), F.lit("otro.org")), group]
    out = shapes[0]
    for k, shaped in enumerate(shapes[1:], 1):
        out = F.when(f % len(shapes) == k, shaped).otherwise(out)
    return out


def _osiris_html(v: dict) -> F.Column:
    cells = [_text(f"<div><strong>{k}</strong> <span>", v[k], "</span></div>") for k in v if not k.startswith("#")]
    return _text('<details class="patient-card" open><summary><span class="patient-name">', v["#name"], '</span><span class="patient-id">', v["#id"], '</span></summary><div class="details-grid">', *cells, "</div></details>")


def _ficha_html(v: dict) -> F.Column:
    cells = [_text(f'<span class="ficha__k">{k}</span> <span class="ficha__v">', v[k], "</span>") for k in v if not k.startswith("#")]
    return _text('<section class="tarjeta" aria-label="Resultado: ', v["#aria"], '"><h2 class="resultado__titulo">', v["#title"], '</h2><span class="sello"><span class="sello__punto"/> ', v["#seal"], "</span>", *cells, "</section>")


def _stream(v: dict) -> F.Column:
    plain = [_text(f',"{k}":"', v[k], '"') for k in ("firstName", "lastName", "age", "idNumber", "currentHospital", "foundLocation", "notes")]
    return _text('{"id":"', v["id"], '"', *plain, ',"hospital":', v["hospital"], ',"redacted":false}')


_STREAM = {"id": f"concat('cm', {_ID})", "firstName": "split_part(" + _N + ", ' ', 1)", "lastName": "split_part(" + _N + ", ' ', 2)", "age": _E, "idNumber": "cedula", "currentHospital": _word("Centro", "", "Otro"), "foundLocation": _word("", "Zona"), "notes": _word("FALLECIDO en sala", "de alta", "sin novedad", "Ingreso ayer", ""), "hospital": _word('{"name":"Hosp Uno","location":"Norte"}', '"$1a:props:hospital:12"', "null", '{"name":"","location":"Sur"}', '"$1a:props:hospital:12"')}

RAW: dict[str, Raw] = {
    "aquiestoyvenezuela": Raw({"id": _ID, "nombre": "nombre", "cedula": "cedula", "edad": _E, "ciudad": "ciudad", "ultima_ubicacion": "hospital", "ubicacion_encontrado": _word("Refugio", " ", None), "estado": _word("Desaparecido", "MISSING", "deceased", "encontrado", None), "foto_url": _FACES, "telefono_contacto": "telefono_familiar", "nombre_de_quien_lo_busca": _word("Tia", None), "observaciones": "notas", "encontrado_por": _word(None, "Vecino"), "telefono_quien_encuentra": "telefono_familiar"}, **_wrapped("records")),
    "busquedaunificadavzla": Raw({"person_record_id": f"CASE WHEN id % 4 = 0 THEN '' ELSE concat('r/', {_ID}) END", "full_name": _N, "age": _E, "photo_url": _FACES, "source_name": _word("Fuente", None), "note_status": _word("believed_missing", "believed_dead", "believed_alive", "information_sought", ""), "note_text": _word("texto &amp; mas", "")}, _person_xml, '<pfif:pfif xmlns:pfif="http://zesty.ca/pfif/1.4/">', "\n", "</pfif:pfif>", _xml_shapes),
    "busquedavzla": Raw({"id": _ID, "nombre": "nombre", "edad": _E, "estado": _word("buscando", "Buscando", "encontrado", None), "desc": "notas", "estadoUb": "ciudad", "visto": _word("ayer", None), "foto": _FACES, "repNombre": _word("Rep", None), "repTel": "telefono_familiar", "apodo": _word("Nene", None, ""), "referencia": _word("plaza", None), "notas": "notas"}),
    "busquedavzla_sheet": Raw(_SHEET, **_csv_row(_SHEET)),
    "desaparecidos_terremoto": Raw({"nombre": "nombre", "cedula": "cedula", "edad": _E, "ubicacion": "hospital", "ciudad": "ciudad", "estado": _WORDS, "condicion": _word("grave", None), "descripcion": "notas"}, **_wrapped("items")),
    "drive_sismo_vzla": Raw(_DRIVE, **_csv_row(_DRIVE)),
    "encuentralos": Raw({"id": _ID, "nombre": "nombre", "edad": _E, "cedula": "cedula", "sexo": "sexo", "foto": _FACES, "estado": _WORDS, "ultima_ubicacion": "ciudad", "reporta_contacto": "telefono_familiar", "descripcion": "notas", "pv_por": _word("P", None), "pv_contacto": _word(None, "04"), "pv_lugar": "hospital", "pv_salud": _word("bien", None)}, **_wrapped("items")),
    "hospital_json": Raw({"nombre_completo": "concat(' ', nombre, '  Perez ')", "cedula": "cedula", "edad": _E, "condicion": _word("Alta médica", "transferido", "desaparecido", "otro", None), "hospital": "hospital", "ciudad": "ciudad", "estado_paciente": _word("estable", None), "observaciones": "notas"}, **_wrapped("pacientes")),
    "hospitalesdevenezuela": Raw(_STREAM, _stream, '0:"corto"\n1:{"people":[', ",", "]}"),
    "hospitalesenvenezuela": Raw({"nombre": "nombre", "cedula": "cedula", "centro": "hospital", "condicion": _WORDS, "cama": _word("12-B", None)}),
    "localizadosvenezuela": Raw({"slug": f"concat('s-', {_ID})", "nombreCompleto": "CASE WHEN id % 10 = 3 THEN NULL ELSE nombre END", "edad": _E, "cedula": "cedula", "condicion": _WORDS, "direccion": "ciudad", "lugarNombre": "hospital", "observaciones": "notas", "telefono": "telefono_familiar"}, **_wrapped("data")),
    "localizapacientes": Raw({"id": _ID, "nombreCompleto": "nombre", "edad": _E, "condicion": _WORDS, "hospital": "hospital", "ciudad": "ciudad", "estado": _word("Miranda", None), "direccion": "notas"}, **_wrapped("resultados")),
    "osirisberbesia": Raw({"#name": _N, "#id": "cedula", "Edad": _E, "Hospital": _H, "Teléfono": "telefono_familiar", "Dirección": "ciudad", "Condición": _word("estable", ""), "Sala": _word("S1", ""), "Cama": _word("", "C9", ""), "Observaciones": _word("obs", "")}, _osiris_html, "<html>", "\n", "</html>"),
    "reencuentrohelp": Raw({"id": _ID, "display_name": "nombre", "cedula": "cedula", "age_min": "CAST(CASE WHEN id % 5 = 0 THEN NULL ELSE id % 30 END AS INT)", "age_max": "CAST(CASE WHEN id % 3 = 0 THEN 0 WHEN id % 3 = 1 THEN id % 30 ELSE 40 END AS INT)", "gender": _word("m", "f", "Male", None), "photo_url": _FACES, "kind": _word("missing", "found", "other", None), "status": _word("open", None), "region": "ciudad", "description": "notas", "senas": _word("tatuaje", None), "location_detail": _word(None, "esquina")}, **_wrapped("records")),
    "reportevenezuela": Raw({"#aria": _N, "#title": _word("Localizado", "Fallecido", "Ingresado &amp; estable"), "#seal": f"CASE id % 3 WHEN 0 THEN concat('Fuente oficial · ', coalesce({_H}, '')) WHEN 1 THEN 'Comunidad' ELSE concat('Comunidad · &Ntilde; ', {_ID}) END", "Nombre": f"CASE WHEN id % 5 = 0 THEN '' ELSE {_N} END", "Cédula": "cedula", "Edad": f"concat({_ID}, ' años')", "Estado": _word("en casa", "", "sala &#65;"), "Lugar": _H, "Contacto": "telefono_familiar"}, _ficha_html, "<html>", "\n", "</html>"),
    "sismo_ehr": Raw({"nombre": "nombre", "cedula": "cedula", "edad": _E, "sexo": _word("M", "F", "m", None), "servicio": _word("UCI", None), "estado": _word("deceased", "alive", "discharged", "critical", None)}, None, '{"facility":{"code":"XX1","name":"Hospital Uno"},"rows":[', ",", "]}"),
    "tebusco": Raw({"uid": _ID, "name": "nombre", "cid": "cedula", "state": _word("missing", "reunited", "found", "dead", "Missing", None), "place": "ciudad", "by_who": _word("B", None), "phone": "telefono_familiar", "msg": "notas", "color_pulsera": _word("azul", None), "codigo_pulsera": _word(None, "77", "")}),
    "ubicame": Raw({"person_record_id": f"concat('P-', {_ID})", "full_name": "nombre", "age": _E, "ext_venezuela_ci": "cedula", "hospital": "hospital", "last_known_location": "ciudad", "status": _word("believed_alive", "believed_missing", "believed_dead", "information_sought", None), "notes": "notas", "phone": "telefono_familiar"}, None, "﻿["),
    "ucv_aparecidos": Raw({"id": _ID, "nombre": "nombre", "edad": _E, "cedula": "cedula", "foto_signed_url": _FACES, "estado": _word("aparecido", "Aparecido", "fallecido", "buscado", None), "ultima_ubicacion": "ciudad", "tipo_confirmacion": _word("llamada", None), "detalles_confirmacion": "notas", "nombre_contacto": _word("Con", None), "telefono_contacto": "telefono_familiar", "registrado_por": _word("Reg", None), "reportado_aparicion_por": _word("Apa", None, None), "contacto_reportador": _word(None, "09"), "descripcion": _word("alto", None), "carrera": _word("Letras", None, ""), "facultad": _word(None, "Humanidades")}),
    "venezuelatebusca": Raw({"full_name": "nombre", "cedula": "cedula", "age": _E, "location": "hospital", "status": _WORDS, "notes": "notas"}),
}


def files(spark: SparkSession, sf_dir: str, source: str) -> DataFrame:
    """url and body of a source's files; each holds at most 50 records."""
    raw = RAW[source]
    rows = people(spark, sf_dir)
    named = {k: f"_v{i}" for i, k in enumerate(raw.keys)}
    rows = rows.select("id", F.floor(F.col("id") / _ROWS).alias("f"), *(F.expr(e).alias(named[k]) for k, e in raw.keys.items()))
    record = raw.record({k: F.col(a) for k, a in named.items()}) if raw.record else F.to_json(F.struct(*(F.col(a).alias(k) for k, a in named.items())))
    each = rows.select("id", "f", record.alias("record")).groupBy("f").agg(F.sort_array(F.collect_list(F.struct("id", "record"))).alias("all"))  # at most _ROWS records
    body = F.concat(F.lit(raw.head), F.array_join(F.transform("all", lambda x: x["record"]), raw.between), F.lit(raw.tail))
    body = raw.shape(F.col("f"), body) if raw.shape else body
    return each.select(F.concat(F.lit("file-"), F.col("f").cast("string")).alias("url"), F.encode(body, "UTF-8").alias("body"))


def b(key: str) -> str:
    """SQL: a raw key's text, stripped; blank is null."""
    return f"""nullif(regexp_replace(CAST("{key}" AS VARCHAR), '^\\s+|\\s+$', '', 'g'), '')"""


def _or(*keys: str) -> str:
    return f"coalesce({', '.join(map(b, keys))})"


def _note(sep: str, *parts: tuple[str, str]) -> str:
    return f"nullif(concat_ws('{sep}', " + ", ".join(f"CASE WHEN {b(k)} IS NOT NULL THEN concat('{label}', {b(k)}) END" for label, k in parts) + "), '')"


def _any(words: list[str]) -> str:
    return ", ".join(f"'{w}'" for w in words)


def _default_state(raw: str, more: dict[str, str]) -> str:
    words = {w: s for s, ws in WORDS.items() for w in ws} | more
    return f"CASE " + " ".join(f"WHEN lower({raw}) IN ({_any([w for w, x in words.items() if x == s])}) THEN '{s}'" for s in WORDS) + " ELSE 'desaparecido' END"


def _sex(raw: str, table_: dict[str, str] | None) -> str:
    if table_ is None:
        return f"CASE WHEN lower({raw}) IN ('m', 'masculino', 'male', 'hombre') THEN 'Masculino' WHEN lower({raw}) IN ('f', 'femenino', 'female', 'mujer') THEN 'Femenino' ELSE {raw} END"
    return "CASE " + " ".join(f"WHEN {raw} = '{k}' THEN '{v}'" for k, v in table_.items()) + " END" if table_ else raw


def _cased(raw: str, words: dict[str, str], otherwise: str, any_case: bool = False) -> str:
    key = f"lower({raw})" if any_case else raw
    return f"CASE " + " ".join(f"WHEN {key} = '{w}' THEN '{s}'" for w, s in words.items()) + f" ELSE '{otherwise}' END"


def _md5(source: str, *parts: str) -> str:
    return f"concat('{source}:', substr(md5(concat_ws(':', {', '.join(f'coalesce({p}, {chr(39) * 2})' for p in parts)})), 1, 12))"


def _sha(prefix: str, *parts: str) -> str:
    return f"concat('{prefix}:', substr(sha256(concat_ws('|', {', '.join(f'coalesce({p}, {chr(39) * 2})' for p in parts)})), 1, 16))"


def _own(prefix: str, key: str) -> str:
    return f"concat('{prefix}:', coalesce({b(key)}, ''))"


def _sql(source: str, columns: dict[str, str], keep: str) -> str:
    raw = ", ".join(f"{e.replace('AS STRING', 'AS VARCHAR')} AS \"{k}\"" for k, e in RAW[source].keys.items())
    return f"{_P}, raw AS (SELECT id AS n, CAST(floor(id / {_ROWS}) AS BIGINT) AS f, {raw} FROM people), made AS (SELECT n, f, {', '.join(f'{e} AS {c}' for c, e in columns.items())} FROM raw) SELECT {', '.join((c if c in columns else f'CAST(NULL AS VARCHAR) AS {c}') for c in PERSON)} FROM made WHERE ({keep})"


def _pages(source: str, columns: dict[str, str], ident: str | None = None, words: dict[str, str] | None = None, files_kept: str = "true") -> None:
    """Registers the pipeline profile: unknown states are desaparecido, a missing state text is the state's name, inline
    photos go, ids that are missing are hashes of source, name and id number."""
    c = dict(columns)
    c["tipo_reporte"] = _default_state(f"coalesce({c.get('tipo_reporte', 'NULL')}, '')", words or {})
    c["estado"] = f"coalesce({c.get('estado', 'NULL')}, upper(substr({c['tipo_reporte']}, 1, 1)) || substr({c['tipo_reporte']}, 2))"
    if "sexo" in c:
        c["sexo"] = _sex(c["sexo"], None)
    if "foto_url" in c:
        c["foto_url"] = f"CASE WHEN NOT starts_with({c['foto_url']}, 'data:') THEN {c['foto_url']} END"
    usual = _md5(source, f"'{source}'", c["nombre"], c.get("cedula", "NULL"))
    c |= {"id": f"coalesce({ident}, {usual})" if ident else usual, "spider_name": f"'{source}'", "fuente_url": "concat('file-', f)"}

    def run(spark, sf_dir):
        return specs.persons(files(spark, sf_dir, source), source)

    QUERIES[f"source_{source}"] = run
    SQL[f"source_{source}"] = _sql(source, c, ("nombre IS NOT NULL OR cedula IS NOT NULL" if "cedula" in c else "nombre IS NOT NULL") + f") AND ({files_kept}")


def _parsed(source: str, columns: dict[str, str], ident: str, state: str, sexes: dict[str, str] | None = None, keep: str = "nombre IS NOT NULL") -> None:
    """Registers the parser profile."""
    c = dict(columns) | {"id": ident, "tipo_reporte": state, "spider_name": f"'{source}'", "fuente_url": "concat('file-', f)"}
    if "sexo" in c:
        c["sexo"] = _sex(c["sexo"], sexes)

    def run(spark, sf_dir):
        return specs.persons(files(spark, sf_dir, source), source, "parser")

    QUERIES[f"parser_{source}"], SQL[f"parser_{source}"] = run, _sql(source, c, keep)


def _map(**keys: str) -> dict[str, str]:
    return {c: b(k) for c, k in keys.items()}


# The rules below are written from what each source's own reader does, column by column.
_aqui = _map(nombre="nombre", cedula="cedula", edad="edad", ciudad="ciudad", ultimo_lugar="ultima_ubicacion", hospital="ubicacion_encontrado", estado="estado", foto_url="foto_url", telefono_familiar="telefono_contacto", contacto_familiar="nombre_de_quien_lo_busca", notas="observaciones", reportero_nombre="encontrado_por", reportero_telefono="telefono_quien_encuentra")
_pages("aquiestoyvenezuela", _aqui | {"tipo_reporte": b("estado")}, _own("aquiestoy", "id"))
_parsed("aquiestoyvenezuela", _aqui | {"hospital": _or("ubicacion_encontrado", "ciudad")}, _own("aquiestoy", "id"), _cased(b("estado"), {"desaparecido": "desaparecido", "buscando": "desaparecido", "missing": "desaparecido", "fallecido": "fallecido", "deceased": "fallecido"}, "ingresado", True))
# of the seven shapes of XML files those that are cut off or of another namespace have no persons; a group hides them from one profile
_uni_name = f"CASE WHEN f % 7 = 4 THEN trim(concat('X ', coalesce({b('full_name')}, ''))) ELSE {b('full_name')} END"
_uni = _map(edad="age", foto_url="photo_url", estado="note_status", reportero_nombre="source_name") | {"nombre": _uni_name, "notas": f"replace({b('note_text')}, '&amp;', '&')"}
_pages("busquedaunificadavzla", _uni | {"tipo_reporte": b("note_status")}, b("person_record_id"), files_kept="f % 7 NOT IN (2, 5, 6)")
_parsed("busquedaunificadavzla", _uni, f"coalesce({b('person_record_id')}, concat('busquedaunificada:', {_uni_name}))", _cased(b("note_status"), {"believed_missing": "desaparecido", "believed_dead": "fallecido", "believed_alive": "ingresado", "is_note_author": "ingresado", "information_sought": "desaparecido"}, "desaparecido"), keep="nombre IS NOT NULL AND f % 7 NOT IN (2, 5)")
_bv = _map(nombre="nombre", edad="edad", estado="estado", descripcion_fisica="desc", ultimo_lugar="estadoUb", ultimo_contacto="visto", reportero_nombre="repNombre", reportero_telefono="repTel")
_pages("busquedavzla", _bv | {"tipo_reporte": b("estado"), "foto_url": b("foto"), "notas": _note(" | ", ("Apodo: ", "apodo"), ("", "referencia"), ("", "notas"))}, _own("busquedavzla", "id"))
_parsed("busquedavzla", _bv | {"foto_url": f"CASE WHEN NOT starts_with({b('foto')}, 'data:') THEN {b('foto')} END", "notas": _note(" · ", ("Apodo: ", "apodo"), ("Referencia: ", "referencia"), ("", "notas"))}, _own("busquedavzla", "id"), _cased(b("estado"), {"buscando": "desaparecido"}, "ingresado"))
_sheet = _map(nombre="APELLIDOS Y NOMBRES", cedula="CÉDULA / ID", edad="EDAD", sexo="SEXO", hospital="HOSPITAL", telefono_familiar="TELÉFONO", ciudad="DIRECCIÓN / PROCEDENCIA")
_pages("busquedavzla_sheet", _sheet | _map(condicion="DIAGNÓSTICO", tipo_reporte="ESTADO", estado="ESTADO") | {"notas": _note(" | ", ("", "OBSERVACIONES"), ("Fuente: ", "TAB DE ORIGEN"))}, _md5("busquedavzla_sheet", b("APELLIDOS Y NOMBRES"), b("CÉDULA / ID"), "'unknown'"))
_parsed("busquedavzla_sheet", _sheet | {"notas": _note(" · ", ("", "OBSERVACIONES"), ("Fuente: ", "TAB DE ORIGEN"))}, _sha("busquedavzla_sheet", b("APELLIDOS Y NOMBRES"), b("CÉDULA / ID")), "'ingresado'", {"M": "Masculino", "F": "Femenino"})
_pages("desaparecidos_terremoto", _map(nombre="nombre", cedula="cedula", edad="edad", hospital="ubicacion", ciudad="ciudad", tipo_reporte="estado", condicion="condicion", estado="estado", notas="descripcion"))
_drive = _map(cedula="CÉDULA/ID", edad="EDAD", sexo="SEXO", hospital="HOSPITAL/CENTRO", ciudad="PROCEDENCIA", condicion="DIAGNÓSTICO/SERVICIO", estado="ESTADO/CONDICIÓN", contacto_familiar="FAMILIAR", notas="COMENTARIOS")
_both = f"nullif(concat_ws(' ', {b('APELLIDO(S)')}, {b('NOMBRE(S)')}), '')"
_pages("drive_sismo_vzla", _drive | {"nombre": f"coalesce({_both}, {b('nombre_final')})", "cama_sala": f"nullif(concat_ws(' | ', {b('ÁREA/ZONA')}, {b('PISO/CAMA')}), '')", "tipo_reporte": b("ESTADO/CONDICIÓN")}, _md5("drive_sismo_vzla", f"coalesce({_both}, {b('nombre_final')})", b("CÉDULA/ID"), "''"))
_parsed("drive_sismo_vzla", _drive | {"nombre": _both, "cama_sala": f"nullif(concat_ws(' / ', {b('ÁREA/ZONA')}, {b('PISO/CAMA')}), '')"}, _sha("drive_sismo", _both, b("CÉDULA/ID")), _cased(b("ESTADO/CONDICIÓN"), {"fallecido": "fallecido", "fallecida": "fallecido", "deceased": "fallecido"}, "ingresado", True), {"M": "Masculino", "F": "Femenino"})
_enc = _map(nombre="nombre", edad="edad", cedula="cedula", sexo="sexo", foto_url="foto", estado="estado", ultimo_lugar="ultima_ubicacion", telefono_familiar="reporta_contacto", descripcion_fisica="descripcion", reportero_nombre="pv_por", reportero_telefono="pv_contacto", hospital="pv_lugar", condicion="pv_salud")
_pages("encuentralos", _enc | {"tipo_reporte": b("estado")}, _own("encuentralos", "id"))
_parsed("encuentralos", _enc, _own("encuentralos", "id"), _cased(b("estado"), {"desaparecido": "desaparecido", "fallecido": "fallecido", "deceased": "fallecido"}, "ingresado"), {})
_pages("hospital_json", _map(cedula="cedula", edad="edad", tipo_reporte="condicion", hospital="hospital", ciudad="ciudad", condicion="estado_paciente", notas="observaciones") | {"nombre": f"regexp_replace({b('nombre_completo')}, '\\s+', ' ', 'g')"}, None, {"alta médica": "ingresado"})
_two = f"nullif(concat_ws(' ', {b('firstName')}, {b('lastName')}), '')"
_holds = lambda words: "(" + " OR ".join(f"contains(lower(coalesce(notes, '')), '{w}')" for w in words) + ")"
_DEAD, _IN, _NOTED = ["fallecido", "fallecida", "deceased", "obito", "exitus"], ["alta", "hospitalizado", "uci", "estable", "grave", "ingreso", "ingresado"], ["fallecido", "alta", "hospitalizado", "uci", "estable", "grave"]
_pages("hospitalesdevenezuela", _map(edad="age", cedula="idNumber", hospital="currentHospital", ciudad="foundLocation") | {"nombre": _two, "tipo_reporte": f"CASE WHEN {_holds(_DEAD)} THEN 'fallecido' WHEN {_holds(_IN)} THEN 'ingresado' END", "condicion": f"CASE WHEN {_holds(_DEAD + _IN)} THEN {b('notes')} END", "notas": f"CASE WHEN NOT {_holds(_DEAD + _IN)} THEN {b('notes')} END"}, _own("hospitalesvzla", "id"))
SQL["source_hospitalesdevenezuela"] += " AND n % 5 NOT IN (0, 3)"  # those with a hospital described are not flat
_last = "last_value(CASE WHEN starts_with(hospital, '{{') THEN json_extract_string(hospital, '$.{}') END IGNORE NULLS) OVER (PARTITION BY f ORDER BY n ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
_parsed("hospitalesdevenezuela", _map(edad="age", cedula="idNumber") | {"nombre": _two, "hospital": f"coalesce(nullif({_last.format('name')}, ''), {b('currentHospital')})", "ciudad": f"coalesce(nullif({_last.format('location')}, ''), {b('foundLocation')})", "estado": "'localizado'", "condicion": f"CASE WHEN {_holds(_NOTED)} THEN {b('notes')} END", "notas": f"CASE WHEN NOT {_holds(_NOTED)} THEN {b('notes')} END"}, _own("hospitalesvzla", "id"), f"CASE WHEN {_holds(['fallecido'])} THEN 'fallecido' ELSE 'ingresado' END")
_pages("hospitalesenvenezuela", _map(nombre="nombre", cedula="cedula", hospital="centro", tipo_reporte="condicion", condicion="condicion", estado="condicion", notas="cama"))
_loc = _map(nombre="nombreCompleto", edad="edad", cedula="cedula", condicion="condicion", ciudad="direccion", hospital="lugarNombre", notas="observaciones", telefono_familiar="telefono")
_pages("localizadosvenezuela", _loc | _map(tipo_reporte="condicion", estado="condicion"), _own("localizados", "slug"))
_parsed("localizadosvenezuela", _loc | {"estado": "'localizado'"}, _own("localizados", "slug"), "'ingresado'")
_lp = _map(nombre="nombreCompleto", edad="edad", condicion="condicion", hospital="hospital", ciudad="ciudad", estado="estado", notas="direccion")
_pages("localizapacientes", _lp | {"tipo_reporte": b("condicion")}, _own("localizapacientes", "id"))
_parsed("localizapacientes", _lp, _own("localizapacientes", "id"), "'ingresado'")
_os = _map(nombre="#name", cedula="#id", edad="Edad", hospital="Hospital", telefono_familiar="Teléfono", ciudad="Dirección", notas="Observaciones")
_pages("osirisberbesia", _os, _md5("osirisberbesia", b("#name"), b("#id"), b("Hospital")))
_parsed("osirisberbesia", _os | {"condicion": b("Condición"), "cama_sala": _or("Sala", "Cama")}, _sha("osiris", b("#name"), b("#id")), "'ingresado'")
_re = _map(nombre="display_name", cedula="cedula", sexo="gender", foto_url="photo_url", estado="status", ultimo_lugar="region", descripcion_fisica="description")
_pages("reencuentrohelp", _re | {"edad": "CASE WHEN age_min IS NOT NULL AND coalesce(age_max, 0) <> 0 AND age_max <> age_min THEN concat(age_min, '-', age_max) ELSE CAST(age_min AS VARCHAR) END", "tipo_reporte": b("kind"), "notas": _note(" | ", ("", "senas"), ("", "location_detail"))}, _own("reencuentro", "id"))
_parsed("reencuentrohelp", _re | {"edad": "CASE WHEN age_min IS NOT NULL AND age_max IS NOT NULL AND age_max <> age_min THEN concat(age_min, '-', age_max) ELSE CAST(age_min AS VARCHAR) END", "notas": _note(" · ", ("Señas: ", "senas"), ("Detalle ubicación: ", "location_detail"))}, _own("reencuentro", "id"), _cased(b("kind"), {"missing": "desaparecido", "found": "ingresado"}, "ingresado"), {"m": "Masculino", "f": "Femenino"})
_clear = lambda x: f"replace(replace(replace({x}, '&amp;', '&'), '&Ntilde;', 'Ñ'), '&#65;', 'A')"
_kind = f"""CASE WHEN contains("#seal", '·') THEN nullif(trim(split_part({_clear('"#seal"')}, '·', 1)), '') ELSE {_clear(b('#seal'))} END"""
_inst = f"""CASE WHEN contains("#seal", '·') THEN nullif(trim(substr({_clear('"#seal"')}, strpos({_clear('"#seal"')}, '·') + 1)), '') END"""
_said = _clear(_or("Estado", "#title"))
_pages("reportevenezuela", {"nombre": _or("Nombre", "#aria"), "cedula": b("Cédula"), "edad": b("Edad"), "hospital": _inst, "tipo_reporte": _clear(b("#title")), "condicion": _said, "estado": _said, "notas": f"nullif(trim(concat(coalesce({_kind}, ''), ' | ', coalesce({_inst}, '')), ' |'), '')"}, _md5("reportevenezuela", f"upper(replace({_or('Nombre', '#aria')}, 'ß', 'ss'))", f"upper(replace({_inst}, 'ß', 'ss'))"))
_parsed("reportevenezuela", {"nombre": b("Nombre"), "edad": f"regexp_replace({b('Edad')}, '\\s*años$', '')", "hospital": b("Lugar"), "estado": _or("Estado", "#title"), "contacto_familiar": b("Contacto"), "notas": b("#seal")}, _sha("reportevzla", b("Nombre"), "NULL"), "'ingresado'")
_eh = _map(nombre="nombre", cedula="cedula", edad="edad", sexo="sexo", cama_sala="servicio", condicion="estado", estado="estado") | {"hospital": "'Hospital Uno'"}
_pages("sismo_ehr", _eh | {"tipo_reporte": b("estado")}, _md5("sismo_ehr", b("nombre"), b("cedula"), "'XX1'"))
_parsed("sismo_ehr", _eh, _sha("sismo_ehr", b("nombre"), b("cedula")), _cased(b("estado"), {"deceased": "fallecido"}, "ingresado"), {"F": "Femenino", "M": "Masculino"})
_tb = _map(nombre="name", cedula="cid", estado="state", ultimo_lugar="place", reportero_nombre="by_who", telefono_familiar="phone")
_tb_notes = (("", "msg"), ("Pulsera: ", "color_pulsera"), ("Código pulsera: ", "codigo_pulsera"))
_pages("tebusco", _tb | {"tipo_reporte": b("state"), "notas": _note(" | ", *_tb_notes)}, _own("tebusco", "uid"))
_parsed("tebusco", _tb | {"notas": _note(" · ", *_tb_notes)}, _own("tebusco", "uid"), _cased(b("state"), {"missing": "desaparecido", "reunited": "ingresado", "found": "ingresado", "alive": "ingresado", "dead": "fallecido"}, "desaparecido"))
_ub = _map(nombre="full_name", edad="age", cedula="ext_venezuela_ci", hospital="hospital", ultimo_lugar="last_known_location", estado="status", notas="notes", telefono_familiar="phone")
_pages("ubicame", _ub | {"tipo_reporte": b("status")}, _own("ubicame", "person_record_id"))
_parsed("ubicame", _ub, _own("ubicame", "person_record_id"), _cased(b("status"), {"believed_missing": "desaparecido", "believed_dead": "fallecido", "information_sought": "desaparecido"}, "ingresado"))
_uc = _map(nombre="nombre", cedula="cedula", foto_url="foto_signed_url", estado="estado", ultimo_lugar="ultima_ubicacion", confirmacion_tipo="tipo_confirmacion", confirmacion_detalle="detalles_confirmacion", contacto_familiar="nombre_contacto", telefono_familiar="telefono_contacto", reportero_telefono="contacto_reportador")
_uc_notes = (("", "descripcion"), ("Carrera: ", "carrera"), ("Facultad: ", "facultad"))
_pages("ucv_aparecidos", _uc | {"tipo_reporte": b("estado"), "reportero_nombre": _or("reportado_aparicion_por", "registrado_por"), "notas": _note(" | ", *_uc_notes)}, _own("ucv", "id"))
_parsed("ucv_aparecidos", _uc | {"edad": b("edad"), "reportero_nombre": _or("registrado_por", "reportado_aparicion_por"), "notas": _note(" · ", *_uc_notes)}, _own("ucv", "id"), _cased(b("estado"), {"aparecido": "ingresado", "fallecido": "fallecido", "deceased": "fallecido"}, "desaparecido"))
_pages("venezuelatebusca", _map(nombre="full_name", cedula="cedula", edad="age", hospital="location", tipo_reporte="status", estado="status", notas="notes"))


_PLACES = "CASE c_custkey % 4 WHEN 0 THEN concat('Cm. ', c_name, ', Centro, Edo. ', c_mktsegment) WHEN 1 THEN concat('Centro, Edo. ', c_mktsegment) WHEN 2 THEN concat('Edo. ', c_mktsegment) ELSE '' END"


@query(f"""WITH c AS (SELECT *, {_PLACES} AS place FROM customer), found AS (SELECT c_custkey, c_name, place, list_transform(string_split(place, ','), lambda x: trim(x)) AS p FROM c WHERE c_custkey % 3 <> 0)
SELECT CAST(o_custkey AS VARCHAR) AS cedula_input, f.c_custkey IS NOT NULL AND f.c_custkey % 3 <> 2 AS found,
  CASE WHEN f.c_custkey % 3 <> 2 THEN f.c_name END AS nombre, CASE WHEN f.c_custkey % 3 <> 2 THEN CASE WHEN f.c_custkey % 7 = 0 THEN '' ELSE concat('V-', f.c_custkey) END END AS cedula_formateada,
  CASE WHEN f.c_custkey % 3 <> 2 THEN CASE WHEN f.c_custkey % 7 = 0 THEN '' ELSE '01/02/1980' END END AS fecha_nacimiento, CASE WHEN f.c_custkey % 3 <> 2 THEN place END AS ubicacion,
  CASE WHEN f.c_custkey % 3 <> 2 THEN CASE WHEN len(p) >= 3 THEN p[1] ELSE '' END END AS parroquia, CASE WHEN f.c_custkey % 3 <> 2 THEN CASE WHEN len(p) >= 3 THEN p[2] WHEN len(p) = 2 THEN p[1] ELSE '' END END AS municipio,
  CASE WHEN f.c_custkey % 3 <> 2 THEN p[-1] END AS estado, CASE WHEN f.c_custkey % 3 <> 2 THEN concat('https://registro/es/persona_venezuela/p-', f.c_custkey) END AS detail_url, CASE WHEN f.c_custkey % 3 <> 2 THEN 2 END AS resultados_total
FROM (SELECT DISTINCT o_custkey + 100 AS o_custkey FROM orders) LEFT JOIN found f ON f.c_custkey = o_custkey""")
def source_dateas_lookup(spark, sf_dir):
    """Ids are searched for; a result's first row leads to a page of details. A third of customers has no row, a
    third a row without a link; some pages of details hold little."""
    who = table(spark, sf_dir, "customer").select(F.col("c_custkey").cast("string").alias("cedula_input"), "c_custkey", "c_name", F.expr(_PLACES).alias("place"))
    key = F.col("cedula_input")
    link = F.when(F.col("c_custkey") % 3 == 2, "").otherwise(_text('<a href="/es/persona_venezuela/p-', key, '">'))
    row = _text('<tr class="odd"><td data-label="Nombre">', F.when(link == "", "<a>").otherwise(link), F.col("c_name"), '</a></td><td data-label="Ubicación">', F.col("place"), "</td></tr>")
    searches = who.select("cedula_input", F.when(F.col("c_custkey") % 3 == 0, "<table></table>").otherwise(_text("<table>", row, '<tr class="even"><td>otro</td></tr></table>')).alias("body"))
    full = _text("<h1> ", F.col("c_name"), " </h1><dl><dt>Cédula</dt><dd>V-", key, "</dd><dt>Fecha de Nacimiento</dt> <dd>01/02/1980</dd><dt>Ubicación</dt><dd>", F.col("place"), "</dd></dl>")
    details = who.select(F.concat(F.lit("https://registro/es/persona_venezuela/p-"), key).alias("url"), F.when(F.col("c_custkey") % 7 == 0, "<p>vacío</p>").otherwise(full).alias("body"))
    ids = table(spark, sf_dir, "orders").select((F.col("o_custkey") + 100).cast("string").alias("cedula_input")).distinct()
    return pages.registry_lookup(ids, searches, details, "https://registro")


@query("SELECT CAST(s_suppkey * 30 AS VARCHAR) AS cedula, c.c_custkey IS NOT NULL OR p.p_partkey IS NOT NULL AS found, coalesce(CASE WHEN c.c_custkey IS NOT NULL THEN c_name END, p_name) AS nombre FROM supplier LEFT JOIN customer c ON c_custkey = s_suppkey * 30 LEFT JOIN part p ON p_partkey = s_suppkey * 30")
def registry_cascade(spark, sf_dir):
    """The first registry that has the id."""
    wanted = table(spark, sf_dir, "supplier").select((F.col("s_suppkey") * 30).cast("string").alias("cedula"))
    first = table(spark, sf_dir, "customer").select(F.col("c_custkey").cast("string").alias("cedula"), F.col("c_name").alias("nombre"))
    second = table(spark, sf_dir, "part").select(F.col("p_partkey").cast("string").alias("cedula"), F.col("p_name").alias("nombre"))
    return repair.lookup(wanted, first, second)


@query("SELECT p_partkey AS cedula, p_name AS nombre FROM part WHERE contains(upper(p_name), 'AN') ORDER BY p_partkey LIMIT 50")
def registry_name_search(spark, sf_dir):
    return repair.name_search(table(spark, sf_dir, "part").select(F.col("p_partkey").alias("cedula"), F.col("p_name").alias("nombre")), "an", 50)


@query("""WITH old AS (SELECT c_custkey AS cedula, c_name AS nombre, CASE WHEN c_custkey % 3 = 0 THEN c_mktsegment ELSE '' END AS nacimiento, CASE WHEN c_custkey % 2 = 0 THEN 'uno' ELSE 'otro' END AS fuente FROM customer),
new AS (SELECT s_suppkey * 20 AS cedula, s_name AS nombre, 'd' || s_suppkey AS nacimiento FROM supplier)
SELECT coalesce(o.cedula, n.cedula) AS cedula, CASE WHEN o.cedula IS NULL THEN n.nombre ELSE o.nombre END AS nombre, CASE WHEN o.cedula IS NULL OR (o.nacimiento = '' AND n.cedula IS NOT NULL) THEN n.nacimiento ELSE o.nacimiento END AS nacimiento,
  CASE WHEN o.cedula IS NULL THEN 'dos' WHEN n.cedula IS NOT NULL AND o.fuente = 'uno' THEN 'uno + dos' ELSE o.fuente END AS fuente FROM old o FULL JOIN new n ON o.cedula = n.cedula""")
def registry_fill(spark, sf_dir):
    """An empty birth date is filled, a single origin becomes both."""
    old = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("cedula"), F.col("c_name").alias("nombre"), F.expr("CASE WHEN c_custkey % 3 = 0 THEN c_mktsegment ELSE '' END").alias("nacimiento"), F.expr("CASE WHEN c_custkey % 2 = 0 THEN 'uno' ELSE 'otro' END").alias("fuente"))
    new = table(spark, sf_dir, "supplier").select((F.col("s_suppkey") * 20).alias("cedula"), F.col("s_name").alias("nombre"), F.concat(F.lit("d"), F.col("s_suppkey").cast("string")).alias("nacimiento"))
    return merge.filled(old, new, "cedula", "nacimiento", "fuente", "uno", "dos")


@query(f"{_P}, k AS (SELECT *, row_number() OVER (PARTITION BY upper(coalesce(nombre, '')), upper(coalesce(hospital, '')) ORDER BY id) AS r FROM people) SELECT id, nombre, hospital FROM k WHERE r = 1")
def in_run_dedup(spark, sf_dir):
    """The first record of each name and place in any case."""
    return merge.once(people(spark, sf_dir).select("id", "nombre", "hospital"), ["nombre", "hospital"], "id")


@query("SELECT DISTINCT CASE page_id % 3 WHEN 0 THEN 'a' WHEN 1 THEN 'b' ELSE 'c' END AS spider_name, concat(sha256(html), CASE page_id % 4 WHEN 0 THEN '.html' WHEN 1 THEN '.xml' WHEN 2 THEN '.zip' ELSE '.bin' END) AS name, CASE page_id % 4 WHEN 0 THEN 'text/html' WHEN 1 THEN 'text/xml' ELSE 'application/octet-stream' END AS content_type, CAST(strlen(html) AS BIGINT) AS bytes FROM pages WHERE page_id % 10 <> 0")
def object_store(spark, sf_dir):
    """K1, K2: contents that are not known yet, written to a store by source and read again."""
    raw = table(spark, sf_dir, "pages").select("page_id", F.expr("CASE page_id % 3 WHEN 0 THEN 'a' WHEN 1 THEN 'b' ELSE 'c' END").alias("spider_name"), F.expr("CASE page_id % 4 WHEN 0 THEN 'html' WHEN 1 THEN 'xml' WHEN 2 THEN 'zip' END").alias("file_type"), F.encode("html", "UTF-8").alias("body"))
    known = raw.filter("page_id % 10 = 0").select(content.checksum(F.col("body")).alias("checksum"))
    scratch = Scratch(spark, "objects")
    content.put_objects(raw, f"{scratch.root}/store", known)
    stored = spark.read.parquet(f"{scratch.root}/store")
    return stored.select("spider_name", "name", "content_type", F.octet_length("body").cast("long").alias("bytes"))


@query(SQL["run_stats"].replace("AS role", "AS role"))
def stats_sink(spark, sf_dir):
    """K6: a run's statistics, written as JSON and read again."""
    scratch = Scratch(spark, "stats")
    content.write_stats(QUERIES["run_stats"](spark, sf_dir), f"{scratch.root}/stats")
    return spark.read.schema("role string, files long, records long, errors long, empty long").json(f"{scratch.root}/stats")


@query(r"SELECT doc_id, md5(trim(regexp_replace(coalesce(text, ''), '[\x09-\x0D\x1C-\x20\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]+', ' ', 'g'))) AS plain FROM documents")
def collapse_white_space(spark, sf_dir):
    """T7, of whole texts."""
    return table(spark, sf_dir, "documents").select("doc_id", F.md5(text.collapse(F.coalesce("text", F.lit(""))).cast("binary")).alias("plain"))


@query(f"SELECT c_custkey, CASE WHEN len(p) >= 3 THEN p[1] ELSE '' END AS parroquia, CASE WHEN len(p) >= 3 THEN p[2] WHEN len(p) = 2 THEN p[1] ELSE '' END AS municipio, p[-1] AS estado, CASE WHEN len(p) >= 2 THEN p[2] ELSE '' END AS municipio_otro FROM (SELECT c_custkey, list_transform(string_split({_PLACES}, ','), lambda x: trim(x)) AS p FROM customer)")
def location_split(spark, sf_dir):
    """As one registry has it, and what the other one makes of the municipality."""
    rows = table(spark, sf_dir, "customer").withColumns({"p": text.location_parts(F.expr(_PLACES)), "q": text.location_parts(F.expr(_PLACES), second_is_both=True)})
    return rows.select("c_custkey", "p.*", F.col("q.municipio").alias("municipio_otro"))


@query("SELECT item_id, replace(replace(replace(replace(concat(text, ' &#209; &eacute; &lt;b&gt; &amp;amp;'), '&#209;', 'Ñ'), '&eacute;', 'é'), '&lt;b&gt;', '<b>'), '&amp;amp;', '&amp;') AS plain FROM benchmark")
def entity_decode(spark, sf_dir):
    """By name and by number."""
    return table(spark, sf_dir, "benchmark").select("item_id", text.unescape(F.concat("text", F.lit(" &#209; &eacute; &lt;b&gt; &amp;amp;"))).alias("plain"))


@query("SELECT o_orderkey, strftime(o_orderdate, '20%y-%m-%d') AS day, o_orderkey % 2 = 0 AS cron FROM orders")
def dates_and_cron(spark, sf_dir):
    """X14."""
    cron = F.when(F.col("o_orderkey") % 2 == 0, " 0 */12 * * * ").otherwise("0 12 * *")
    return table(spark, sf_dir, "orders").select("o_orderkey", text.iso_date(F.date_format("o_orderdate", "dd-MM-yy")).alias("day"), text.valid_cron(cron).alias("cron"))


@query("SELECT s_suppkey, CASE s_suppkey % 3 WHEN 0 THEN s_name WHEN 1 THEN 'x' END AS found FROM supplier")
def fuzzy_header(spark, sf_dir):
    """The first non-empty value under a header that looks like the id number's."""
    fields = F.expr("CASE s_suppkey % 3 WHEN 0 THEN map('N', 'n', 'CÉDULA o ID', s_name) WHEN 1 THEN map('Cedula', ' ', 'c_dula 2', 'x', 'cedula 3', 'y') ELSE map('Nombre', s_name) END")
    return table(spark, sf_dir, "supplier").select("s_suppkey", text.fuzzy_key(fields, "cedula", "c_dula").alias("found"))


@query("SELECT p_partkey, p_name AS name, p_brand AS place, '2026-06-' || lpad(CAST(1 + p_partkey % 28 AS VARCHAR), 2, '0') AS date FROM part WHERE p_partkey % 4 <> 0")
def text_list(spark, sf_dir):
    """The numbered list: lines of another shape give nothing."""
    day = F.lpad((1 + F.col("p_partkey") % 28).cast("string"), 2, "0")
    line = F.when(F.col("p_partkey") % 4 == 0, F.col("p_name")).otherwise(F.concat(F.col("p_partkey").cast("string"), F.lit(".  "), "p_name", F.lit(" ("), "p_brand", F.lit(", "), day, F.lit("-06-26) ")))
    return table(spark, sf_dir, "part").withColumn("r", readers.numbered_list(line)).filter("r.name is not null").select("p_partkey", "r.*")


#: What stands in the files in place of some records, as JSON; null: a record as it should be.
_BAD = f"CASE WHEN id % 11 = 0 THEN '3' WHEN id % 11 = 1 THEN '\"x\"' WHEN id % 11 = 2 THEN '[1]' WHEN id % 11 = 3 THEN 'null' WHEN id % 11 = 4 THEN concat('{{\"id\":\"', {_ID}, '\",\"nombre\":\" \"}}') WHEN id % 11 = 5 THEN concat('{{\"id\":\"', {_ID}, '\",\"nombre\":\"A\\\\u0000B\"}}') END"
_BAD_SQL = _BAD.replace("AS STRING", "AS VARCHAR").replace("\\\\", "\\")


def _spoiled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of a list of objects, some of whose elements are no records of a person; each 20th is cut off."""
    rows = people(spark, sf_dir).select("id", F.floor(F.col("id") / _ROWS).alias("f"), F.expr(_BAD).alias("bad"), F.concat(F.lit('{"id":"'), F.col("id").cast("string"), F.lit('","nombre":"Ana","edad":'), (F.col("id") % 90).cast("string"), F.lit("}")).alias("good"))
    each = rows.groupBy("f").agg(F.sort_array(F.collect_list(F.struct("id", F.coalesce("bad", "good").alias("record")))).alias("all"))  # at most _ROWS records
    body = F.concat(F.lit('{"items":['), F.array_join(F.transform("all", lambda x: x["record"]), ","), F.lit("]}"))
    body = F.when(F.col("f") % 20 == 7, F.substr(body, F.lit(1), F.length(body) - 5)).otherwise(body)
    return each.select(F.concat(F.lit("file-"), F.col("f").cast("string")).alias("url"), F.encode(body, "UTF-8").alias("body"))


_SPOILED = f"{_P}, r AS (SELECT id, CAST(floor(id / {_ROWS}) AS BIGINT) AS f, id % 11 AS k, {_BAD_SQL} AS bad FROM people), n AS (SELECT *, CAST(row_number() OVER (PARTITION BY f ORDER BY id) - 1 AS INTEGER) AS nth FROM r)"
_LEFT_OUT = "SELECT concat('file-', f) AS url, nth, CASE k WHEN 4 THEN 'no_name' WHEN 5 THEN 'nul_character' ELSE 'not_an_object' END AS error, bad AS raw FROM n WHERE bad IS NOT NULL AND f % 20 <> 7 UNION ALL SELECT DISTINCT concat('file-', f), CAST(NULL AS INTEGER), 'unreadable', NULL FROM n WHERE f % 20 = 7"


@query(f"{_SPOILED} {_LEFT_OUT}")
def record_quarantine(spark, sf_dir):
    """M5: a bad element of a file costs that record only; what went is kept, with the reason."""
    return specs.rejected(_spoiled(spark, sf_dir), "encuentralos").withColumnRenamed("at", "nth")


@query(f"{_SPOILED}, x AS ({_LEFT_OUT}) SELECT error AS kind, count(*) AS n FROM x GROUP BY 1 UNION ALL SELECT 'file', count(DISTINCT f) FROM n UNION ALL SELECT 'person', count(*) FROM n WHERE bad IS NULL AND f % 20 <> 7")
def quarantine_stats(spark, sf_dir):
    """Files, persons and what was left out, by reason."""
    return specs.parse_statistics(_spoiled(spark, sf_dir), "encuentralos")


def _put(spark: SparkSession, sf_dir: str, source: str, folder: str, which: str = "true") -> str:
    """Puts the source's files into a folder, beside those that are there."""
    one_line = F.regexp_replace(F.decode("body", "UTF-8"), "[\r\n]+", " ")
    files(spark, sf_dir, source).filter(which).select(one_line.alias("value")).write.mode("append").option("maxRecordsPerFile", 1).text(folder)
    return folder


_WITHOUT_URL = [c for c in PERSON if c != "fuente_url"]


@query(f"SELECT {', '.join(_WITHOUT_URL)} FROM ({SQL['source_encuentralos']})")
def datasource_persons(spark, sf_dir):
    """A source's files on disk through the data source; its rows are those of source_encuentralos."""
    return datasource.read_persons(spark, _put(spark, sf_dir, "encuentralos", f"{Scratch(spark, 'files').root}/in"), "encuentralos").select(*_WITHOUT_URL)


@query(f"SELECT {', '.join(_WITHOUT_URL)} FROM ({SQL['source_tebusco']})")
def datasource_stream(spark, sf_dir):
    """The same of files that arrive in two parts; each run of the stream reads those that the one before did not."""
    root = Scratch(spark, "files").root
    for part in ("hash(url) % 2 = 0", "hash(url) % 2 <> 0", "false"):
        arriving = datasource.stream_persons(spark, _put(spark, sf_dir, "tebusco", f"{root}/in", part), "tebusco")
        ingest.append_once(arriving, f"{root}/out", f"{root}/cp").awaitTermination()
    return spark.read.parquet(f"{root}/out").select(*_WITHOUT_URL)


@query("SELECT s_suppkey, CAST(n AS INTEGER) AS nth, CASE n WHEN 0 THEN s_name ELSE 'Ana' END AS nombre, CASE n WHEN 0 THEN '' ELSE '7' END AS edad FROM supplier, range(0, 2) r(n) WHERE s_suppkey % 3 <> 2")
def csv_people(spark, sf_dir):
    """The table function in SQL; the header follows a title and a blank row, and files without one give nothing."""
    datasource.register(spark)
    text_ = F.when(F.col("s_suppkey") % 3 == 2, "x,y\n1,2\n").otherwise(F.concat(F.lit("Lista,\n,\nNombre,Edad\n"), "s_name", F.lit("\n\nAna,7\n")))
    bodies = table(spark, sf_dir, "supplier").select("s_suppkey", F.encode(text_, "UTF-8").alias("body"))
    return spark.sql("SELECT s_suppkey, row_number() OVER (PARTITION BY s_suppkey ORDER BY nth) - 1 AS nth, record['Nombre'] AS nombre, record['Edad'] AS edad FROM {bodies}, LATERAL csv_people(body, 'NOMBRE')", bodies=bodies)
