import pytest

from acopio.sources import readers, specs

FILES = {
    "encuentralos": '{"items":[{"id":"a1","nombre":"Ana Prueba Uno","edad":40,"sexo":"m","estado":"Hospitalizado","cedula":null,"foto":"data:x"}],"total":1}',
    "aquiestoyvenezuela": '{"success":true,"records":[{"id":7,"nombre":"Beto Prueba","estado":"encontrado"}],"hasMore":false}',
    "tebusco": '[{"uid":"u1","name":"Carla Prueba","state":"reunited","color_pulsera":"azul"}]',
    "sismo_ehr": '{"facility":{"code":"XX1","name":"Hospital Uno"},"rows":[{"nombre":"Dora Prueba","estado":"deceased"}]}',
    "ubicame": '﻿[{"person_record_id":"P-1","full_name":"ELSA PRUEBA","status":"believed_alive"}]',
    "hospital_json": '{"pacientes":[{"nombre_completo":"Hugo Prueba","condicion":"alta médica"},{}]}',
    "busquedaunificadavzla": "<pfif:pfif xmlns:pfif='http://zesty.ca/pfif/1.4/'><pfif:person><pfif:person_record_id>r/1</pfif:person_record_id><pfif:full_name>Flor Prueba</pfif:full_name><pfif:note><pfif:status>believed_dead</pfif:status></pfif:note></pfif:person></pfif:pfif>",
    "busquedavzla_sheet": "TITULO,,\nN°,HOSPITAL,APELLIDOS Y NOMBRES,EDAD,CÉDULA / ID,SEXO\n1,Hospital Uno,Prueba Gina,33,1234567,F\n2,Hospital Dos,Prueba Iris\n",
    "osirisberbesia": '<details class="patient-card"><summary><span class="patient-name">Hugo Prueba</span><span class="patient-id">7654321</span></summary><div><strong>Edad</strong><span>50</span></div></details>',
    "reportevenezuela": '<section class="tarjeta" aria-label="x"><span class="ficha__k">Nombre</span><span class="ficha__v">Iris Prueba</span><span class="ficha__k">Edad</span><span class="ficha__v">30 años</span></section>',
    "hospitalesdevenezuela": '1:"people":[{"id":"c1","firstName":"Juan","lastName":"Prueba","hospital":{"name":"H1","location":"C1"}},{"id":"c2","firstName":"Karla","lastName":"Prueba","hospital":"$1a","notes":"FALLECIDO"}]',
}


def read(spark, source, profile="pipeline", body=None):
    files = spark.createDataFrame([("u", bytearray((FILES[source] if body is None else body).encode()))], "url string, body binary")
    return specs.persons(files, source, profile).orderBy("id").collect()


@pytest.mark.parametrize("source, nombre, tipo, ident", [
    ("encuentralos", "Ana Prueba Uno", "ingresado", "encuentralos:a1"), ("aquiestoyvenezuela", "Beto Prueba", "dado_de_alta", "aquiestoy:7"),
    ("tebusco", "Carla Prueba", "dado_de_alta", "tebusco:u1"), ("ubicame", "ELSA PRUEBA", "dado_de_alta", "ubicame:P-1"),
    ("busquedaunificadavzla", "Flor Prueba", "fallecido", "r/1"), ("sismo_ehr", "Dora Prueba", "fallecido", None), ("osirisberbesia", "Hugo Prueba", "desaparecido", None),
])
def test_pipeline_profile(spark, source, nombre, tipo, ident):
    r = read(spark, source)[0]
    assert (r.nombre, r.tipo_reporte) == (nombre, tipo) and (ident is None or r.id == ident)


def test_parser_profile(spark):
    assert read(spark, "ubicame", "parser")[0].tipo_reporte == "ingresado"
    r = read(spark, "osirisberbesia", "parser")[0]
    assert (r.edad, r.cedula, r.id[:7], len(r.id)) == ("50", "7654321", "osiris:", 23)


def test_special_shapes(spark):
    assert read(spark, "sismo_ehr")[0].hospital == "Hospital Uno"
    assert read(spark, "hospital_json")[0].tipo_reporte == "ingresado" and len(read(spark, "hospital_json")) == 1
    assert [(r.hospital, r.tipo_reporte) for r in read(spark, "hospitalesdevenezuela", "parser")] == [("H1", "ingresado"), ("H1", "fallecido")]
    assert sorted(r.nombre for r in read(spark, "busquedavzla_sheet")) == ["Prueba Gina", "Prueba Iris"]
    assert read(spark, "reportevenezuela", "parser")[0].edad == "30" and read(spark, "reportevenezuela")[0].edad == "30 años"
    assert read(spark, "encuentralos")[0].foto_url is None


def test_ids_of_pages(spark):
    import hashlib

    md5 = lambda x: hashlib.md5(x.encode()).hexdigest()[:12]
    body = FILES["osirisberbesia"].replace("<div><strong>Edad", '<div><strong>Hospital</strong><span>Centro 1</span></div><div><strong>Edad')
    assert read(spark, "osirisberbesia", body=body)[0].id == "osirisberbesia:" + md5("Hugo Prueba:7654321:Centro 1")
    assert read(spark, "sismo_ehr")[0].id == "sismo_ehr:" + md5("Dora Prueba::XX1")
    files = spark.createDataFrame([("u", bytearray(FILES["busquedavzla_sheet"].encode()), "Tab 3")], "url string, body binary, label string")
    assert {r.id for r in specs.persons(files, "busquedavzla_sheet").collect()} == {"busquedavzla_sheet:" + md5(f"{x}:Tab 3") for x in ("Prueba Gina:1234567", "Prueba Iris:")}
    drive = "a,b,c\nApellido,Nombre,Cedula o c_dula\nDiaz,Eva,77\n"
    assert read(spark, "drive_sismo_vzla", body=drive.split("\n", 1)[1])[0].id == "drive_sismo_vzla:" + md5("Diaz Eva:77:")
    card = '<section class="tarjeta" aria-label="Resultado: Iris Prueba"><span class="sello x"><i></i> Comunidad · Centro Dos</span></section>'
    got = read(spark, "reportevenezuela", body=card)[0]
    assert (got.id, got.hospital, got.notas) == ("reportevenezuela:" + md5("IRIS PRUEBA:CENTRO DOS"), "Centro Dos", "Comunidad | Centro Dos")


def test_broken_files(spark):
    assert read(spark, "aquiestoyvenezuela", body='{"success":true,"total":10}') == []
    assert read(spark, "encuentralos", body="not json") == []


def test_numbered_list(spark):
    r = spark.createDataFrame([("12. Luis Prueba (Centro Uno, 28-06-26)",)], "x string").select(readers.numbered_list(__import__("pyspark").sql.functions.col("x")).alias("r")).first().r
    assert tuple(r) == ("Luis Prueba", "Centro Uno", "2026-06-28")


def test_numbered_lists_are_taken_apart_once(spark):
    """Each part of a line is worked out once, however many others are made of it."""
    from pyspark.sql import functions as F

    lines = {
        " 12. Luis Prueba (Centro Uno, 28-06-26) ": ("Luis Prueba", "Centro Uno", "2026-06-28"), "3.\tAna (B) C (D (x), 1-2)": ("Ana (B) C", "D (x)", "1-2"),
        "x. Ana (B, 01-02-03)": (None,) * 3, "4.Ana (B, 01-02-03)": (None,) * 3, "5. (B, 01-02-03)": (None,) * 3, "6. Ana (B, x)": (None,) * 3, "": (None,) * 3,
    }
    rows = spark.createDataFrame([*[(k,) for k in lines], (None,)], "x string").select("x", readers.numbered_list(F.col("x")).alias("r"))
    assert rows._jdf.queryExecution().analyzed().toString().count("regexp_replace") == 7
    assert {r.x: tuple(r.r) for r in rows.collect()} == lines | {None: (None,) * 3}


def test_streams(spark, tmp_path):
    from acopio.streaming import ingest

    src, out, done = (str(tmp_path / x) for x in ("in", "out", "cp"))
    df = spark.createDataFrame([("a", "x"), ("b", "x"), ("c", "y")], "url string, body string")
    df.coalesce(1).write.parquet(src)
    ingest.append_once(ingest.new_pages(spark, src, df.schema), out, done).awaitTermination()
    df.coalesce(1).write.mode("append").parquet(src)
    ingest.append_once(ingest.new_pages(spark, src, df.schema), out, done).awaitTermination()
    assert spark.read.parquet(out).count() == 2


def test_pages_once_within_a_watermark(spark, tmp_path):
    """State is bounded: a content that comes again within the delay goes, the table of known contents decides later on."""
    import datetime as dt

    from acopio.streaming import ingest

    t = dt.datetime(2026, 1, 1)
    df = spark.createDataFrame([("a", "x", t), ("b", "x", t + dt.timedelta(minutes=5)), ("c", "y", t)], "url string, body string, seen timestamp")
    df.coalesce(1).write.parquet(str(tmp_path / "in"))
    pages = ingest.new_pages(spark, str(tmp_path / "in"), df.schema, within=("seen", "1 hour"))
    ingest.append_once(pages, str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    assert sorted(r.body for r in spark.read.parquet(str(tmp_path / "out")).collect()) == ["x", "y"]


def test_stateful_guard_equals_the_sequence(spark, tmp_path):
    """ST7: each report with whether it counts and the state after it, over several runs, with state for each entity."""
    import itertools

    from acopio.functions.status import STATES
    from acopio.streaming import ingest

    cases = list(enumerate(itertools.product(STATES, repeat=3)))
    kind = "entity string, seq long, kind string"
    want = {}
    for turn in range(3):
        rows = []
        for e, kinds in cases:
            rows.append((f"e{e}", turn, kinds[turn]))
            now = next((want[f"e{e}", s][1] for s in range(turn - 1, -1, -1)), None)
            ok = now is None or now == "desaparecido" or (now != "fallecido" and kinds[turn] != "desaparecido")
            want[f"e{e}", turn] = (ok, kinds[turn] if ok else now)
        spark.createDataFrame(rows, kind).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        reports = spark.readStream.schema(kind).parquet(str(tmp_path / "in"))
        ingest.append_once(ingest.guarded(reports, "entity", "kind", "seq"), str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    got = {(r.entity, r.seq): (r.accepted, r.state) for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert got == want


def test_guard_is_not_called_for_each_entity(spark, tmp_path, monkeypatch):
    """Many entities share a group and its calls, a null one among them; each has a state of its own."""
    from acopio.streaming import ingest

    monkeypatch.setattr(ingest, "GUARDS", 2)
    kind = "entity string, seq long, kind string"
    rows = [(None if e == 0 else f"e{e}", s, k) for e in range(40) for s, k in enumerate(["desaparecido", "ingresado", "desaparecido", "fallecido", "ingresado"])]
    for part in (rows[::2], rows[1::2][::-1]):
        spark.createDataFrame(sorted(part, key=lambda r: -r[1]), kind).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    reports = spark.readStream.schema(kind).parquet(str(tmp_path / "in"))
    ingest.append_once(ingest.guarded(reports, "entity", "kind", "seq"), str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    got = {(r.entity, r.seq): (r.accepted, r.state) for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    want = [(True, "desaparecido"), (True, "ingresado"), (False, "ingresado"), (True, "fallecido"), (False, "fallecido")]
    assert got == {(e, s): want[s] for e, s, _ in rows}


def test_merged_batches(spark, tmp_path):
    from acopio.streaming import ingest

    kind = "e string, kind string, name string, seq long"
    for rows in ([("a", "ingresado", "x", 1), ("b", "fallecido", "y", 1)], [("a", "desaparecido", "z", 2), ("b", "ingresado", "q", 2), ("c", "desaparecido", None, 2)], [("c", "dado_de_alta", "w", 3)]):
        spark.createDataFrame(rows, kind).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        ingest.merge_reports(spark.readStream.schema(kind).parquet(str(tmp_path / "in")), str(tmp_path / "out"), str(tmp_path / "cp"), "e", "kind", ["seq"], ["name"]).awaitTermination()
    last = max((tmp_path / "out").glob("batch=*"), key=lambda p: int(p.name[6:]))
    assert {r.e: (r.state, r.name) for r in spark.read.parquet(str(last)).collect()} == {"a": ("ingresado", "x"), "b": ("fallecido", "y"), "c": ("dado_de_alta", "w")}


def test_xml_files(spark):
    """As an XML parser sees them: cut-off files and unbound prefixes give nothing, CDATA and entities are text, comments and
    other namespaces count for nothing, encodings are obeyed; a broken file leaves others alone."""
    ns = "xmlns:p='http://zesty.ca/pfif/1.4/'"
    person = lambda name, more="": f"<p:person><p:full_name>{name}</p:full_name>{more}</p:person>"
    bodies = {
        "cdata": f"<r {ns}>{person('<![CDATA[Ana <& Cía]]>')}</r>",
        "entities": f"<r {ns}>{person('Jos&#233; &#x4E;u&ntilde;ez').replace('&ntilde;', '&amp;')}</r>",
        "comment": f"<r {ns}><!-- {person('Nadie')} -->{person('Eva')}</r>",
        "cut": f"<r {ns}>{person('Nadie')}",
        "unbound": "<r><p:person><p:full_name>Nadie</p:full_name></p:person></r>",
        "foreign": f"<r {ns} xmlns:q='http://otro/'><q:person><q:full_name>Nadie</q:full_name></q:person>{person('Eva', '<q:age>9</q:age><q:note><q:status>believed_dead</q:status></q:note><p:note><p:status>believed_missing</p:status></p:note>')}</r>",
        "default": "<r xmlns='http://zesty.ca/pfif/1.4/'><person><full_name> Leo </full_name><note><status>believed_dead</status></note><note><status>x</status></note></person></r>",
        "group": f"<r {ns}><p:group>{person('Zoe')}</p:group></r>",
        "empty": "",
    }
    rows = [(k, bytearray(v.encode())) for k, v in bodies.items()] + [("latin", bytearray(f"<?xml version='1.0' encoding='ISO-8859-1'?><r {ns}>{person('Íñigo')}</r>".encode("latin-1"))), ("odd", bytearray(f"<?xml version='1.0' encoding='no-such'?><r {ns}/>".encode())), ("null", None)]
    files = spark.createDataFrame(rows, "url string, body binary").repartition(1)
    for profile, more in (("pipeline", {}), ("parser", {"group": [("Zoe", "desaparecido")]})):
        got = {}
        for r in specs.persons(files, "busquedaunificadavzla", profile).collect():
            got.setdefault(r.fuente_url, []).append((r.nombre, r.tipo_reporte))
        missing = "desaparecido"
        assert got == {"cdata": [("Ana <& Cía", missing)], "entities": [("José Nu&ez", missing)], "comment": [("Eva", missing)], "foreign": [("Eva", missing)], "default": [("Leo", "fallecido")], "latin": [("Íñigo", missing)]} | more
    errors = {r.url for r in readers.pfif_records(files, True).filter("error is not null").collect()}
    assert errors == {"cut", "unbound", "empty", "odd", "null"}


def test_bad_records_cost_themselves_only(spark):
    """Elements that are no objects, repeated keys, numbers with fractions, nested values; files that are no JSON or no list."""
    bodies = {
        "mixed": '{"items":[{"id":1,"nombre":"Ana","edad":4.0},3,"x",[1],null,true,{"id":2,"nombre":"Eva","nombre":"Zoe","edad":4.70},{"id":3},{"nombre":" ","cedula":"V-1"},{"id":4,"nombre":"N\\u0000"},{"id":5,"nombre":{"a":[1]},"edad":1e2}]}',
        "cut": '{"items":[{"id":1,"nombre":"Ana"}', "object": '{"items":{"id":1,"nombre":"Ana"}}', "other": '{"x":[]}', "empty": '{"items":[]}', "bare": '[{"id":9,"nombre":"Leo"}]', "nothing": "", "number": "7",
    }
    files = spark.createDataFrame([(k, bytearray(v.encode())) for k, v in bodies.items()] + [("null", None)], "url string, body binary")
    rows = specs.persons(files, "encuentralos").collect()
    assert sorted((r.fuente_url, r.nombre, r.edad) for r in rows if r.nombre) == [("bare", "Leo", None), ("mixed", "Ana", "4.0"), ("mixed", "Zoe", "4.7"), ("mixed", '{"a":[1]}', "100.0")]
    assert [r.cedula for r in rows if not r.nombre] == ["V-1"]
    gone = {(r.url, r.at): (r.error, r.raw) for r in specs.rejected(files, "encuentralos").collect()}
    no = "not_an_object"
    assert {k: v for k, v in gone.items() if k[1] is not None} == {("mixed", 1): (no, "3"), ("mixed", 2): (no, '"x"'), ("mixed", 3): (no, "[1]"), ("mixed", 4): (no, "null"), ("mixed", 5): (no, "true"), ("mixed", 7): ("no_name", '{"id":"3"}'), ("mixed", 9): ("nul_character", '{"id":"4","nombre":"N\\u0000"}')}
    assert {k[0] for k, v in gone.items() if k[1] is None and v == ("unreadable", None)} == {"cut", "object", "other", "nothing", "number", "null"}
    counts = {r.kind: r.n for r in specs.parse_statistics(files, "encuentralos", "pipeline").collect()}
    assert counts == {"file": 9, "empty_file": 1, "person": 5, "unreadable": 6, no: 5, "no_name": 1, "nul_character": 1}
    xml = spark.createDataFrame([("u", bytearray(b"<cut"))], "url string, body binary")
    assert [(r.at, r.error) for r in specs.rejected(xml, "busquedaunificadavzla").collect()] == [(None, "unreadable")]


def test_csv_files_are_handed_on_in_parts(spark):
    """A worker holds the records of no more than some files at once, whatever a batch of files has."""
    import pyarrow as pa

    class Files:  # takes the function that runs in tasks
        columns, sparkSession = ("url", "body"), spark

        def select(self, *_):
            return self

        def mapInArrow(self, run, _):
            return run

    body = ("a,b,c\n" + "1,2,3\n" * 30).encode()
    files = pa.RecordBatch.from_pydict({"url": [f"u{k}" for k in range(400)], "body": [b"\xff" if k == 7 else body for k in range(400)]})
    parts = list(readers.csv_records(Files(), None)(iter([files])))
    rows = [(u, k, e) for p in parts for u, k, e in zip(p.column("url").to_pylist(), p.column("at").to_pylist(), p.column("error").to_pylist(), strict=True)]
    assert max(p.num_rows for p in parts) <= readers.HELD < len(rows)
    assert rows == [x for k in range(400) for x in ([("u7", None, "UnicodeDecodeError")] if k == 7 else [(f"u{k}", n, None) for n in range(30)])]
