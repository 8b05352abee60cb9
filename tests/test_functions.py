import random
from difflib import SequenceMatcher

import pytest
from pyspark.sql import functions as F

from acopio.functions import compare, status, text
from acopio.operators import merge, quality
from acopio.operators.components import connected_components
from acopio.plans.scratch import Scratch


def one(spark, value, f):
    return spark.createDataFrame([(value,)], "x string").select(f(F.col("x"))).first()[0]


@pytest.mark.parametrize("raw, want", [("  José-María  Ñáñez 2 ", "JOSE MARIA NANEZ"), (None, ""), ("ﬁn", "FIN")])
def test_normalize_name(spark, raw, want):
    assert one(spark, raw, text.normalize_name) == want


def test_places_and_ids(spark):
    assert one(spark, "Hosp. N° 2,  Año", text.normalize_place) == "HOSP N 2 AÑO"
    assert one(spark, "V-12.345.678", text.id_number) == "12345678"
    assert one(spark, "12", text.id_number) is None


@pytest.mark.parametrize("token, want", [("VALLEZ", "bayes"), ("QUINTERO", "kintero"), ("CHACON", "kakon"), ("GIMENEZ", "jimenes"), ("JIMENEZ", "jimenes"), ("H", "")])
def test_phonetic(spark, token, want):
    assert one(spark, token, text.phonetic_code) == want


def test_compare(spark):
    rows = [("ANA PEREZ", "PEREZ ANA"), ("", "X"), ("ANA", "ANA PEREZ"), ("Ana", "ANA"), ("MARTA LOPEZ", "MARTHA LOPES"), ("LUIS", "OLGA")]
    got = compare.compare_names(spark.createDataFrame(rows, "a string, b string"), "a", "b").collect()
    assert [(r.category, r.score) for r in got[:4]] == [("exacta_reordenada", 0.98), ("no_coincide", 0.0), ("fonetica", 1.0), ("exacta", 1.0)]
    assert got[4].category == "fonetica" and got[5].category == "no_coincide"
    assert got[5].score == round(SequenceMatcher(None, "LUIS", "OLGA").ratio(), 3)


def test_compare_equals_the_plain_rule(spark):
    """Every pair of some names, empty and far ones among them, against sets of tokens and difflib."""
    import itertools

    names = ["", "ANA", "BARTOLOME GARCIA", "JOSE", "MARIA JOSEFINA PEREZ", "Pérez María", "maria perez", "MARTA LOPEZ", "MARTHA LOPES", "7", "  ", "AB CD EF GH IJ KL MN OP", "ab cd xx yy ij kl mn oq", "LUIS A", "LUISA", None]
    pairs = list(itertools.product(range(len(names)), repeat=2))
    rows = spark.createDataFrame([(i, j, names[i], names[j]) for i, j in pairs], "i int, j int, a string, b string")
    plain = {r.i: (r.n, set(r.codes)) for r in spark.createDataFrame(list(enumerate(names)), "i int, x string").select("i", text.normalize_name(F.col("x")).alias("n"), text.phonetic_tokens(text.normalize_name(F.col("x"))).alias("codes")).collect()}
    for r in compare.compare_names(rows, "a", "b").collect():
        (a, fa), (b, fb) = plain[r.i], plain[r.j]
        if not a or not b:
            want = ("no_coincide", 0.0)
        elif a == b:
            want = ("exacta", 1.0)
        elif set(a.split()) == set(b.split()):
            want = ("exacta_reordenada", 0.98)
        else:
            score = max(len(fa & fb) / (min(len(fa), len(fb)) or 1), SequenceMatcher(None, a, b).ratio())
            want = ("fonetica" if score >= 0.82 else "no_coincide", round(score, 3))
        assert (r.category, r.score) == want, (a, b)


def test_alike_names_under_one_id_are_no_finding(spark):
    rows = [("V-1", "MARTA LOPEZ"), ("1", "MARTHA LOPES"), ("2", "LUIS"), ("2.", "OLGA"), ("3", "ANA"), ("3", "ANA B"), ("3", "ANNA"), ("4", "X"), (None, "Y"), ("", "Z")]
    got = quality.shared_ids(spark.createDataFrame(rows, "cedula string, nombre string")).collect()
    assert sorted((r.id_digits, r.nombre, r.n_names) for r in got) == [("2", "LUIS", 2), ("2", "OLGA", 2), ("3", "ANA", 3), ("3", "ANA B", 3), ("3", "ANNA", 3)]


def test_candidates_equal_the_plain_rule(spark):
    """Candidates of one block against every pair compared in full."""
    import itertools

    from acopio.operators import linkage

    names = ["ANA MARIA PEREZ", "ANA MARIAH PERES", "ANA LOPEZ", "ANA PEREZ MARIA", "ANNA LOPES", "ANA", "ANA QUINTERO RUIZ", "ANA KINTERO"]
    people = spark.createDataFrame([(k, n, None, None, None) for k, n in enumerate(names)], "id long, nombre string, edad string, hospital string, cedula string")
    got = {(r.id_a, r.id_b): r.score for r in linkage.candidates(linkage.blocked(people)).collect()}
    pairs = [(i, j, names[i], names[j]) for i, j in itertools.combinations(range(len(names)), 2)]
    full = compare.compare_names(spark.createDataFrame(pairs, "i int, j int, a string, b string"), "a", "b").filter("category = 'fonetica'").collect()
    assert got == {(r.i, r.j): r.score for r in full} and got


def test_validation_is_written_back(spark):
    from acopio.operators import repair

    people = spark.createDataFrame([(1, "V-1", "ANA PEREZ"), (2, "2", "X"), (3, "no digits", "Y"), (4, None, "Z"), (5, "5", "Q")], "id int, cedula string, nombre string")
    known = spark.createDataFrame([("1", "PEREZ ANA"), ("2", ""), ("5", "BEA")], "cedula string, nombre string")
    got = {r.id: (r.cedula_validacion, r.cedula_nombre_oficial, r.cedula_similitud) for r in repair.with_validation(people, repair.validated(people, known)).collect()}
    assert got == {1: ("exacta_reordenada", "PEREZ ANA", 0.98), 2: ("sin_registro", None, None), 3: ("sin_registro", None, None), 4: (None, None, None), 5: ("no_coincide", "BEA", 0.0)}


def test_scratch_needs_a_shared_folder_on_a_cluster(spark):
    import types

    import pyspark

    from acopio.plans import scratch

    far = types.SimpleNamespace(conf=types.SimpleNamespace(get=lambda *a: None), sparkContext=types.SimpleNamespace(master="spark://x:7077"))
    with pytest.raises(ValueError):
        scratch.shared_dir(far)
    far.sparkContext.master = "local-cluster[2,1,1024]"
    with pytest.raises(ValueError):
        scratch.shared_dir(far)
    assert scratch.shared_dir(spark) and pyspark.__version__


def test_status(spark):
    assert [one(spark, v, status.map_status) for v in ("Hospitalizado", "xyz", "")] == ["ingresado", "desaparecido", "desaparecido"]
    assert one(spark, "no localizado", status.suggested_status) == "desaparecido"
    pairs = [("fallecido", "ingresado", False), ("desaparecido", "fallecido", True), ("ingresado", "desaparecido", False), ("ingresado", "fallecido", True), (None, "desaparecido", True)]
    got = spark.createDataFrame(pairs, "a string, b string, w boolean").select(status.may_change(F.col("a"), F.col("b")).alias("g"), "w").collect()
    assert all(r.g == r.w for r in got)


def test_fold_equals_sequence(spark):
    import itertools

    rows, want = [], {}
    for k, kinds in enumerate(x for n in (1, 2, 3) for x in itertools.product(status.STATES, repeat=n)):
        now = None
        for seq, kind in enumerate(kinds):
            rows.append((k, seq, kind))
            if now is None or now == "desaparecido" or (now != "fallecido" and kind != "desaparecido"):
                now = kind
        want[k] = now
    got = merge.folded(spark.createDataFrame(rows, "e int, seq int, kind string"), "e", "kind", ["seq"], []).collect()
    assert {r.e: r.state for r in got} == want


@pytest.mark.parametrize("age, bad", [("42", False), (" 42 ", False), ("-1", True), ("121", True), ("20-25", True), ("4.7", True)])
def test_age(spark, age, bad):
    assert one(spark, age, quality.invalid_age) == bad


@pytest.mark.parametrize("number, want", [("1111111", "repeated digit"), ("2345678", "sequential"), ("8765432", "sequential"), ("12345", "sequential, length 5"), ("1029384", "")])
def test_suspicious_ids(spark, number, want):
    assert one(spark, number, quality.id_reasons) == want


def test_variants(spark):
    f = lambda v: one(spark, v, text.suspicious_canonical)
    assert f("R / N PEREZ") and f("LOPEZ/GARCIA FERNANDA") and not f("ANA PRUEBA / ANA PRUEVA")
    assert one(spark, "<b>x</b> / y", text.slash_class) == "posible_inyeccion"


def test_components(spark):
    e = spark.createDataFrame([(1, 2), (2, 3), (9, 3), (4, 5), (6, 6)], "src long, dst long")
    got = {r.id: r.component for r in connected_components(e, Scratch(spark, "t")).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 9: 1, 4: 4, 5: 4}
    assert connected_components(e.limit(0), Scratch(spark, "t")).count() == 0


def test_ratio_in_sql_equals_difflib():
    duckdb = pytest.importorskip("duckdb")
    from acopio.plans.queries import _sound
    from acopio.plans.ratio_sql import compared

    dice, pairs = random.Random(4), [("", "ANA"), ("ANA", "ANA"), ("ANA LUZ", "LUZ ANA")]
    word = lambda: "".join(dice.choice("ABCDEF") for _ in range(dice.randint(1, 7)))
    pairs += [tuple(" ".join(word() for _ in range(dice.randint(1, most))) for most in sizes) for sizes in [(4, 4)] * 200 + [(9, 90)] * 12 + [(90, 90)] * 2]
    con = duckdb.connect()
    con.execute("CREATE TABLE named (a VARCHAR, b VARCHAR)")
    con.executemany("INSERT INTO named VALUES (?, ?)", pairs)
    got = con.execute(f"WITH RECURSIVE {compared('SELECT a, b FROM named', _sound)} SELECT cmp.a, cmp.b, category, score, ratio FROM cmp LEFT JOIN ratio USING (a, b)").fetchall()
    assert len(got) == len(set(pairs))
    for a, b, category, score, ratio in got:
        if not a or set(a.split()) == set(b.split()):
            assert (category, score) == (("no_coincide", 0.0) if not a else ("exacta", 1.0) if a == b else ("exacta_reordenada", 0.98))
        else:
            assert ratio == SequenceMatcher(None, a, b).ratio() and score >= round(ratio, 3)


def test_placeholders_end_where_the_sql_says(spark):
    """Letters other than ASCII ones are no part of a word there, a vertical tab is no blank."""
    from acopio.operators import quality

    cases = {"TEST": True, "öschtest": False, "eutestö": False, "ötest einö": True, "Persona sin\tdatos": True, "sin\x0bdatos": False, "testı n/a": True, "prueba_1": False, "SİN NOMBRE": True, "ñna": True, "Ana": False}
    rows = spark.createDataFrame(list(cases.items()), "name string, want boolean").withColumn("got", quality.placeholder(F.col("name")))
    assert rows.filter("got <> want").collect() == []


def test_multipart_bodies_are_scanned_once(spark):
    """Names and values, a scan each; a scan for each part and pair of parts took as long as their number squared."""
    fields = text.multipart_fields(F.col("body"))
    scans = spark.createDataFrame([], "body string").select(fields.alias("f"))._jdf.queryExecution().analyzed().toString()
    assert scans.count("regexp_extract_all") == 2
    end = "\r\n----------------1\r\n"
    body = end.join(['name="a"\r\n\r\n1', 'name="b"\n\n ', 'name="c"; filename="x"\r\nContent-Type: y\r\n\r\n2', 'name="d"\r\n\r\n4', 'name="a"\r\n\r\n 3 ', ""])
    got = spark.createDataFrame([(body,), (None,), ("",)], "body string").select(fields.alias("f")).collect()
    assert [r.f for r in got] == [{"a": "3", "d": "4"}, None, {}]
