"""The table of persons as it is kept up, against plain loops."""

import datetime as dt
import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from acopio.functions import text
from acopio.operators import constraints, linkage, schedules, store, upsert
from acopio.plans.scratch import Scratch

THEN, NOW = dt.datetime(2020, 1, 1), dt.datetime(2024, 5, 1)
COLUMNS = ["tipo_reporte", "nombre", "edad", "cedula", "hospital"]
TABLE = "id string, tipo_reporte string, nombre string, edad string, cedula string, hospital string, folio int, created_at timestamp, updated_at timestamp"
BATCH = "arrival long, id string, tipo_reporte string, nombre string, edad string, cedula string, hospital string, extra string"


def replayed(table, batch):
    """One record after another: the rows afterwards and what became of each record."""
    rows = {r[0]: dict(zip(["id", *COLUMNS, "folio", "created_at", "updated_at"], r, strict=True)) for r in table}
    out = []
    pair = lambda r: (r["nombre"].lower(), r["hospital"].lower()) if r["nombre"] and r["hospital"] else None
    for rec in sorted(batch, key=lambda r: (r[0], [(x is not None, x or "") for x in r[1:7]])):
        new = {c: (v or "").strip() or None for c, v in zip(["id", *COLUMNS], rec[1:7], strict=True)}
        if not new["id"]:
            import hashlib

            key = f":{new['nombre'] or ''}:{new['cedula'] or ''}"
            new["id"] = ":" + hashlib.md5(key.encode()).hexdigest()[:12]
        if not new["nombre"] and not new["cedula"]:
            out.append((rec[0], new["id"], None, None, "skipped"))
            continue
        hit, by = (new["id"], "id") if new["id"] in rows else (None, None)
        if not hit and new["cedula"]:
            found = [k for k, r in rows.items() if r["cedula"] == new["cedula"]]
            hit, by = (min(found), "cedula") if found else (None, None)
        if not hit and pair(new):
            found = [k for k, r in rows.items() if pair(r) == pair(new)]
            hit, by = (min(found), "nombre_hospital") if found else (None, None)
        if not hit:
            rows[new["id"]] = dict(new, folio=None, created_at=NOW, updated_at=NOW)
            out.append((rec[0], new["id"], new["id"], None, "inserted"))
            continue
        row = rows[hit]
        now = row["tipo_reporte"]
        if now and (now == "fallecido" or (now != "desaparecido" and new["tipo_reporte"] == "desaparecido")):
            out.append((rec[0], new["id"], hit, by, "blocked"))
            continue
        row.update({c: v for c, v in new.items() if v and c != "id"}, updated_at=NOW)
        out.append((rec[0], new["id"], hit, by, "updated"))
    return sorted((tuple(r[c] for c in ["id", *COLUMNS, "folio", "created_at", "updated_at"]) for r in rows.values()), key=str), sorted(out, key=str)


def done(spark, table, batch):
    known, records = spark.createDataFrame(table, TABLE), spark.createDataFrame(batch, BATCH)
    rows, outcomes = upsert.upserted(known, records, "arrival", F.lit(NOW))
    after = upsert.applied(known, rows)
    assert after.columns == known.columns
    return sorted((tuple(r) for r in after.collect()), key=str), sorted((tuple(r) for r in outcomes.select("arrival", "id", "pid", "matched_by", "outcome").collect()), key=str)


STATES = ["ingresado", "desaparecido", "desaparecido", "fallecido", "dado_de_alta", None, ""]


@pytest.mark.parametrize(("seed", "stretch"), [(1, 5)])
def test_upsert_equals_one_record_after_another(spark, monkeypatch, seed, stretch):
    """Ids, id numbers, names and places shared within the batch and with the table, one id number by a third of all."""
    monkeypatch.setattr(upsert, "STRETCH", stretch)
    dice = random.Random(seed)
    number = lambda: dice.choice([None, "", "111", "111", " 222 ", str(dice.randint(1, 60))])
    name = lambda: dice.choice([None, "  ", "ANA", "ana ", f"P{dice.randint(1, 25)}"])
    place = lambda: dice.choice([None, "", "Central", "CENTRAL", f"H{dice.randint(1, 3)}"])
    table = [(f"k{k:02}", dice.choice(STATES), (name() or "").strip() or None, None, (number() or "").strip() or None, (place() or "").strip() or None, k, THEN, THEN) for k in range(30)]
    batch = [(k, dice.choice([None, "", f"k{dice.randint(0, 60):02}", f"n{dice.randint(0, 30)}"]), dice.choice(STATES), name(), dice.choice([None, "4"]), number(), place(), "x") for k in range(60)]
    assert done(spark, table, batch) == replayed(table, batch)


@pytest.mark.parametrize(("stretch", "holders"), [(1000, 2), (7, 1), (7, 50)])
def test_long_chains_take_few_rounds(spark, monkeypatch, stretch, holders):
    """Each record is found by what the one before it made of a row: as many links as records, but a round a stretch, and
    another one where the holders of a key run out."""
    monkeypatch.setattr(upsert, "STRETCH", stretch)
    monkeypatch.setattr(upsert, "HOLDERS", holders)
    rounds, write = [], Scratch.write
    monkeypatch.setattr(Scratch, "write", lambda self, df, name: (rounds.append(name), write(self, df, name))[1])
    table = [(f"k{k:02}", "desaparecido", f"N{k}", None, "0", "H", k, THEN, THEN) for k in range(20)]
    batch = [(k, f"k{k // 2:02}" if k % 2 else None, "desaparecido", f"M{k}", None, str(k % 4 // 3), "H", "x") for k in range(28)]
    assert done(spark, table, batch) == replayed(table, batch)
    assert len([n for n in rounds if n.startswith("round-")]) <= -(-28 // stretch) + 3


def test_upsert_of_odd_batches(spark):
    chain = [  # each is found by what the one before it made or changed
        (0, "a", "desaparecido", "Ana", None, "1", "H", None), (1, None, "ingresado", "Ana B", None, "1", None, None),
        (2, "b", None, "ana b", "30", "2", "h", None), (3, "c", "desaparecido", None, None, "2", None, None), (4, "c", "fallecido", None, None, "2", None, None),
        (5, None, "ingresado", "x", None, "2", None, None), (6, None, "ingresado", None, None, "1", None, None), (7, None, None, " ", None, "", "H", None),
    ]
    assert done(spark, [], chain) == replayed([], chain)
    assert [r[4] for r in replayed([], chain)[1]].count("inserted") == 2
    ties = [(5, "a", "ingresado", "n", None, str(k % 2), None, None) for k in range(4)]
    assert done(spark, [], ties) == replayed([], ties)
    table = [("z", "ingresado", "Ana", None, "9", "H", 1, THEN, THEN)]
    assert done(spark, table, []) == (replayed(table, [])[0], []) and done(spark, [], []) == ([], [])


def test_store_rewrites_what_it_touches(spark, tmp_path):
    """Batches cut anywhere equal one sequence; a batch writes its buckets only; versions are whole and run once."""
    dice = random.Random(3)
    table = [(f"k{k:03}", dice.choice(STATES), f"N{k}", None, str(1000 + k), "H", k, THEN, THEN) for k in range(300)]
    batch = [(k, dice.choice([None, f"k{dice.randint(0, 20):03}", f"n{dice.randint(0, 4)}"]), dice.choice(STATES), dice.choice([None, f"N{dice.randint(0, 20)}", "Nueva"]), None, dice.choice([None, "77", str(1000 + dice.randint(0, 20))]), dice.choice([None, "h"]), None) for k in range(24)]
    records, known = spark.createDataFrame(batch, BATCH), spark.createDataFrame(table, TABLE)
    kept = store.PersonStore(spark, str(tmp_path / "persons"), known.schema, buckets=128)
    kept.load(known)
    seen = []
    for n, (low, high) in enumerate([(0, 3), (3, 11), (11, 24)], 1):
        part = records.filter(f"arrival >= {low} and arrival < {high}")
        seen += kept.upsert(part, "arrival", F.lit(NOW), n, Scratch(spark, f"t{n}")).collect()
        assert kept.upsert(part, "arrival", F.lit(NOW), n, Scratch(spark, f"again{n}")) is None
        written = list((tmp_path / f"persons/rows/v={n}").glob("_bucket=*"))
        assert 0 < len(written) <= high - low
    want, outcomes = replayed(table, batch)
    assert sorted((tuple(r) for r in kept.read().collect()), key=str) == want
    assert sorted((tuple(r[c] for c in ("arrival", "id", "pid", "matched_by", "outcome")) for r in seen), key=str) == outcomes
    index = {(r.kind, r.key, r.id) for r in kept.store.read("keys").collect()}
    assert {k for kind, k, _ in index if kind == 1} == {r[4] for r in want if r[4]}
    first = sorted(tuple(r) for r in kept.store.read("rows", version=1).select("id").collect())
    kept.store.vacuum(keep=3)
    assert kept.store.versions() == [1, 2, 3] and sorted(tuple(r) for r in kept.store.read("rows", version=1).select("id").collect()) == first
    kept.store.vacuum(keep=1)
    assert kept.store.versions() == [3] and sorted((tuple(r) for r in kept.read().collect()), key=str) == want
    (tmp_path / "persons/rows/v=4").mkdir()  # a version that was never finished is not there
    assert kept.store.latest() == 3 and kept.read().count() == len(want)


def test_upsert_stream(spark, tmp_path):
    from acopio.streaming import ingest

    kept = store.PersonStore(spark, str(tmp_path / "persons"), spark.createDataFrame([], TABLE).schema, buckets=8)
    batch = [(0, "a", "desaparecido", "Ana", None, "1", None, None), (1, None, "ingresado", "Ana B", None, "1", None, None), (2, "b", "ingresado", "Eva", None, "2", "H", None), (3, None, "fallecido", "EVA", None, None, "h", None)]
    for k in range(2):
        spark.createDataFrame(batch[2 * k : 2 * k + 2], BATCH).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        records = spark.readStream.schema(BATCH).parquet(str(tmp_path / "in"))
        ingest.upsert_stream(records, kept, str(tmp_path / "cp"), "arrival").awaitTermination()
    assert sorted((r.id, r.tipo_reporte, r.nombre, r.cedula) for r in kept.read().collect()) == [("a", "ingresado", "Ana B", "1"), ("b", "fallecido", "EVA", "2")]
    assert kept.store.versions() == [1, 2]


def test_pairs_of_a_hot_block_are_dealt_evenly(spark, monkeypatch):
    """One name holds half of all rows: every two rows of a block meet once, in cells whose pairs fill tasks evenly."""
    monkeypatch.setattr(linkage, "CELL", 64)
    dice = random.Random(6)
    rows = [(k, "JOSE" if k % 2 else f"B{dice.randint(0, 30)}", "h" if dice.random() < 0.9 else "g") for k in range(4000)]
    df = spark.createDataFrame(rows, "id long, block_key string, place string")
    a, b = linkage.cells(df, ["block_key", "place"])
    keys = ["block_key", "place", "_i", "_j"]
    count = lambda side, n: side.groupBy(*keys).count().withColumnRenamed("count", n)
    pairs = F.when(F.col("_i") == F.col("_j"), F.col("n") * (F.col("n") - 1) / 2).otherwise(F.col("n") * F.col("m"))
    sizes = count(a, "n").join(count(b, "m"), keys).withColumn("pairs", pairs).cache()
    groups = {}
    for _, key, place in rows:
        groups[key, place] = groups.get((key, place), 0) + 1
    assert sizes.agg(F.sum("pairs")).first()[0] == sum(n * (n - 1) // 2 for n in groups.values())
    assert sizes.agg(F.max("pairs")).first()[0] < 4 * 64 * 64
    tasks = [r[0] for r in sizes.groupBy(F.pmod(F.hash(*keys), F.lit(8))).agg(F.sum("pairs").alias("p")).select("p").collect()]
    assert len(tasks) == 8 and max(tasks) < 2 * min(tasks)
    met = a.join(b.withColumnRenamed("id", "other"), keys).filter("_i < _j or id < other").select(F.least("id", "other").alias("x"), F.greatest("id", "other").alias("y"))
    assert met.count() == met.distinct().count() == sum(n * (n - 1) // 2 for n in groups.values())


def test_block_pairs_in_cells(spark, monkeypatch):
    dice = random.Random(7)
    rows = [(k, f"Ana {dice.choice(['Maria', 'Marta', 'Luz'])} {dice.choice('ABCD')}", dice.choice([None, "30", "31", "40"]), None, dice.choice(["H", "h.", None])) for k in range(300)]
    df = spark.createDataFrame(rows, "id long, nombre string, edad string, cedula string, hospital string")
    found = []
    for cell in (256, 7):
        monkeypatch.setattr(linkage, "CELL", cell)
        found.append(sorted(tuple(r) for r in linkage.block_pairs(linkage.blocked(df)).select("id_a", "id_b", "nombre_a", "nombre_b", "edad_a", "edad_b").collect()))
    assert found[0] == found[1] and len(found[0]) > 1000 and all(r[0] < r[1] and r[2] == rows[r[0]][1] and r[5] == rows[r[1]][2] for r in found[0])


NAMES = ["ANA QUINTERO", "ANA QUINTERA", "ANA KINTERO", "ANA LOPEZ", "ANA", "ANA LUZ MAR", "ANA MAR LUZ", "ANA ADNADDID", "ANA DANAIDDD", "ANA DIADTDNA", "ANA DIDNTDAA", "ANA TDANIANN", "ANA NTANIDAN"]


def persons(spark, n, seed):
    """Rows of few names, some of which are alike in one order only, and the candidates among them by plain loops."""
    import itertools
    from difflib import SequenceMatcher

    dice = random.Random(seed)
    rows = [(k, dice.choice(NAMES), dice.choice([None, "30", "31", "33", "40"]), dice.choice([None, "V-1234567", "1234567", "7654321", "12"]), dice.choice(["H", "h.", None])) for k in range(n)]
    people = spark.createDataFrame(rows, "id long, nombre string, edad string, cedula string, hospital string")
    each = spark.createDataFrame([(x,) for x in NAMES], "x string").select("x", text.phonetic_tokens(F.col("x")).alias("c")).collect()
    codes = {r.x: set(r.c) for r in each}
    want = {}
    for a, b in itertools.combinations(rows, 2):
        ages = [int(r[2]) for r in (a, b) if r[2]]
        if a[1] == b[1] or set(a[1].split()) == set(b[1].split()) or (a[4] is None) != (b[4] is None) or (len(ages) == 2 and abs(ages[0] - ages[1]) > 2):
            continue
        fa, fb = codes[a[1]], codes[b[1]]
        score = max(len(fa & fb) / min(len(fa), len(fb)), SequenceMatcher(None, a[1], b[1]).ratio())
        if score >= linkage.ALIKE:
            numbers = [(r[3] or "").removeprefix("V-") for r in (a, b)]
            same = len(numbers[0]) == 7 and numbers[0] == numbers[1]
            want[a[0], b[0]] = (round(score, 3), "ALTA" if same else "MEDIA" if round(score, 3) == 1 and len(ages) == 2 and ages[0] == ages[1] else "BAJA")
    return people, want


def test_names_are_compared_once(spark, monkeypatch):
    """Pairs of rows are those of the plain loops; the ratio sees pairs of names, not of rows."""
    people, want = persons(spark, 400, 8)
    seen, plain = spark.sparkContext.accumulator(0), linkage.scored.func

    @F.pandas_udf(linkage.scored.returnType)
    def counted(a: pd.Series, b: pd.Series, c: pd.Series) -> pd.DataFrame:
        seen.add(int(a.notna().sum()))
        return plain(a, b, c)

    monkeypatch.setattr(linkage, "scored", counted.asNondeterministic())
    got = {(r.id_a, r.id_b): (r.score, r.tier) for r in linkage.candidates(linkage.blocked(people, split=1000)).collect()}
    assert got == want and len(got) > 2000 and {t for _, t in got.values()} == {"ALTA", "MEDIA", "BAJA"}
    assert 0 < seen.value <= 2 * 2 * len(NAMES) ** 2  # two places, two orders


def roots(pairs):
    """The least id that each id of some pairs reaches."""
    up = {}
    find = lambda x: x if up.setdefault(x, x) == x else find(up[x])
    for a, b in pairs:
        a, b = sorted((find(a), find(b)))
        up[b] = a
    return {x: find(x) for x in up}


def test_links_join_what_all_pairs_join(spark):
    """Links are some of the pairs, join the same ids, and are few where many rows share names."""
    for n, seed in ((60, 3), (90, 4), (400, 8)):
        people, want = persons(spark, n, seed)
        scratch = Scratch(spark, "links")
        rows = linkage.compared_rows(linkage.blocked(people, split=1000), scratch)
        alike = linkage.alike_names(rows, scratch)
        links = {t: scratch.write(linkage.links(alike, rows, scratch, t), f"links-{t}") for t in ("ALTA", "MEDIA")}
        every = {"ALTA": {p for p, (_, t) in want.items() if t == "ALTA"}, "ALTA-MEDIA": {p for p, (_, t) in want.items() if t != "BAJA"}}
        assert {(r.id_a, r.id_b) for r in links["ALTA"].collect()} <= every["ALTA"]
        assert {(r.id_a, r.id_b) for r in links["MEDIA"].collect()} <= every["ALTA-MEDIA"]
        for name, pairs in every.items():
            got = linkage.clusters(links["ALTA"].unionByName(links["MEDIA"]), scratch, tuple(name.split("-")))
            assert {r.id: r.component for r in got.collect()} == roots(pairs), (n, name)
    contained = linkage.contained_names(rows, scratch)
    some, all_pairs = (df.select("id_a", "id_b").collect() for df in (linkage.links(contained, rows, scratch), linkage.row_pairs(contained, rows, ["id"])))
    assert set(some) <= set(all_pairs) and roots(some) == roots(all_pairs) and len(all_pairs) > 2 * len(some)


# schedules, keys and the registry of contents


def fields(text):
    """The values of five cron fields by a plain loop, None if one cannot be read."""
    ranges = [(0, 59), (0, 23), (1, 31), (1, 12), (0, 6)]
    names = [[], [], [], "jan feb mar apr may jun jul aug sep oct nov dec".split(), "sun mon tue wed thu fri sat".split()]
    out = []
    if len(text.split()) != 5:
        return None
    for (low, high), known, field in zip(ranges, names, text.lower().split(), strict=True):
        values = set()
        for part in field.split(","):
            span, _, step = part.partition("/")

            def number(x, low=low, high=high, known=known):
                k = int(x) if x.isdigit() else known.index(x[:3]) + low if x[:3] in known else None
                return k if k is not None and low <= k <= high else None

            if span == "*":
                each = list(range(low, high + 1))
            else:
                a, dash, b = span.partition("-")
                a, b = number(a), number(b) if dash else None
                if a is None or (dash and b is None) or ("/" in part and not dash):
                    return None
                each = [a] if not dash else list(range(a, b + 1)) if a <= b else [*range(a, high + 1), *range(low, b + 1)]
            if "/" in part:
                if not step.isdigit() or not int(step):
                    return None
                each = each[:: int(step)]
            values |= set(each)
        out.append(sorted(values))
    return out


def test_cron_fields(spark):
    texts = ["* * * * *", "0 */12 * * *", "5,1-3 22-2/2 1-31/10 nov-FEB sat-mon", "*/7 0 31 2 0", "1-5/3,4 * * january *", "60 * * * *", "* 24 * * *", "* * 0 * *", "* * * 13 *", "* * * * 7", "*/0 * * * *", "5/10 * * * *", "a * * * *", "* * *", "", "1-x * * * *", "1, * * * *", "* * * * mon,foo", "1/2/3 * * * *", "-1 * * * *", " 0  1 2\t3 4 "]
    rows = schedules.expanded(spark.createDataFrame([(t,) for t in texts] * 2, "schedule string")).collect()
    assert len(rows) == 2 * len(texts)
    for r in rows:
        want = fields(r.schedule)
        assert r.valid == (want is not None), r.schedule
        if want:
            assert [r[f"_{k}"] for k in schedules.FIELDS] == want, r.schedule


def test_due_times(spark):
    rows = spark.createDataFrame([("a", "*/20 3 29 2 *", True), ("b", "0 0 * * mon", True), ("off", "* * * * *", False), ("bad", "x", True), ("c", "59 23 * * *", True)], "name string, schedule string, enabled boolean")
    start, end = (F.lit(t).cast("timestamp") for t in ("2024-02-28 23:59:00", "2024-03-04 00:01:00"))
    got = sorted((r.name, str(r.due_at)) for r in schedules.due(rows, start, end).collect())
    day = dt.datetime(2024, 2, 28, 23, 59)
    want = [("c", str(day + dt.timedelta(days=k))) for k in range(5)] + [("a", f"2024-02-29 03:{m}:00") for m in ("00", "20", "40")] + [("b", "2024-03-04 00:00:00")]
    assert got == sorted(want)
    runs = spark.createDataFrame([("c", dt.datetime(2024, 3, 3, 23, 59)), ("b", dt.datetime(2024, 3, 3))], "spider_name string, started_at timestamp")
    assert {r.name: r.overdue for r in schedules.last_due(rows, runs, end, start).collect()} == {"a": True, "b": True, "c": False}
    assert schedules.due(rows.limit(0), start, end).count() == 0


def test_keys(spark):
    tables = {
        "spider_config": spark.createDataFrame([(1, "a"), (2, "b"), (2, "c"), (None, "c")], "id int, name string"),
        "scrape_run": spark.createDataFrame([(10, "a"), (11, "a"), (12, "b"), (13, "z"), (14, None)], "id int, spider_name string"),
        "scraped_file": spark.createDataFrame([("x",), ("y",)], "checksum string"),
        "run_file": spark.createDataFrame([(1, 10, "x"), (2, 10, "x"), (3, 12, "y"), (4, 99, "x"), (5, None, "y"), (6, None, "y")], "id int, run_id int, checksum string"),
    }
    got = {(r.table, r.rule, r.value, r.n) for r in constraints.violations(tables, constraints.KEYS).collect()}
    assert got == {
        ("spider_config", "repeated id", "2", 2), ("spider_config", "null id", "null", 1), ("spider_config", "repeated name", "c", 2), ("scrape_run", "orphan spider_name", "z", 1),
        ("run_file", "repeated run_id,checksum", "10|x", 2), ("run_file", "orphan run_id", "99", 1),
    }
    left = constraints.deleted(tables, constraints.KEYS, "spider_config", spark.createDataFrame([("a",), ("nobody",)], "name string"), Scratch(spark, "d"))
    ids = {name: sorted(str(r[0]) for r in rows.collect()) for name, rows in left.items()}
    assert ids == {"spider_config": ["2", "2", "None"], "scrape_run": ["12", "13", "14"], "scraped_file": ["x", "y"], "run_file": ["3", "4", "5", "6"]}
    # files go with either of their two parents; a name that another row still has is kept
    left = constraints.deleted(tables, constraints.KEYS, "scraped_file", spark.createDataFrame([("x",)], "checksum string"), Scratch(spark, "d"))
    assert sorted(r.id for r in left["run_file"].collect()) == [3, 5, 6] and left["scrape_run"].count() == 5
    left = constraints.deleted(tables, constraints.KEYS, "spider_config", spark.createDataFrame([(2, "c")], "id int, name string"), Scratch(spark, "d"))
    assert left["spider_config"].count() == 3 and left["scrape_run"].count() == 5


def test_seen_contents(spark, tmp_path):
    kept = store.SeenStore(spark, str(tmp_path / "seen"), buckets=32)
    kept.load(spark.createDataFrame([(f"k{k}", k) for k in range(200)], "checksum string, first_seen long"))
    pages = spark.createDataFrame([(1, "k5"), (2, "new"), (3, "new"), (4, None)], "page long, checksum string")
    got = {r.page: r.is_new for r in kept.sift(pages.filter("checksum is not null"), "page", 1, Scratch(spark, "s1")).collect()}
    assert got == {1: False, 2: True, 3: False}
    assert len(list((tmp_path / "seen/seen/v=1").glob("_bucket=*"))) == 1
    known = kept.known_of(pages.filter("checksum is not null").select("checksum").distinct())
    assert sorted(r.checksum for r in known.collect()) == ["k5", "new"]
    plan = known._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert "BroadcastHashJoin" in plan and plan.count("Exchange hashpartitioning") <= 1  # the batch's own distinct, not what is known
    assert {r.checksum: r.first_seen for r in kept.read().filter("checksum in ('k5', 'new')").collect()} == {"k5": 5, "new": 2}
    with pytest.raises(ValueError, match="there already"):
        kept.sift(pages, "page", 1, Scratch(spark, "s2"))


def test_runs_are_logged(spark, tmp_path):
    """A stream that ends well, one with bad records, one that breaks off, and a run whose driver died."""
    import time

    from acopio.streaming import runs

    log = runs.RunLog(spark, str(tmp_path / "runs"))
    log.begin("dead", "muerto", dt.datetime(2024, 1, 1))
    listener = runs.RunListener(log)
    spark.streams.addListener(listener)
    kind = "body string, error string"
    try:
        for name, rows in (("bien", [("a", None)]), ("a_medias", [("a", None), ("b", "x")]), ("mal", [("boom", None)])):
            spark.createDataFrame(rows, kind).coalesce(1).write.parquet(str(tmp_path / name))
            stream = runs.counted(spark.readStream.schema(kind).parquet(str(tmp_path / name)), "error")

            def batch(df, n):
                if df.filter("body = 'boom'").count():
                    raise ValueError("boom")

            q = stream.writeStream.queryName(name).foreachBatch(batch).option("checkpointLocation", str(tmp_path / f"cp-{name}")).trigger(availableNow=True).start()
            try:
                q.awaitTermination()
            except Exception as e:
                assert "boom" in str(e)
            until = time.time() + 90
            while time.time() < until and any(listener.seen) or log.read().filter(f"spider_name = '{name}' and status <> 'running'").isEmpty():
                time.sleep(0.5)
                assert time.time() < until
    finally:
        spark.streams.removeListener(listener)
    log.close_stale(dt.datetime(2024, 1, 1, 1, 0, 1))
    got = {r.spider_name: (r.status, r.items, r.errors, r.finished_at is not None) for r in log.read().collect()}
    assert got["bien"] == ("success", 1, 0, True) and got["a_medias"] == ("partial", 2, 1, True) and got["mal"][0] == "failed" and got["mal"][3]
    assert got["muerto"] == ("failed", 0, 0, True) and len(got) == 4
    log.end("dead", 5, 0, False, dt.datetime(2024, 1, 2))  # closed runs stay closed
    assert log.read().filter("run_id = 'dead'").first().status == "failed"


def test_import_is_applied(spark):
    from acopio.operators import merge

    known = spark.createDataFrame([(1, "Ana", "V-1", "H", "ingresado", "a", 0, 0), (2, "Eva", None, None, "desaparecido", None, 0, 0), (3, "EVA", None, "X", "fallecido", "c", 0, 0), (4, "Leo", "V-4", None, None, "d", 0, 0)], "id long, nombre string, cedula string, hospital string, tipo_reporte string, notas string, created_at int, updated_at int")
    rows = [  # by number: blocked, accepted, blocked again; by name: one row of two; two new ones of a name; nobody
        (1, "Otra", "V-1", None, "desaparecido", "n1"), (2, "Ana B", "V-1", None, "fallecido", "n2"), (3, "Ana C", "V-1", "Z", "ingresado", "n3"),
        (4, " eva ", "", None, "dado_de_alta", "n4"), (5, "Nueva", None, "Q", "ingresado", "n5"), (6, "NUEVA", None, "R", "fallecido", "n6"), (7, " ", "V-9", None, "ingresado", "n7"), (8, "Leo", "V-4", None, "desaparecido", "n8"),
    ]
    incoming = spark.createDataFrame(rows, "row_id long, nombre string, cedula string, hospital string, tipo_reporte string, notas string")
    got = {r.id: (r.nombre, r.cedula, r.hospital, r.tipo_reporte, r.notas, r.created_at, r.updated_at) for r in merge.imported(incoming, known, F.col("row_id") + 100, F.lit(9)).collect()}
    assert got == {
        1: ("Ana B", "V-1", "H", "fallecido", "n2", 0, 9), 2: (" eva ", "", None, "dado_de_alta", "[Estado anterior: desaparecido] n4", 0, 9), 3: ("EVA", None, "X", "fallecido", "c", 0, 0),
        4: ("Leo", "V-4", None, "desaparecido", "n8", 0, 9), 105: ("Nueva", None, "Q", "ingresado", "n5", 9, 9),
    }
    assert merge.imported(incoming.limit(0), known, F.lit(0), F.lit(9)).count() == 4 and merge.imported(incoming.limit(5), known.limit(0), F.col("row_id"), F.lit(9)).count() == 5
