"""Nulls in every column, empty tables, repeated rows, ties, very long texts and clashing columns; the pipeline by brute
force; distrust over links by brute force."""

import random
from collections import Counter

import corpus_pipeline
import numpy as np
import pytest
from acopio.llm import mixing, packing, quality_model, queries
from acopio.llm.line_dedup import line_dedup
from acopio.llm.near_dedup import drop_near, near_dedup
from acopio.llm.nearest import nearest
from acopio.llm.quality_rules import quality_rules
from acopio.llm.set_join import set_join
from acopio.llm.sharding import kd_shards
from acopio.llm.substring_dedup import substring_dedup
from acopio.llm.common import Scratch
from acopio.llm.url_filters import FOLLOW, MOVED, THRESHOLD, UrlRule, host_links, rounds_for, spread, url_filters

CLASH = ["_id", "_th", "_slot", "_at", "_score", "_x0", "_c0", "kept_text", "n_lines", "component", "rep", "size", "shard", "block"]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{c} string" for c in CLASH)
ROWS = [(None, None, None, None, None), (None, "a b c", None, "s", 5), (1, None, "en", None, 0), (2, "", "en", "s", 0), (3, "same text here", "de", "s", 14), (3, "same text here", "de", "s", 14), (4, "same text here", "de", "s", 14), (5, "word " * 60_000 + "\n" * 500, "en", "t", 1), (6, "a" * 200_000, "", "", 1), (7, "é ß 漢字 \x0b x\r\n\tÄ", "fr", "s", 9)]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame([r + tuple(CLASH) for r in ROWS], SCHEMA).cache()


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(1, 1, 0), (3, 0, None), (None, 1, 1), (4, None, 0), (7, 1, 0)], "doc_id long, quality int, toxic int")


TABLES = {
    "sharding": lambda d, _: kd_shards(d, 8), "substring": lambda d, _: substring_dedup(d, 50), "lines": lambda d, _: line_dedup(d, 2), "mixed": lambda d, _: mixing.mixed(d),
    "rules": lambda d, _: quality_rules(d), "classifier": lambda d, x: quality_model.quality_scores(d, x), "near": lambda d, _: near_dedup(d, 3, 85), "sets": lambda d, _: set_join(d, 4, 85),
}
STAGES = {"drop_poor": lambda d, x: quality_model.drop_poor(d, x, 0.0), "mix": lambda d, _: mixing.mix(d), "line_stage": lambda d, _: corpus_pipeline.line_dedup_stage(None, d, "")}


@pytest.mark.parametrize("name", TABLES)
def test_a_row_for_each(odd, labels, name):
    assert Counter(r.doc_id for r in TABLES[name](odd, labels).collect()) == Counter(r[0] for r in ROWS)
    assert TABLES[name](odd.limit(0), labels).count() == 0


@pytest.mark.parametrize("name", STAGES)
def test_stages_keep_columns(odd, labels, name):
    out = STAGES[name](odd, labels)
    assert out.columns == odd.columns and out.count() == len(ROWS)
    assert all(r[c] == c for r in out.collect() for c in CLASH)
    assert STAGES[name](odd.limit(0), labels).count() == 0


def test_near_stage_keeps_columns(odd):
    out = drop_near(odd)
    assert out.columns == odd.columns and sorted(r.doc_id for r in out.filter("doc_id is not null").collect()) == [1, 2, 3, 3, 5, 6, 7]
    assert drop_near(odd.limit(0)).count() == 0


def test_packing(odd):
    total = Counter()
    for r in packing.best_fit_packing(odd, (64, 8192)).collect():
        total[r.doc_id] += r.length
    assert total == {None: 5, 1: 1, 2: 1, 3: 8, 4: 4, 5: 60_001, 6: 2, 7: 6} and packing.best_fit_packing(odd.limit(0)).count() == 0


def test_nearest_of_few(spark):
    kind = "vec_id long, embedding array<double>, label int"
    assert nearest(spark.createDataFrame([], kind)).count() == 0
    got = nearest(spark.createDataFrame([(0, [1.0, 2.0], None), (3, [1.0, 3.0], 1), (2, [1.0, 1.0], 1), (None, None, None)], kind)).collect()
    assert [(r.query_id, r["rank"], r.vec_id, r.score) for r in got] == [(0, 1, 2, 1.0), (0, 2, 3, 1.0)]


def test_rounds_suffice_for_any_number_of_trusted_hosts():
    for trusted in (0.0, 1.0, 3e3, 1e6, 1e10):
        k = rounds_for(trusted)
        assert FOLLOW ** (k - 1) * max(trusted, 1.0) <= MOVED and k < 200


def test_repeated_pages_and_other_columns(spark):
    """The same page_id twice, the same row twice, columns with names that the operator uses itself."""
    rows = [(1, "http://a.com/en/1", None, "x", 1), (1, "http://b.net/de/1", None, "x", 2), (2, "http://a.com/1", "", "y", 3), (2, "http://a.com/1", "", "y", 3)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, host string, rule int")
    rules = [UrlRule("com", "/en/", allow=False), UrlRule("net", "/de/", allow=True)]
    got = sorted(tuple(r) for r in url_filters(pages, rules).select("page_id", "host", "path", "verdict").collect())
    assert got == [(1, "a.com", "/en/1", "block"), (1, "b.net", "/de/1", "allow"), (2, "a.com", "/1", "allow"), (2, "a.com", "/1", "allow")]


def test_distrust_over_links(spark):
    """bad.org is blocked; hub and spam hosts link to it alone, far half to hub, and good.net, trusted, links to far. Values
    against plain rounds to the fixed point."""
    to = lambda *hosts: " ".join(f'<a href="http://{h}/">' for h in hosts)
    rows = [(1, "http://bad.org/x", to("bad.org")), (2, "http://hub.io/a", to("bad.org", "bad.org")), (3, "http://far.io/", to("hub.io", "calm.io")), (4, "http://good.net/ok", to("far.io")), (5, "http://calm.io/", to("good.net"))]
    rows += [(10 + k, f"http://spam{k}.io/", to("bad.org")) for k in range(100)]  # a popular blocked host
    rows += [(200, "http://mixed.io/", to("bad.org", "good.net", "calm.io")), (201, "http://mainly.io/", to(*["bad.org"] * 9, "calm.io")), (202, "http://trusted.net/ok", to("bad.org"))]
    rules = [UrlRule("org", "/", False), UrlRule("good.net", "/ok", True), UrlRule("trusted.net", "/ok", True)]
    links = {}
    for _, url, html in rows:
        h = url.split("/")[2]
        for g in html.split("http://")[1:]:
            if (g := g.split("/")[0]) != h:
                links.setdefault(h, []).append(g)
    hosts = sorted({u.split("/")[2] for _, u, _ in rows})
    good, bad = {"good.net": 1.0, "trusted.net": 1.0}, {"bad.org": 1.0}
    trust, distrust = dict(good), dict(bad)
    for _ in range(200):
        trust = {h: good.get(h, 0) + FOLLOW * sum(trust.get(s, 0) * v.count(h) / len(v) for s, v in links.items()) for h in hosts}
        distrust = {h: bad.get(h, 0) + (1 - bad.get(h, 0)) * FOLLOW * sum(distrust.get(g, 0) for g in links.get(h, [])) / max(1, len(links.get(h, []))) for h in hosts}
    want = {h for h in hosts if distrust[h] > trust[h] and distrust[h] >= THRESHOLD}
    assert want == {"hub.io", "mainly.io"} | {f"spam{k}.io" for k in range(100)}  # bad.org, which a trusted host links to, falls to its rule
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.host: r.verdict for r in url_filters(pages, rules).collect()}
    assert got == {h: "block" if h in want | {"bad.org"} else "allow" for h in hosts}
    seeds = spark.createDataFrame([(h, good.get(h, 0.0), bad.get(h, 0.0)) for h in {*good, *bad}], "host string, good double, bad double")
    held = {r.host: (r.trust, r.distrust) for r in spread(host_links(pages), seeds, Scratch(spark, "t")).collect()}
    assert all(abs(held[h][0] - trust[h]) < 0.01 and abs(held[h][1] - distrust[h]) < 0.01 for h in hosts)
    assert url_filters(spark.createDataFrame([], "page_id long, url string, html string"), rules).count() == 0


def test_pipeline(spark, tmp_path):
    """Every stage on what the one before kept: run() against plain Python but for the classifier, whose kept ids are taken."""
    dice = random.Random(5)
    vocabulary = [f"w{k}" for k in range(300)]
    good = [" ".join(dice.choice(vocabulary) for _ in range(dice.randint(30, 90))) for _ in range(60)]
    for k in range(20):  # near copies
        w = good[k % 5].split()
        w[-1] = f"y{k}"
        good.append(" ".join(w))
    texts = [t + "\nShared  Footer " if k % 2 else t for k, t in enumerate(good)] + ["$$$ !!! ### " * 30 + str(k) for k in range(40)] + [None, ""]
    spark.createDataFrame([(k, t, "en", f"s{k % 3}", len(t or "")) for k, t in enumerate(texts)], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(k, int(k < 80), 0) for k in range(120)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    kept = sorted(r.doc_id for r in corpus_pipeline.quality_classifier(spark, docs, str(tmp_path)).collect())
    assert set(range(80)) <= set(kept) and not set(range(80, 120)) & set(kept)
    lines = {k: (texts[k] or "").split("\n") for k in kept}
    count = Counter(x for v in lines.values() for x in {y.strip().lower() for y in v} if x)
    left = {k: "\n".join(x for x in v if count[x.strip().lower()] < 10) for k, v in lines.items()}
    sets = {}
    for k, t in left.items():
        w = t.lower().split()
        sets[k] = {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) > 4 else ({tuple(w)} if w else set())
    root = {k: k for k in kept}
    for _ in kept:  # smallest id reachable
        old = dict(root)
        for a in kept:
            for b in kept:
                if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                    root[a] = min(root[a], root[b])
        if old == root:
            break
    want = {k: len(left[k].split()) + 1 for k in kept if root[k] == k}
    got = Counter()
    for r in corpus_pipeline.run(spark, str(tmp_path)).collect():
        got[r.doc_id] += r.length
    assert got == want and len(want) < len(kept)


def test_packing_follows_the_mixture(spark, monkeypatch):
    """Groups are runs of the mixture, bins go by their first piece in it, and without the mixing stage they differ."""
    monkeypatch.setattr(packing, "GROUP", 25)
    dice = random.Random(8)
    docs = spark.createDataFrame([(k, " ".join(["word"] * dice.randint(1, 4000)), f"s{k % 3 if k > 60 else 0}", k) for k in range(150)], "doc_id long, text string, source string, mix_at long")
    placed = corpus_pipeline.mix_sources(spark, docs, "")
    where = {r.doc_id: (r.mix_slot, r.mix_at, r.doc_id) for r in placed.collect()}
    rows = corpus_pipeline.best_fit_packing_stage(spark, placed, "").collect()
    assert sorted((r.doc_id, r.length) for r in rows) == sorted((r.doc_id, len(r.text.split()) + 1) for r in docs.collect())
    first = {}
    for r in rows:
        first[r.bin] = min(first.get(r.bin, (10**9,)), where[r.doc_id])
    groups = {}
    for r in rows:
        groups.setdefault(r.bin >> 32, []).append(where[r.doc_id][0])
    assert len(groups) > 3 and len({t for t, *_ in where.values()}) > 20
    assert all(max(groups[a]) < min(groups[b]) for a, b in zip(sorted(groups), sorted(groups)[1:], strict=False))
    assert [first[b] for b in sorted(first)] == sorted(first.values())
    without = corpus_pipeline.best_fit_packing_stage(spark, docs, "").collect()
    assert sorted(without) != sorted(rows)
    heavy = corpus_pipeline.best_fit_packing_stage(spark, mixing.mix(docs, {"s2": 50.0}, place=corpus_pipeline.PLACE), "").collect()
    share = lambda v: sum(r.bin >> 32 == 0 and where[r.doc_id] is not None and r.doc_id > 60 and r.doc_id % 3 == 2 for r in v)
    assert share(heavy) > share(rows)


def test_pipeline_of_odd_tables(spark, tmp_path):
    """run() on an empty table, on null ids and texts, repeated rows and columns whose names clash with its own."""
    kind = SCHEMA + ", mix_slot string, mix_at string"
    for name, rows in (("empty", []), ("odd", [r + tuple(CLASH) + ("a", "b") for r in ROWS])):
        spark.createDataFrame(rows, kind).write.parquet(f"{tmp_path}/{name}/documents.parquet")
        spark.createDataFrame([(1, 1, 0), (3, 1, None)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/{name}/labels.parquet")
        got = corpus_pipeline.run(spark, f"{tmp_path}/{name}").collect()
        assert ({r.doc_id for r in got} == {None, 1, 2, 3, 5, 6, 7}) if rows else not got


def test_many_rows_alike(spark):
    """Rows without an id and of one text: none is lost, none shares a slot or a place."""
    rows = [(None, "same words here", "en", "s") for _ in range(500)] + [(k, f"t{k}", "en", "s") for k in range(500)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    got = kd_shards(docs, 4).collect()
    assert len(got) == 1000 and len({(r.shard, r.slot) for r in got}) == 1000
    assert len({r.shard for r in got if r.doc_id is None}) == 1
    packed = packing.best_fit_packing(docs, (64, 256)).collect()
    assert len(packed) == 1000 and len({(r.bin, r.place) for r in packed}) == 1000
    mixed = mixing.mixed(docs, block_bytes=512).collect()
    assert len(mixed) == 1000 and len({(r.block, r.at) for r in mixed}) == 1000
    assert {r.n_removed for r in substring_dedup(docs, 3).filter("doc_id is null").collect()} == {0}


def test_sql_of_url_filters_spreads_distrust_too(spark, tmp_path):
    """The query against its SQL on pages whose hosts link to one another, with odd urls and null pages."""
    duckdb = pytest.importorskip("duckdb")
    dice = random.Random(4)
    hosts = [f"h{k}.{e}" for k in range(12) for e in ("example.com", "example.net", "org", "io")]
    rows = []
    for k in range(600):
        host = dice.choice(hosts)
        bad = host.startswith(("h1.", "h2.")) and host.endswith("example.com")
        path = "/en/5" if bad else dice.choice(["/en/7", "/de/1", "/de/8", "/es/2", "/fr/", "/", ""])
        to = [dice.choice(["h1.example.com", "h2.example.com"] if host.endswith("io") else hosts) for _ in range(dice.randrange(4))]
        rows.append((k, f"http://{host.upper()}{path}?x=1", " ".join(f"<a class='x' href='//{h}/y'>" for h in to)))
    rows += [(600, None, None), (601, "no scheme", "<a href=http://h1.org/>"), (602, "http://h1.io", None), (603, "://", "")]
    spark.createDataFrame(rows, "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{tmp_path}/pages.parquet/*.parquet'")
    names = ["page_id", "host", "path", "rule", "verdict"]
    got = sorted(tuple(r) for r in queries.op10_url_filters(spark, str(tmp_path)).select(*names).collect())
    assert got == sorted(con.execute(f"SELECT {', '.join(names)} FROM ({queries.SQL['op10_url_filters']})").fetchall())
    assert sum(r[3] is None and r[4] == "block" for r in got) > 20  # by links alone


def test_sql_of_nearest_on_odd_vectors(spark, tmp_path):
    """The query against exact neighbours by SQL: vectors that take no part, repeated ids and ties; one list holds all."""
    duckdb = pytest.importorskip("duckdb")
    dice = np.random.default_rng(6)
    rows = [(k, [float(v) for v in dice.integers(0, 4, 5)]) for k in range(350)]
    rows += [(100, [9.0] * 5), (400, None), (500, [0.0] * 5), (600, [float("nan")] * 5), (700, [1.0, None, 1.0, 1.0, 1.0]), (800, [1.0] * 4), (900, []), (None, [1.0] * 5)]
    spark.createDataFrame(rows, "vec_id long, embedding array<float>").write.parquet(f"{tmp_path}/embeddings.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{tmp_path}/embeddings.parquet/*.parquet'")
    names = ["query_id", "rank", "vec_id", "score"]
    got = sorted(tuple(r) for r in queries.op5_posting_list_search(spark, str(tmp_path)).select(*names).collect())
    assert got == sorted(con.execute(f"SELECT {', '.join(names)} FROM ({queries.SQL['op5_posting_list_search']})").fetchall())
    assert {r[0] for r in got} == {0, 100, 200, 300}


def test_spelling_sends_no_vocabulary_to_every_task(spark, monkeypatch):
    """Written tables are far smaller than their rows: none of the joins of words may gather them in the driver."""
    from acopio.llm import spelling

    words = [f"{a}{b}{c}tura" for a in "bcdfg" for b in "aeiou" for c in ("", "n", "nn", "r")]
    docs = spark.createDataFrame([(0, " ".join(words * 3 + words[:50] * 4))], "doc_id long, text string")
    plans, write = [], spelling.Scratch.write

    def kept(self, df, name):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return write(self, df, name)

    monkeypatch.setattr(spelling.Scratch, "write", kept)
    out = spelling.spelling_variants(docs)
    plans.append(out._jdf.queryExecution().executedPlan().toString())
    assert out.count() == len(set(words)) and len(plans) >= 4
    assert not [p for p in plans if "Broadcast" in p]
