"""Operators against brute force on small tables with nulls, empty and repeated rows, ties and clashing columns."""

import hashlib
import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from acopio.llm import mixing, packing, quality_model
from acopio.llm.line_dedup import CuckooFilter, LineStore, line_dedup
from acopio.llm.near_dedup import drop_near, near_dedup
from acopio.llm.nearest import RATIO, CentroidGraph, nearest
from acopio.llm.quality_rules import quality_rules
from acopio.llm.sharding import kd_shards
from acopio.llm.substring_dedup import substring_dedup
from acopio.llm.url_filters import UrlRule, url_filters

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, sig string, start int, slot int"


@pytest.fixture(scope="module")
def texts():
    dice = random.Random(4)
    words = [f"w{k}" for k in range(400)] + ["É", "ñandú", "A", "a"]
    out = [" ".join(dice.choice(words) for _ in range(dice.randint(1, 120))) for _ in range(40)]
    for k in range(30):
        w = out[k % 12].split()
        w[dice.randrange(len(w))] = f"x{k}"
        out.append(" ".join(w) + "\n Common Line \t\n" + str(k))
    return [*out, None, "", " \n\t", out[0], out[0], "word " * 3000, "\ncommon line\n"]


@pytest.fixture(scope="module")
def docs(spark, texts):
    return spark.createDataFrame([(k * 3 + 1, t, "en" if k % 2 else None, f"s{k % 3}" if k % 5 else None, 1, "s", 1, 2) for k, t in enumerate(texts)], SCHEMA).cache()


def words(t):
    return (t or "").encode().split()


def test_sharding(docs, texts):
    rows = kd_shards(docs, 8).collect()
    assert len(rows) == len(texts) and {r.law for r in rows} == {"bytes"}
    by = {s: [r for r in rows if r.shard == s] for s in range(8)}
    assert all(sorted(r.slot for r in v) == list(range(len(v))) for v in by.values())
    for r in rows:
        t = (texts[(r.doc_id - 1) // 3] or "").encode()
        assert (r.size, r.text_crc32, r.grown_shard) == (len(t) + 1, zlib.crc32(t), None)
    assert kd_shards(docs.limit(0), 8).count() == 0


def test_sharding_keeps_copies_and_balances(spark):
    """Equal texts lie in one shard, heavy ones too; the others' bytes are near equal; the first cut is along a dimension."""
    dice = random.Random(9)
    rows = [(k, "x" * dice.randint(1, 60) + str(k), dice.choice(["de", "en", "es"]), f"https://www.example.com/{dice.randint(0, 99):02}") for k in range(-3000, 3000)]
    rows += [(10_000 + k, "copy " * 40, "en", "https://www.example.com/50") for k in range(100)]  # over half of a shard
    rows += [(20_000 + k, "heavy " * 50, "en", f"https://www.example.com/{k % 90}") for k in range(700)]  # over a leaf
    rows += [(-(2**63), "first", None, None), (2**63 - 2, "last", "zz", "zz"), (None, "none", "en", ""), (None, "none", "en", "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    got = kd_shards(docs, 8).collect()
    shard, sizes = {}, [0] * 8
    for r in got:
        shard.setdefault(r.text_crc32, set()).add(r.shard)
        sizes[r.shard] += r.size
    assert len(got) == len(rows) and all(len(v) == 1 for v in shard.values())
    heavy = next(iter(shard[zlib.crc32(b"heavy " * 50)]))
    others = [n for s, n in enumerate(sizes) if s != heavy]
    assert sizes[heavy] == 700 * 301 and max(others) - min(others) < 0.01 * sum(others) / 7
    assert kd_shards(docs, target_bytes=20_000).agg({"shard": "max"}).first()[0] + 1 == -(-sum(sizes) // 20_000)
    lang = {zlib.crc32(t.encode()): (x or "") for _, t, x, _ in sorted(rows, key=lambda r: (r[0] is None, r[0]))[::-1]}
    left = {lang[c] for c, v in shard.items() if next(iter(v)) < 3 and c != zlib.crc32(b"copy " * 40)}
    right = {lang[c] for c, v in shard.items() if 3 <= next(iter(v)) < 7 and c != zlib.crc32(b"copy " * 40)}
    assert max(left) <= min(right)  # seven shards are cut as three and four


def test_ranks(spark):
    from acopio.llm.common import Scratch
    from acopio.llm.sharding import ranks

    values = [f"https://{k * 7919 % 501:03}" for k in range(501)] + [None, "", "é", "z"]
    got = {r.v: r.r for r in ranks(spark.createDataFrame([(v,) for v in values * 2], "a string"), "a", Scratch(spark, "t"), "t").collect()}
    assert got == {v: k for k, v in enumerate(sorted({v for v in values if v is not None}, key=lambda v: v.encode()), 1)}


def test_substring(docs, texts):
    got, first = {r.doc_id: r for r in substring_dedup(docs, 20).collect()}, {}
    for k, t in enumerate(texts):
        w, i = words(t), k * 3 + 1
        gone = set()
        for p in range(len(w) - 19):
            if first.setdefault(tuple(w[p : p + 20]), i) < i:
                gone |= set(range(p, p + 20))
        left = b" ".join(x for p, x in enumerate(w) if p not in gone)
        assert (got[i].n_words, got[i].n_removed, got[i].kept_sha256) == (len(w), len(gone), hashlib.sha256(left).hexdigest())
    assert substring_dedup(docs.limit(0)).count() == 0


def test_substring_of_hot_anchors(spark, docs, monkeypatch):
    """Whether an anchor counts as hot changes nothing."""
    from acopio.llm import substring_dedup as s

    phrase = "one two three four five six seven eight"
    more = spark.createDataFrame([(1000 + k, f"a{k} b{k % 3} {phrase} " + " ".join(f"t{j}" for j in range(k % 5 * 4)) + f" {phrase} end") for k in range(60)], "doc_id long, text string")
    both = docs.select("doc_id", "text").unionByName(more)
    cold = sorted(substring_dedup(both, 12).collect())
    monkeypatch.setattr(s, "HOT", 1)
    assert sorted(substring_dedup(both, 12).collect()) == cold and sum(r.n_removed for r in cold) > 500


def test_lines(docs, texts):
    key = lambda x: x.strip(b" \t\n\x0b\x0c\r").lower()
    lines = [(t or "").encode().split(b"\n") for t in texts]
    n = Counter(k for x in lines for k in {key(y) for y in x})
    got = {r.doc_id: r for r in line_dedup(docs, 10).collect()}
    for k, x in enumerate(lines):
        kept = [y for y in x if not key(y) or n[key(y)] < 10]
        assert (got[k * 3 + 1].n_lines, got[k * 3 + 1].kept_sha256) == (len(x), hashlib.sha256(b"\n".join(kept)).hexdigest())


def test_lines_are_reversible(spark, docs):
    a, b = docs.filter("doc_id % 2 = 0"), docs.filter("doc_id % 2 = 1")
    back = LineStore(spark, 8, shards=4).insert(b).insert(a).delete(a)
    assert sorted(back.apply(b).collect()) == sorted(LineStore(spark, 8, shards=4).insert(b).apply(b).collect())


def test_lines_count_documents(spark):
    """Ten rows of one document are one document, whatever their texts; rows without an id count by their texts."""
    rows = [(1, "A\nb")] * 6 + [(1, f"a\nx{k}") for k in range(4)] + [(2, "b"), (None, "B\nq"), (None, "b\nq"), (None, "b\nq")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    held = {}
    for i, t in rows:
        for x in {y.lower() for y in t.split("\n")}:
            held.setdefault(x, set()).add(i if i is not None else t)
    for least in (2, 3, 4, 5):
        want = Counter((i, sum(len(held[x.lower()]) >= least for x in t.split("\n"))) for i, t in rows)
        assert Counter((r.doc_id, r.n_dropped) for r in line_dedup(docs, least).collect()) == want
    store = LineStore(spark, 3, shards=2).insert(docs)
    assert {r.n for r in store.delete(docs).counts.collect()} == set()


def test_cuckoo():
    h = np.random.default_rng(1).integers(0, 2**63, 5000).astype(np.uint64)
    f = CuckooFilter(5000)
    assert f.add(h) and f.has(h).all()
    f.remove(h[:2500])
    assert f.has(h[2500:]).all() and f.has(h[:2500]).mean() < 0.01


def test_mixing():
    quota = mixing.quotas([0.5, 0.3, 0.15, 0.05])
    seen = [0] * 4
    for t, s in enumerate(mixing.earliest_deadline_first(quota), 1):
        seen[s] += 1
        assert all(abs(seen[k] - quota[k] * t / sum(quota)) < 1 for k in range(4))
    plan = mixing.phases([7000, 300, 5], [1, 1, 1])
    slots = sorted(first + (b - lo) // q * mixing.FRAME + where[(b - lo) % q] for _, lo, hi, q, first, where in plan for b in range(lo, hi))
    assert slots == list(range(7305))


def test_mixing_follows_the_weights_for_long():
    weights = [1 / 3] + [2 / 57] * 19 + [0.0001]
    total = sum(weights)
    blocks = [int(60_000 * w / total) + 2 for w in weights]
    order = [-1] * sum(blocks)
    for s, lo, hi, q, first, where in mixing.phases(blocks, weights):
        for b in range(lo, hi):
            order[first + (b - lo) // q * mixing.FRAME + where[(b - lo) % q]] = s
    assert -1 not in order
    seen, far = np.zeros(len(weights)), 0.0
    for t, s in enumerate(order[:60_000], 1):
        seen[s] += 1
        far = max(far, np.abs(seen - np.array(weights) / total * t).max())
    assert far < 1


def test_mixing_of_many_sources(spark, monkeypatch):
    """More sources than are scheduled at once: given weights hold, and no two sources share a slot."""
    monkeypatch.setattr(mixing, "MOST_SOURCES", 12)
    monkeypatch.setattr(mixing, "KEPT", 4, raising=False)
    monkeypatch.setattr(mixing, "BUCKETS", 5, raising=False)
    rows = [(40 * k + i, "x" * 99, f"s{k}" if k else None) for k in range(40) for i in range(40 if k in (7, 8, 9) else 8)]
    got = mixing.mixed(spark.createDataFrame(rows, "doc_id long, text string, source string"), {"s3": 10.0, "s7": 1e-6, "absent": 5.0}, block_bytes=200).collect()
    assert sorted(r.doc_id for r in got) == sorted(r[0] for r in rows)
    held = {}
    for r in got:
        held.setdefault(r.slot, set()).add((r.source, r.block))
    assert sorted(held) == list(range(len(held))) and all(len(v) == 1 for v in held.values())
    at = {s: sorted(t for t, v in held.items() if (s, next(iter(v))[1]) in v) for s in ("s3", "s7")}
    assert at["s3"][-1] < 10 and at["s7"][1] > len(held) // 2
    for s in range(40):
        of = sorted((r.block, r.slot) for r in got if r.source == f"s{s}")
        assert [t for _, t in of] == sorted(t for _, t in of)


def test_blocks_grow_beyond_a_number_of_them(spark, monkeypatch):
    """With more blocks than the schedule may hold they are larger ones, equal to asking for that size; nothing is lost."""
    df = spark.createDataFrame([(i, "x" * (9 + i % 50), f"s{i % 3}") for i in range(900)], "doc_id long, text string, source string")
    total = sum(10 + i % 50 for i in range(900))
    for most in (10**6, 40):  # far from it, and beyond
        monkeypatch.setattr(mixing, "MOST_BLOCKS", most, raising=False)
        got = mixing.mixed(df, block_bytes=100).collect()
        assert sorted(r.doc_id for r in got) == list(range(900)) and len({(r.source, r.block) for r in got}) <= min(most, -(-total // 100)) + 3
    monkeypatch.setattr(mixing, "MOST_BLOCKS", 10**6)
    asked = mixing.mixed(df, block_bytes=-(-total // 40)).collect()
    assert sorted(map(tuple, asked)) == sorted(map(tuple, got))


def test_slots_of_documents(docs, texts):
    """Each document's block and place in it by cumulative bytes, each block's slot by a plain earliest-deadline schedule."""
    from fractions import Fraction

    rows = mixing.mixed(docs, {"s1": 3.0}, block_bytes=256).collect()
    by, total = {}, sum(r.size for r in rows)
    for r in rows:
        by.setdefault(r.source, []).append(r)
    names = sorted(by, key=lambda s: s or mixing._NULL)
    blocks = {s: -(-sum(r.size for r in by[s]) // 256) for s in names}
    weight = {s: Fraction(3.0 if s == "s1" else (sum(r.size for r in by[s]) / total) ** 0.5) for s in names}
    for s in names:
        at = 0
        for r in sorted(by[s], key=lambda r: (r.block, r.at)):
            assert (r.block, r.at) == divmod(at, 256)
            at += r.size
    slot, t, done = {}, 0, dict.fromkeys(names, 0)
    while active := [s for s in names if done[s] < blocks[s]]:
        sum_, begun, gone = sum(weight[s] for s in active), dict.fromkeys(active, 0), 0
        while True:
            due = [(math.ceil((begun[s] + 1) * sum_ / weight[s]), k, s) for k, s in enumerate(active) if math.floor(begun[s] * sum_ / weight[s]) <= gone]
            s = min(due)[2]
            if done[s] == blocks[s]:
                break
            slot[s, done[s]] = t
            done[s], begun[s], gone, t = done[s] + 1, begun[s] + 1, gone + 1, t + 1
    assert all(r.slot == slot[r.source, r.block] for r in rows) and len(rows) == len(texts)


def test_mixed_keeps_all(docs, texts):
    rows = mixing.mixed(docs, block_bytes=256).collect()
    assert sorted(r.doc_id for r in rows) == [k * 3 + 1 for k in range(len(texts))]
    assert mixing.mix(docs, block_bytes=256).columns == docs.columns
    assert mixing.mixed(docs.limit(0)).count() == 0


def test_packing(docs, texts):
    rows = packing.best_fit_packing(docs, (64, 128, 256)).collect()
    total = Counter()
    for r in rows:
        total[r.doc_id] += r.length
    assert total == {k * 3 + 1: len(words(t)) + 1 for k, t in enumerate(texts)}
    for b in {r.bin for r in rows}:
        held = sorted((r.place, r.length) for r in rows if r.bin == b)
        assert all(p == sum(n for _, n in held[:k]) for k, (p, _) in enumerate(held)) and sum(n for _, n in held) <= next(r.capacity for r in rows if r.bin == b)


def _least_cost(lengths, sizes):
    """The cheapest way to put pieces into bins of these sizes, by trying all."""
    best = [math.inf]

    def place(k, bins):
        if k == len(lengths):
            best[0] = min(best[0], sum(packing.cost(next(c for c in sizes if c >= b)) for b in bins))
            return
        for i in range(len(bins)):
            if bins[i] + lengths[k] <= sizes[-1]:
                place(k + 1, [*bins[:i], bins[i] + lengths[k], *bins[i + 1 :]])
        place(k + 1, [*bins, lengths[k]])

    place(0, [])
    return best[0]


def test_lengths_are_chosen_together():
    """Never dearer than the best single length, near the cheapest of all ways in small cases, and cheaper where only
    larger bins hold several pieces."""
    dice = np.random.default_rng(3)
    total = lambda caps: sum(packing.cost(int(c)) for c in caps)
    for high in (200, 600, 3000, 8192):
        lengths = dice.integers(1, high + 1, 1500)
        bins, places, caps = packing.best_fit(lengths)
        held = np.bincount(bins, lengths)
        assert (held <= caps).all() and len(caps) == bins.max() + 1 and len(set(zip(bins.tolist(), places.tolist(), strict=True))) == 1500
        for c in packing.CAPACITIES:
            if c >= lengths.max():
                alone = packing.packed_into(lengths, (c,))[2]
                assert total(caps) <= sum(packing.cost(next(x for x in packing.CAPACITIES if x >= u)) for u in alone) + 1e-6
    assert set(packing.best_fit(np.full(900, 600))[2].tolist()) == {2048}  # 1024 would hold one of them
    ratio = []
    for _ in range(60):
        lengths = dice.integers(1, 1400, dice.integers(1, 7))
        ratio.append(total(packing.best_fit(lengths, (512, 1024, 2048))[2]) / _least_cost(lengths.tolist(), (512, 1024, 2048)))
    assert min(ratio) >= 1 - 1e-9 and max(ratio) < 1.5 and np.mean(ratio) < 1.03


def test_nearest(spark):
    dice = np.random.default_rng(2)
    x = dice.normal(size=(900, 8))
    x[5] = x[7]
    rows = [(k, [float(v) for v in x[k]]) for k in range(900)] + [(1000, None), (1100, [0.0] * 8), (1200, [math.nan] * 8), (1300, [1.0])]
    got = nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    hits = 0
    for q in range(0, 900, 100):
        d = np.sqrt(((x - x[q]) ** 2).sum(axis=1))
        d[q] = np.inf
        hits += len(set(np.argsort(d, kind="stable")[:10]) & {r.vec_id for r in got if r.query_id == q})
        mine = sorted((r for r in got if r.query_id == q), key=lambda r: r["rank"])
        assert [r["rank"] for r in mine] == list(range(1, 11)) and [(r.score, r.vec_id) for r in mine] == sorted((r.score, r.vec_id) for r in mine)
        assert all(abs(r.score - np.linalg.norm(x[r.vec_id] - x[q])) < 1e-12 for r in mine)
    assert hits >= 0.9 * 90 and all(r.query_id < 900 and r.vec_id < 900 for r in got)


def test_nearest_of_repeated_ids_and_other_lengths(spark):
    """A vec_id that occurs twice is its smallest vector's; vectors of a rarer length take no part; ties go by id."""
    rows = [(0, [0.5, 0.0]), (1, [9.0, 9.0]), (1, [1.0, 0.0]), (2, [0.0, 0.0, 1.0]), (3, [0.0, 0.0]), (5, [0.5, 1.0]), (4, [0.5, -1.0]), (4, [0.5, -1.0])]
    got = nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert [(r["rank"], r.vec_id, r.score) for r in sorted(got, key=lambda r: r["rank"])] == [(1, 1, 0.5), (2, 4, 1.0), (3, 5, 1.0)]


def test_nearest_searches_all_lists_of_the_ratio():
    """More lists than any fixed number of probes: the ratio alone selects, and few suffice where it is narrow."""
    dice = np.random.default_rng(6)
    c, sizes = dice.normal(size=(600, 32)) * 0.2, np.full(600, 200)
    graph = CentroidGraph(c)
    for q in dice.normal(size=(10, 32)):
        d = np.sqrt(((c - q) ** 2).sum(axis=1))
        assert set(graph.within(q, sizes)[0]) == set(np.flatnonzero(d <= RATIO * d.min())) and (d <= RATIO * d.min()).sum() > 64
    lone = np.concatenate([c[:1] + 50, c[1:]])
    assert len(CentroidGraph(lone).within(lone[0] + 0.01, sizes)[0]) == 8  # 1500 vectors


def test_walk_sees_few_centroids_where_they_lie_in_clusters():
    dice = np.random.default_rng(8)
    hubs = dice.normal(size=(40, 32)) * 3
    c, sizes = (hubs[:, None] + dice.normal(size=(40, 50, 32)) * 0.3).reshape(-1, 32), np.full(2000, 200)
    graph, seen = CentroidGraph(c), []
    for q in hubs + dice.normal(size=(40, 32)) * 0.3:
        d = np.sqrt(((c - q) ** 2).sum(axis=1))
        got, n = graph.within(q, sizes)
        assert set(np.flatnonzero(d <= RATIO * d.min())) <= set(got)
        seen.append(n)
    assert np.mean(seen) < 700  # of 2000


def test_nearest_beyond_one_turn_of_queries(spark, monkeypatch):
    """Many queries of a part are dealt to repeats of it; every row may be a query, also without others to fit on."""
    monkeypatch.setattr("acopio.llm.nearest.ASKED", 50)
    x = np.random.default_rng(9).normal(size=(300, 4))
    got = nearest(spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(x)], "vec_id long, embedding array<double>"), "vec_id >= 0", 3).collect()
    want = []
    for k, v in enumerate(x):
        d = np.sqrt(((x - v) ** 2).sum(axis=1))
        d[k] = np.inf
        want += [(k, rank, int(i)) for rank, i in enumerate(np.argsort(d, kind="stable")[:3], 1)]
    assert sorted((r.query_id, r["rank"], r.vec_id) for r in got) == want


def test_rules(docs, texts):
    for r in quality_rules(docs).collect():
        t = texts[(r.doc_id - 1) // 3] or ""
        w = words(t)
        c = Counter(tuple(w[k : k + 3]) for k in range(len(w) - 2))
        cover = {j for k in range(len(w) - 2) if c[tuple(w[k : k + 3])] > 1 for j in (k, k + 1, k + 2)}
        assert (r.n_words, r.n_repeat_words) == (len(w), len(cover))
        chars, symbols = sum(len(x.decode()) for x in w), sum(t.count(c) for c in "#*$%&|<>")
        lines = [x for x in t.split("\n") if x.strip(" \t\n\x0b\x0c\r")]
        again = len(lines) - len(set(lines))
        assert (r.word_chars, r.n_symbols, r.n_dup_lines) == (chars, symbols, again)
        bad = 100 * symbols > 30 * len(w) or (len(lines) > 4 and 100 * again > 60 * len(lines)) or not 2 * len(w) <= chars <= 20 * len(w)
        bad |= 100 * t.count("!!") > 30 * len(w) or 2 * sum(c.isupper() for c in t) > chars
        assert r.kept == (not r.base_failed and not bad)
        assert r.base_failed == (len(w) < 50 or 100 * len(cover) > 50 * len(w)) and not (r.base_failed and r.kept)


def test_rules_run_in_the_order_of_rejection_per_cost(spark):
    """A cheap rule that rejects much comes before a dear one that rejects little; the order changes no verdict."""
    from acopio.llm import quality_rules as q
    from acopio.llm.common import Scratch
    from pyspark.sql import functions as F

    docs = spark.createDataFrame([(k, " ".join(["Word"] * 60) + ("!!" * 40 if k % 2 else "") + "x" * (k % 7)) for k in range(300)], "doc_id long, text string")
    slow = q.Rule("slow", F.length(F.regexp_replace(F.col("text"), "(W|o|r)+?[^x]*?d", "")) == 17)
    quick = q.Rule("quick", F.col("doc_id") % 2 == 1)
    sample = q.bounded_sample(docs, 200, 1 << 16, Scratch(spark, "t"))
    assert sample.count() == 200 and q.bounded_sample(docs, 200, 10, Scratch(spark, "t")).count() == 0
    assert [r.name for r, *_ in q.cascade_order(sample, [slow, quick])] == ["quick", "slow"]
    a, b = ({r.doc_id: r.kept for r in quality_rules(docs, x).collect()} for x in ([slow, quick], [quick, slow]))
    assert a == b and not any(v for k, v in a.items() if k % 2)


def test_scores_by_plain_convolution():
    """The score against loops over every window, filter and chunk."""
    dice = np.random.default_rng(5)
    m = quality_model
    net = m.Network(dice.normal(0, 0.3, (m.WIDTH, 256, 3)).astype(np.float32), dice.normal(0, 0.3, 3).astype(np.float32), dice.normal(0, 0.5, 6).astype(np.float32), 0.1)
    texts = [b"", b"a", b"x" * 255, bytes(range(256)) * 3, "é漢".encode() * 300]
    want = []
    for t in texts:
        n = max(1, -(-len(t) // m.CHUNK))
        padded = t + bytes(n * m.CHUNK + m.WIDTH)
        pools = [[max(sum(net.table[j, padded[c * m.CHUNK + p + j], f] for j in range(m.WIDTH)) for p in range(m.CHUNK)) for f in range(3)] for c in range(n)]
        z = np.maximum(np.array(pools) + net.bias, 0)
        want.append(1 / (1 + math.exp(-(np.concatenate([z.mean(axis=0), z.max(axis=0)]) @ net.out + net.base))))
    assert np.allclose(m.score(texts, net, net.pairs()), want, atol=1e-5)


def test_classifier_of_odd_labels(spark):
    """Labels of one class alone give their share; a document labelled twice is learned twice."""
    docs = spark.createDataFrame([(k, f"t {k}") for k in range(12)], "doc_id long, text string")
    one = spark.createDataFrame([(k, 1) for k in range(12)], "doc_id long, quality int")
    assert {r.score for r in quality_model.quality_scores(docs, one).collect()} == {1.0}
    both = one.unionByName(spark.createDataFrame([(k, 0) for k in range(6)], "doc_id long, quality int"))
    assert quality_model.quality_scores(docs, both).filter("score between 0 and 1").count() == 12


def test_classifier(spark):
    dice = random.Random(1)
    clean = lambda: " ".join(dice.choice(["the", "and", "thing", "over"]) for _ in range(60))
    rows = [(k, clean() if k % 2 else clean() + " $$$### " * 4, k % 2) for k in range(300)]
    docs = spark.createDataFrame([(k, t) for k, t, _ in rows] + [(900, None), (901, "")], "doc_id long, text string")
    labels = spark.createDataFrame([(k, q) for k, _, q in rows], "doc_id long, quality int")
    got = {r.doc_id: r for r in quality_model.quality_scores(docs, labels).collect()}
    held = [k for k, _, _ in rows if got[k].held_out]
    assert len(got) == 302 and sum(got[k].predicted == k % 2 for k in held) >= 0.95 * len(held)
    assert quality_model.quality_scores(docs, labels.limit(0)).count() == 302


def test_classifier_learns_all_of_long_texts(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(quality_model, "chunks", lambda t, own=quality_model.chunks: seen.append(t) or own(t))
    ids = [k for k in range(40) if k % 5]
    long = {k: f"long {k} " + " ".join(f"w{j}" for j in range(30_000)) for k in ids[:2]}
    docs = spark.createDataFrame([(k, long.get(k, f"short {k}")) for k in ids], "doc_id long, text string")
    labels = spark.createDataFrame([(k, k % 2) for k in ids], "doc_id long, quality int")
    monkeypatch.setattr(quality_model, "EPOCHS", 1)
    quality_model.train(docs, labels)
    held = {r.doc_id for r in labels.filter(quality_model.remainder() == 0).collect()}
    assert sorted(seen) == sorted(long.get(k, f"short {k}").encode() for k in ids if k not in held)
    assert any(len(t) > 134_000 for t in seen)
    monkeypatch.setattr(quality_model, "CLASS_BYTES", 20)
    seen.clear()
    quality_model.train(docs, labels)
    assert 2 <= len(seen) < 10


def test_near(docs, texts):
    sets = {}
    for k, t in enumerate(texts):
        w = (t or "").encode().lower().split()
        sets[k * 3 + 1] = {tuple(w[i : i + 3]) for i in range(len(w) - 2)} if len(w) > 2 else ({tuple(w)} if w else set())
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in sets:
        for j in sets:
            if j < i and sets[i] and 100 * len(sets[i] & sets[j]) >= 85 * len(sets[i] | sets[j]):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_dedup(docs, 3, 85).collect()}
    assert got == {i: (len(s), find(i)) for i, s in sets.items()}
    assert drop_near(docs, 3, 85).count() == len({find(i) for i in sets})


def test_urls(spark):
    link = '<a href="http://bad.org/x">'
    rows = [(1, "http://a.Com/en/7", link), (2, None, None), (3, "x", ""), (4, "https://bad.org/es/1?q#z", ""), (5, "http://b.net/de/8", ""), (6, "http://good.net/de/", ""), (7, "http://a.com/fr", "")]
    rules = [UrlRule("com", "/en/", False), UrlRule("a.com", "/en/7", True), UrlRule("net", "/de/", True), UrlRule("org", "/es/", False)]
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_filters(spark.createDataFrame(rows, "page_id long, url string, html string"), rules).collect()}
    assert got[1] == ("a.com", "/en/7", "a.com/en/7", "allow") and got[2] == ("", "", None, "allow") and got[4] == ("bad.org", "/es/1", "org/es/", "block")
    assert got[5][2:] == ("net/de/", "allow") and got[7][2] is None


def test_many_rules_give_what_few_give(spark):
    """On either side of INLINE: rules joined by host against rules in one expression, and both against plain Python."""
    from acopio.llm import url_filters as u

    dice = random.Random(2)
    hosts = ["com", "a.com", "b.a.com", "net", "x.net", "org", "bücher.de"]
    rules = sorted({(dice.choice(hosts), dice.choice(["/", "/a", "/a/b", "/c", ""])) for _ in range(90)})
    rules = [UrlRule(h, p, k % 3 == 0) for k, (h, p) in enumerate(rules)]
    more = rules + [UrlRule(f"h{k}.example", "/", k % 2 == 0) for k in range(70)]
    assert len(rules) <= u.INLINE < len(more)
    rows = [(k, f"http://{dice.choice(['', 'www.', 'q.b.'])}{dice.choice(hosts + ['none.io', 'acom'])}{dice.choice(['', '/', '/a/b/c', '/a', '/c?x', '#f'])}") for k in range(400)] + [(900, None), (901, "x://"), (902, "no")]
    pages = spark.createDataFrame(rows, "page_id long, url string")
    few, many = ({r.page_id: (r.host, r.path, r.rule, r.allowed) for r in u.judged(pages, x).collect()} for x in (rules, more))
    assert few == many and len(few) == len(rows)
    for host, path, rule, allowed in few.values():
        fit = [r for r in rules if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
        best = min(fit, key=lambda r: (-len(r.text), r.text)) if fit else None
        assert (rule, allowed) == ((best.text, best.allow) if best else (None, None))
