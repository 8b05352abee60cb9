"""Spelling variants, the filter audit and the n-gram join against brute force: nulls, empty and very long texts, repeated
rows, ties, empty tables and clashing columns."""

import random
import re
import zlib
from collections import Counter, defaultdict
from itertools import permutations

import numpy as np
import pyarrow as pa
import pytest

from acopio.llm import filter_audit, set_join, spelling
from acopio.llm.common import Rolling, Scratch
from acopio.llm.near_dedup import shingles

from .test_edges import ROWS, odd  # noqa: F401  odd is a fixture


# spelling variants


def variants(docs, least=5, often=3, ratio=2, damage=None):
    count = Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if damage and h % damage == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            count[run] += 1
    v = {w: n for w, n in count.items() if len(w) >= least and n >= often}

    def near(a, b):
        a, b = sorted((a, b), key=len)
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b, strict=True)) == 1
        return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))

    close = {w: [x for x in v if near(w, x)] for w in v}
    form = {}
    for w, xs in close.items():
        best = min(xs, key=lambda x: (-v[x], x), default=None)
        form[w] = best if best and v[best] >= ratio * v[w] else None
    out = []
    for w in v:
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, v[w], len(close[w]), v.get(form[w])))
    return sorted(out, key=str)


def spelled(docs, **more):
    cols = ("word", "form", "root", "n", "n_near", "form_n")
    return sorted((tuple(r[c] for c in cols) for r in spelling.spelling_variants(docs, **more).collect()), key=str)


def test_spelling_variants(spark):
    dice = random.Random(11)
    base = ["camión", "casas", "aaaaaa", "perros", "ÿÀÉéé", "largas", "sol", "Ñandú", "gatos" * 40]
    words = []
    for w in base:
        words += [w] * 12 + [w.upper()] * 3
        for _ in range(12):
            i = dice.randrange(len(w))
            x = dice.choice([w[:i] + w[i + 1 :], w[:i] + dice.choice("aeñÀ") + w[i:], w[:i] + dice.choice("aezÿ") + w[i + 1 :]])
            words += [x] * dice.randint(1, 6)
            j = dice.randrange(len(x))
            words += [x[:j] + x[j + 1 :]] * dice.randint(2, 4)
    dice.shuffle(words)
    rows = [(k // 2 if k % 7 else None, " ".join(words[k * 9 : k * 9 + 9]) + dice.choice([" 7x", "\n", "ß-a"])) for k in range(len(words) // 9 + 1)]
    rows += [(1, None), (2, ""), (3, rows[0][1]), (3, rows[0][1])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for more in ({}, {"damage": 3}, {"least": 1, "often": 1, "ratio": 1.5}):
        want = variants(rows, **more)
        names = {"least": "min_length", "often": "min_count"}
        assert spelled(docs, **{names.get(k, k): x for k, x in more.items()}) == want and any(r[1] for r in want)
    assert any(r[1] and r[2] not in (r[0], r[1]) for r in variants(rows, least=1, often=1, ratio=1.5))  # a chain of several steps
    assert spelled(docs.limit(0)) == []


def test_spelling_of_odd_rows(odd):  # noqa: F811
    want = variants([(r[0], r[1]) for r in ROWS], 1, 1, 2, 97)
    assert spelled(odd, min_length=1, min_count=1, damage=97) == want and any(len(r[0]) > 199_990 for r in want)


def test_deletion_keys():
    """Distinct words and deletions have distinct keys, equal ones the same; places are those whose deletion is the same."""
    words = ["abc", "aab", "ab", "b", "ac", "aaaa", "ñaña", "ab" * 300]
    who, key, low, high = spelling.deletion_keys(pa.array(words))
    meaning = {}
    for w, k, a, b in zip(who, key, low, high, strict=True):
        word = words[w]
        assert (a < 0) == (b < 0)
        made = {word} if a < 0 else {word[:i] + word[i + 1 :] for i in range(a, b + 1)}
        assert len(made) == 1 and meaning.setdefault(k, made) == made
    assert len({next(iter(m)) for m in meaning.values()}) == len(meaning)
    assert Counter(who) == {k: 1 + len({w[:i] + w[i + 1 :] for i in range(len(w))}) for k, w in enumerate(words)}


def test_roots_of_a_long_chain(spark):
    """Chains are short in practice; the joins find the end of any."""
    forms = spark.createDataFrame([(k, k + 1) for k in range(100)] + [(200, 50), (300, 301)], "id long, form long")
    got = {r.id: r.root for r in spelling.roots(forms, Scratch(spark, "t")).collect()}
    assert got == {k: 100 for k in range(100)} | {200: 100, 300: 301}


# the filter audit

TEXTS = ["", " ", "one two two", "A B\tC\x0b\x0cD", "é漢字 É", "x" * 50, "a\n" * 30, "#$ 50% & | *", "w " * 49 + "end", "same same", "ß\r\nß", "tail"]


def measured(t):
    w = t.encode().split()
    return len(w), len(set(w)), sum("A" <= c <= "Z" for c in t), sum(c in "#$%&*|" for c in t), len(t)


@pytest.mark.parametrize("block", [1, 7, 64, 4 << 20])
def test_counts(monkeypatch, block):
    monkeypatch.setattr(filter_audit, "BLOCK", block)
    dice = random.Random(block)
    texts = TEXTS + ["".join(dice.choice("ab É\n#Z") for _ in range(dice.randint(0, 90))) for _ in range(200)]
    names = ("n_words", "n_distinct", "n_capitals", "n_symbols", "n_points")
    for array in (pa.array(texts), pa.array(texts, pa.large_string()), pa.array(["skipped words", *texts]).slice(1), pa.array([None, *texts]).slice(1)):
        got = filter_audit.counts(array)
        assert [tuple(int(got[c][k]) for c in names) for k in range(len(texts))] == [measured(t) for t in texts]
    assert not len(filter_audit.counts(pa.array([], pa.string()))["n_words"])


def test_words_that_share_a_hash(monkeypatch):
    monkeypatch.setattr(filter_audit, "_hashes", lambda data, starts, sizes: np.zeros(len(starts), np.uint64))
    assert filter_audit.counts(pa.array(["a b a c", "same same", "ab ac"]))["n_distinct"].tolist() == [3, 1, 2]


def audited(rows, labels, letters="ABCDE"):
    """rows: doc_id, text, source."""
    good, bad = defaultdict(int), defaultdict(int)
    for k, q, t in labels:
        good[k], bad[k] = max(good[k], int(q == 1)), max(bad[k], int(t == 1))
    ids = defaultdict(list)
    for k, t, _ in rows:
        ids[t or ""].append(float("inf") if k is None else k)
    parts = defaultdict(list)
    for k, t, s in rows:
        w, d, c, x, n = measured(t or "")
        fails = {"A": w < 50, "B": 100 * d < 65 * w, "C": 100 * c > 5 * n, "D": x > 0, "E": (float("inf") if k is None else k) > min(ids[t or ""])}
        parts[s or ""].append(({f for f in letters if fails[f]}, good[k] if k is not None else 0, bad[k] if k is not None else 0))
    out = {}
    for part, docs in parts.items():
        total = Counter()
        for order in permutations(letters):
            left = docs
            for step, f in enumerate(order, 1):
                gone, left = [d for d in left if f in d[0]], [d for d in left if f not in d[0]]
                total[f] += len(gone)
                out[part, "".join(order), step] = [len(left), len(gone), sum(f in d[0] for d in docs) - len(gone), sum(d[0] == {f} for d in docs), sum(d[1] for d in gone), sum(d[2] for d in gone)]
        for (p, order, step), v in out.items():
            if p == part:
                v.append(total[order[step - 1]])
    return out


def figures(df):
    cols = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
    return {(r.part, r.filter_order, r.step): [r[c] for c in cols] for r in df.collect()}


LABELS = [(1, 1, 0), (1, 0, None), (3, 0, 1), (None, 1, 1), (4, None, 1), (7, 1, 0), (5, 1, 1), (12, 1, 0)]


def test_audit(spark, odd):  # noqa: F811
    labels = spark.createDataFrame(LABELS, "doc_id long, quality int, toxic int")
    assert figures(filter_audit.audit(odd, labels)) == audited([(r[0], r[1], r[3]) for r in ROWS], LABELS)
    assert filter_audit.audit(odd.limit(0), labels).count() == 0
    dice = random.Random(2)
    rows = [(dice.choice([None, *range(30)]), dice.choice([None, *TEXTS]), dice.choice([None, "", "s", "t"])) for _ in range(150)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    assert figures(filter_audit.audit(docs, labels)) == audited(rows, LABELS)
    some = tuple(f for f in filter_audit.FILTERS if f.letter in "BE")
    assert figures(filter_audit.audit(docs, labels.limit(0), some)) == audited(rows, [], "BE")
    with pytest.raises(ValueError):
        filter_audit.audit(docs, labels, filter_audit.FILTERS + filter_audit.FILTERS[:1])


# the n-gram join


@pytest.mark.parametrize("percent", [50, 70, 85, 95])
def test_bands(percent):
    bands = set_join.Bands(percent)
    for n in range(1, 400):
        b = bands.of(n)
        assert n <= bands.highs[b] and (b == 0 or n > bands.highs[b - 1])
        assert n * 100 // percent <= bands.highs[b + 1]  # larger partners are here or in the next band
        for y in range(n, n * 100 // percent + 1):
            most = max((n + y - 2 * c for c in range(n + 1) if 100 * c >= percent * (n + y - c)), default=-1)
            assert most <= bands.differ(n + y) < bands.segments[bands.of(y)]


def keys(items, bands, costs):
    key, cut, active = set_join.emitted(items, bands, costs)
    return dict(zip(zip(key.tolist(), cut.tolist(), strict=True), active.tolist(), strict=True))


@pytest.mark.parametrize("seed", range(6))
def test_linked_sets_meet(seed):
    """Whatever the costs are: a linked pair shares a key that is whole in one of them and active in one of them."""
    dice, bands = np.random.default_rng(seed), set_join.Bands(85)
    costs = {b: np.sort(dice.exponential(10 ** dice.integers(0, 5), set_join.LARGE + 2))[::-1] if seed % 2 else dice.random(set_join.LARGE + 2) * 100 for b in range(60)}
    met = 0
    for _ in range(300):
        n = int(dice.choice([6, 7, 8, 12, 15, 30, 60, 200, 700]))
        a = np.unique(dice.integers(0, 2**63, n).astype(np.uint64))
        off, more = dice.integers(0, n // 6 + 2), dice.integers(0, n // 6 + 2)
        b = np.unique(np.concatenate([dice.permutation(a)[off:], dice.integers(0, 2**63, more).astype(np.uint64)]))
        both = len(np.intersect1d(a, b))
        if len(b) and 100 * both >= 85 * (len(a) + len(b) - both) and both < max(len(a), len(b)):
            x, y = keys(a, bands, costs), keys(b, bands, costs)
            assert any((k, not c) in y and (y[k, not c] or active) or not c and (k, False) in y and (active or y[k, False]) for (k, c), active in x.items())
            met += 1
    assert met > 60


def linked(rows, width, percent):
    """doc_id, n, component of every row, by all pairs; nodes are doc_ids."""
    sets = []
    for k, t in rows:
        w = [b.lower() for b in (t or "").encode().split()]
        sets.append((k, {tuple(w[i : i + width]) for i in range(len(w) - width + 1)} if len(w) >= width else ({tuple(w)} if w else set())))
    root = {k: k for k, _ in sets if k is not None}
    edges = [(a, b) for a, x in sets for b, y in sets if a is not None and b is not None and a < b and x and y and 100 * len(x & y) >= percent * len(x | y)]
    moved = True
    while moved:
        moved = False
        for a, b in edges:
            low = min(root[a], root[b])
            moved |= root[a] != low or root[b] != low
            root[a] = root[b] = low
    return sorted(((k, len(s), root.get(k)) for k, s in sets), key=str)


def joined(df, width=4, percent=85):
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in set_join.set_join(df, width, percent).collect()), key=str)


def test_set_join_of_odd_rows(odd):  # noqa: F811
    assert joined(odd) == linked([(r[0], r[1]) for r in ROWS], 4, 85) and joined(odd.limit(0)) == []


@pytest.mark.parametrize("limits", [(8, 4096, 8192), (1, 2, 3)])
def test_set_join(spark, monkeypatch, limits):
    """Families of near copies: chains, families just under the threshold that share buckets, copies and short texts."""
    for name, v in zip(("PIVOTS", "MOST_PIVOTS", "CELL"), limits, strict=True):
        monkeypatch.setattr(set_join, name, v)
    dice = random.Random(13)
    words = [f"w{k}" for k in range(500)]
    texts = []
    for length in (4, 9, 10, 14, 25, 60, 150):
        for edits in (1, 2, 4):
            w = [dice.choice(words) for _ in range(length)]
            for _ in range(9):
                texts.append(" ".join(w))
                x = list(w)
                for _ in range(dice.randint(0, edits)):
                    x[dice.randrange(len(x))] = dice.choice(words)
                if dice.random() < 0.5:  # a chain, else copies of one text
                    w = x
                else:
                    texts.append(" ".join(x).upper())
    texts += texts[:20] + [None, "", "one", "One", "two words", "license " * 40]
    rows = list(enumerate(texts))
    dice.shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    want = linked(rows, 4, 85)
    assert joined(docs) == want and len({c for _, _, c in want}) < len(rows) - 100
    if limits[0] == 1:
        assert joined(docs, 2, 70) == linked(rows, 2, 70)


def test_costs_cover_all_sets(spark):
    texts = [" ".join(f"x{k % 7}y{i}" for i in range(30)) for k in range(21)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = docs.selectExpr("doc_id as _id", "doc_id as _th", "text").mapInArrow(set_join._sign(4, 85), set_join._SIGNED_SQL)
    costs = set_join.meeting_costs(rows)
    assert list(costs) == [set_join.Bands(85).of(27)] and max(costs[next(iter(costs))]) == 2  # each set is there three times
    assert len(shingles(texts[0], 4, Rolling())) == 27
