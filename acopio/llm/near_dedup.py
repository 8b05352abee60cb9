"""Near-duplicate documents by SetSketch registers, banded, estimated by likelihood and verified on full sets.

A document's set is its distinct word shingles (A-Z lower-cased). A register is the exponentially spaced, truncated
minimum of one hash over the set; registers of a union are the registers' maxima, and two sets agree in a register with
a probability close to their Jaccard similarity. Then:

1. equal sets become one class, of which the smallest doc_id stands for all: copies are never paired;
2. representatives that agree in a band of registers meet in a bucket. Each bucket pairs its members with its smallest
   one only. Joint likelihood of the registers, given both set sizes, estimates a pair's similarity and drops pairs far
   below the threshold; what is left is verified on the full sets;
3. buckets whose members are not all in one component yet go on: some members outside their largest component meet all
   members of other components and leave the bucket, until the members left in it are connected. So any two documents
   of a bucket have met or are connected without: no link between different texts is lost to the pairing.

With 32 bands of 4, a pair at 0.8 is missed by the bands with a probability of 5e-8, at 0.85 of 5e-11; the estimate
drops a pair at the threshold with a probability of 4e-11.

Defined results: a null or empty text has no shingle and is linked with nothing; rows that share a doc_id are one node;
rows with a null doc_id have a null component and are kept.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.components import connected_components
from .common import LAST_ID, Rolling, Scratch, apart, arrow, i64, keyed, slices, u64, word_hashes

BANDS, ROWS, SPACING = 32, 4, 1.01
REGISTERS = BANDS * ROWS
#: How far under the threshold an estimate may fall and still be verified, in standard deviations of the estimate.
SLACK = 6.5
#: Members outside a bucket's largest component that meet its other members in the first round; GROWTH times as many in
#: each further round, up to the second number.
PIVOTS, MOST_PIVOTS, GROWTH = 8, 4096, 32
#: Documents of open buckets that share a rare shingle, at most.
RARE = 8
_dice = np.random.default_rng(20)
_MUL = (_dice.integers(1, 2**32, REGISTERS, dtype=np.uint64) | np.uint64(1)).astype(np.uint32)
_ADD = _dice.integers(0, 2**32, REGISTERS, dtype=np.uint64).astype(np.uint32)


def shingles(text: str | None, width: int, roll: Rolling) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's shingles; a text of fewer words is one shingle."""
    words = (text or "").encode().lower().split()
    if not words:
        return np.empty(0, np.uint64)
    h = word_hashes(words)
    return np.unique(roll.windows(h, min(width, len(h))))


def registers(items: np.ndarray) -> np.ndarray:
    """Least hash of each function, as the exponent of an exponentially spaced scale (greater: rarer)."""
    x = (items ^ (items >> np.uint64(32))).astype(np.uint32)
    least = np.full(REGISTERS, 2**32 - 1, np.uint32)
    for part in np.array_split(x, max(1, len(x) // 2048)):
        np.minimum(least, (part[None, :] * _MUL[:, None] + _ADD[:, None]).min(axis=1), out=least)
    rate = -np.log1p(-(least.astype(np.float64) + 0.5) / 2**32)
    return np.clip(4000 - np.floor(np.log(rate) / np.log(SPACING)), 0, 65535).astype(np.uint16)


def likely_jaccard(more: np.ndarray, less: np.ndarray, same: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> np.ndarray:
    """The similarity that makes the counts of greater, smaller and equal registers most likely, given set sizes."""
    u = n_a / (n_a + n_b)
    v = 1 - u
    j = np.linspace(0, 1, 201)[None, :] * np.minimum(u / v, v / u)[:, None]
    p = lambda x: -np.log1p(-np.clip(x, 1e-12, 1) * (SPACING - 1) / SPACING) / np.log(SPACING)
    a, b = p(u[:, None] - v[:, None] * j), p(v[:, None] - u[:, None] * j)
    ll = more[:, None] * np.log(a) + less[:, None] * np.log(b) + same[:, None] * np.log(np.clip(1 - a - b, 1e-12, 1))
    return np.take_along_axis(j, ll.argmax(axis=1)[:, None], 1)[:, 0]


_SETS = pa.schema([("_id", pa.int64()), ("_th", pa.int64()), ("n", pa.int32()), ("hi", pa.int64()), ("lo", pa.int64()), ("sig", pa.list_(pa.int64()))])
_SETS_SQL = "_id long, _th long, n int, hi long, lo long, sig array<long>"


def _sign(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        roll = Rolling()
        for batch in batches:
            for part in slices(batch, "text"):
                out: dict[str, list] = {k: [] for k in ("n", "hi", "lo", "sig")}
                for text in part.column("text").to_pylist():
                    s = shingles(text, width, roll)
                    d = np.frombuffer(xxhash.xxh3_128_digest(s.tobytes()), np.int64)
                    out["n"].append(len(s))
                    out["hi"].append(d[0])
                    out["lo"].append(d[1])
                    out["sig"].append(registers(s).view(np.int64) if len(s) else None)
                yield arrow({"_id": part.column("_id"), "_th": part.column("_th")} | out, _SETS)

    return run


def _estimate(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        floor = percent / 100 - SLACK * np.sqrt(percent / 100 * (1 - percent / 100) / REGISTERS)
        for batch in batches:
            if not batch.num_rows:
                continue
            x, y = (batch.column(c).flatten().to_numpy().view(np.uint16).reshape(-1, REGISTERS) for c in ("sig_a", "sig_b"))
            n_a, n_b = (batch.column(c).to_numpy().astype(float) for c in ("n_a", "n_b"))
            est = likely_jaccard((x > y).sum(axis=1), (x < y).sum(axis=1), (x == y).sum(axis=1), n_a, n_b)
            fit = 100 * np.minimum(n_a, n_b) >= percent * np.maximum(n_a, n_b)
            yield batch.select(["a", "b"]).filter(pa.array(fit & (est >= floor)))

    return run


def _verify(width: int, percent: int):
    """Of texts, or of the sorted sets themselves where the columns hold arrays."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        roll, last, mine = Rolling(), None, None
        for batch in batches:
            good = []
            packed = pa.types.is_list(batch.column("set_a").type)
            items = (lambda x: u64(x.values.to_numpy())) if packed else (lambda x: shingles(x.as_py(), width, roll))
            for a, set_a, set_b in zip(batch.column("a").to_pylist(), batch.column("set_a"), batch.column("set_b"), strict=True):
                if (key := (a, None if packed else set_a.as_py())) != last:
                    last, mine = key, items(set_a)
                other = items(set_b)
                both = len(np.intersect1d(mine, other, assume_unique=True))
                good.append(100 * both >= percent * (len(mine) + len(other) - both))
            yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    return run


def _links(pairs: DataFrame, reps: DataFrame, sets: DataFrame, width: int, percent: int, scratch: Scratch, name: str) -> DataFrame:
    """Of pairs (a, b), maybe with n_ and sig_ of both, those that are similar enough. sets: rep and set, its text or its shingles."""
    if "sig_a" not in pairs.columns:
        left, right = (reps.select(F.col("rep").alias(c), F.col("n").alias(f"n_{c}"), F.col("sig").alias(f"sig_{c}")) for c in "ab")
        pairs = pairs.join(right, "b").join(left, "a")
    near = pairs.select("a", "b", "n_a", "n_b", "sig_a", "sig_b").mapInArrow(_estimate(percent), "a long, b long").distinct()
    left, right = (sets.select(F.col("rep").alias(c), F.col("set").alias(f"set_{c}")) for c in "ab")
    sure = near.join(right.hint("merge"), "b").select("a", "b", "set_b").join(left.hint("merge"), "a").select("a", "b", "set_a", "set_b")
    return scratch.write(sure.mapInArrow(_verify(width, percent), "a long, b long").distinct(), f"{name}-links")


def _open(members: DataFrame, comp: DataFrame) -> DataFrame:
    """Members (band, value, rep; a written table, it is read twice) of buckets that hold several components."""
    inside = members.join(comp.withColumnRenamed("id", "rep"), "rep", "left").withColumn("c", F.coalesce("component", "rep")).drop("component")
    several = inside.groupBy("band", "value").agg(F.min("c").alias("low"), F.max("c").alias("high")).filter("low < high").select("band", "value")
    return inside.drop("c").join(several, ["band", "value"])


def _components(links: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    return scratch.write(connected_components(links.select(F.col("a").alias("src"), F.col("b").alias("dst")), scratch, f"c-{name}"), f"comp-{name}")


def _bucketed(open_: DataFrame, facts: DataFrame, links: DataFrame, comp: DataFrame, stale: bool, reps: DataFrame, sets: DataFrame, width: int, percent: int, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """The links, with those inside open buckets, and the components. facts: rep, n, most, core, sig, c0 (its component so
    far); comp: components of all links but, if stale, the latest.

    The members are written once. What changes from round to round is how many members of each first component a bucket
    still has (counts, less the pivots that left), and which of these components have grown together since; so a round
    handles the members outside a bucket's largest component, never rewrites those inside it, and a pivot meets members
    of other first components only."""
    members = scratch.write(open_.join(facts, "rep"), "members")
    parts = scratch.write(members.groupBy("band", "value", "c0").agg(F.count(F.lit(1)).alias("m"), F.count_if("core").alias("cores")), "parts")
    gone, k = None, 0
    while True:
        k += 1
        live = parts
        if gone is not None:
            left = gone.groupBy("band", "value", "c0").agg((-F.count(F.lit(1))).alias("m"), (-F.count_if("core")).alias("cores"))
            live = parts.unionByName(left).groupBy("band", "value", "c0").agg(F.sum("m").alias("m"), F.sum("cores").alias("cores")).filter("m > 0")
        live = live.join(comp.withColumnRenamed("id", "c0"), "c0", "left").withColumn("c", F.coalesce("component", "c0")).drop("component")
        live = scratch.write(live, f"live{k}")
        main = live.groupBy("band", "value", "c").agg(F.sum("m").alias("m"), F.sum("cores").alias("cores")).groupBy("band", "value")
        main = main.agg(F.max(F.struct("m", "c")).alias("s"), F.count(F.lit(1)).alias("parts"), F.sum("cores").alias("cores")).filter("parts > 1 and cores > 0")
        outside = live.join(main.select("band", "value", F.col("s.c").alias("main")), ["band", "value"]).filter("c <> main").select("band", "value", "c0")
        outside = members.join(outside, ["band", "value", "c0"])
        if gone is not None:
            outside = outside.join(gone.select("band", "value", "rep"), ["band", "value", "rep"], "left_anti")
        w = Window.partitionBy("band", "value").orderBy((F.col("most") / F.col("n")).desc(), F.xxhash64("rep"), "rep")  # the most central first
        chosen = outside.withColumn("_n", F.row_number().over(w)).filter(F.col("_n") <= min(MOST_PIVOTS, PIVOTS * GROWTH ** (k - 1))).drop("_n")
        chosen = scratch.write(chosen, f"pivots{k}")
        scratch.drop(f"live{k}")
        if chosen.isEmpty():
            return links, _components(links, scratch, "last") if stale else comp
        pivots = chosen.select("band", "value", *(F.col(c).alias(f"p_{c}") for c in ("rep", "c0", "n", "most", "core", "sig")))
        fit = F.expr(f"c0 <> p_c0 and (core or p_core) and least(most, p_most) * {100 + percent} >= {percent} * (n + p_n)")
        fit &= ~F.exists(F.sequence(F.lit(0), F.lit(BANDS - 1)), lambda x: (x < F.col("i.band")) & (F.get("sig", x) == F.get("p_sig", x)))  # once, in the first band that they share
        near = members.alias("i").join(pivots.alias("j"), (F.col("i.band") == F.col("j.band")) & (F.col("i.value") == F.col("j.value")) & fit)
        turned = F.col("rep") > F.col("p_rep")
        pairs = near.select(*(F.when(turned != (s == "b"), F.col(f"p_{c}")).otherwise(F.col(c)).alias(f"{o}_{s}" if o else s) for s in "ab" for c, o in (("rep", ""), ("n", "n"), ("sig", "sig"))))
        more = _links(pairs, reps, sets, width, percent, scratch, f"more{k}")
        gone = chosen.drop("sig") if gone is None else gone.unionByName(chosen.drop("sig"))
        if stale or not more.isEmpty():
            links, stale = links.unionByName(more), False
            comp = _components(links, scratch, str(k))


def _each(width: int):
    made = pa.schema([("rep", pa.int64()), ("items", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        roll = Rolling()
        for batch in batches:
            for part in slices(batch, "text"):
                yield arrow({"rep": part.column("rep"), "items": [i64(shingles(t, width, roll)) for t in part.column("text").to_pylist()]}, made)

    return run


def _bounds(base: DataFrame, reps: DataFrame, some: DataFrame, comp: DataFrame, width: int, percent: int, scratch: Scratch) -> tuple[DataFrame, DataFrame, DataFrame]:
    """For the documents of some (rep), whose shingles are counted: rare ones are in at most RARE of them.

    bounds: rep, n, most (its shingles that are not rare), core. Two documents that share no rare shingle have at most
    the smaller most in common; they can be linked only if min(most) * (100 + percent) >= percent * (n + n'), so at
    least one of them, a core, has most * (100 + percent) >= percent * 2n. Hopeless documents are left out.
    pairs: a, b, the documents of different components (comp) that share rare shingles and can be linked by what they
    may have in common.
    sets: rep and set, the shingles."""
    known = comp.select(F.col("id").alias("rep"), "component")
    texts = base.hint("merge").join(some.withColumnRenamed("rep", "_id"), "_id").select(F.col("_id").alias("rep"), "text")
    packed = scratch.write(texts.mapInArrow(_each(width), "rep long, items array<long>"), "items")
    each = packed.select("rep", F.explode("items").alias("item"))
    counts = each.groupBy("item").agg(F.count(F.lit(1)).alias("df"), F.min("rep").alias("first")).filter(F.col("df") <= RARE)
    own = counts.filter("df = 1").groupBy(F.col("first").alias("rep")).agg(F.count(F.lit(1)).alias("rare"))
    shared = each.join(counts.filter("df > 1").select("item"), "item").join(known, "rep", "left").withColumn("c", F.coalesce("component", "rep"))
    shared = shared.groupBy("item").agg(F.sort_array(F.collect_set(F.struct("rep", "c"))).alias("reps"))  # at most RARE
    shared = scratch.write(shared.select("reps"), "shared")
    rare = own.unionByName(shared.select(F.explode("reps").alias("r")).groupBy(F.col("r.rep").alias("rep")).agg(F.count(F.lit(1)).alias("rare"))).groupBy("rep").agg(F.sum("rare").alias("rare"))
    sized = reps.select("rep", "n").join(some, "rep", "left_semi").groupBy("rep").agg(F.max("n").alias("n"))
    every = scratch.write(sized.join(rare, "rep", "left").select("rep", "n", (F.col("n") - F.coalesce("rare", F.lit(0))).alias("most")), "every")
    apart = shared.select(F.explode(F.expr("flatten(transform(reps, (x, i) -> transform(filter(slice(reps, i + 2, size(reps)), y -> y.c <> x.c), y -> struct(x.rep as a, y.rep as b))))")).alias("p"))
    pairs = apart.groupBy("p.a", "p.b").agg(F.count(F.lit(1)).alias("common"))
    for c in "ab":
        pairs = pairs.join(every.select(F.col("rep").alias(c), F.col("n").alias(f"n_{c}"), F.col("most").alias(f"m_{c}")), c)
    pairs = pairs.filter(f"(least(m_a, m_b) + common) * {100 + percent} >= {percent} * (n_a + n_b)").select("a", "b")
    bounds = every.filter(f"100 * most >= {percent} * n").withColumn("core", F.expr(f"most * {100 + percent} >= {2 * percent} * n"))
    return bounds, pairs, packed.withColumnRenamed("items", "set")


def near_components(docs: DataFrame, width: int = 5, percent: int = 80) -> tuple[DataFrame, DataFrame]:
    """(rows, links): _id, _th, n, component for each row of docs, and the verified links a, b between class
    representatives that connect the components."""
    scratch = Scratch(docs.sparkSession, "near")
    base = keyed(docs).select("_id", "_th", "text")
    signed = scratch.write(base.mapInArrow(_sign(width), _SETS_SQL), "signed")
    classes = signed.filter("n > 0").groupBy("hi", "lo").agg(F.min("_id").alias("rep"))
    member = scratch.write(signed.filter("n > 0").join(classes, ["hi", "lo"]).select("_id", "_th", "rep", "n", F.when(F.col("_id") == F.col("rep"), F.col("sig")).alias("sig")), "member")
    reps = member.filter("sig is not null").select("rep", "_th", "n", "sig")

    each = reps.select("rep", F.posexplode("sig").alias("band", "value"))
    led = each.groupBy("band", "value").agg(F.min("rep").alias("lead"), F.count(F.lit(1)).alias("size")).filter("size > 1")
    met = scratch.write(each.join(led, ["band", "value"]).filter("rep <> lead"), "met")
    links = _links(met.select(F.col("lead").alias("a"), F.col("rep").alias("b")).distinct(), reps, base.select(F.col("_id").alias("rep"), F.col("text").alias("set")), width, percent, scratch, "lead")

    # buckets of three and more, without the member that all others have met
    comp = _components(links, scratch, "lead")
    open_ = scratch.write(_open(met.filter("size > 2").select("band", "value", "rep"), comp), "open")
    bounds, pairs, sets = _bounds(base, reps, open_.select("rep").distinct(), comp, width, percent, scratch)
    more = _links(pairs, reps, sets, width, percent, scratch, "rare")
    stale = not more.isEmpty()
    links = links.unionByName(more) if stale else links
    facts = bounds.join(reps.select("rep", "sig").dropDuplicates(["rep"]), "rep").join(comp.withColumnRenamed("id", "rep"), "rep", "left")
    facts = facts.withColumn("c0", F.coalesce("component", "rep")).drop("component")
    links, comp = _bucketed(open_, facts, links, comp, stale, reps, sets, width, percent, scratch)
    rows = member.select("_id", "_th", "n", "rep").distinct().join(comp.withColumnRenamed("id", "rep"), "rep", "left").select("_id", "_th", "n", F.coalesce("component", "rep").alias("component"))
    alone = signed.filter("n = 0").select("_id", "_th", "n", F.col("_id").alias("component")).distinct()
    return rows.unionByName(alone), links.distinct()


def near_dedup(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """A row for each of docs (doc_id, text): doc_id, n_shingles, component_id (the smallest doc_id reachable), kept
    (it is its component's smallest)."""
    rows, _ = near_components(docs, width, percent)
    ids = keyed(docs).select("doc_id", "_id", "_th").join(rows, ["_id", "_th"])
    component = F.when(F.col("doc_id").isNotNull(), F.least("component", F.lit(LAST_ID)))
    return ids.select("doc_id", F.col("n").cast("long").alias("n_shingles"), component.alias("component_id"), F.coalesce(F.col("doc_id") == F.col("component"), F.lit(True)).alias("kept"))


def drop_near(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """docs with one document of each component, the smallest doc_id."""
    rows, _ = near_components(docs, width, percent)
    gone = rows.filter("component <> _id").select("_id", "_th")
    base, back = apart(docs, "doc_id", "text")
    return keyed(base, *(c for c in base.columns if c not in ("doc_id", "text"))).join(gone, ["_id", "_th"], "left_anti").select(*back)


__all__ = ["drop_near", "i64", "near_components", "near_dedup"]
