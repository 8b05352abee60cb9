"""Exact Jaccard self-join of word n-gram sets by partitioning the universe of n-grams, as connected components.

1. equal sets become one class, of which the smallest doc_id stands for all: copies are never paired;
2. sizes fall into bands, each as wide as the threshold lets a partner's size differ, so a set's larger partners lie in
   its own band or the next one. Every band has one segment more than two of its sets may differ in n-grams (H). n-grams
   are hashed into the segments; a key is the hash of the subset of a set that falls into a segment. Every 32nd segment
   also has the keys of its one-deletion neighbourhood;
3. pigeonhole: a set seeks its partners in a band by segments of level 0 (equal subsets) or 1 (subsets that differ in one
   n-gram at most). If levels plus one add up to H + 1, a partner is met. Which segments get which level is chosen by
   cost: how many other sets a subset of that size meets on average in that band, counted over all sets, and the rows it
   takes. Small subsets, which many sets share, are left out for the sake of deletions elsewhere;
4. sets that share a key meet in a bucket, where all are paired with one of them and verified on their whole sets. Buckets
   whose members are not in one component yet go on in rounds: some members outside the largest component meet all members
   of other components and leave, until what is left is connected. So two sets of a bucket have met or are connected
   without: no link is lost. Sets that have too few n-grams in common with any other (bounds from counts of n-grams) stay
   out of these rounds, after those that share rare n-grams were paired.

n-grams are compared by 64-bit hashes. Defined results: a null or empty text has no n-gram and is linked with nothing;
rows that share a doc_id are one node; rows with a null doc_id have a null component.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.components import connected_components
from .common import LAST_ID, Rolling, Scratch, arrow, i64, keyed, mix, slices
from .near_dedup import _bounds, _verify, shingles

#: Every so many segments have a one-deletion neighbourhood.
CUT_EVERY = 32
#: Subsets of this size and more are as rare as can be.
LARGE = 63
#: Members outside a bucket's largest component that meet the others in the first round; GROWTH times as many in each
#: further round, up to the second number. Members of a bucket that one task pairs with them.
PIVOTS, MOST_PIVOTS, GROWTH, CELL = 8, 4096, 32, 8192
_SALT = np.uint64(0xA0761D6478BD642F)


class Bands:
    """Size bands for a threshold in percent, and their segments."""

    def __init__(self, percent: int):
        if not 50 <= percent < 100:
            raise ValueError("a threshold from 50 to 99 percent")
        self.percent, low, highs = percent, 1, []
        while low < 1 << 40:
            highs.append(low * 100 // percent)
            low = highs[-1] + 1
        self.highs = np.array(highs)
        self.segments = [self.differ(2 * h) + 1 for h in highs]
        self._places: dict[int, np.ndarray] = {}

    def of(self, n: int) -> int:
        return int(np.searchsorted(self.highs, n))

    def differ(self, both: int) -> int:
        """In how many n-grams two linked sets of so many together may differ."""
        return both * (100 - self.percent) // (100 + self.percent)

    def reach(self, n: int, band: int) -> int:
        """The size of the largest partner in a band of a set of n."""
        return min(int(self.highs[band]), n * 100 // self.percent)


    def places(self, band: int) -> np.ndarray:
        """A number for each segment of a band, which goes into its keys."""
        if band not in self._places:
            self._places[band] = mix((np.uint64(band) << np.uint64(40)) + np.arange(self.segments[band], dtype=np.uint64))
        return self._places[band]


class Parts:
    """The subsets of a sorted set that fall into a band's segments."""

    def __init__(self, items: np.ndarray, band: int, bands: Bands):
        m, self.place = bands.segments[band], bands.places(band)
        self.owner = (((items >> np.uint64(32)) * np.uint64(m)) >> np.uint64(32)).astype(np.int64)  # rises with the items
        self.sizes = np.bincount(self.owner, minlength=m)
        bounds = np.concatenate([[0], np.cumsum(self.sizes)])
        self.weights = mix(items ^ _SALT)
        sums = np.zeros(len(items) + 1, np.uint64)
        np.cumsum(self.weights, out=sums[1:])
        self.sums = sums[bounds[1:]] - sums[bounds[:-1]]

    def keys(self) -> np.ndarray:
        return mix(self.sums + self.place)

    def cuts(self, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(segment, key) of every subset of the segments which (a mask) without one of its members."""
        at = np.flatnonzero(which[self.owner])
        own = self.owner[at]
        return own, mix(self.sums[own] - self.weights[at] + self.place[own])


def levels(sizes: np.ndarray, need: int, others: np.ndarray) -> np.ndarray:
    """The level of each segment (-1: left out) so that levels plus one add up to need at the least cost. others: of each
    size, how many sets a subset meets on average."""
    j = np.minimum(sizes, LARGE)
    once = 1 + others[j]
    cut = j[::CUT_EVERY]
    twice = np.maximum(cut + others[cut + 1] + cut * others[np.maximum(cut - 1, 0)], once[::CUT_EVERY])
    best = np.argsort(np.concatenate([once, twice]), kind="stable")[:need]  # level 1 is never before the segment's level 0
    out = np.full(len(sizes), -1)
    out[best[best < len(sizes)]] = 0
    out[(best[best >= len(sizes)] - len(sizes)) * CUT_EVERY] = 1
    return out


def emitted(items: np.ndarray, bands: Bands, others: dict[int, np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(key, cut, active) rows of a set. In its own band it is found by all segments' keys and the neighbourhoods' (cut);
    active ones are those by which it seeks. In the next band it only seeks."""
    n, out = len(items), []
    own = bands.of(n)
    for band in (own, own + 1):
        m, reach = bands.segments[band], bands.reach(n, band)
        need = bands.differ(n + reach) + 1
        if m == 1 or (band != own and (reach <= bands.highs[own] or need == 1)):
            continue  # only equal sets, or none, can be linked here
        parts = Parts(items, band, bands)
        level = levels(parts.sizes, need, others.get(band, np.zeros(LARGE + 2))) if need > 1 else np.full(m, -1)
        shown, cuttable = level >= 0, level == 1
        if band == own:
            shown, cuttable = np.ones(m, bool), np.arange(m) % CUT_EVERY == 0
        who, cut = parts.cuts(cuttable)
        out.append((parts.keys()[shown], np.zeros(int(shown.sum()), bool), (level >= 0)[shown]))
        out.append((cut, np.ones(len(cut), bool), (level == 1)[who]))
    if not out:
        return np.empty(0, np.uint64), np.empty(0, bool), np.empty(0, bool)
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


_SIGNED = pa.schema([("_id", pa.int64()), ("_th", pa.int64()), ("n", pa.int64()), ("hi", pa.int64()), ("lo", pa.int64()), ("band", pa.int32()), ("keys", pa.list_(pa.int64())), ("sizes", pa.list_(pa.int16()))])
_SIGNED_SQL = "_id long, _th long, n long, hi long, lo long, band int, keys array<long>, sizes array<short>"


def _sign(width: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        roll, bands = Rolling(), Bands(percent)
        for batch in batches:
            for part in slices(batch, "text"):
                out: dict[str, list] = {k: [] for k in ("n", "hi", "lo", "band", "keys", "sizes")}
                for text in part.column("text").to_pylist():
                    s = shingles(text, width, roll)
                    d = np.frombuffer(xxhash.xxh3_128_digest(s.tobytes()), np.int64)
                    band = bands.of(len(s))
                    some = len(s) and bands.segments[band] > 1
                    p = Parts(s, band, bands) if some else None
                    row = (len(s), d[0], d[1], band, i64(p.keys()) if some else None, np.minimum(p.sizes, LARGE).astype(np.int16) if some else None)
                    for k, v in zip(out, row, strict=True):
                        out[k].append(v)
                yield arrow({"_id": part.column("_id"), "_th": part.column("_th")} | out, _SIGNED)

    return run


def _emit(width: int, percent: int, others: dict[int, np.ndarray]):
    made = pa.schema([("key", pa.int64()), ("rep", pa.int64()), ("cut", pa.bool_()), ("active", pa.bool_())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        roll, bands = Rolling(), Bands(percent)
        for batch in batches:
            for part in slices(batch, "text", 1 << 20):
                rows = [emitted(shingles(t, width, roll), bands, others) for t in part.column("text").to_pylist()]
                key, cut, active = (np.concatenate(x) for x in zip(*rows, strict=True))
                reps = np.repeat(part.column("rep").to_numpy(), [len(r[0]) for r in rows])
                yield arrow({"key": i64(key), "rep": reps, "cut": cut, "active": active}, made)

    return run


def meeting_costs(reps: DataFrame) -> dict[int, np.ndarray]:
    """For each band, how many other sets a subset of each size meets on average: one row for each of some hundred bands
    and 64 sizes is gathered. reps: band, keys, sizes."""
    each = reps.select("band", F.explode(F.arrays_zip("keys", "sizes")).alias("x")).groupBy("band", F.col("x.keys").alias("key"), F.col("x.sizes").alias("size")).agg(F.count(F.lit(1)).alias("n"))
    means = each.groupBy("band", "size").agg(F.sum("n").alias("n"), F.sum(F.col("n").cast("double") * (F.col("n") - 1)).alias("met"))
    out: dict[int, np.ndarray] = {}
    for r in means.collect():
        out.setdefault(r.band, np.zeros(LARGE + 2))[r["size"]] = r.met / r.n
    return out


def _verified(pairs: DataFrame, sets: DataFrame, width: int, percent: int, scratch: Scratch, name: str) -> DataFrame:
    """Of pairs (a, b, each once) those that are similar enough. sets: rep and set, its text or its n-grams."""
    left, right = (sets.select(F.col("rep").alias(c), F.col("set").alias(f"set_{c}")) for c in "ab")
    both = pairs.join(right.hint("merge"), "b").select("a", "b", "set_b").join(left.hint("merge"), "a").select("a", "b", "set_a", "set_b")
    return scratch.write(both.mapInArrow(_verify(width, percent), "a long, b long").distinct(), f"{name}-links")


def _ordered(a: str, b: str) -> list:
    return [F.least(a, b).alias("a"), F.greatest(a, b).alias("b")]


def _components(links: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    return scratch.write(connected_components(links.select(F.col("a").alias("src"), F.col("b").alias("dst")), scratch, f"c-{name}"), f"comp-{name}")


def _placed(members: DataFrame, comp: DataFrame) -> DataFrame:
    """members (rep and more) with c, the component so far."""
    return members.join(comp.withColumnRenamed("id", "rep"), "rep", "left").withColumn("c", F.coalesce("component", "rep")).drop("component")


def _open(members: DataFrame) -> DataFrame:
    """key, main (the component with the most members), m: buckets of members (key, rep, cut, active, c) that hold several
    components and rows that may be paired."""
    parts = members.groupBy("key", "c").agg(F.count(F.lit(1)).alias("m"), F.max("active").alias("active"), F.max(~F.col("cut")).alias("whole"))
    buckets = parts.groupBy("key").agg(F.max(F.struct("m", "c")).alias("s"), F.sum("m").alias("m"), F.count(F.lit(1)).alias("parts"), F.max("active").alias("active"), F.max("whole").alias("whole"))
    return buckets.filter("parts > 1 and active and whole").select("key", F.col("s.c").alias("main"), "m")


def _rounds(members: DataFrame, facts: DataFrame, links: DataFrame, comp: DataFrame, sets: DataFrame, width: int, percent: int, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """The links, with those inside open buckets, and the components. members: key, rep, cut, active; facts: rep, n, most
    and core of those that can be linked by what they have in common beside rare n-grams."""
    now, k = scratch.write(_placed(members.join(facts, "rep"), comp), "round-0"), 0
    while True:
        k += 1
        held = now.join(_open(now), "key")
        w = Window.partitionBy("key").orderBy((F.col("most") / F.col("n")).desc(), F.xxhash64("rep"), "rep")
        most = min(MOST_PIVOTS, PIVOTS * GROWTH ** (k - 1))
        chosen = held.filter("c <> main").withColumn("_n", F.row_number().over(w)).filter(F.col("_n") <= most).drop("_n")
        chosen = scratch.write(chosen, f"pivots-{k}")
        if chosen.isEmpty():
            return links, comp
        # a bucket's members are dealt to cells, and its pivots to each of them
        cell = F.ceil(F.col("m") / CELL).cast("int")
        pivots = chosen.select("key", F.explode(F.sequence(F.lit(0), cell - 1)).alias("cell"), *(F.col(c).alias(f"p_{c}") for c in ("rep", "n", "most", "core", "cut", "active", "c")))
        others = held.withColumn("cell", F.pmod(F.xxhash64("rep"), cell).cast("int"))
        fit = F.expr(f"c <> p_c and not (cut and p_cut) and (active or p_active) and (core or p_core) and least(most, p_most) * {100 + percent} >= {percent} * (n + p_n) and 100 * least(n, p_n) >= {percent} * greatest(n, p_n)")
        pairs = others.join(pivots, ["key", "cell"]).filter(fit).select(*_ordered("rep", "p_rep")).distinct()
        more = _verified(pairs, sets, width, percent, scratch, f"round-{k}")
        if not more.isEmpty():
            links = links.unionByName(more)
            comp = _components(links, scratch, f"round-{k}")
        left = held.join(chosen.select("key", "rep"), ["key", "rep"], "left_anti").drop("main", "m", "c")
        now = scratch.write(_placed(left, comp), f"round-{k}")
        scratch.drop(f"round-{k - 1}")


def set_components(docs: DataFrame, width: int = 4, percent: int = 85) -> tuple[DataFrame, DataFrame]:
    """(rows, links): _id, _th, n, component for each row of docs, and the verified links a, b between class
    representatives that connect the components."""
    scratch = Scratch(docs.sparkSession, "sets")
    base = keyed(docs).select("_id", "_th", "text")
    signed = scratch.write(base.mapInArrow(_sign(width, percent), _SIGNED_SQL), "signed")
    some = signed.filter("n > 0")
    classes = some.groupBy("hi", "lo").agg(F.min("_id").alias("rep"))
    classed = some.join(classes, ["hi", "lo"])
    member = scratch.write(classed.select("_id", "_th", "n", "rep").distinct(), "member")
    alone = scratch.write(signed.filter("n = 0").select("_id", "_th", "n", F.col("_id").alias("component")).distinct(), "alone")
    others = meeting_costs(classed.filter("_id = rep and keys is not null").select("band", "keys", "sizes"))
    scratch.drop("signed")
    reps = member.filter("_id = rep").select("rep", "_th", "n")

    texts = base.hint("merge").join(reps.select(F.col("rep").alias("_id"), "_th"), ["_id", "_th"], "left_semi").select(F.col("_id").alias("rep"), "text")
    each = scratch.write(texts.mapInArrow(_emit(width, percent, others), "key long, rep long, cut boolean, active boolean"), "each")
    # most keys belong to one set: they are counted in narrow rows first; what is left is met without sorting the others
    live = each.groupBy("key").agg(F.count(F.lit(1)).alias("size"), F.max("active").alias("sought"), F.min("cut").alias("cuts"))
    live = scratch.write(live.filter("size > 1 and sought and not cuts").select("key", "size"), "live")
    inside = scratch.write(each.join(live.hint("shuffle_hash"), "key"), "inside")
    scratch.drop("each")
    lead = inside.groupBy("key").agg(F.min(F.struct("cut", ~F.col("active"), "rep")).alias("lead")).select("key", F.col("lead.rep").alias("lead"))
    met = inside.join(lead, "key").filter("rep <> lead")
    sets = base.select(F.col("_id").alias("rep"), F.col("text").alias("set"))
    first = met.select(*_ordered("rep", "lead")).distinct()
    links = _verified(first, sets, width, percent, scratch, "lead")
    comp = _components(links, scratch, "lead")

    # the lead has met all others of its bucket: the rest of larger buckets goes on
    rest = scratch.write(_placed(met.filter("size > 2").select("key", "rep", "cut", "active"), comp), "rest")
    open_ = scratch.write(rest.join(_open(rest).select("key"), "key").select("key", "rep", "cut", "active"), "open")
    scratch.drop("inside")
    facts, pairs, packed = _bounds(base, reps, open_.select("rep").distinct(), comp, width, percent, scratch)
    more = _verified(pairs, packed, width, percent, scratch, "rare")
    if not more.isEmpty():
        links = links.unionByName(more)
        comp = _components(links, scratch, "rare")
    links, comp = _rounds(open_, facts, links, comp, packed, width, percent, scratch)
    rows = member.join(comp.withColumnRenamed("id", "rep"), "rep", "left").select("_id", "_th", "n", F.coalesce("component", "rep").alias("component"))
    return rows.unionByName(alone), links


def set_join(docs: DataFrame, width: int = 4, percent: int = 85) -> DataFrame:
    """A row for each of docs (doc_id, text): doc_id, n_shingles, component_id (the smallest doc_id reachable)."""
    rows, _ = set_components(docs, width, percent)
    ids = keyed(docs).select("doc_id", "_id", "_th").join(rows, ["_id", "_th"])
    return ids.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("doc_id").isNotNull(), F.least("component", F.lit(LAST_ID))).alias("component_id"))
