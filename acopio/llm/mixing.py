"""Mixing sources to target weights by Pfair scheduling.

Each source is cut into blocks of about ``block_bytes``. Block i of a source of weight w is released at slot floor(i/w)
and due at slot ceil((i+1)/w); the earliest deadline goes first, so at any slot of a phase each source is less than one
block away from its share, however long the phase lasts: weights are taken as exact ratios of integers, nothing is
rounded. When a source runs out, a new phase begins with the weights of the others, so that no document is dropped or
repeated.

Bounds: up to MOST_SOURCES sources are scheduled on the driver. Of more, those with a given weight and the KEPT largest
stay as they are; the others are dealt by hash into BUCKETS, each scheduled like a source with its members' blocks and
the sum of their weights, and a second Pfair pass, in a task of its own, gives the bucket's turns to its members. The
schedule has one number for each block, made on the driver and broadcast in runs of FRAME blocks. A block has
``block_bytes`` or, where that would make more than MOST_BLOCKS of the corpus, its bytes over MOST_BLOCKS; as each source
ends with a block that is not full, there are at most MOST_BLOCKS and one for each source, 8 bytes each.

Defined results: null sources are one source; a source without a given weight gets the default one, its bytes to the
power of ``temper``; a document goes with the block in which it starts.
"""

from __future__ import annotations

import heapq
import math
from fractions import Fraction

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, apart, keyed, numbered, running

FRAME, MOST_SOURCES, KEPT, BUCKETS = 4096, 1024, 512, 512
MOST_BLOCKS = 1 << 21
_NULL = "\x00"


def quotas(weights: list[float], frame: int = FRAME) -> list[int]:
    """Whole shares of a frame, by largest remainder, at least 1 each."""
    total = sum(weights)
    exact = [max(1.0, w / total * frame) for w in weights]
    scale = frame / sum(exact)
    out = [max(1, int(x * scale)) for x in exact]
    order = sorted(range(len(out)), key=lambda k: (out[k] - exact[k] * scale, k))
    for k in range(frame - sum(out)):
        out[order[k % len(out)]] += 1
    for _ in range(sum(out) - frame):
        out[max(range(len(out)), key=lambda k: (out[k], -k))] -= 1
    return out


def ratios(weights: list[float]) -> list[int]:
    """Integers in exactly the ratios of weights."""
    exact = [Fraction(w) for w in weights]
    scale = math.lcm(*(x.denominator for x in exact))
    out = [int(x * scale) for x in exact]
    return [x // math.gcd(*out) for x in out]


def earliest_deadline_first(share: list[int], blocks: list[int] | None = None) -> list[int]:
    """The source of each slot, for weights in the ratios of share, until the next slot is due to one with none of its
    blocks left; without blocks, one period of sum(share) slots."""
    period, blocks = sum(share), blocks or share
    done, out = [0] * len(share), []
    ready, later = [(-(-period // n), s) for s, n in enumerate(share)], []
    heapq.heapify(ready)
    while True:
        while later and later[0][0] <= len(out):
            s = heapq.heappop(later)[1]
            heapq.heappush(ready, (-(-(done[s] + 1) * period // share[s]), s))
        s = heapq.heappop(ready)[1]
        if done[s] == blocks[s]:
            return out
        out.append(s)
        done[s] += 1
        heapq.heappush(later, (done[s] * period // share[s], s))


def phases(blocks: list[int], weights: list[float]) -> list[tuple[int, int, int, int, int, list[int]]]:
    """(source, first block, block after the last, their number, first slot of the phase, slot in the phase of each)."""
    share, done, slot, out = ratios(weights) if weights else [], [0] * len(blocks), 0, []
    while active := [s for s in range(len(blocks)) if done[s] < blocks[s]]:
        order = earliest_deadline_first([share[s] for s in active], [blocks[s] - done[s] for s in active])
        where: list[list[int]] = [[] for _ in active]
        for t, k in enumerate(order):
            where[k].append(t)
        for k, s in enumerate(active):
            if where[k]:
                out.append((s, done[s], done[s] + len(where[k]), len(where[k]), slot, where[k]))
            done[s] += len(where[k])
        slot += len(order)
    return out


def runs(blocks: list[int], weights: list[float]) -> list[tuple[int, int, list[int]]]:
    """(source, run, slots): the slots of every FRAME consecutive blocks of a source."""
    slots: list[list[int]] = [[] for _ in blocks]
    for s, *_, first, where in phases(blocks, weights):
        slots[s] += [first + t for t in where]
    return [(s, a // FRAME, v[a : a + FRAME]) for s, v in enumerate(slots) for a in range(0, len(v), FRAME)]


_INSIDE = pa.schema([("_s", pa.string()), ("_e", pa.int64()), ("_run", pa.int64()), ("turns", pa.list_(pa.int64()))])


def _inside(key: tuple, rows: pa.Table) -> pa.Table:
    rows = rows.sort_by("_s").to_pydict()
    plan = runs(rows["blocks"], rows["weight"])
    return pa.table([pa.array(v, f.type) for v, f in zip(([rows["_s"][s] for s, *_ in plan], [key[0].as_py()] * len(plan), [r for _, r, _ in plan], [t for *_, t in plan]), _INSIDE, strict=True)], schema=_INSIDE)


def mixed(docs: DataFrame, weights: dict[str, float] | None = None, block_bytes: int = 1 << 16, temper: float = 0.5) -> DataFrame:
    """A row for each of docs (doc_id, text, source): _id, _th, doc_id, source, size, block, slot, at. Order by slot, at
    and doc_id for the mixture; at is the bytes of its source's block before the document."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "mix")
    base = keyed(docs, "source").select("doc_id", "_id", "_th", "source", (F.octet_length(F.coalesce("text", F.lit(""))) + 1).cast("long").alias("size"), F.coalesce("source", F.lit(_NULL)).alias("_s"))
    base = scratch.write(numbered(base), "base")
    sums = scratch.write(base.groupBy("_s").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("rows")), "sources")
    n, total, rows = sums.agg(F.count(F.lit(1)), F.coalesce(F.sum("bytes"), F.lit(1)), F.coalesce(F.sum("rows"), F.lit(0))).first()
    given, block_bytes = weights or {}, max(block_bytes, -(-total // MOST_BLOCKS))
    blocks, weight = F.ceil(F.col("bytes") / block_bytes).alias("blocks"), F.greatest(F.lit(1e-9), F.pow(F.col("bytes") / total, F.lit(temper))).alias("weight")
    own = sums.select("_s", blocks, weight)
    if n > MOST_SOURCES:
        kept = {r["_s"] for r in sums.orderBy(F.desc("bytes"), "_s").limit(KEPT).select("_s").collect()} | set(given)
        kept = F.broadcast(spark.createDataFrame([(s,) for s in sorted(kept)], "_s string"))
        others = own.join(kept, "_s", "left_anti").withColumn("_e", -1 - F.pmod(F.xxhash64("_s"), F.lit(BUCKETS)))
        own = own.join(kept, "_s")
    named = sorted(tuple(r) for r in own.collect())  # at most MOST_SOURCES rows, or KEPT and those given
    entities = [(k, b, max(1e-9, given.get(s, w))) for k, (s, b, w) in enumerate(named)]
    if n > MOST_SOURCES:
        entities += sorted(tuple(r) for r in others.groupBy("_e").agg(F.sum("blocks"), F.sum("weight")).collect())  # at most BUCKETS rows
    table = spark.createDataFrame([(entities[k][0], run, slots) for k, run, slots in runs([b for _, b, _ in entities], [w for *_, w in entities])], "_e long, _turns long, slots array<long>")
    dealt = running(base, ["_s"], [F.col("_id"), F.col("_th"), F.col("_u")], F.col("size"), "_before", rows)
    dealt = dealt.withColumn("block", F.floor(F.col("_before") / block_bytes)).withColumn("at", F.col("_before") % block_bytes)
    names = spark.createDataFrame([(s, k) for k, (s, *_) in enumerate(named)], "_s string, _e long")
    turns = dealt.join(F.broadcast(names), "_s").withColumn("turn", F.col("block"))
    if n > MOST_SOURCES:
        inside = scratch.write(others.groupBy("_e").applyInArrow(_inside, "_s string, _e long, _run long, turns array<long>"), "inside")
        folded = dealt.withColumn("_run", F.floor(F.col("block") / FRAME)).join(inside, ["_s", "_run"])
        turns = turns.unionByName(folded.withColumn("turn", F.element_at("turns", (F.col("block") % FRAME).cast("int") + 1)).drop("_run", "turns"))
    turns = turns.withColumn("_turns", F.floor(F.col("turn") / FRAME)).join(F.broadcast(table), ["_e", "_turns"])
    slot = F.element_at("slots", (F.col("turn") % FRAME).cast("int") + 1)
    return turns.select("_id", "_th", "doc_id", "source", "size", "block", slot.alias("slot"), "at")


def mix(docs: DataFrame, weights: dict[str, float] | None = None, block_bytes: int = 1 << 16, temper: float = 0.5, place: tuple[str, str] | None = None) -> DataFrame:
    """docs in the order of the mixture, range-partitioned and sorted by slot; with place, slot and at are added under its
    names, in place of columns so called: tables that are written and read again have no order of their own."""
    plan = mixed(docs, weights, block_bytes, temper).select("_id", "_th", F.col("slot").alias("_slot"), F.col("at").alias("_at")).dropDuplicates(["_id", "_th"])
    base, back = apart(docs.drop(*(place or ())), "doc_id", "text")
    joined = keyed(base, *(c for c in base.columns if c not in ("doc_id", "text"))).join(plan, ["_id", "_th"])
    added = [F.col(c).alias(name) for c, name in zip(("_slot", "_at"), place or (), strict=bool(place))]
    return joined.repartitionByRange("_slot", "_at", "_id").sortWithinPartitions("_slot", "_at", "_id").select(*back, *added)
