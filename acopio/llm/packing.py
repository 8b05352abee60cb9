"""Best-fit packing of documents into sequences of several permitted lengths.

Pieces are packed longest first. A piece goes into the open bin that it leaves fullest; if none holds it, a bin is opened
in the size of least cost for each token that the piece and the longest waiting ones that fit would fill it with, where
a bin costs its padding-bearing length, a fixed part and attention's quadratic part. At the end each bin shrinks to the
smallest permitted length that holds its contents. A group is also packed with each single length that holds all its
pieces, and the cheapest packing stays, so the permitted lengths together never cost more than the best of them alone.
Documents longer than the longest sequence are cut into pieces, none is dropped. Pieces are dealt into groups of
about GROUP, each packed by one task; a group wastes at most a few part-filled bins. Groups are made by hash or, where
documents have a place in a mixture, of consecutive slots: then groups are numbered along the mixture, and a group's bins
by their first piece in it.

Lengths are words plus one end mark, or the tokens of a tokenizer given by path. Defined results: a null or empty text
has the end mark alone; rows alike in every way are packed as rows of their own.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch, arrow, keyed, numbered, slices

GROUP = 40_000
CAPACITIES = (512, 1024, 2048, 4096, 8192)
#: A bin's fixed cost in tokens, and the length at which attention costs as much as all the rest.
FIXED, QUADRATIC = 16.0, 65536.0


def cost(capacity: int) -> float:
    return FIXED + capacity * (1 + capacity / QUADRATIC)


class _Waiting:
    """How many pieces of each length wait, and the longest waiting one of at most some length."""

    def __init__(self, lengths: np.ndarray):
        self.count = np.bincount(lengths, minlength=2).tolist()
        self.below = list(range(len(self.count)))

    def longest(self, most: int) -> int:
        k = most = min(most, len(self.count) - 1)
        while k and not self.count[k]:
            self.below[k] = min(self.below[k], k - 1)
            k = self.below[k]
        while most > k:  # next time in one step
            self.below[most], most = k, self.below[most]
        return k

    def filled(self, first: int, capacity: int) -> int:
        """What a bin would hold if, after a first piece, the longest waiting ones that fit went into it."""
        room, x = capacity - first, capacity
        while room and (x := self.longest(min(room, x))):
            n = min(self.count[x], room // x)
            room -= n * x
            x -= 1
        return capacity - room


def packed_into(lengths: np.ndarray, capacities: tuple[int, ...]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The bin of each piece, its place in the bin, and each bin's contents; bins are opened in these sizes only."""
    order = np.argsort(-lengths, kind="stable")
    waiting, sizes = _Waiting(lengths), sorted(capacities)
    bins, places = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    room: list[int] = []  # distinct free lengths, sorted
    free: dict[int, list[int]] = {}
    used: list[int] = []
    for k, n in zip(order.tolist(), lengths[order].tolist(), strict=True):
        waiting.count[n] -= 1
        i = bisect_left(room, n)
        if i < len(room):
            left = room[i]
            b = free[left].pop()
            if not free[left]:
                del free[left], room[i]
        else:
            fit = sizes[bisect_left(sizes, n) :]
            if len(fit) > 1:
                holds = [waiting.filled(n, c) for c in fit]
                left = min(zip(fit, holds, strict=True), key=lambda x: (cost(sizes[bisect_left(sizes, x[1])]) / x[1], x[0]))[0]
            else:
                left = fit[0]
            b = len(used)
            used.append(0)
        bins[k], places[k] = b, used[b]
        used[b] += n
        if left - n:
            if left - n not in free:
                insort(room, left - n)
                free[left - n] = []
            free[left - n].append(b)
    return bins, places, np.array(used, np.int64)


def best_fit(lengths: np.ndarray, capacities: tuple[int, ...] = CAPACITIES) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The bin of each piece, its place in the bin, and each bin's capacity after downsizing: of the packing with all
    sizes and those with a single size that holds every piece, the one of least cost."""
    caps = np.sort(np.array(capacities))
    if not len(lengths):
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64)
    costs = np.array([cost(c) for c in caps.tolist()])
    best = None
    for sizes in [tuple(caps.tolist()), *((c,) for c in caps.tolist() if c >= lengths.max())]:
        bins, places, used = packed_into(lengths, sizes)
        shrunk = np.searchsorted(caps, used)
        if best is None or costs[shrunk].sum() < best[0] - 1e-6:
            best = costs[shrunk].sum(), bins, places, caps[shrunk]
    return best[1:]


_KINDS = {"doc_id": pa.int64(), "_id": pa.int64(), "_th": pa.int64(), "_slot": pa.int64(), "_at": pa.int64()}
_PIECES = pa.schema([*_KINDS.items(), *((c, pa.list_(pa.int32())) for c in ("piece", "start", "length"))])


def _measure(longest: int, tokenizer: str | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if tokenizer:
            from tokenizers import Tokenizer

            coder = Tokenizer.from_file(tokenizer)
            lengths = lambda texts: [len(x.ids) for x in coder.encode_batch(texts, add_special_tokens=False)]
        else:
            lengths = lambda texts: [len(x.encode().split()) for x in texts]
        for batch in batches:
            for part in slices(batch, "text"):
                ends = [n + 1 for n in lengths([t or "" for t in part.column("text").to_pylist()])]
                starts = [np.arange(0, e, longest) for e in ends]
                yield arrow({**{c: part.column(c).cast(t) for c, t in _KINDS.items()}, "piece": [np.arange(len(s)) for s in starts], "start": starts, "length": [np.diff(np.append(s, e)) for s, e in zip(starts, ends, strict=True)]}, _PIECES)

    return run


_PACKED = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int32()), ("length", pa.int32()), ("bin", pa.int64()), ("capacity", pa.int32()), ("place", pa.int32())])


def _pack(capacities: tuple[int, ...], ordered: bool):
    def run(key: tuple, rows: pa.Table) -> pa.Table:
        rows = rows.sort_by([(c, "ascending") for c in ("_slot", "_at", "_id", "_th", "piece")])
        bins, places, caps = best_fit(rows.column("length").to_numpy().astype(np.int64), capacities)
        if ordered:
            firsts = np.unique(bins, return_index=True)[1]
            turn = np.argsort(firsts)
            bins, caps = np.argsort(turn)[bins], caps[turn]
        got = {n: rows.column(n) for n in ("doc_id", "piece", "start", "length")}
        got |= {"bin": (key[0].as_py() << 32) + bins, "capacity": caps[bins].astype(np.int32), "place": places.astype(np.int32)}
        return pa.table([got[n] for n in _PACKED.names], schema=_PACKED)

    return run


def _consecutive(each: DataFrame, total: int, scratch: Scratch) -> DataFrame:
    """each, with the group g: runs of slots with about GROUP pieces."""
    spark = each.sparkSession
    slots = scratch.write(each.groupBy("_slot").agg(F.count(F.lit(1)).alias("n")), "slots")
    last = slots.agg(F.max("_slot")).first()[0] or 0
    width = last // (4096 + 16 * (total // GROUP)) + 1
    slots = slots.withColumn("_range", F.floor(F.col("_slot") / width))
    sums, before = sorted(tuple(r) for r in slots.groupBy("_range").agg(F.sum("n")).collect()), []  # so many ranges at most
    held = 0
    for r, n in sums:
        before.append((r, held))
        held += n
    w = Window.partitionBy("_range").orderBy("_slot").rowsBetween(Window.unboundedPreceding, -1)
    slots = slots.withColumn("_in", F.coalesce(F.sum("n").over(w), F.lit(0))).join(F.broadcast(spark.createDataFrame(before, "_range long, _before long")), "_range")
    return each.join(slots.select("_slot", F.floor((F.col("_before") + F.col("_in")) / GROUP).alias("g")), "_slot")


def best_fit_packing(docs: DataFrame, capacities: tuple[int, ...] = CAPACITIES, tokenizer: str | None = None, order: tuple[str, str] | None = None) -> DataFrame:
    """A row for each piece of docs (doc_id, text): doc_id, piece, start and length (in tokens of the document, the end
    mark last), bin, capacity (the bin's) and place (tokens before it in the bin). order: the columns of a document's
    slot in a mixture and its place in the slot, which bins are to follow."""
    scratch = Scratch(docs.sparkSession, "pack")
    slot, at = (F.coalesce(F.col(f"`{c}`").cast("long"), F.lit(0)) for c in order) if order else (F.lit(0).cast("long"),) * 2
    placed = keyed(docs.select("doc_id", "text", slot.alias("_slot"), at.alias("_at")), "_slot", "_at")
    own = ", ".join(f"{c} long" for c in _KINDS)
    packed = placed.select(*_KINDS, "text").mapInArrow(_measure(max(capacities), tokenizer), f"{own}, piece array<int>, start array<int>, length array<int>")
    each = packed.select(*_KINDS, F.explode(F.arrays_zip("piece", "start", "length")).alias("p")).select(*_KINDS, "p.*")
    each = scratch.write(numbered(each), "pieces")
    total = each.count()
    if order and total:
        each = _consecutive(each, total, scratch)
    else:
        each = each.withColumn("g", F.pmod(F.xxhash64("_id", "_th", "piece", "_u"), F.lit(max(1, -(-total // GROUP)))))
    return each.drop("_u").groupBy("g").applyInArrow(_pack(tuple(capacities), bool(order)), "doc_id long, piece int, start int, length int, bin long, capacity int, place int")
