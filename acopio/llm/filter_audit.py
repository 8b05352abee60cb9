"""What filters do to a corpus in every order: how much each removes, what it repeats of others, what it costs in good rows.

1. ``scan`` reads the Arrow buffers of the texts: a table of byte classes and prefix sums count words, capitals, symbols
   and code points of all documents of a batch at once; distinct words are the runs of equal hashes among a document's
   sorted word hashes, each run compared byte by byte (a document in which two words share a hash is counted from its
   words).
2. each document's failures are one mask of bits, so the corpus shrinks to a count for each part, mask and label; the
   failure that depends on other rows (a text that an earlier document has) is found from counts by text hash, gathered
   before they are shuffled, so a text that a third of all rows hold is no hot key.
3. every figure of every order and step is a sum over the at most 2**filters masks of a part.

Defined results: a null text counts as an empty one, a null part as the empty string; rows that share a doc_id are
counted each, and none of them is later than the other; a null doc_id is later than every other and has no labels;
labels that repeat a doc_id count once, by their greatest values; an empty table gives no row.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import permutations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import LAST_ID, Scratch, arrow, mix, slices, small_batches

SYMBOLS = b"#$%&*|"
#: Bytes of a text that are looked at together: bounds a worker's memory for very long texts.
BLOCK = 4 << 20
#: Above this number of filters the orders are too many to list.
MOST_FILTERS = 6

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_CAPITAL = np.zeros(256, bool)
_CAPITAL[ord("A") : ord("Z") + 1] = True
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(SYMBOLS)] = True
_START = (np.arange(256) & 0xC0) != 0x80  # a byte that begins a code point
_LETTER = np.random.default_rng(12).integers(0, 2**64, 256, dtype=np.uint64)
_STEP = 0x9E3779B97F4A7C15


@dataclass(frozen=True)
class Filter:
    """A letter and the condition, over the columns of scan, under which a document fails. Without one: an earlier
    document has the same text."""

    letter: str
    fails: str | None


#: The filters that the query audits.
FILTERS = (
    Filter("A", "n_words < 50"),
    Filter("B", "100 * n_distinct < 65 * n_words"),
    Filter("C", "100 * n_capitals > 5 * n_points"),
    Filter("D", "n_symbols > 0"),
    Filter("E", None),
)


def _blocks(data: np.ndarray, start: int, end: int) -> Iterator[tuple[int, int]]:
    """start to end in parts of about BLOCK bytes that end behind white space."""
    while end - start > BLOCK:
        cut = start + BLOCK
        while cut < end:
            if len(at := np.flatnonzero(_SPACE[data[cut : cut + BLOCK]])):
                cut += int(at[0]) + 1
                break
            cut += BLOCK
        yield start, min(cut, end)
        start = min(cut, end)
    if end > start:
        yield start, end


def _hashes(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """A hash of each word: its bytes' numbers, weighed by powers of their places in the word."""
    ends = np.cumsum(sizes)
    place = np.arange(ends[-1]) - np.repeat(ends - sizes, sizes)
    with np.errstate(over="ignore"):
        power = np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(int(sizes.max()), _STEP, np.uint64)]))
        return mix(np.add.reduceat(_LETTER[data[np.repeat(starts, sizes) + place]] * power[place], ends - sizes))


def _same_words(data: np.ndarray, a: np.ndarray, b: np.ndarray, sizes_a: np.ndarray, sizes_b: np.ndarray) -> np.ndarray:
    """Whether the words that start at a and b are equal, byte by byte."""
    same = sizes_a == sizes_b
    for part in np.array_split(np.flatnonzero(same), max(1, int(sizes_a.sum()) // BLOCK)):
        if len(part):
            n = sizes_a[part]
            ends = np.cumsum(n)
            place = np.arange(ends[-1]) - np.repeat(ends - n, n)
            same[part] = np.logical_and.reduceat(data[np.repeat(a[part], n) + place] == data[np.repeat(b[part], n) + place], ends - n)
    return same


def counts(texts: pa.Array) -> dict[str, np.ndarray]:
    """n_words, n_distinct, n_capitals, n_symbols and n_points of each text, from the array's buffers."""
    texts = pc.fill_null(texts, "")
    size = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    n = len(texts)
    _, where, body = texts.buffers()
    at = np.frombuffer(where, size, n + 1 + texts.offset)[texts.offset :].astype(np.int64)
    data = np.frombuffer(body, np.uint8) if body is not None else np.empty(0, np.uint8)
    out = {c: np.zeros(n, np.int64) for c in ("n_words", "n_distinct", "n_capitals", "n_symbols", "n_points")}
    docs, starts, sizes, keys = [], [], [], []
    for low, high in _blocks(data, int(at[0]), int(at[-1])):
        part = data[low:high]
        edges = np.clip(at, low, high) - low
        for c, kind in (("n_capitals", _CAPITAL), ("n_symbols", _SYMBOL), ("n_points", _START)):
            sums = np.zeros(len(part) + 1, np.int64)
            np.cumsum(kind[part], out=sums[1:])
            out[c] += sums[edges[1:]] - sums[edges[:-1]]
        word = ~_SPACE[part]
        first = word.copy()
        first[1:] &= ~word[:-1]
        last = word.copy()
        last[:-1] &= ~word[1:]
        inner = edges[(edges > 0) & (edges < len(part))]  # words end where their text ends
        first[inner] = word[inner]
        last[inner - 1] = word[inner - 1]
        starts_here, ends_here = np.flatnonzero(first), np.flatnonzero(last) + 1
        if len(starts_here):
            docs.append(np.searchsorted(edges, starts_here, "right") - 1)
            starts.append(starts_here + low)
            sizes.append(ends_here - starts_here)
            keys.append(_hashes(data, starts[-1], sizes[-1]))
    if docs:
        doc, start, length, key = (np.concatenate(x) for x in (docs, starts, sizes, keys))
        out["n_words"] = np.bincount(doc, minlength=n)
        bits = np.uint64(max(1, int(n - 1).bit_length()))
        order = np.argsort((doc.astype(np.uint64) << (np.uint64(64) - bits)) | (key >> bits))
        doc, start, length, key = doc[order], start[order], length[order], key[order] >> bits
        equal = (doc[1:] == doc[:-1]) & (key[1:] == key[:-1])
        out["n_distinct"] = np.bincount(doc[np.concatenate([[True], ~equal])], minlength=n)
        pairs = np.flatnonzero(equal)
        wrong = pairs[~_same_words(data, start[pairs], start[pairs + 1], length[pairs], length[pairs + 1])]
        for k in np.unique(doc[wrong]):
            out["n_distinct"][k] = len(set(data[at[k] : at[k + 1]].tobytes().split()))
    return out


_FACTS = pa.schema([("_id", pa.int64()), ("part", pa.string()), *((c, pa.int64()) for c in ("n_words", "n_distinct", "n_capitals", "n_symbols", "n_points")), ("digest", pa.binary())])
_FACTS_SQL = "_id long, part string, n_words long, n_distinct long, n_capitals long, n_symbols long, n_points long, digest binary"


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "text"):
            texts = part.column("text")
            digest = [hashlib.sha256(t.as_buffer() if t.is_valid else b"").digest() for t in texts.cast(pa.large_binary())]
            yield arrow({"_id": part.column("_id"), "part": part.column("part"), "digest": digest} | counts(texts), _FACTS)


def scan(docs: DataFrame, part: str = "source") -> DataFrame:
    """For each of docs (doc_id, text and the part's column): _id (null ids last), part, the counts and the text's SHA-256."""
    small_batches(docs.sparkSession)
    rows = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST_ID)).alias("_id"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"), "text")
    return rows.mapInArrow(_scan, _FACTS_SQL)


def _labelled(facts: DataFrame, labels: DataFrame) -> DataFrame:
    """facts with good and toxic, 0 without a label."""
    flag = lambda c: F.coalesce(F.max((F.col(c) == 1).cast("int")), F.lit(0)).alias("good" if c == "quality" else c)
    known = labels.filter("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("_id")).agg(flag("quality"), flag("toxic"))
    named = facts.filter(F.col("_id") < LAST_ID).join(known, "_id", "left")  # rows without an id would all meet in one task
    rest = facts.filter(F.col("_id") == LAST_ID).withColumns({"good": F.lit(None).cast("int"), "toxic": F.lit(None).cast("int")})
    return named.unionByName(rest).withColumns({c: F.coalesce(c, F.lit(0)) for c in ("good", "toxic")})


def masks(docs: DataFrame, labels: DataFrame, filters: tuple[Filter, ...] = FILTERS, part: str = "source") -> DataFrame:
    """part, mask (bit k: fails filter k), n, good, toxic: how many documents, of them with quality 1 and with toxic 1."""
    bit = lambda f, k: F.when(F.expr(f.fails), 1 << k).otherwise(0)
    own = sum((bit(f, k) for k, f in enumerate(filters) if f.fails is not None), F.lit(0))
    later = sum(1 << k for k, f in enumerate(filters) if f.fails is None)
    scratch = Scratch(docs.sparkSession, "audit")
    facts = scratch.write(scan(docs, part).select("_id", "part", "digest", own.alias("own")), "facts")  # read twice, as is same
    rows = _labelled(facts, labels)
    kind = ["digest", "part", "own", "good", "toxic"]
    # rows of one text and id, then how many rows of a kind there are and how many of them have its least id
    same = rows.groupBy(*kind, "_id").agg(F.count(F.lit(1)).alias("n"))
    same = same.groupBy(*kind).agg(F.sum("n").alias("n"), F.min(F.struct("_id", "n")).alias("first"))
    same = scratch.write(same, "same")
    first = same.groupBy("digest").agg(F.min("first._id").alias("least"))
    met = same.join(first, "digest")
    early = F.when(F.col("first._id") == F.col("least"), F.col("first.n")).otherwise(0)
    both = F.array(F.struct(F.col("own").alias("mask"), early.alias("n")), F.struct((F.col("own") + later).alias("mask"), (F.col("n") - early).alias("n")))
    each = met.select("part", "good", "toxic", F.explode(both).alias("x")).select("part", "good", "toxic", "x.*").filter("n > 0")
    return each.groupBy("part", "mask").agg(F.sum("n").alias("n"), F.sum(F.col("n") * F.col("good")).alias("good"), F.sum(F.col("n") * F.col("toxic")).alias("toxic"))


def audit(docs: DataFrame, labels: DataFrame, filters: tuple[Filter, ...] = FILTERS, part: str = "source") -> DataFrame:
    """For each part, order of the filters and step: kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley
    (what the step's filter removes, summed over all orders)."""
    if len(filters) > MOST_FILTERS or len({f.letter for f in filters}) < len(filters):
        raise ValueError(f"up to {MOST_FILTERS} filters of different letters")
    orders = list(permutations(range(len(filters))))
    # at most 2**filters masks of a part meet in one array
    parts = masks(docs, labels, filters, part).groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("m"))
    steps = [("".join(filters[k].letter for k in p), s + 1, sum(1 << k for k in p[:s]), 1 << p[s]) for p in orders for s in range(len(filters))]
    listed = F.array(*(F.struct(F.lit(o).alias("filter_order"), F.lit(s).alias("step"), F.lit(before).alias("before"), F.lit(bit).alias("bit")) for o, s, before, bit in steps))
    rows = parts.select("part", "m", F.explode(listed).alias("s")).select("part", "m", "s.*")

    def over(when: str, value: str = "n") -> Column:
        return F.expr(f"aggregate(m, 0L, (a, x) -> a + if({when}, x.{value}, 0L))")

    mine, early = "(x.mask & bit) > 0", "(x.mask & before) > 0"
    return rows.select(
        "part", "filter_order", "step",
        over("(x.mask & (before | bit)) = 0").alias("kept"),
        over(f"{mine} and not {early}").alias("removed"),
        over(f"{mine} and {early}").alias("redundant"),
        over("x.mask = bit").alias("unique_fails"),
        over(f"{mine} and not {early}", "good").alias("good_lost"),
        over(f"{mine} and not {early}", "toxic").alias("toxic_lost"),
        # of the filters that a document fails each comes first in as many orders
        F.expr(f"aggregate(m, 0L, (a, x) -> a + if({mine}, x.n * {len(orders)}L div bit_count(x.mask), 0L))").alias("shapley"),
    )


__all__ = ["FILTERS", "Filter", "audit", "counts", "masks", "scan"]
