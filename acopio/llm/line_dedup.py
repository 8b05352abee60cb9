"""Dropping lines that many documents share, reversibly.

A line's key is the line stripped of ASCII white space and lower-cased (A-Z). Per key, an exact table counts the
documents that hold it. Keys are dealt into shards by hash; each shard has a cuckoo filter of the keys that reach the
threshold. Inserting documents raises counts and adds keys to the filters, deleting documents lowers them and takes keys
out again, so the state after a deletion is the state as if the document had never come. Applying the store asks a
shard's filter first and its exact keys only for what the filter lets through.

A shard's references are dealt further by document where they are many (one very common line), so no task holds more
than about ``REFS`` of them.

Defined results: a null or empty text is one empty line; empty keys are never dropped; a line twice in one document
counts once, and so do rows that share a doc_id, whatever their texts are, in one insertion or deletion; rows with a null
doc_id count once for each different text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import LAST_ID, Scratch, arrow, keyed, slices

#: References to lines that one task holds at most, about; and shards at most, so that their sizes can be broadcast.
REFS, MOST_SHARDS = 300_000, 1 << 16
_SPACE = b" \t\n\x0b\x0c\r"


def line_key(line: bytes) -> bytes:
    return line.strip(_SPACE).lower()


class CuckooFilter:
    """16-bit fingerprints in buckets of four; a key's two buckets differ by a hash of its fingerprint. Arrays of 64-bit
    hashes go in, are looked up and come out again; no key that was added is ever missed."""

    SLOTS, KICKS = 4, 500

    def __init__(self, capacity: int, table: np.ndarray | None = None):
        size = 1
        while size * self.SLOTS * 0.8 < max(1, capacity):
            size *= 2
        self.table = np.zeros((size, self.SLOTS), np.uint16) if table is None else table

    @classmethod
    def load(cls, raw: bytes) -> CuckooFilter:
        return cls(0, np.frombuffer(raw, np.uint16).reshape(-1, cls.SLOTS).copy())

    def dump(self) -> bytes:
        return self.table.tobytes()

    def _places(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        mask = np.uint64(len(self.table) - 1)
        f = (h >> np.uint64(48)).astype(np.uint16)
        f[f == 0] = 1
        i = (h & mask).astype(np.int64)
        return f, i, self._other(i, f)

    def _other(self, i, f):
        return i ^ ((np.asarray(f).astype(np.int64) * 0x5BD1E995) & (len(self.table) - 1))

    def add(self, h: np.ndarray) -> bool:
        """False if it is too full; then build a larger one from the exact keys."""
        f, i, j = self._places(h)
        for turn in range(4):
            if not len(f):
                return True
            at = j if turn % 2 else i
            first = np.unique(at, return_index=True)[1]  # one newcomer a bucket and round
            free = self.table[at[first]] == 0
            some = first[free.any(axis=1)]
            self.table[at[some], free[free.any(axis=1)].argmax(axis=1)] = f[some]
            left = np.ones(len(f), bool)
            left[some] = False
            f, i, j = f[left], i[left], j[left]
        dice = np.random.default_rng(len(self.table))
        for x, a, b in zip(f.tolist(), i.tolist(), j.tolist(), strict=True):
            at = a if (self.table[a] == 0).any() else b
            for _ in range(self.KICKS):
                if (free := np.flatnonzero(self.table[at] == 0)).size:
                    self.table[at, free[0]] = x
                    break
                k = int(dice.integers(self.SLOTS))
                x, self.table[at, k] = int(self.table[at, k]), x
                at = int(self._other(at, x))
            else:
                return False
        return True

    def has(self, h: np.ndarray) -> np.ndarray:
        f, i, j = self._places(h)
        return ((self.table[i] == f[:, None]) | (self.table[j] == f[:, None])).any(axis=1)

    def remove(self, h: np.ndarray) -> None:
        """Only of keys that were added."""
        for x, a, b in zip(*(v.tolist() for v in self._places(h)), strict=True):
            at = a if (self.table[a] == x).any() else b
            self.table[at, np.flatnonzero(self.table[at] == x)[0]] = 0


_REFS = pa.schema([("_id", pa.int64()), ("_th", pa.int64()), ("hi", pa.list_(pa.int64())), ("lo", pa.list_(pa.int64()))])


def _digest(key: bytes) -> tuple[int, int]:
    d = xxhash.xxh3_128_intdigest(key)
    hi, lo = d >> 64, d & (2**64 - 1)
    return hi - (hi >> 63 << 64), lo - (lo >> 63 << 64)


def _refs(min_chars: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                hi, lo = [], []
                for text in part.column("text").to_pylist():
                    keys = {line_key(x) for x in (text or "").encode().split(b"\n")}
                    got = [_digest(k) for k in keys if k and (min_chars < 2 or len(k.decode()) >= min_chars)]
                    hi.append([x[0] for x in got])
                    lo.append([x[1] for x in got])
                yield arrow({"_id": part.column("_id"), "_th": part.column("_th"), "hi": hi, "lo": lo}, _REFS)

    return run


def line_refs(docs: DataFrame, min_chars: int = 1) -> DataFrame:
    """_id, _th, hi, lo: a row for each document and distinct key in it; hi and lo are the key's 128-bit hash."""
    packed = keyed(docs).select("_id", "_th", "text").mapInArrow(_refs(min_chars), "_id long, _th long, hi array<long>, lo array<long>")
    return packed.select("_id", "_th", F.explode(F.arrays_zip("hi", "lo")).alias("k")).select("_id", "_th", "k.hi", "k.lo")


_STATE = pa.schema([("shard", pa.int64()), ("filter", pa.binary()), ("keys", pa.binary())])


def _hash(hi: np.ndarray, lo: np.ndarray) -> np.ndarray:
    return hi.view(np.uint64) ^ (lo.view(np.uint64) << np.uint64(1))


def _load(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, [("hi", np.int64), ("lo", np.int64)])


def _update(key: tuple, state: pa.Table, change: pa.Table) -> pa.Table:
    """A shard's filter and exact keys after some keys came to the threshold and others fell under it."""
    filters = CuckooFilter.load(state.column("filter")[0].as_py()) if state.num_rows else CuckooFilter(64)
    keys = _load(state.column("keys")[0].as_py()) if state.num_rows else np.empty(0, [("hi", np.int64), ("lo", np.int64)])
    moved = np.empty(change.num_rows, keys.dtype)
    moved["hi"], moved["lo"] = change.column("hi").to_numpy(), change.column("lo").to_numpy()
    up = change.column("up").to_numpy().astype(bool)
    filters.remove(_hash(moved["hi"][~up].copy(), moved["lo"][~up].copy()))
    keys = np.sort(np.concatenate([np.setdiff1d(keys, moved[~up]), moved[up]]))
    if not filters.add(_hash(moved["hi"][up].copy(), moved["lo"][up].copy())):
        size = max(64, len(keys))
        filters = CuckooFilter(2 * size)
        while not filters.add(_hash(keys["hi"].copy(), keys["lo"].copy())):
            size *= 2
            filters = CuckooFilter(2 * size)
    return pa.table({"shard": [key[0].as_py()], "filter": [filters.dump()], "keys": [keys.tobytes()]}, _STATE)


_HITS = pa.schema([("_id", pa.int64()), ("_th", pa.int64()), ("lo", pa.int64()), ("hi", pa.int64())])


def _match(key: tuple, state: pa.Table, refs: pa.Table) -> pa.Table:
    if not state.num_rows or not refs.num_rows:
        return _HITS.empty_table()
    hi, lo = refs.column("hi").to_numpy(), refs.column("lo").to_numpy()
    may = np.flatnonzero(CuckooFilter.load(state.column("filter")[0].as_py()).has(_hash(hi, lo)))
    keys = _load(state.column("keys")[0].as_py())
    asked = np.empty(len(may), keys.dtype)
    asked["hi"], asked["lo"] = hi[may], lo[may]
    at = np.minimum(np.searchsorted(keys, asked), max(0, len(keys) - 1))
    sure = may[keys[at] == asked] if len(keys) else may[:0]
    return refs.select(_HITS.names).take(pa.array(sure))


class LineStore:
    """Exact document counts of line keys, and filters of the keys found in at least min_docs documents.

    A document is inserted once; delete() takes documents with the texts they were inserted with."""

    def __init__(self, spark: SparkSession, min_docs: int = 10, min_chars: int = 1, shards: int = 64):
        self.spark, self.min_docs, self.min_chars = spark, min_docs, min_chars
        self.shards, self.scratch, self.version = min(MOST_SHARDS, max(1, shards)), Scratch(spark, "lines"), 0
        self.counts = spark.createDataFrame([], "hi long, lo long, n long")
        self.state = spark.createDataFrame([], "shard long, filter binary, keys binary")

    def _shard(self):
        return F.pmod(F.col("lo"), F.lit(self.shards))

    def insert(self, docs: DataFrame) -> LineStore:
        return self._change(docs, 1)

    def delete(self, docs: DataFrame) -> LineStore:
        return self._change(docs, -1)

    def _references(self, docs: DataFrame) -> DataFrame:
        """A row for each document and distinct key in it. Only the rows of ids that occur again need a shuffle to become
        one document, so they are told apart first, by their ids alone."""
        refs = line_refs(docs, self.min_chars)
        again = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST_ID)).alias("_id")).groupBy("_id").agg(F.count(F.lit(1)).alias("n"))
        again = self.scratch.write(again.filter("n > 1").select("_id"), f"again-{self.version}")
        if again.isEmpty():
            return refs
        several = refs.join(again, "_id", "left_semi").select("_id", F.when(F.col("_id") == LAST_ID, F.col("_th")).alias("_th"), "hi", "lo").distinct()
        return refs.join(again, "_id", "left_anti").select("_id", "_th", "hi", "lo").unionByName(several)

    def _change(self, docs: DataFrame, sign: int) -> LineStore:
        self.version += 1
        delta = self._references(docs).groupBy("hi", "lo").agg((F.count(F.lit(1)) * sign).alias("d"))
        if self.version == 1:
            both = delta.select("hi", "lo", F.lit(0).cast("long").alias("was"), F.col("d").alias("n"))
        else:
            both = self.counts.join(delta, ["hi", "lo"], "full").select("hi", "lo", F.coalesce("n", F.lit(0)).alias("was"), (F.coalesce("n", F.lit(0)) + F.coalesce("d", F.lit(0))).alias("n"))
        both = self.scratch.write(both, f"counts-{self.version}")
        up, down = both.n >= self.min_docs, both.was >= self.min_docs
        moved = both.filter(up != down).select(self._shard().alias("shard"), "hi", "lo", up.alias("up"))
        old = self.state.groupBy("shard").cogroup(moved.groupBy("shard"))
        self.state = self.scratch.write(old.applyInArrow(_update, "shard long, filter binary, keys binary"), f"state-{self.version}")
        self.counts = both.filter("n > 0").select("hi", "lo", "n")
        return self

    def hits(self, docs: DataFrame) -> DataFrame:
        """_id, _th, hi, lo (arrays): the keys to drop, of documents that have any."""
        refs = line_refs(docs, self.min_chars).withColumn("shard", self._shard())
        sizes = self.counts.groupBy(self._shard().alias("shard")).agg(F.ceil(F.sum("n") / REFS).cast("int").alias("salts"))  # at most MOST_SHARDS rows
        refs = refs.join(F.broadcast(sizes), "shard", "left").withColumn("salt", F.pmod(F.xxhash64("_id", "_th"), F.coalesce("salts", F.lit(1))).cast("long")).drop("salts")
        state = self.state.join(F.broadcast(sizes), "shard", "left").withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce("salts", F.lit(1)).cast("long") - 1))).drop("salts")
        found = state.groupBy("shard", "salt").cogroup(refs.groupBy("shard", "salt")).applyInArrow(_match, "_id long, _th long, lo long, hi long")
        return found.groupBy("_id", "_th").agg(F.collect_list("hi").alias("hi"), F.collect_list("lo").alias("lo"))

    def apply(self, docs: DataFrame, carry: tuple[str, ...] = (), with_text: bool = True) -> DataFrame:
        """A row for each of docs: doc_id, n_lines, n_dropped, kept_text (if with_text), kept_sha256 and the columns of carry."""
        carried = [f"_c{k}" for k in range(len(carry))]
        base = keyed(docs, *(F.col(c).alias(a) for c, a in zip(carry, carried, strict=True)))
        joined = base.join(self.hits(docs), ["_id", "_th"], "left").select("doc_id", "text", "hi", "lo", *carried)
        kinds = dict(joined.dtypes)
        schema = "doc_id long, n_lines long, n_dropped long, " + "kept_text string, " * with_text + "kept_sha256 string" + "".join(f", {c} {kinds[c]}" for c in carried)
        out = joined.mapInArrow(_drop(carried, with_text), schema)
        return out.withColumnsRenamed(dict(zip(carried, carry, strict=True)))


def _drop(carried: list[str], with_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                n, gone, texts, sums = [], [], [], []
                for text, hi, lo in zip(*(part.column(c).to_pylist() for c in ("text", "hi", "lo")), strict=True):
                    lines = kept = (text or "").encode().split(b"\n")
                    if hi:
                        drop = set(zip(hi, lo, strict=True))
                        kept = [x for x in lines if not (k := line_key(x)) or _digest(k) not in drop]
                    left = b"\n".join(kept)
                    n.append(len(lines))
                    gone.append(len(lines) - len(kept))
                    texts.append(left.decode() if with_text else None)
                    sums.append(hashlib.sha256(left).hexdigest())
                cols = {"doc_id": part.column("doc_id").cast(pa.int64()), "n_lines": pa.array(n, pa.int64()), "n_dropped": pa.array(gone, pa.int64())}
                cols |= {"kept_text": pa.array(texts, pa.string())} if with_text else {}
                cols |= {"kept_sha256": pa.array(sums, pa.string())} | {c: part.column(c) for c in carried}
                yield pa.RecordBatch.from_pydict(cols)

    return run


def line_dedup(docs: DataFrame, min_docs: int = 10, min_chars: int = 1, carry: tuple[str, ...] = (), with_text: bool = True) -> DataFrame:
    """Inserts all of docs (doc_id, text) into a new store and applies it to them."""
    spark = docs.sparkSession
    lines = docs.agg(F.sum(F.length(F.coalesce("text", F.lit(""))))).first()[0] or 0
    store = LineStore(spark, min_docs, min_chars, shards=-(-lines // (100 * REFS)))
    return store.insert(docs).apply(docs, carry, with_text)
