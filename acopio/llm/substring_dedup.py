"""Removing passages that an earlier document already holds.

Every window of ``width`` consecutive words gets a Rabin-Karp hash. A word goes if a window over it also starts in a
document with a smaller doc_id; windows are judged on the input. Equal windows share the least hash of the short word
runs inside them, their anchor, so only windows under an anchor found in two documents can repeat; the anchors are
counted in Spark first, and only windows under repeated ones travel:

1. each document's distinct anchors, counted over all documents;
2. windows under repeated anchors; inside a batch the smallest document stands for all, so a passage that a third of
   the corpus holds arrives once a batch, not once a document;
3. per anchor, windows also found in a smaller document; they merge into maximal removal intervals. An anchor of more than
   HOT documents, whose windows could be too many for one task, is not kept together: the smallest document of each of
   its windows is an aggregate;
4. the intervals are cut from the texts.

Defined results: a null or empty text has no words; a null doc_id counts as larger than any other; rows that repeat a
doc_id never remove each other's words; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import LAST_ID, Rolling, Scratch, arrow, i64, keyed, n_tasks, slices, sliding_min, u64, word_hashes

#: Words in a run whose hash can be an anchor; documents of an anchor whose windows one task sees, at most.
RUN, HOT = 8, 1000
_NONE = np.empty(0, np.int64)


def anchored(text: str, width: int, roll: Rolling) -> tuple[np.ndarray, np.ndarray]:
    """The hash and the anchor of every window."""
    words = text.encode().split()
    if len(words) < width:
        return np.empty(0, np.uint64), np.empty(0, np.uint64)
    h, run = word_hashes(words), min(RUN, width)
    return roll.windows(h, width), sliding_min(roll.windows(h, run), width - run + 1)


def merged(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal intervals that cover the same words."""
    if not len(starts):
        return _NONE, _NONE
    order = np.argsort(starts, kind="stable")
    starts, ends = starts[order], np.maximum.accumulate(ends[order])
    first = np.flatnonzero(np.concatenate([[True], starts[1:] > ends[:-1]]))
    return starts[first], np.concatenate([ends[first[1:] - 1], ends[-1:]])


def _anchors(width: int):
    schema = pa.schema([("_id", pa.int64()), ("_th", pa.int64()), ("anchors", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        roll = Rolling()
        for batch in batches:
            for part in slices(batch, "text"):
                found = [i64(np.unique(anchored(t or "", width, roll)[1])) for t in part.column("text").to_pylist()]
                yield arrow({"_id": part.column("_id"), "_th": part.column("_th"), "anchors": [x for x in found]}, schema)

    return run


_KINDS = pa.schema([("local", pa.bool_()), ("_id", pa.int64()), ("_th", pa.int64()), ("anchor", pa.int64()), ("start", pa.int32()), ("hashes", pa.binary()), ("each", pa.list_(pa.int64())), ("starts", pa.list_(pa.int32())), ("ends", pa.list_(pa.int32()))])


def _runs(rows: np.ndarray, pos: np.ndarray, anchor: np.ndarray) -> np.ndarray:
    """Where a new run of consecutive windows of one row under one anchor begins."""
    return np.flatnonzero(np.concatenate([[True], (rows[1:] != rows[:-1]) | (pos[1:] != pos[:-1] + 1) | (anchor[1:] != anchor[:-1])]))


def _flags(rows: np.ndarray, pos: np.ndarray, width: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    order = np.lexsort((pos, rows))
    rows, pos = rows[order], pos[order]
    cuts = [0, *(np.flatnonzero(np.diff(rows)) + 1), len(rows)]
    for a, b in zip(cuts, cuts[1:], strict=False):
        if b > a:
            yield rows[a], *merged(pos[a:b], pos[a:b] + width)


def _windows(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        roll = Rolling()
        for batch in batches:
            for part in slices(batch, "text"):
                ids, ths = part.column("_id").to_numpy(), part.column("_th").to_numpy()
                hot = np.unique(part.column("hot").flatten().to_numpy()).view(np.uint64)
                got = []
                for k, (text, rep) in enumerate(zip(part.column("text").to_pylist(), part.column("repeated"), strict=True)):
                    h, a = anchored(text or "", width, roll)
                    at = np.flatnonzero(np.isin(a, u64(rep.values.to_numpy())))
                    got.append((np.full(len(at), k), at, h[at], a[at]))
                row, pos, h, a = (np.concatenate(x) for x in zip(*got, strict=True))
                if not len(row):
                    continue
                order = np.lexsort((ids[row], a, h))
                row, pos, h, a = row[order], pos[order], h[order], a[order]
                new = np.concatenate([[True], (h[1:] != h[:-1]) | (a[1:] != a[:-1])])
                least = ids[row][np.flatnonzero(new)][np.cumsum(new) - 1]
                late = ids[row] > least
                out: dict[str, list] = {n: [] for n in _KINDS.names}

                def put(out=out, **x) -> None:
                    for n in _KINDS.names:
                        out[n].append(x.get(n))

                for k, s, e in _flags(row[late], pos[late], width):
                    put(local=True, _id=ids[k], _th=ths[k], starts=s, ends=e)
                row, pos, h, a = (x[~late] for x in (row, pos, h, a))
                order = np.lexsort((pos, row))
                row, pos, h, a = row[order], pos[order], h[order], a[order]
                cuts = [*_runs(row, pos, a), len(row)] if len(row) else [0]
                apart = np.isin(a, hot)
                for x, y in zip(cuts, cuts[1:], strict=False):
                    held = {"each": i64(h[x:y])} if apart[x] else {"hashes": h[x:y].tobytes()}
                    put(local=False, _id=ids[row[x]], _th=ths[row[x]], anchor=i64(a[x : x + 1])[0], start=pos[x], **held)
                yield arrow(out, _KINDS)

    return run


_INTERVALS = pa.schema([("_id", pa.int64()), ("_th", pa.int64()), ("starts", pa.list_(pa.int32())), ("ends", pa.list_(pa.int32()))])


def _verdicts(width: int):
    """Rows come sorted by anchor; of the last anchor of a batch, the smallest document of each window goes on."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = (np.empty(0, np.int64), np.empty(0, np.uint64), np.empty(0, np.int64))  # anchor, hash, id
        for batch in batches:
            if not batch.num_rows:
                continue
            ids, ths, anchors, starts = (batch.column(n).to_numpy(zero_copy_only=False) for n in ("_id", "_th", "anchor", "start"))
            hashes = [np.frombuffer(x, np.uint64) for x in batch.column("hashes").to_pylist()]
            sizes = np.array([len(x) for x in hashes])
            row = np.repeat(np.arange(len(ids)), sizes)
            pos = np.concatenate([np.arange(len(x)) for x in hashes]) + starts[row]
            old = len(kept[0])
            a, h, d = (np.concatenate(x) for x in zip(kept, (anchors[row], np.concatenate(hashes), ids[row]), strict=True))
            order = np.lexsort((d, h, a))
            a, h, d = a[order], h[order], d[order]
            new = np.concatenate([[True], (h[1:] != h[:-1]) | (a[1:] != a[:-1])])
            first = np.flatnonzero(new)
            late = d > d[first][np.cumsum(new) - 1]
            where = order[late] - old
            where = where[where >= 0]
            out: dict[str, list] = {n: [] for n in _INTERVALS.names}
            for k, s, e in _flags(row[where], pos[where], width):
                for n, v in zip(_INTERVALS.names, (ids[k], ths[k], s, e), strict=True):
                    out[n].append(v)
            yield arrow(out, _INTERVALS)
            last = first[a[first] == anchors[-1]]
            kept = (a[last], h[last], d[last])

    return run


def removal_intervals(docs: DataFrame, scratch: Scratch, width: int) -> DataFrame:
    """_id, _th and the word intervals to remove, as arrays starts and ends, for documents that lose any."""
    base = keyed(docs).select("_id", "_th", "text")
    anchors = scratch.write(base.mapInArrow(_anchors(width), "_id long, _th long, anchors array<long>"), "anchors")
    single = anchors.select("_id", "_th", F.explode("anchors").alias("anchor"))
    twice = single.groupBy("anchor").agg(F.min("_id").alias("a"), F.max("_id").alias("b"), (F.count(F.lit(1)) > HOT).alias("hot")).filter("a < b").select("anchor", "hot")
    repeated = single.join(twice, "anchor").groupBy("_id", "_th").agg(F.collect_set("anchor").alias("repeated"), F.collect_set(F.when(F.col("hot"), F.col("anchor"))).alias("hot"))
    repeated = scratch.write(repeated, "repeated")
    scratch.drop("anchors")
    windows = base.join(repeated, ["_id", "_th"]).mapInArrow(_windows(width), "local boolean, _id long, _th long, anchor long, start int, hashes binary, each array<long>, starts array<int>, ends array<int>")
    windows = scratch.write(windows, "windows")
    far = windows.filter("hashes is not null").select("_id", "_th", "anchor", "start", "hashes").repartition(n_tasks(scratch.spark), "anchor").sortWithinPartitions("anchor", "_id")
    hot = windows.filter("each is not null").select("_id", "_th", "start", F.posexplode("each").alias("i", "h")).select("_id", "_th", "h", (F.col("start") + F.col("i")).alias("at"))
    hot = hot.groupBy("h", "_id", "_th").agg(F.collect_list("at").alias("at"))  # a window may recur in a document
    late = hot.join(hot.groupBy("h").agg(F.min("_id").alias("first")), "h").filter("_id > first").groupBy("_id", "_th").agg(F.flatten(F.collect_list("at")).alias("starts"))
    late = late.withColumn("ends", F.transform("starts", lambda x: x + width))
    found = far.mapInArrow(_verdicts(width), "_id long, _th long, starts array<int>, ends array<int>").unionByName(windows.filter("local").select("_id", "_th", "starts", "ends")).unionByName(late)
    return found.groupBy("_id", "_th").agg(F.flatten(F.collect_list("starts")).alias("starts"), F.flatten(F.collect_list("ends")).alias("ends"))


_CUT = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_text", pa.string()), ("kept_sha256", pa.string())])


def _cut(with_text: bool):
    schema = _CUT if with_text else pa.schema([f for f in _CUT if f.name != "kept_text"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                out: dict[str, list] = {n: [] for n in _CUT.names}
                for doc_id, text, s, e in zip(*(part.column(n).to_pylist() for n in ("doc_id", "text", "starts", "ends")), strict=True):
                    words = (text or "").encode().split()
                    kept = words
                    if s:
                        at, kept = 0, []
                        for a, b in zip(*merged(np.array(s, np.int64), np.array(e, np.int64)), strict=True):
                            kept += words[at:a]
                            at = b
                        kept += words[at:]
                    left = b" ".join(kept)
                    for n, v in zip(_CUT.names, (doc_id, len(words), len(words) - len(kept), left.decode() if with_text else None, hashlib.sha256(left).hexdigest()), strict=True):
                        out[n].append(v)
                yield arrow(out, schema)

    return run


def substring_dedup(docs: DataFrame, width: int = 50, with_text: bool = True) -> DataFrame:
    """A row for each of docs (doc_id, text): doc_id, n_words, n_removed, kept_text (if with_text), kept_sha256."""
    scratch = Scratch(docs.sparkSession, "substring")
    gone = removal_intervals(docs, scratch, width)
    joined = keyed(docs).join(gone, ["_id", "_th"], "left").select("doc_id", "text", "starts", "ends")
    return joined.mapInArrow(_cut(with_text), "doc_id long, n_words long, n_removed long, " + "kept_text string, " * with_text + "kept_sha256 string")


__all__ = ["LAST_ID", "anchored", "merged", "removal_intervals", "substring_dedup"]
