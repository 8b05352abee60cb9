"""Document quality by a byte-level convolutional network in numpy.

Learned filters of WIDTH bytes slide over every byte of a document, in chunks of CHUNK positions that overlap by
WIDTH - 1 bytes. Each filter is max-pooled in a chunk and rectified; the document has each filter's mean and maximum
over its chunks, and a logistic unit combines them into one probability. Only the text's bytes are inputs.

The network is fitted on the driver on a bounded sample: at most PER_CLASS labelled documents of each class, those of
smallest hash, and no more once those before hold CLASS_BYTES, weighted back to the classes' shares. Every byte of a
sampled document is learned from. Scoring reads every byte of every text.

Defined results: a null or empty text is one chunk of zero bytes; labels that are null take no part, a document
labelled twice is learned twice; without labels of both classes the score is the share of 1 among them, or 0.5.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import apart, slices, small_batches

WIDTH, CHUNK, FILTERS = 6, 256, 16
PER_CLASS, CLASS_BYTES, EPOCHS, RATE = 1500, 32 << 20, 12, 0.02
THRESHOLD = 0.3


@dataclass
class Network:
    """table: a filter's weight for each place in the window and byte value; bias; out: weights of the filters' means,
    then maxima; base: the logistic unit's bias."""

    table: np.ndarray
    bias: np.ndarray
    out: np.ndarray
    base: float

    def pairs(self) -> np.ndarray:
        """The same filters for pairs of bytes: half as many look-ups."""
        even, odd = self.table[0::2], self.table[1::2]
        return (even[:, :, None, :] + odd[:, None, :, :]).reshape(WIDTH // 2, 65536, -1)


def chunks(text: bytes) -> np.ndarray:
    """A row of CHUNK + WIDTH - 1 bytes for each chunk; zeros after the end."""
    n = max(1, -(-len(text) // CHUNK))
    padded = np.zeros(n * CHUNK + WIDTH - 1, np.uint8)
    padded[: len(text)] = np.frombuffer(text, np.uint8)
    return np.lib.stride_tricks.sliding_window_view(padded, CHUNK + WIDTH - 1)[::CHUNK]


def pooled(rows: np.ndarray, pairs: np.ndarray) -> np.ndarray:
    """Each filter's maximum in each chunk, before the bias."""
    out = np.empty((len(rows), pairs.shape[2]), np.float32)
    for a in range(0, len(rows), 64):
        x = rows[a : a + 64].astype(np.uint16)
        code = (x[:, :-1] << 8) | x[:, 1:]
        y = pairs[0][code[:, :CHUNK]]
        for k in range(1, WIDTH // 2):
            y += pairs[k][code[:, 2 * k : 2 * k + CHUNK]]
        out[a : a + 64] = y.max(axis=1)
    return out


def features(z: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    return np.concatenate([np.add.reduceat(z, starts, axis=0) / sizes[:, None], np.maximum.reduceat(z, starts, axis=0)], axis=1)


def score(texts: list[bytes], net: Network, pairs: np.ndarray) -> np.ndarray:
    parts = [chunks(t) for t in texts]
    z = np.maximum(pooled(np.concatenate(parts), pairs) + net.bias, 0)
    x = features(z, np.array([len(p) for p in parts])) @ net.out + net.base
    return 1 / (1 + np.exp(-x.astype(np.float64)))


def fit(texts: list[bytes], labels: np.ndarray, weights: np.ndarray, seed: int = 7) -> Network:
    """Adam on the weighted cross-entropy; through the maxima, only winning windows have a gradient."""
    dice = np.random.default_rng(seed)
    p = {"table": dice.normal(0, 0.3, (WIDTH, 256, FILTERS)), "bias": np.zeros(FILTERS), "out": dice.normal(0, 0.3, 2 * FILTERS), "base": np.zeros(1)}
    m, v = {k: np.zeros_like(x) for k, x in p.items()}, {k: np.zeros_like(x) for k, x in p.items()}
    parts = [chunks(t) for t in texts]
    step, size = 0, 64
    for epoch in range(EPOCHS):
        order = dice.permutation(len(parts))
        for a in range(0, len(order), size):
            some = order[a : a + size]
            rows, sizes = np.concatenate([parts[k] for k in some]), np.array([len(parts[k]) for k in some])
            net = Network(p["table"].astype(np.float32), p["bias"], p["out"], p["base"][0])
            doc = np.repeat(np.arange(len(some)), sizes)
            at = np.empty((len(rows), FILTERS), np.int64)
            top = np.empty((len(rows), FILTERS))
            for b in range(0, len(rows), 256):
                x = rows[b : b + 256]
                y = net.table[0][x[:, :CHUNK]]
                for k in range(1, WIDTH):
                    y += net.table[k][x[:, k : k + CHUNK]]
                at[b : b + 256] = y.argmax(axis=1)
                top[b : b + 256] = y.max(axis=1)
            z = np.maximum(top + p["bias"], 0)
            f = features(z, sizes)
            prob = 1 / (1 + np.exp(-(f @ p["out"] + p["base"][0])))
            g = (prob - labels[some]) * weights[some] / weights[some].sum()
            grad = {"out": f.T @ g + 1e-4 * p["out"], "base": np.array([g.sum()])}
            gf = g[:, None] * p["out"][None, :]
            gz = (gf[:, :FILTERS] / sizes[:, None])[doc]
            is_max = z == f[:, FILTERS:][doc]
            gz = (gz + gf[:, FILTERS:][doc] * is_max / np.maximum(1, np.add.reduceat(is_max, np.concatenate([[0], np.cumsum(sizes)[:-1]]), axis=0))[doc]) * (z > 0)
            grad["bias"] = gz.sum(axis=0)
            grad["table"] = np.zeros_like(p["table"])
            r, c = np.nonzero(gz)
            for k in range(WIDTH):
                np.add.at(grad["table"][k], (rows[r, at[r, c] + k], c), gz[r, c])
            grad["table"] += 1e-5 * p["table"]
            step += 1
            rate = RATE * (1 - epoch / EPOCHS)
            for k, x in p.items():
                m[k] += 0.1 * (grad[k] - m[k])
                v[k] += 0.01 * (grad[k] ** 2 - v[k])
                x -= rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.99**step)) + 1e-8)
    return Network(p["table"].astype(np.float32), p["bias"].astype(np.float32), p["out"].astype(np.float32), float(p["base"][0]))


def remainder(column: str = "doc_id"):
    """crc32 of the id as text, modulo 5; 0 is held out."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % 5


def train(docs: DataFrame, labels: DataFrame) -> Network | float:
    """The network, or the constant score where the labels don't hold both classes."""
    known = labels.filter(F.col("quality").isin(0, 1) & (remainder() != 0) & F.col("doc_id").isNotNull()).select("doc_id", "quality")
    shares = {r["quality"]: r["count"] for r in known.groupBy("quality").count().collect()}
    if len(shares) < 2:
        return float(next(iter(shares), 0.5))
    some = [known.filter(F.col("quality") == q).orderBy(F.xxhash64("doc_id"), "doc_id").limit(PER_CLASS) for q in (0, 1)]
    sample = some[0].unionByName(some[1])  # at most 2 * PER_CLASS rows
    text = F.encode(F.coalesce("text", F.lit("")), "UTF-8")
    sizes = docs.select("doc_id", F.octet_length(text).alias("n")).join(F.broadcast(sample.distinct()), "doc_id").groupBy("quality", "doc_id").agg(F.sum("n").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("quality").orderBy(F.xxhash64("doc_id"), "doc_id").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    fit_in = sizes.withColumn("before", before).filter(F.col("before") < CLASS_BYTES).select("doc_id", "quality")
    rows = docs.select("doc_id", "text").join(F.broadcast(sample.join(fit_in, ["doc_id", "quality"])), "doc_id").select("doc_id", text.alias("t"), "quality").collect()
    rows = sorted(rows, key=lambda r: (r["doc_id"], bytes(r["t"]), r["quality"]))
    got = np.array([r["quality"] for r in rows], np.float64)
    if len(set(got)) < 2:
        return float(got[0]) if len(got) else 0.5
    weight = np.where(got == 1, shares[1] / got.sum(), shares[0] / (1 - got).sum())
    return fit([bytes(r["t"]) for r in rows], got, weight / weight.mean())


def _score(net: Network | float, carried: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs = net.pairs() if isinstance(net, Network) else None
        for batch in batches:
            for part in slices(batch, "text", 1 << 20):
                texts = [(t or "").encode() for t in part.column("text").to_pylist()]
                got = score(texts, net, pairs) if pairs is not None else np.full(len(texts), net)
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in carried), pa.array(got, pa.float64())], [*carried, "_score"])

    return run


def scored(docs: DataFrame, net: Network | float, keep: list[str]) -> DataFrame:
    """The columns keep of docs, and _score."""
    small_batches(docs.sparkSession)
    base = docs.select("text", *(F.col(c).alias(f"_c{k}") for k, c in enumerate(keep)))
    names = [f"_c{k}" for k in range(len(keep))]
    kinds = dict(base.dtypes)
    out = base.mapInArrow(_score(net, names), ", ".join(f"{n} {kinds[n]}" for n in names) + ", _score double")
    return out.withColumnsRenamed(dict(zip(names, keep, strict=True)))


def quality_scores(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """A row for each of docs (doc_id, text): doc_id, held_out, score, predicted."""
    out = scored(docs, train(docs, labels), ["doc_id"])
    return out.select("doc_id", (remainder() == 0).alias("held_out"), F.col("_score").alias("score"), F.when(F.col("_score") >= threshold, 1).otherwise(0).alias("predicted"))


def drop_poor(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """docs that score the threshold or more."""
    base, back = apart(docs, "doc_id", "text")
    return scored(base, train(docs, labels), base.columns).filter(F.col("_score") >= threshold).select(*back)


__all__ = ["Network", "drop_poor", "fit", "quality_scores", "score", "train"]
