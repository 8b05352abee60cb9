"""What the corpus operators share: words, hashes, written tables and gapless ranks.

Words are runs of bytes other than the six ASCII white-space characters, which is what ``bytes.split()`` gives;
multi-byte UTF-8 characters never hold such bytes. ``bytes.lower()`` lower-cases A-Z alone.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..plans.scratch import Scratch, shared_dir, shuffled  # noqa: F401

SPACE = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LAST_ID = 2**63 - 1


#: Rows that Spark hands to a Python worker at once, at most: texts are long, and two workers share an executor.
BATCH = 1000


def small_batches(spark: SparkSession) -> None:
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= BATCH:
        spark.conf.set(name, str(BATCH))


def keyed(docs: DataFrame, *more: str) -> DataFrame:
    """doc_id, text and the columns of more, with _id (null ids last) and _th, by which rows are told apart."""
    small_batches(docs.sparkSession)
    return docs.select(
        "doc_id", "text", *more,
        F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST_ID)).alias("_id"),
        F.xxhash64(F.coalesce("text", F.lit("")), F.col("text").isNull()).alias("_th"),
    )


def apart(docs: DataFrame, *own: str) -> tuple[DataFrame, list[Column]]:
    """docs with its columns other than own under neutral names, which clash with none of an operator's, and the columns
    that give docs' names back."""
    names = {c: c if c in own else f"_x{k}" for k, c in enumerate(docs.columns)}
    return docs.select(*(F.col(f"`{c}`").alias(a) for c, a in names.items())), [F.col(a).alias(c) for c, a in names.items()]


def n_tasks(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def u64(values) -> np.ndarray:
    return np.asarray(values).view(np.uint64)


def i64(values: np.ndarray) -> np.ndarray:
    return values.view(np.int64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser of 64-bit words: every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))


class Rolling:
    """Rabin-Karp hashes modulo 2**64 by prefix sums; powers grow with the longest text seen."""

    BASE = 0x9E3779B97F4A7C15

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    def _grow(self, n: int) -> None:
        if len(self.up) < n:
            size = max(n, 2 * len(self.up), 4096)
            inverse = pow(self.BASE, -1, 2**64)
            self.up, self.down = (np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(size, b, np.uint64)])) for b in (self.BASE, inverse))

    def windows(self, h: np.ndarray, width: int) -> np.ndarray:
        """The hash of every window of so many words, from the words' hashes."""
        n = len(h)
        if n < width:
            return np.empty(0, np.uint64)
        self._grow(n + 1)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(h * self.up[:n], out=sums[1:])
        return mix((sums[width:] - sums[:-width]) * self.down[: n - width + 1])


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """The least of every window, by doubling."""
    have = 1
    while have * 2 <= width:
        x = np.minimum(x[:-have], x[have:])
        have *= 2
    rest = width - have
    return np.minimum(x[:-rest], x[rest:]) if rest else x


def arrow(batch_rows: dict[str, list | np.ndarray | pa.Array], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([v if isinstance(v, pa.Array) else pa.array(v, f.type) for f, v in ((f, batch_rows[f.name]) for f in schema)], schema=schema)


def _trim() -> None:
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):
        pass


def slices(batch: pa.RecordBatch, column: str, most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with about so many bytes in a text column: keeps a worker's memory flat."""
    if not batch.num_rows:
        return
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    part = np.cumsum(sizes, dtype=np.int64) // most
    cuts = [0, *(np.flatnonzero(np.diff(part)) + 1), batch.num_rows]
    for a, b in zip(cuts, cuts[1:], strict=False):
        yield batch.slice(a, b - a)
    if part[-1]:  # a large batch: give freed memory back, as idle workers keep it otherwise
        pa.default_memory_pool().release_unused()
        _trim()


def numbered(df: DataFrame) -> DataFrame:
    """df, to be written, with _u: a number for rows with a null id (_id is LAST_ID), null for others. Only such rows can
    be alike in great number; the number spreads them."""
    return df.withColumn("_u", F.when(F.col("_id") == LAST_ID, F.monotonically_increasing_id()))


def running(df: DataFrame, by: list[str], order: list[Column], value: Column, name: str, total: int, rows_a_bucket: int = 4000) -> DataFrame:
    """Adds, as a long, the sum of value over the rows before a row in its group of by (value 1: a gapless rank), without
    bringing a group into one task: hashed buckets are summed, and sums inside a bucket shifted by those of the buckets
    before. order: columns that tell rows apart; df: narrow and cheap to read twice; total: its rows, about."""
    df = df.withColumn("_bucket", F.pmod(F.xxhash64(*order), F.lit(max(1, -(-total // rows_a_bucket)))))
    sums = df.groupBy(*by, "_bucket").agg(F.sum(value).alias("_sum"))
    w = Window.partitionBy(*by).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    before = sums.select(*by, "_bucket", F.coalesce(F.sum("_sum").over(w), F.lit(0)).alias("_offset"))
    w = Window.partitionBy(*by, "_bucket").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    inside = df.withColumn("_in", F.coalesce(F.sum(value).over(w), F.lit(0)))
    return inside.join(before, [*by, "_bucket"]).withColumn(name, (F.col("_offset") + F.col("_in")).cast("long")).drop("_bucket", "_offset", "_in")


def documents(spark: SparkSession, sf_dir: str, table: str = "documents") -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


Batches = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]
