"""Spelling variants: words at an edit distance of one, each tied to its commonest neighbour and to the root of that chain.

1. words are counted inside each task before they are shuffled, so the commonest word is no hot key;
2. symmetric deletion: every word emits itself and its distinct single deletions, as 64-bit hashes worked out from prefix
   sums (a word of any length emits as many rows as it has runs of equal letters, none longer than a few numbers). Words
   that share a key and can be at distance one by the places of their deletions meet in an equi-join; a key is shared by
   the words that one letter more makes of it, so no key grows with the corpus. Spelling decides in the end;
3. a word's form is its commonest neighbour, if that is common enough; roots are found by joining the table of forms with
   itself, which doubles the reach each time. A form is at least twice as common, so chains are short and never close.

Defined results: null texts have no words; rows that share a doc_id count each; a null doc_id counts as the empty string
where occurrences are damaged; an empty table gives no row.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, arrow, i64, mix, shuffled, slices, small_batches

_RUN = re.compile("[A-Za-zÀ-ÿ]+")
#: Different words that a task counts before it hands them on.
HELD = 300_000
_STEP = 0x9E3779B97F4A7C15
_BACK = pow(_STEP, -1, 2**64)


def _counted(damage: int | None, min_length: int):
    made = pa.schema([("word", pa.string()), ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[str] = Counter()
        for batch in batches:
            for part in slices(batch, "text"):
                for doc_id, text in zip(part.column("doc_id").to_pylist(), part.column("text").to_pylist(), strict=True):
                    begin = f"{'' if doc_id is None else doc_id}:".encode()
                    # bytes.lower() lower-cases A-Z alone
                    for word, n in Counter(_RUN.findall((text or "").encode().lower().decode())).items():
                        if damage and (h := zlib.crc32(begin + word.encode())) % damage == 0:
                            at = h % len(word)
                            word = word[:at] + word[at + 1 :]
                        if len(word) >= min_length:
                            held[word] += n
                if len(held) >= HELD:
                    yield arrow({"word": list(held), "n": list(held.values())}, made)
                    held.clear()
        if held:
            yield arrow({"word": list(held), "n": list(held.values())}, made)

    return run


def vocabulary(docs: DataFrame, min_length: int = 5, min_count: int = 3, damage: int | None = None) -> DataFrame:
    """word, n: runs of Latin letters of docs' texts in lower case with at least so many letters and occurrences. damage:
    an occurrence whose number is a multiple of it loses a letter, so that there are misspellings to find."""
    small_batches(docs.sparkSession)
    rows = docs.select("doc_id", "text").mapInArrow(_counted(damage, min_length), "word string, n long")
    return rows.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= min_count)


_KEYS = pa.schema([("key", pa.int64()), ("id", pa.int64()), ("low", pa.int32()), ("high", pa.int32())])


def deletion_keys(words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(word's number, key, low, high) of each word and each of its distinct deletions. low to high are the places whose
    deletion gives the same; both are -1 for the word itself."""
    sizes = pc.utf8_length(words).to_numpy(zero_copy_only=False).astype(np.int64)
    letters = np.frombuffer("".join(words.to_pylist()).encode("utf-32-le"), np.uint32).astype(np.int64)
    ends = np.cumsum(sizes)
    starts, total = ends - sizes, len(letters)
    with np.errstate(over="ignore"):
        up, down = (np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(total + 1, b, np.uint64)])) for b in (_STEP, _BACK))
        sums = np.zeros(total + 1, np.uint64)
        np.cumsum(mix(letters.astype(np.uint64) + np.uint64(1)) * up[:total], out=sums[1:])
        whole = mix((sums[ends] - sums[starts]) * down[starts])
        owner = np.repeat(np.arange(len(sizes)), sizes)
        new = np.ones(total, bool)  # where a run of equal letters begins
        new[1:] = (letters[1:] != letters[:-1]) | (owner[1:] != owner[:-1])
        at = np.flatnonzero(new)
        who = owner[at]
        until = np.append(at[1:], total) - 1
        rest = (sums[at] - sums[starts[who]]) + (sums[ends[who]] - sums[at + 1]) * np.uint64(_BACK)
        keys = mix(rest * down[starts[who]])
    none = np.full(len(sizes), -1)
    return np.concatenate([np.arange(len(sizes)), who]), np.concatenate([whole, keys]), np.concatenate([none, at - starts[who]]), np.concatenate([none, until - starts[who]])


def _emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "word", 1 << 20):
            who, key, low, high = deletion_keys(part.column("word"))
            yield arrow({"key": i64(key), "id": part.column("id").to_numpy()[who], "low": low.astype(np.int32), "high": high.astype(np.int32)}, _KEYS)


def neighbours(words: DataFrame) -> DataFrame:
    """a, b: ids of words (id, word, n; a written table) at a distance of one, in both directions, each pair once."""
    keys = words.select("id", "word").mapInArrow(_emit, "key long, id long, low int, high int")
    a, b = (keys.select("key", *(F.col(c).alias(f"{c}_{s}") for c in ("id", "low", "high"))) for s in "ab")
    # one is the other's deletion, or both lack the same place: then they differ in that place alone
    near = F.expr("id_a <> id_b and if(low_a < 0 or low_b < 0, (low_a < 0) <> (low_b < 0), low_a <= high_b and low_b <= high_a)")
    met = a.join(shuffled(b), "key").filter(near).select(F.col("id_a").alias("a"), F.col("id_b").alias("b")).distinct()
    left, right = (words.select(F.col("id").alias(s), F.col("word").alias(f"word_{s}")) for s in "ab")
    return met.join(shuffled(right), "b").join(shuffled(left), "a").filter(F.levenshtein("word_a", "word_b", 1) == 1).select("a", "b", "word_b")


def roots(forms: DataFrame, scratch: Scratch) -> DataFrame:
    """id, root: the end of each chain id -> form (both long) of forms, which must not close. Each round doubles the reach."""
    k, held = 0, scratch.write(forms.select("id", F.col("form").alias("root")), "roots-0")
    while True:
        k += 1
        further = held.select(F.col("id").alias("root"), F.col("root").alias("next"))
        now = held.join(shuffled(further), "root", "left").select("id", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved"))
        now = scratch.write(now, f"roots-{k}")
        if now.filter("moved").isEmpty():
            return now.select("id", "root")
        held = now.select("id", "root")


def spelling_variants(docs: DataFrame, min_length: int = 5, min_count: int = 3, ratio: int = 2, damage: int | None = None) -> DataFrame:
    """A row for each word of docs (doc_id, text): word, form, root, n, n_near, form_n."""
    scratch = Scratch(docs.sparkSession, "spelling")
    words = scratch.write(vocabulary(docs, min_length, min_count, damage).withColumn("id", F.monotonically_increasing_id()), "words")
    near = neighbours(words).join(shuffled(words.select(F.col("id").alias("b"), F.col("n").alias("n_b"))), "b")
    best = F.min(F.struct((-F.col("n_b")).alias("less"), F.col("word_b").alias("form"), F.col("b").alias("form_id"))).alias("best")
    tied = near.groupBy(F.col("a").alias("id")).agg(F.count(F.lit(1)).alias("n_near"), best)
    known = words.join(shuffled(tied), "id", "left").withColumn("form_n", -F.col("best.less"))
    enough = F.col("form_n") >= ratio * F.col("n")
    known = known.select("id", "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), *(F.when(enough, F.col(c)).alias(a) for c, a in (("best.form", "form"), ("form_n", "form_n"), ("best.form_id", "form_id"))))
    known = scratch.write(known, "known")
    ends = roots(known.filter("form_id is not null").select("id", F.col("form_id").alias("form")), scratch)
    ends = ends.join(shuffled(words.select(F.col("id").alias("root"), F.col("word").alias("root_word"))), "root").select("id", "root_word")
    return known.join(shuffled(ends), "id", "left").select("word", "form", F.coalesce("root_word", "word").alias("root"), "n", "n_near", "form_n")
