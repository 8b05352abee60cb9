"""Quality rules as a short-circuit cascade, in built-in Spark functions only.

Every rule is a boolean column, true where it rejects. On a bounded sample each rule's cost (seconds a row) and
rejection rate are measured; rules then run in the order of rejection per cost, in one CASE, so a row pays for no rule
after the one that rejects it. The order changes the cost, never the verdict.

Counts of a text are worked out inside one row with array functions: nothing is exploded, so nothing is shuffled.
Defined results: a null text counts as empty; empty texts have no words and fail the base rule.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans.scratch import Scratch

#: White space between words, as a class of regular expressions and as characters.
SPACE_CLASS, SPACE = r"[\x20\x09-\x0D]", " \t\n\x0b\x0c\r"
#: The sample on which cost and selectivity are estimated: rows, and bytes of a text in it, at most.
SAMPLE, SAMPLE_BYTES = 500, 1 << 16


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body of a value that is worked out once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def words(text: Column) -> Column:
    trimmed = F.btrim(text, F.lit(SPACE))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, SPACE_CLASS + "+"))


def repeated_words(w: Column) -> Column:
    """Words in windows of three that are found twice or more. Most texts end at the first comparison; the others sort
    their windows, keep the places of those equal to a neighbour, and add the words that each place covers anew."""
    n = F.size(w)
    windows = F.when(n < 3, F.array().cast("array<bigint>")).otherwise(
        F.transform(F.sequence(F.lit(0), n - 3), lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)))
    )

    def covered(places: Column) -> Column:
        steps = F.transform(places, lambda p, k: F.least(F.lit(3), F.coalesce(F.get(places, k + 1) - p, F.lit(3))))
        return F.aggregate(steps, F.lit(0), lambda a, b: a + b)

    def places(s: Column) -> Column:
        same = lambda x, k: F.coalesce(x["h"] == F.get(s, k - 1)["h"], F.lit(False)) | F.coalesce(x["h"] == F.get(s, k + 1)["h"], F.lit(False))
        return F.sort_array(F.transform(F.filter(s, same), lambda x: x["i"]))

    def count(t: Column) -> Column:
        ordered = F.sort_array(F.transform(t, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(t)) == F.size(t), F.lit(0)).otherwise(let(ordered, lambda s: let(places(s), covered)))

    return let(windows, count)


def with_counts(docs: DataFrame) -> DataFrame:
    """docs and _m, a struct of the text's counts."""
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(SPACE)) != "")
    only = lambda keep: F.length(F.regexp_replace(text, f"[^{keep}]+", ""))
    made = let(words(text), lambda w: F.struct(
        F.size(w).cast("long").alias("n_words"),
        F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
        repeated_words(w).cast("long").alias("n_repeat_words"),
    ))
    line = let(lines, lambda x: F.struct(F.size(x).cast("long").alias("n_lines"), (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines")))
    return docs.withColumns({"_w": made, "_l": line, "_n_symbols": only("#*$%&|<>").cast("long")})


@dataclass(frozen=True)
class Rule:
    """rejects: a column over the columns of with_counts and text."""

    name: str
    rejects: Column


def default_rules() -> list[Rule]:
    text, n = F.coalesce(F.col("text"), F.lit("")), F.col("_w.n_words")
    count = lambda pattern: F.regexp_count(text, F.lit(pattern))
    return [
        Rule("symbols", 100 * F.col("_n_symbols") > 30 * n),
        Rule("duplicate_lines", (F.col("_l.n_lines") > 4) & (100 * F.col("_l.n_dup_lines") > 60 * F.col("_l.n_lines"))),
        Rule("word_length", (F.col("_w.word_chars") < 2 * n) | (F.col("_w.word_chars") > 20 * n)),
        Rule("shouting", 100 * count(r"!!") > 30 * n),
        Rule("capitals", F.lit(2) * F.length(F.regexp_replace(text, r"[^\p{Lu}]+", "")) > F.col("_w.word_chars")),
    ]


def bounded_sample(docs: DataFrame, rows: int, most_bytes: int, scratch: Scratch) -> DataFrame:
    """Up to so many of the first documents that are not longer than most_bytes, with their counts, as a small table: it
    is read with as few partitions of docs as hold them, and worked out once."""
    some = docs.filter(F.octet_length(F.coalesce("text", F.lit(""))) <= most_bytes).limit(rows).collect()  # at most rows * most_bytes
    return scratch.write(with_counts(docs.sparkSession.createDataFrame(some, docs.schema).coalesce(1)), "sample")


def cascade_order(sample: DataFrame, rules: list[Rule], repeats: int = 4) -> list[tuple[Rule, float, float]]:
    """(rule, seconds a row, share rejected), most rejection per cost first. sample: a small table, counts at hand. Each
    rule works on the sample so many times over inside one task; what a job without any rule takes is taken off, and the
    faster of two runs counts, so that starting jobs is not taken for a rule's cost."""
    many = sample.withColumn("_again", F.explode(F.sequence(F.lit(1), F.lit(repeats))))

    def timed(bad: Column) -> tuple[float, int, int]:
        best = None
        for _ in range(2):
            began = time.perf_counter()
            got = many.agg(F.count_if(bad).alias("bad"), F.count(F.lit(1)).alias("n")).first()
            took = time.perf_counter() - began
            best = took if best is None else min(best, took)
        return best, got["bad"], got["n"]

    idle = timed(F.col("_again") < 0)[0]
    out = []
    for rule in rules:
        took, bad, n = timed(F.coalesce(rule.rejects, F.lit(False)))
        out.append((rule, max(1e-9, took - idle) / max(1, n), bad / max(1, n)))
    return sorted(out, key=lambda x: (-x[2] / x[1], x[0].name))


def verdict(ordered: list[Rule]) -> Column:
    """True if no rule rejects; stops at the first that does."""
    out = F.lit(True)
    for rule in reversed(ordered):
        out = F.when(F.coalesce(rule.rejects, F.lit(False)), False).otherwise(out)
    return out


def base_failed(n_words: Column, n_repeat_words: Column) -> Column:
    return (n_words < 50) | (100 * n_repeat_words > 50 * n_words)


def quality_rules(docs: DataFrame, rules: list[Rule] | None = None, sample_rows: int = SAMPLE, sample_bytes: int = SAMPLE_BYTES) -> DataFrame:
    """A row for each of docs (doc_id, text): doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    base_failed, kept."""
    rules = default_rules() if rules is None else rules
    docs = docs.select("doc_id", "text")
    scratch = Scratch(docs.sparkSession, "rules")
    order = [rule for rule, _, _ in cascade_order(bounded_sample(docs, sample_rows, sample_bytes, scratch), rules)]
    scratch.drop("sample")
    failed = base_failed(F.col("_w.n_words"), F.col("_w.n_repeat_words"))
    return with_counts(docs).select(
        "doc_id", "_w.n_words", "_w.word_chars", F.col("_n_symbols").alias("n_symbols"), "_l.n_dup_lines", "_w.n_repeat_words",
        failed.alias("base_failed"), F.when(failed, False).otherwise(verdict(order)).alias("kept"),
    )
