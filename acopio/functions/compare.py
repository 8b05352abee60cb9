"""Comparing two names: exact, reordered, phonetic or not alike, with a score."""

from __future__ import annotations

from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from .text import id_number, name_tokens, normalize_name, phonetic_tokens

ALIKE, REORDERED = 0.82, 0.98


@F.pandas_udf(StructType([StructField("score", DoubleType()), StructField("rounded", DoubleType())]))
def scored(a: pd.Series, b: pd.Series, contained: pd.Series) -> pd.DataFrame:
    """score: the larger of containment and the Ratcliff-Obershelp similarity, which depends on the order of the names;
    with a null name containment alone. rounded: that to three places, as Python rounds."""
    best = [c if x is None or y is None else max(c, SequenceMatcher(None, x, y).ratio()) for x, y, c in zip(a, b, contained, strict=True)]
    return pd.DataFrame({"score": best, "rounded": [round(s, 3) for s in best]}, dtype="float64")


scored = scored.asNondeterministic()  # so that no plan runs it twice


def containment(fa: Column, fb: Column) -> Column:
    """Phonetic tokens in common, as a share of the smaller set."""
    low = F.least(F.size(fa), F.size(fb))
    return F.when(low > 0, F.size(F.array_intersect(fa, fb)) / low).otherwise(0.0)


def same_tokens(a: Column, b: Column) -> Column:
    return F.sort_array(F.array_distinct(name_tokens(a))) == F.sort_array(F.array_distinct(name_tokens(b)))


def needs_ratio(a: Column, b: Column, contained: Column, floor: float = 0.0) -> Column:
    """Whether the ratio can exceed containment and the larger of them can reach the floor: the ratio is at most twice
    the shorter length over both lengths."""
    la, lb = F.length(a), F.length(b)
    most = 2 * F.least(la, lb) / F.greatest(la + lb, F.lit(1))
    return (a != b) & (contained < 1) & (most > contained) & ((most >= floor) | (contained >= floor))


def category(a: Column, b: Column, score: Column) -> Column:
    """Of normalized names and the larger of containment and ratio."""
    return F.when((a == "") | (b == ""), "no_coincide").when(a == b, "exacta").when(same_tokens(a, b), "exacta_reordenada").when(score >= ALIKE, "fonetica").otherwise("no_coincide")


def compare_names(df, left: str, right: str):
    """df with category and score for two name columns; the ratio runs only on rows whose score it can change."""
    df = df.withColumns({"_a": normalize_name(F.col(left)), "_b": normalize_name(F.col(right))})
    df = df.withColumn("_c", containment(phonetic_tokens(F.col("_a")), phonetic_tokens(F.col("_b"))))
    a, b = F.col("_a"), F.col("_b")
    need = (a != "") & (b != "") & needs_ratio(a, b, F.col("_c")) & ~same_tokens(a, b)
    df = df.withColumn("_s", scored(F.when(need, a), F.when(need, b), F.col("_c")))
    df = df.withColumn("category", category(a, b, F.col("_s.score")))
    score = F.when((a == "") | (b == ""), 0.0).when(F.col("category") == "exacta", 1.0).when(F.col("category") == "exacta_reordenada", REORDERED).otherwise(F.col("_s.rounded"))
    return df.withColumn("score", score).drop("_a", "_b", "_c", "_s")


def tier(id_a: Column, id_b: Column, score: Column, age_a: Column, age_b: Column) -> Column:
    """ALTA: equal id numbers; MEDIA: full score and equal whole ages; else BAJA."""
    return grade(id_number(id_a), id_number(id_b), score, age_a.try_cast("int"), age_b.try_cast("int"))


def grade(number_a: Column, number_b: Column, score: Column, age_a: Column, age_b: Column) -> Column:
    """The tier of id numbers and whole ages that are worked out already."""
    return F.when(number_a == number_b, "ALTA").when((score == 1.0) & (age_a == age_b), "MEDIA").otherwise("BAJA")
