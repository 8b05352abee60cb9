"""Connected components by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.scratch import Scratch, shuffled


def connected_components(edges: DataFrame, scratch: Scratch, name: str = "components") -> DataFrame:
    """edges: src, dst (long), in any direction, with repeats and loops. Gives id, component (the least id reachable)
    for every id with an edge to another one. Nulls take no part. Each round hangs every node under smaller ones, so
    their number grows with the logarithm of a component's size; edges never grow in number."""
    e = edges.filter("src <> dst").select(F.greatest("src", "dst").alias("u"), F.least("src", "dst").alias("v")).distinct()
    e = scratch.write(e, f"{name}-0")
    before, k = None, 0
    while True:
        state = e.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), F.lit(0))).first()
        if tuple(state) == before or not state[0]:
            break
        before = tuple(state)
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v"))).repartition("u")  # one shuffle for the minimum and the join
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("m", "u").alias("m"))
        large = both.join(shuffled(least), "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).repartition("u")
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(shuffled(low), "u").select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
        k += 1
        e = scratch.write(small, f"{name}-{k}")
        scratch.drop(f"{name}-{k - 1}")
    roots = e.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()
    return e.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(roots)
