"""Sharding by a K-d tree over document metadata.

A node that is to become k leaves is cut along its widest dimension (its range as a share of the whole table's range) at
the weighted quantile that gives each side bytes in proportion to its leaves. Cuts of all nodes of a level are found
together: a histogram of bytes over the keys of each node, refined inside the bin that holds the cut, so that only bins
are ever gathered, never rows. Text dimensions count by the rank of their values in byte order.

Documents of equal text make one unit, at the metadata of its smallest doc_id, and stay in one shard. Units over HEAVY of
a leaf are few (at most shards / HEAVY) and are placed one by one: those as heavy as a leaf take a shard of their own,
the others are dealt along the cut dimension in proportion, and the cut among the light units makes up the difference.
So sizes in bytes are near equal, as far as equal texts in one shard permit, whatever one source, language or text weighs.

Defined results: a null text has 0 bytes and the checksum 0; nulls in a dimension sort first; rows alike in every way
have slots of their own; ids may have any value.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch, keyed, numbered, running

_BINS = 12
#: A unit of copies is placed by itself above this share of a leaf; a cut is exact to this share of a leaf.
HEAVY, EXACT = 1 / 32, 1 / 2000
_KEY = ["_th", "text_crc32", "size"]


def ranks(docs: DataFrame, name: str, scratch: Scratch, table: str) -> DataFrame:
    """v, r: the distinct values of a text column and their rank in byte order, from 1. Ranges of values are ranked apart
    and shifted by the number of values before."""
    values = docs.select(F.col(f"`{name}`").alias("v")).filter("v is not null").distinct().repartitionByRange("v")
    values = scratch.write(values.withColumn("p", F.spark_partition_id()), table)
    starts, held = [], 0
    for p, n in sorted(tuple(r) for r in values.groupBy("p").agg(F.count(F.lit(1))).collect()):  # a row for each range
        starts.append((p, held))
        held += n
    starts = F.broadcast(scratch.spark.createDataFrame(starts, "p int, before long"))
    return values.join(starts, "p").select("v", (F.col("before") + F.row_number().over(Window.partitionBy("p").orderBy("v"))).alias("r"))


def _split(heavy: list[dict], dim: str, want: float, total: float) -> tuple[list[dict], list[dict]]:
    """Heavy units for the left side, which is to hold want of total bytes in all, and for the right one."""
    share, all_ = want / total if total else 0.0, sum(h["bytes"] for h in heavy)
    along = sorted(heavy, key=lambda h: (h[dim], h["unit"]))
    sums = [sum(h["bytes"] for h in along[:k]) for k in range(len(along) + 1)]
    k = min(range(len(sums)), key=lambda i: (abs(sums[i] - share * all_), i))
    if sums[k] <= want and all_ - sums[k] <= total - want:
        return along[:k], along[k:]
    sides, room = ([], []), [want, total - want]
    for h in sorted(heavy, key=lambda h: (-h["bytes"], h["unit"])):
        i = 0 if room[0] >= room[1] else 1
        sides[i].append(h)
        room[i] -= h["bytes"]
    return sides


def _level(units: DataFrame, heavy: list[dict], nodes: list[dict], dims: list[str], root: dict, leaf: float, scratch: Scratch, level: int) -> tuple[DataFrame, list[dict]]:
    """Cuts every node of more than one leaf; nodes: node, first (shard), leaves; heavy units get their new node."""
    spark = scratch.spark
    splitting = [n for n in nodes if n["leaves"] > 1]
    seen = {r["node"]: r.asDict() for r in units.groupBy("node").agg(F.sum("bytes").alias("bytes"), *(f(d).alias(f"{d}_{k}") for d in dims for k, f in (("lo", F.min), ("hi", F.max)))).collect()}
    cuts = []
    for n in splitting:
        r, mine = seen.get(n["node"]), [h for h in heavy if h["node"] == n["node"]]
        values = {d: [h[d] for h in mine] + ([r[f"{d}_lo"], r[f"{d}_hi"]] if r else []) for d in dims}
        spread = {d: (max(v) - min(v)) / max(1, root[d][1] - root[d][0]) if v else 0 for d, v in values.items()}
        d = max(dims, key=lambda x: spread[x])
        light, left = r["bytes"] if r else 0, n["leaves"] // 2
        total = light + sum(h["bytes"] for h in mine)
        sides = _split(mine, d, total * left / n["leaves"], total)
        for i, side in enumerate(sides):
            for h in side:
                h["node"] = 2 * n["node"] + 1 + i
        want = min(max(0.0, total * left / n["leaves"] - sum(h["bytes"] for h in sides[0])), light)
        cuts.append({"node": n["node"], "dim": dims.index(d), "lo": r[f"{d}_lo"] if r else 0, "hi": r[f"{d}_hi"] if r else 0, "a": 0, "b": 1 << 62, "want": want, "cut": None})
    made = "node int, dim int, lo double, width double"
    at = spark.createDataFrame([(c["node"], c["dim"], float(c["lo"]), max(1.0, float(c["hi"]) - float(c["lo"]))) for c in cuts], made)
    value = F.element_at(F.array(*(F.col(d).cast("double") for d in dims)), F.col("dim") + 1)
    place = F.least(F.greatest((value - F.col("lo")) / F.col("width"), F.lit(0.0)), F.lit(1.0))
    place = (place * (2**31 - 1)).cast("long")
    keys = units.join(F.broadcast(at), "node").withColumn("key", F.shiftleft(place, 31) + F.col("tie").bitwiseAND(2**31 - 1)).select("node", "key", "bytes", "unit")
    keys = scratch.write(keys, f"keys{level}")
    while todo := [c for c in cuts if c["cut"] is None]:
        now = spark.createDataFrame([(c["node"], c["a"], c["b"], max(0, (c["b"] - c["a"] - 1).bit_length() - _BINS), float(c["want"])) for c in todo], "node int, a long, b long, s int, want double")
        inside = keys.join(F.broadcast(now), "node").filter("key >= a and key < b").withColumn("bin", F.expr("shiftright(key - a, s)"))
        bins = inside.groupBy("node", "bin", "a", "s", "want").agg(F.sum("bytes").alias("w"))
        w = Window.partitionBy("node").orderBy("bin")
        bins = bins.withColumn("upto", F.sum("w").over(w)).withColumn("r", F.row_number().over(Window.partitionBy("node").orderBy(F.col("upto") < F.col("want"), F.when(F.col("upto") < F.col("want"), -F.col("bin")).otherwise(F.col("bin"))))).filter("r = 1")
        got = {r["node"]: r for r in bins.collect()}
        for c in todo:
            if (r := got.get(c["node"])) is None:
                c["cut"] = c["a"]
                continue
            start, end, under = c["a"] + (r["bin"] << r["s"]), c["a"] + ((r["bin"] + 1) << r["s"]), r["upto"] - r["w"]
            if r["s"] == 0 or r["w"] <= EXACT * leaf:
                c["cut"] = end if r["upto"] - c["want"] <= c["want"] - under else start
            else:
                c["a"], c["b"], c["want"] = start, min(end, c["b"]), c["want"] - under
    done = spark.createDataFrame([(c["node"], c["cut"]) for c in cuts], "node int, cut long")
    moved = keys.join(F.broadcast(done), "node").select("unit", (F.col("node") * 2 + F.when(F.col("key") < F.col("cut"), 1).otherwise(2)).cast("int").alias("to"))
    units = units.join(moved, "unit", "left").withColumn("node", F.coalesce("to", "node")).drop("to")
    units = scratch.write(units, f"units{level + 1}")
    scratch.drop(f"keys{level}")
    after = [n for n in nodes if n["leaves"] == 1]
    for n in splitting:
        left = n["leaves"] // 2
        after += [{"node": 2 * n["node"] + 1, "first": n["first"], "leaves": left}, {"node": 2 * n["node"] + 2, "first": n["first"] + left, "leaves": n["leaves"] - left}]
    return units, after


def _dimension(docs: DataFrame, name: str) -> Column:
    return F.col(f"`{name}`") if dict(docs.dtypes)[name] == "string" else F.coalesce(F.col(f"`{name}`").cast("long"), F.lit(-(2**63)).cast("long"))


def kd_shards(docs: DataFrame, shards: int | None = None, target_bytes: int | None = None, dims: tuple[str, ...] = ("lang", "source")) -> DataFrame:
    """A row for each of docs (doc_id, text and dims): doc_id, size, text_crc32, law, shard, slot, grown_shard. Give the
    number of shards, or a leaf's target_bytes; size and doc_id are always dimensions, too."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "kd")
    text, own = F.coalesce("text", F.lit("")), [f"_d{k}" for k in range(len(dims))]
    base = keyed(docs, *(_dimension(docs, d).alias(a) for a, d in zip(own, dims, strict=True)))
    base = base.select("doc_id", "_id", "_th", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"), *own)
    base = scratch.write(numbered(base).withColumn("unit", F.xxhash64(*_KEY)), "base")
    names = [*own, "_dsize", "_did"]
    total, rows = base.agg(F.coalesce(F.sum("size"), F.lit(0)), F.count(F.lit(1))).first()
    if shards is None:
        shards = max(1, -(-total // (target_bytes or 1 << 30)))
    units = base.groupBy("unit").agg(F.sum("size").alias("bytes"), F.min(F.struct("_id", *own, "size")).alias("m")).select("unit", "bytes", *(F.col(f"m.{d}").alias(d) for d in own), F.col("m.size").alias("size"), F.col("m._id").alias("_did"))
    for k, (d, a) in enumerate(zip(dims, own, strict=True)):
        if dict(docs.dtypes)[d] == "string":
            units = units.join(ranks(docs, d, scratch, f"values{k}"), F.col(a) == F.col("v"), "left").withColumn(a, F.coalesce("r", F.lit(0).cast("long"))).drop("v", "r")
    units = units.withColumn("_dsize", (F.log2(F.col("size").cast("double") + 1) * 2**20).cast("long")).drop("size")
    units = scratch.write(units.withColumn("tie", F.xxhash64("unit", F.lit(1))).withColumn("node", F.lit(0)), "all")
    bounds = units.agg(*(f(d).alias(f"{d}_{k}") for d in names for k, f in (("lo", F.min), ("hi", F.max)))).first().asDict()
    root = {d: (bounds[f"{d}_lo"] or 0, bounds[f"{d}_hi"] or 0) for d in names}
    leaf = max(1.0, total / shards)
    heavy = [r.asDict() for r in units.filter(F.col("bytes") > HEAVY * leaf).collect()]  # under shards / HEAVY of them
    heavy.sort(key=lambda h: (-h["bytes"], h["unit"]))
    placed, rest, left = {}, total, shards
    while heavy and left > 1 and heavy[0]["bytes"] >= rest / left:  # as heavy as a leaf: a shard of its own
        h, left = heavy.pop(0), left - 1
        placed[h["unit"]], rest = left, rest - h["bytes"]
    single = spark.createDataFrame([(u,) for u in [*placed, *(h["unit"] for h in heavy)]], "unit long")
    units = scratch.write(units.join(F.broadcast(single), "unit", "left_anti"), "units0")
    nodes, level = [{"node": 0, "first": 0, "leaves": left}], 0
    while rows and any(n["leaves"] > 1 for n in nodes):
        units, nodes = _level(units, heavy, nodes, names, root, max(1.0, rest / left), scratch, level)
        scratch.drop(f"units{level}")
        level += 1
    first = {n["node"]: n["first"] for n in nodes}
    placed |= {h["unit"]: first[h["node"]] for h in heavy}
    leaves = spark.createDataFrame(list(first.items()), "node int, shard int")
    where = F.broadcast(spark.createDataFrame(list(placed.items()), "unit long, own int"))
    kept = ["doc_id", "_id", "_th", "_u", "size", "text_crc32"]
    marked = base.join(where, "unit", "left")  # copies of a heavy text are never shuffled by it
    light = marked.filter("own is null").join(units.join(F.broadcast(leaves), "node").select("unit", "shard"), "unit")
    dealt = marked.filter("own is not null").select(*kept, F.col("own").alias("shard")).unionByName(light.select(*kept, "shard"))
    dealt = scratch.write(dealt, "dealt")
    out = running(dealt, ["shard"], [F.col("_id"), F.col("_th"), F.col("_u")], F.lit(1), "slot", rows)
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
