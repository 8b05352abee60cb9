"""Probable duplicates among person rows: two-level blocks, staged comparison, tiers, clusters and estimates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.compare import ALIKE, containment, grade, needs_ratio, same_tokens, scored
from ..functions.text import id_number, name_tokens, normalize_name, normalize_place, phonetic_code, phonetic_tokens
from ..plans.scratch import Scratch, shuffled
from .components import connected_components

SPLIT, PREFIX, AGE_GAP = 60, 3, 2
#: Rows (or names) of a group that meet in one task, about: their pairs are some ten thousand.
CELL = 256
#: Rows of a name that travel as one, about: two such parts make some thousand pairs.
PART = 64
NAME = ["block_key", "place", "plain", "norm"]
NO_SECOND = "(sin_segundo)"


def prepared(people: DataFrame) -> DataFrame:
    """Each named row with its normalized name, tokens and codes, worked out once."""
    df = people.filter(F.coalesce("nombre", F.lit("")) != "").withColumn("norm", normalize_name(F.col("nombre")))
    tokens = name_tokens(F.col("norm"))
    first, second = F.get(tokens, F.lit(0)), F.get(tokens, F.lit(1))
    return df.withColumns({"codes": phonetic_tokens(F.col("norm")), "code": phonetic_code(first), "second": phonetic_code(second)})


def blocked(people: DataFrame, split: int = SPLIT, prefix: int = PREFIX, scratch: Scratch | None = None) -> DataFrame:
    """prepared rows with block_key: the first token's code, or where over split rows share it, that and the start of the
    second token's code. Codes are counted by an aggregate that is joined back, so a common code is no single task. With
    scratch, normalized names and codes are worked out once and written, as counting and pairing read the rows again."""
    rows = prepared(people).filter(F.coalesce("code", F.lit("")) != "")
    if scratch:
        keep = [c for c in ("id", "nombre", "edad", "cedula", "hospital") if c in people.columns]
        rows = scratch.write(rows.select(*keep, "norm", "codes", "code", "second"), "prepared")
    sizes = rows.groupBy("code").agg(F.count(F.lit(1)).alias("freq"))
    start = F.when(F.coalesce("second", F.lit("")) == "", NO_SECOND).otherwise(F.substring("second", 1, prefix))
    return rows.join(sizes, "code").withColumn("block_key", F.when(F.col("freq") <= split, F.col("code")).otherwise(F.concat_ws(":", "code", start)))


def block_stats(blocks: DataFrame) -> DataFrame:
    n = F.count(F.lit(1))
    return blocks.groupBy("block_key").agg(n.alias("n")).withColumn("pairs", (F.col("n") * (F.col("n") - 1) / 2).cast("long"))


def block_histogram(people: DataFrame, split: int = SPLIT) -> DataFrame:
    """One-level blocks by size class: 1, 2 to split, more."""
    sizes = first_codes(people)
    label = F.when(F.col("n") == 1, "1").when(F.col("n") <= split, f"2-{split}").otherwise(f">{split}")
    return sizes.groupBy(label.alias("size_class")).agg(F.count(F.lit(1)).alias("blocks"), F.sum("n").alias("people"))


def first_codes(people: DataFrame) -> DataFrame:
    """code, n: rows of each one-level block."""
    return prepared(people).filter(F.coalesce("code", F.lit("")) != "").groupBy("code").agg(F.count(F.lit(1)).alias("n"))


def largest_blocks(people: DataFrame, split: int = SPLIT, most: int = 15) -> DataFrame:
    """The largest of the one-level blocks over split: code, n."""
    return first_codes(people).filter(F.col("n") > split).orderBy(F.desc("n"), "code").limit(most)


def block_coverage(people: DataFrame, split: int = SPLIT, limit: int = 500) -> DataFrame:
    """One row: how many one-level blocks have 2 to split rows, whether a limit on blocks covers them, how many it leaves."""
    small = F.count_if(F.col("n").between(2, split))
    return first_codes(people).agg(F.count(F.lit(1)).alias("blocks"), small.alias("comparable"), (small <= limit).alias("covered"), F.greatest(small - limit, F.lit(0)).cast("long").alias("left_out"))


def cells(rows: DataFrame, by: list[str], ident: tuple[str, ...] = ("id",)) -> tuple[DataFrame, DataFrame]:
    """Two copies of rows, to be joined on by, _i and _j, that bring any two rows of a group together once: a group of
    over CELL rows is cut into chunks by hash, and each pair of chunks is a cell of its own. Chunk i of the first copy
    goes to the cells (i, j >= i), chunk j of the second to (i <= j, j); within (i, i) the ids tell the two apart. So a
    group's pairs are dealt to as many keys as they need, of about equal numbers, whatever its size is."""
    large = rows.groupBy(*by).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > CELL)
    dealt = rows.join(large, by, "left").withColumn("_g", F.coalesce(F.ceil(F.col("_n") / CELL), F.lit(1)).cast("int"))
    dealt = dealt.withColumn("_c", F.pmod(F.xxhash64(*ident), F.col("_g")).cast("int"))
    first = dealt.withColumns({"_i": F.col("_c"), "_j": F.explode(F.sequence("_c", F.col("_g") - 1))})
    second = dealt.withColumns({"_j": F.col("_c"), "_i": F.explode(F.sequence(F.lit(0), F.col("_c")))})
    return first.drop("_n", "_g", "_c"), second.drop("_n", "_g", "_c")


def compared_rows(blocks: DataFrame, scratch: Scratch | None = None) -> DataFrame:
    """Rows of blocks with what a pair is judged by: place, age, plain (the name without case) and number."""
    rows = blocks.filter(F.col("id").isNotNull()).withColumns({"place": normalize_place(F.col("hospital")), "age": F.col("edad").try_cast("int"), "plain": F.lower(F.trim("nombre")), "number": id_number(F.col("cedula"))})
    return scratch.write(rows, "rows") if scratch else rows


def name_pairs(rows: DataFrame, scratch: Scratch | None = None) -> DataFrame:
    """Pairs of names that differ, of a block and place, each once however many rows have them: of both plain, norm, codes,
    n, least and most (ids). a is the one with the least id."""
    names = rows.groupBy(*NAME).agg(F.first("codes").alias("codes"), F.count(F.lit(1)).alias("n"), F.min("id").alias("least"), F.max("id").alias("most"))
    names = scratch.write(names, "names") if scratch else names
    by, keep = NAME[:2], ["least", *NAME[2:], "codes", "n", "most"]
    a, b = (side.select(*by, "_i", "_j", F.struct(*keep).alias(s)) for side, s in zip(cells(names, by, (*NAME[2:],)), "ab", strict=True))
    before = F.struct(*(F.col(f"a.{c}") for c in keep[:3])) < F.struct(*(F.col(f"b.{c}") for c in keep[:3]))
    met = a.join(shuffled(b), [*by, "_i", "_j"]).filter(((F.col("_i") < F.col("_j")) | before) & (F.col("a.plain") != F.col("b.plain")))
    met = met.select(*by, F.when(before, F.col("a")).otherwise(F.col("b")).alias("a"), F.when(before, F.col("b")).otherwise(F.col("a")).alias("b"))
    return met.select(*by, *(F.col(f"{s}.{c}").alias(f"{c}_{s}") for s in "ab" for c in keep))


def _near(a: Column, b: Column) -> Column:
    return a.isNull() | b.isNull() | (F.abs(a - b) <= AGE_GAP)


def _side(columns: list[str], s: str, shared: list[str] = NAME[:2]) -> list[str]:
    """The columns as pairs have them of their a or b; what is the same in both is there once."""
    return [c if c in shared else f"{c}_{s}" for c in columns]


def row_pairs(pairs: DataFrame, rows: DataFrame, keep: list[str]) -> DataFrame:
    """Pairs of rows a.id < b.id with compatible ages, of pairs of names: block_key, place, keep of both, and score, which is
    that of the names in this order (a's row first: score, b's row first: back); without one a pair is left out. Rows of a
    name travel in parts of about PART, and each pair of parts is a row until its pairs are made in place; they are dealt to
    a set number of tasks, as their size says little about their pairs."""
    large = rows.groupBy(*NAME).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > PART)
    part = lambda n: F.greatest(F.ceil(n / PART), F.lit(1)).cast("int")
    dealt = rows.join(large, NAME, "left").withColumn("part", F.pmod(F.xxhash64("id"), part(F.coalesce("_n", F.lit(1)))).cast("int"))
    parts = shuffled(dealt.groupBy(*NAME, "part").agg(F.collect_list(F.struct(*dict.fromkeys(["id", "age", *keep]))).alias("who")))
    for s in "ab":
        pairs = pairs.withColumn(f"part_{s}", F.explode(F.sequence(F.lit(0), part(F.col(f"n_{s}")) - 1)))
    on = [*NAME, "part"]
    pairs = pairs.join(parts.toDF(*_side(parts.columns, "a")), _side(on, "a"))
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    pairs = pairs.repartition(tasks, *_side(on, "b")).join(parts.toDF(*_side(parts.columns, "b")), _side(on, "b"))
    met = pairs.select(*NAME[:2], "score", "back", F.explode("who_a").alias("a"), "who_b").select(*NAME[:2], "score", "back", "a", F.explode("who_b").alias("b"))
    first = F.col("a.id") < F.col("b.id")
    met = met.filter((F.col("a.id") != F.col("b.id")) & _near(F.col("a.age"), F.col("b.age")) & F.when(first, F.col("score")).otherwise(F.col("back")).isNotNull())
    sides = {"a": ("a", "b"), "b": ("b", "a")}
    return met.select(*NAME[:2], F.when(first, F.col("score")).otherwise(F.col("back")).alias("score"), *(F.when(first, F.col(f"{x}.{c}")).otherwise(F.col(f"{y}.{c}")).alias(f"{c}_{s}") for s, (x, y) in sides.items() for c in keep))


def block_pairs(blocks: DataFrame) -> DataFrame:
    """Pairs a.id < b.id of a block whose names differ, whose ages are compatible and whose places are equal."""
    rows = compared_rows(blocks)
    every = name_pairs(rows).withColumns({"score": F.lit(1.0), "back": F.lit(1.0)})
    return row_pairs(every, rows, ["id", "nombre", "norm", "codes", "edad", "cedula", "hospital", "age", "plain"]).drop("score")


def contained_names(rows: DataFrame, scratch: Scratch | None = None, least: float = ALIKE) -> DataFrame:
    """Pairs of names alike by shared phonetic tokens alone, with score and back, which are the same."""
    pairs = name_pairs(rows, scratch).withColumn("score", F.round(containment(F.col("codes_a"), F.col("codes_b")), 3)).withColumn("back", F.col("score"))
    pairs = pairs.filter((F.col("score") >= least) & (F.col("norm_a") != "") & (F.col("norm_b") != "")).drop("codes_a", "codes_b")
    return scratch.write(pairs, "alike") if scratch else pairs


def alike_names(rows: DataFrame, scratch: Scratch | None = None) -> DataFrame:
    """Pairs of names alike by phonetic tokens or ratio, neither equal nor reordered, with score and back: the ratio depends
    on the order, and a row of either name may come first. Null: not alike in that order. The ratio, the only Python here,
    sees each pair of names once in each order that rows have, and only if it can change the outcome."""
    pairs = name_pairs(rows, scratch)
    a, b = F.col("norm_a"), F.col("norm_b")
    pairs = pairs.filter((a != "") & (b != "") & ~same_tokens(a, b)).withColumn("_c", containment(F.col("codes_a"), F.col("codes_b")))
    need = needs_ratio(a, b, F.col("_c"), ALIKE)
    pairs = pairs.filter(need | (F.col("_c") >= ALIKE)).drop("codes_a", "codes_b")
    turned = need & (F.col("least_b") < F.col("most_a"))
    pairs = pairs.withColumns({"_s": scored(F.when(need, a), F.when(need, b), F.col("_c")), "_t": scored(F.when(turned, b), F.when(turned, a), F.col("_c"))})
    pairs = pairs.withColumns({to: F.when(F.col(f"{s}.score") >= ALIKE, F.col(f"{s}.rounded")) for to, s in (("score", "_s"), ("back", "_t"))})
    pairs = pairs.filter(F.col("score").isNotNull() | F.col("back").isNotNull()).drop("_c", "_s", "_t")
    return scratch.write(pairs, "alike") if scratch else pairs


def containment_pairs(blocks: DataFrame, least: float = ALIKE, scratch: Scratch | None = None) -> DataFrame:
    """Pairs alike by shared phonetic tokens alone: id_a, id_b, score."""
    rows = compared_rows(blocks, scratch)
    return row_pairs(contained_names(rows, scratch, least), rows, ["id"]).select("id_a", "id_b", "score")


def candidates(blocks: DataFrame, scratch: Scratch | None = None) -> DataFrame:
    """Phonetic duplicates: id_a, id_b, nombre_a, nombre_b, score, tier. Equal and reordered names are not among them. With
    scratch, rows, names and pairs of names are worked out once and written."""
    rows = compared_rows(blocks, scratch)
    out = row_pairs(alike_names(rows, scratch), rows, ["id", "nombre", "age", "number"])
    out = out.withColumn("tier", grade(F.col("number_a"), F.col("number_b"), F.col("score"), F.col("age_a"), F.col("age_b")))
    return out.select("id_a", "id_b", "nombre_a", "nombre_b", "score", "tier")


def links(alike: DataFrame, rows: DataFrame, scratch: Scratch, tier: str = "") -> DataFrame:
    """id_a, id_b, tier: pairs of rows, enough of them to join what all pairs of alike names with compatible ages join (ALTA:
    all with equal numbers; MEDIA: all of full score and equal ages, those that are ALTA, too). A class is rows of equal
    name, age and, for ALTA, number. Where rows of class P pair with rows of Q that have larger ids, these stand for all:
    P's least id with Q's largest, each row of P with the largest of all such Q, each row of Q with the least of all such P.
    So they are one for two classes in each order and two a row at most, however many rows share names."""
    also = {"ALTA": ["number"], "MEDIA": ["years"]}.get(tier, [])
    shared, key = NAME[:2] + also, list(dict.fromkeys([*NAME, "years", *also]))
    rows = rows.withColumn("years", F.when(F.col("age").isNull(), "").otherwise(F.col("age").cast("string")))
    if tier:
        rows = rows.filter(F.col("number" if tier == "ALTA" else "age").isNotNull())
    classes = rows.groupBy(*key).agg(F.first("age").alias("age"), F.min("id").alias("least"), F.max("id").alias("most"))
    ways = [alike.select(*NAME[:2], *(F.col(f"{c}_{x}").alias(f"{c}_{s}") for x, s in zip(way, "ab", strict=True) for c in NAME[2:]), F.col(score).alias("score")) for way, score in (("ab", "score"), ("ba", "back"))]
    met = ways[0].unionByName(ways[1]).filter(F.col("score") == 1.0 if tier == "MEDIA" else F.col("score").isNotNull()).drop("score")
    met = met.join(shuffled(classes.toDF(*_side(classes.columns, "a", shared))), _side(NAME, "a"))
    met = met.join(shuffled(classes.toDF(*_side(classes.columns, "b", shared))), _side([*NAME, *also], "b", shared))
    met = scratch.write(met.filter(_near(F.col("age_a"), F.col("age_b")) & (F.col("least_a") < F.col("most_b"))), f"classes-{tier}")
    last = met.groupBy(*_side(key, "a", shared)).agg(F.max("most_b").alias("hub")).toDF(*key, "hub")
    first = met.groupBy(*_side(key, "b", shared)).agg(F.min("least_a").alias("hub")).toDF(*key, "hub")
    out = met.select(F.col("least_a").alias("id_a"), F.col("most_b").alias("id_b"))
    out = out.unionByName(rows.join(shuffled(last), key).filter("id < hub").select(F.col("id").alias("id_a"), F.col("hub").alias("id_b")))
    out = out.unionByName(rows.join(shuffled(first), key).filter("hub < id").select(F.col("hub").alias("id_a"), F.col("id").alias("id_b")))
    return out.withColumn("tier", F.lit(tier))


def clusters(pairs: DataFrame, scratch: Scratch, tiers: tuple[str, ...]) -> DataFrame:
    """id, component over the pairs (id_a, id_b, tier) of some tiers."""
    edges = pairs.filter(F.col("tier").isin(*tiers)).select(F.col("id_a").alias("src"), F.col("id_b").alias("dst"))
    return connected_components(edges, scratch, "-".join(tiers))


def unique_estimate(total: int, components: DataFrame) -> DataFrame:
    """How many persons there may be: clusters, and rows outside of them."""
    c, n = F.countDistinct("component"), F.count(F.lit(1))
    return components.agg(c.alias("clusters"), (F.lit(total) - n).alias("outside"), (c + F.lit(total) - n).alias("estimate"))


def top_pairs(pairs: DataFrame, n: int = 40) -> DataFrame:
    return pairs.orderBy(F.desc("score"), "id_a", "id_b").limit(n)


