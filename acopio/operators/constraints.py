"""Keys as declarations: what violates them, and deletions that follow foreign keys."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.scratch import Scratch


@dataclass(frozen=True)
class Unique:
    """Columns whose values no two rows share; null values are never equal. primary: null values are violations, too."""

    table: str
    columns: tuple[str, ...]
    primary: bool = False


@dataclass(frozen=True)
class Foreign:
    """Columns whose values, if none is null, must be those of a row of another table."""

    table: str
    columns: tuple[str, ...]
    to: str
    to_columns: tuple[str, ...]


#: The keys of the tables of sources, runs and files.
KEYS = (
    Unique("spider_config", ("id",), True), Unique("spider_config", ("name",)), Unique("scrape_run", ("id",), True), Unique("scraped_file", ("checksum",), True),
    Unique("run_file", ("id",), True), Unique("run_file", ("run_id", "checksum")),
    Foreign("scrape_run", ("spider_name",), "spider_config", ("name",)), Foreign("run_file", ("run_id",), "scrape_run", ("id",)), Foreign("run_file", ("checksum",), "scraped_file", ("checksum",)),
)


def _text(columns: tuple[str, ...]):
    return F.concat_ws("|", *(F.coalesce(F.col(c).cast("string"), F.lit("null")) for c in columns)).alias("value")


def violations(tables: dict[str, DataFrame], keys: tuple[Unique | Foreign, ...]) -> DataFrame:
    """table, rule, value, n: for each violated key the values in question and how many rows have them. rule: null,
    repeated or orphan, with the columns. Values are counted before they are compared, so a value of a million rows is one
    row of a join."""
    found = []
    for k in keys:
        names = ",".join(k.columns)
        counts = tables[k.table].groupBy(*k.columns).agg(F.count(F.lit(1)).alias("n"))
        some_null = reduce(lambda a, b: a | b, (F.col(c).isNull() for c in k.columns))
        report = lambda rows, rule, k=k, names=names: rows.select(F.lit(k.table).alias("table"), F.lit(f"{rule} {names}").alias("rule"), _text(k.columns), "n")
        if isinstance(k, Foreign):
            there = tables[k.to].select(*(F.col(c).alias(a) for c, a in zip(k.to_columns, k.columns, strict=True))).distinct()
            found.append(report(counts.filter(~some_null).join(there, list(k.columns), "left_anti"), "orphan"))
            continue
        found.append(report(counts.filter(~some_null & (F.col("n") > 1)), "repeated"))
        if k.primary:
            found.append(report(counts.filter(some_null), "null"))
    return reduce(DataFrame.unionByName, found)


def deleted(tables: dict[str, DataFrame], keys: tuple[Unique | Foreign, ...], table: str, rows: DataFrame, scratch: Scratch) -> dict[str, DataFrame]:
    """The tables after deleting rows (its columns name some of table's: all rows that agree in them go) and, to a fixed
    point, every row whose foreign key leads to a deleted row. Each round is a semi-join on the keys of what went in the
    round before; keys are given once each, so a row that many rows lead to is no hot key."""
    own = [c for c in rows.columns]
    gone = {table: scratch.write(tables[table].join(rows.distinct(), own, "left_semi"), f"gone-{table}-0")}
    left = {**tables, table: scratch.write(tables[table].join(rows.distinct(), own, "left_anti"), f"left-{table}-0")}
    k = 0
    while gone:
        k += 1
        more: dict[str, DataFrame] = {}
        for f in (f for f in keys if isinstance(f, Foreign) and f.to in gone):
            lost = gone[f.to].select(*(F.col(c).alias(a) for c, a in zip(f.to_columns, f.columns, strict=True))).distinct()
            # a value that another row still has is no loss
            lost = lost.join(left[f.to].select(*(F.col(c).alias(a) for c, a in zip(f.to_columns, f.columns, strict=True))), list(f.columns), "left_anti")
            name = f"{f.table}-{'-'.join(f.columns)}-{k}"
            hit = scratch.write(left[f.table].join(lost, list(f.columns), "left_semi"), f"gone-{name}")
            if not hit.isEmpty():
                left[f.table] = scratch.write(left[f.table].join(lost, list(f.columns), "left_anti"), f"left-{name}")
                more[f.table] = more[f.table].unionByName(hit) if f.table in more else hit
        gone = more
    return {name: rows.select(*tables[name].columns) for name, rows in left.items()}
