"""Due times of schedules given as five cron fields: minute, hour, day of month, month, day of week."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The fields in their order with their least and greatest values, and names that stand for numbers.
FIELDS = {"minute": (0, 59), "hour": (0, 23), "day": (1, 31), "month": (1, 12), "weekday": (0, 6)}
NAMES = {
    "month": ["jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec"],
    "weekday": ["sun", "mon", "tue", "wed", "thu", "fri", "sat"],
}


def _bound(which: int) -> Column:
    return F.get(F.array(*(F.lit(v[which]) for v in FIELDS.values())), F.col("i"))


def _number(text: str) -> Column:
    """A number in range or a name of the field i, else null."""
    names = {f"{k}{n}": v + FIELDS[kind][0] for k, kind in enumerate(FIELDS) for v, n in enumerate(NAMES.get(kind, []))}
    named = F.create_map(*(F.lit(x) for pair in names.items() for x in pair))
    value = F.when(F.col(text).rlike(r"^\d{1,4}$"), F.col(text).try_cast("int")).otherwise(F.try_element_at(named, F.concat("i", F.substring(text, 1, 3))))
    return F.when(value.between(F.col("low"), F.col("high")), value)


def expanded(schedules: DataFrame, cron: str = "schedule") -> DataFrame:
    """schedules with _minute, _hour, _day, _month and _weekday, the values of each field, and valid: there are five fields
    and each can be read, as a list of ``*``, ``a``, ``a-b``, ``*/step``, ``a-b/step`` of numbers or names (0 is Sunday);
    ranges that begin after their end go over the field's end. Every different text is read once."""
    texts = schedules.select(F.col(cron).alias("_cron")).distinct()
    fields = texts.withColumn("f", F.split(F.lower(F.trim("_cron")), r"\s+")).filter(F.size("f") == len(FIELDS))
    parts = fields.select("_cron", F.posexplode("f").alias("i", "field")).select("_cron", "i", F.explode(F.split("field", ",")).alias("part"))
    parts = parts.withColumns({"low": _bound(0), "high": _bound(1), "p": F.split("part", "/")}).withColumns({"span": F.get("p", F.lit(0)), "step": F.get("p", F.lit(1))})
    parts = parts.withColumns({"a": F.substring_index("span", "-", 1), "b": F.when(F.col("span").contains("-"), F.substr("span", F.locate("-", F.col("span")) + 1))})
    step = F.when(F.col("step").isNull(), 1).when(F.col("step").rlike(r"^\d{1,4}$"), F.nullif(F.col("step").try_cast("int"), F.lit(0)))
    parts = parts.withColumns({"first": F.when(F.col("span") == "*", F.col("low")).otherwise(_number("a")), "last": F.when(F.col("span") == "*", F.col("high")).otherwise(_number("b")), "by": step})
    alone = F.col("b").isNull() & (F.col("span") != "*") & F.col("step").isNull()
    parts = parts.withColumn("end", F.when(alone, F.col("first")).when(F.col("last") < F.col("first"), F.col("last") + F.col("high") - F.col("low") + 1).otherwise(F.col("last")))
    good = (F.size("p") <= 2) & F.col("by").isNotNull() & F.col("first").isNotNull() & F.col("end").isNotNull()
    values = F.transform(F.expr("sequence(first, end, by)"), lambda x: F.col("low") + F.pmod(x - F.col("low"), F.col("high") - F.col("low") + 1))
    parts = parts.withColumn("good", F.coalesce(good, F.lit(False))).withColumn("values", F.when(F.col("good"), values))
    # at most 60 different values of a field meet
    each = parts.groupBy("_cron", "i").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_set("values")))).alias("values"), F.min("good").alias("good"))
    read = each.groupBy("_cron").agg(*(F.max(F.when(F.col("i") == k, F.col("values"))).alias(f"_{kind}") for k, kind in enumerate(FIELDS)), F.min("good").alias("_good"))
    return schedules.join(read, schedules[cron] == read["_cron"], "left").drop("_cron").withColumn("valid", F.coalesce("_good", F.lit(False))).drop("_good")


def due(schedules: DataFrame, start: Column, end: Column, cron: str = "schedule", enabled: str = "enabled", keep: tuple[str, ...] = ("name",)) -> DataFrame:
    """keep, due_at: the times from start (included) to end (not) at which enabled schedules of valid fields are due. Days
    must fit both day fields. Only days that fit are expanded, then the hours and minutes of the schedule, so the rows made
    are those that are due."""
    rows = expanded(schedules, cron).filter(F.col("valid") & F.col(enabled))
    first, last = F.to_date(start), F.to_date(end)
    rows = rows.withColumn("_date", F.explode(F.filter(F.sequence(first, last), lambda d: F.array_contains(F.col("_month"), F.month(d)) & F.array_contains(F.col("_day"), F.day(d)) & F.array_contains(F.col("_weekday"), F.dayofweek(d) - 1))))
    rows = rows.withColumn("_h", F.explode("_hour")).withColumn("_m", F.explode("_minute"))
    at = F.timestamp_add("MINUTE", F.col("_h") * 60 + F.col("_m"), F.col("_date").cast("timestamp"))
    return rows.withColumn("due_at", at).filter((F.col("due_at") >= start) & (F.col("due_at") < end)).select(*keep, "due_at")


def last_due(schedules: DataFrame, runs: DataFrame, now: Column, back: Column, cron: str = "schedule") -> DataFrame:
    """name, due_at, overdue: the latest due time of each schedule from back to now, and whether no run (spider_name,
    started_at) began since."""
    latest = due(schedules, back, now, cron).groupBy("name").agg(F.max("due_at").alias("due_at"))
    began = runs.groupBy(F.col("spider_name").alias("name")).agg(F.max("started_at").alias("began"))
    return latest.join(began, "name", "left").select("name", "due_at", (F.col("began").isNull() | (F.col("began") < F.col("due_at"))).alias("overdue"))
