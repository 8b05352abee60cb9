"""A Spark session with the settings that results depend on."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.showConsoleProgress": "false",
}


def session(master: str = "local[*]", name: str = "acopio", **more: str) -> SparkSession:
    builder = SparkSession.builder.master(master).appName(name)
    for key, value in {**SETTINGS, **{k.replace("__", "."): v for k, v in more.items()}}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
