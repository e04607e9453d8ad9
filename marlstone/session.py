"""Sessions with the settings that the engine counts on."""

from __future__ import annotations

from pyspark.sql import SparkSession

#: What the engine's results or plans depend on.
SETTINGS = {
    "spark.sql.ansi.enabled": "true",  # overflow is an error
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.legacy.timeParserPolicy": "CORRECTED",
}


def session(master: str | None = None, shuffle_partitions: int | None = None, **settings: str) -> SparkSession:
    builder = SparkSession.builder.appName("marlstone")
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in {**SETTINGS, **settings}.items():
        builder = builder.config(k, v)
    return builder.getOrCreate()
