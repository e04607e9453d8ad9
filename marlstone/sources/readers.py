"""Reading and writing tables outside the engine's stores."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marlstone.functions.hashing import shard_column, split_column
from marlstone.sources.store import PART


def parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def csv(spark: SparkSession, path: str, schema: str, **options: str) -> DataFrame:
    """A schema is asked for: inferring one would read the data twice."""
    return spark.read.schema(schema).options(**options).csv(path)


def json(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).json(path)


def orc(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.orc(path)


def jdbc_shards(spark: SparkSession, urls: Sequence[str], table: str, properties: Mapping[str, str], column: str | None = None, bounds: tuple[int, int] | None = None, partitions: int = 8) -> DataFrame:
    """One table that lies on several databases, read side by side; each database in `partitions` ranges of `column`.
    Its driver has to be on the class path."""
    frames = []
    for url in urls:
        ranges = {"column": column, "lowerBound": bounds[0], "upperBound": bounds[1], "numPartitions": partitions} if column and bounds else {}
        frames.append(spark.read.jdbc(url, table, properties=dict(properties), **ranges))
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def write_sharded(rows: DataFrame, path: str, key: str, shards: Sequence[str]) -> None:
    """Rows by shard, in folders that a predicate on the key prunes."""
    rows.withColumn(PART, shard_column(F.col(key), shards)).write.partitionBy(PART).parquet(path)


def write_split(rows: DataFrame, path: str, key: str, algorithm: str, tables: int) -> None:
    rows.withColumn(PART, split_column(F.col(key), algorithm, tables)).write.partitionBy(PART).parquet(path)
