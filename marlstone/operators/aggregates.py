"""Aggregates with MySQL's rules."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def average(x: Column, scale: int | None = None) -> Column:
    """AVG; with a scale, the sum over the count rounded half up, as a decimal."""
    if scale is None:
        return F.avg(x)
    count = F.count(x)
    return F.round(F.sum(x) / F.nullif(count, F.lit(0)), scale).cast(f"decimal(38, {scale})")


def group_concat(x: Column, separator: str = ",", distinct: bool = False) -> Column:
    return F.listagg_distinct(x.cast("string"), F.lit(separator)) if distinct else F.listagg(x.cast("string"), F.lit(separator))


def grouped(df: DataFrame, keys: Sequence[str], *aggregates: Column, bare: Sequence[str] = ()) -> DataFrame:
    """A group's aggregates, with any value of the columns in `bare`; without keys one row, also of an empty table."""
    values = [F.any_value(c).alias(c) for c in bare]
    return df.groupBy(*keys).agg(*values, *aggregates) if keys else df.agg(*values, *aggregates)


def salted_sum(df: DataFrame, keys: Sequence[str], column: str, salts: int = 16) -> DataFrame:
    """Exact distinct-free sums and counts of skewed keys by two rounds: what map-side sums leave of a hot key is dealt
    over `salts` tasks first."""
    first = df.withColumn("__salt", (F.rand(23) * salts).cast("int")).groupBy(*keys, "__salt").agg(F.sum(column).alias("__s"), F.count(column).alias("__n"))
    return first.groupBy(*keys).agg(F.sum("__s").alias("sum"), F.sum("__n").alias("count"))
