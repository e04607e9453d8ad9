"""Order and limits. Nulls are smallest."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from marlstone.plans.errors import SqlError

Key = str | tuple[str, str]


def keys(by: Sequence[Key]) -> list[Column]:
    """Names, or (name, "desc")."""
    out = []
    for k in by:
        name, way = (k, "asc") if isinstance(k, str) else k
        out.append(F.col(name).desc_nulls_last() if way.lower() == "desc" else F.col(name).asc_nulls_first())
    return out


def ordered(df: DataFrame, by: Sequence[Key]) -> DataFrame:
    return df.orderBy(*keys(by)) if by else df


def limited(df: DataFrame, count: int, offset: int = 0) -> DataFrame:
    for n in (count, offset):
        if n < 0:
            raise SqlError("negative number cannot be converted to unsigned")
        if n >= 1 << 64:
            raise SqlError("requested limit is out of range")
    df = df.offset(offset) if offset else df
    return df.limit(min(count, (1 << 31) - 1))


def top(df: DataFrame, by: Sequence[Key], count: int, offset: int = 0) -> DataFrame:
    """The first rows by an order: each task keeps count + offset rows, one merges them."""
    return limited(ordered(df, by), count, offset)


def top_of_each(df: DataFrame, group: Sequence[str], by: Sequence[Key], count: int) -> DataFrame:
    """The first rows of each group. Spark cuts groups to `count` rows before the shuffle."""
    place = F.row_number().over(W.partitionBy(*group).orderBy(*keys(by)))
    return df.withColumn("__place", place).filter(F.col("__place") <= count).drop("__place")
