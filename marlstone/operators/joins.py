"""Joins. Catalyst picks the strategy; these add checks of size and ways around skew."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A side is broadcast only if the optimiser's estimate of it is below this.
MOST_BROADCAST_BYTES = 32 << 20


def estimated_bytes(df: DataFrame) -> int:
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def reference(df: DataFrame, most: int = MOST_BROADCAST_BYTES) -> DataFrame:
    """df, marked for broadcasting if it is small enough; a larger one is joined like any other."""
    return F.broadcast(df) if estimated_bytes(df) <= most else df


def join(left: DataFrame, right: DataFrame, on: str | Sequence[str] | Column | None = None, how: str = "inner", most_broadcast: int = MOST_BROADCAST_BYTES) -> DataFrame:
    """how: inner, left, right, full, semi, anti or cross."""
    right = reference(right, most_broadcast) if how != "full" else right
    if how == "cross" or on is None:
        return left.crossJoin(right)
    return left.join(right, on, {"semi": "left_semi", "anti": "left_anti", "full": "full_outer"}.get(how, how))


def salted_join(left: DataFrame, right: DataFrame, keys: Sequence[str], salts: int = 16, how: str = "inner") -> DataFrame:
    """A join whose left rows of a key are dealt over `salts` tasks; the right rows are sent to each of them. For a key
    that holds much of the left side where the right side has few rows of it. how: inner, left, semi or anti."""
    if how not in ("inner", "left", "semi", "anti"):
        raise ValueError(f"a salted join can't be {how}")
    rows = left.withColumn("__salt", (F.rand(17) * salts).cast("int"))
    copies = right.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return rows.join(copies, [*keys, "__salt"], {"semi": "left_semi", "anti": "left_anti"}.get(how, how)).drop("__salt")


def not_in(left: DataFrame, column: str, right: DataFrame, other: str) -> DataFrame:
    """Rows for which `column NOT IN (other of right)` is true: all if right is empty, none if it has a null. One
    row tells which; the rest is an anti join, which is dealt by its key."""
    state = right.agg(F.count(F.lit(1)).alias("n"), F.count(F.lit(1)) - F.count(other)).toDF("__n", "__nulls")
    known = right.select(F.col(other).alias("__other")).filter("__other is not null")
    tested = left.crossJoin(F.broadcast(state)).filter("__nulls = 0").filter((F.col("__n") == 0) | F.col(column).isNotNull())
    return tested.join(known, F.col(column) == F.col("__other"), "left_anti").drop("__n", "__nulls")
