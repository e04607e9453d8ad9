"""Unions and their kin, with the checks of the dialect."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame

from marlstone.plans.errors import SqlError


def checked(left: DataFrame, right: DataFrame, strict: bool) -> None:
    if len(left.columns) != len(right.columns):
        raise SqlError("The used SELECT statements have a different number of columns")
    if strict and any(a.dataType != b.dataType for a, b in zip(left.schema, right.schema, strict=True)):
        raise SqlError("column field type does not match")


def union_all(*frames: DataFrame, strict: bool = False) -> DataFrame:
    """The rows of all, under the first one's names."""

    def both(a: DataFrame, b: DataFrame) -> DataFrame:
        checked(a, b, strict)
        return a.union(b)

    return reduce(both, frames)


def union(*frames: DataFrame, strict: bool = False) -> DataFrame:
    return union_all(*frames, strict=strict).distinct()


def except_rows(left: DataFrame, right: DataFrame, every: bool = False, strict: bool = False) -> DataFrame:
    checked(left, right, strict)
    return left.exceptAll(right) if every else left.subtract(right)


def intersect_rows(left: DataFrame, right: DataFrame, every: bool = False, strict: bool = False) -> DataFrame:
    checked(left, right, strict)
    return left.intersectAll(right) if every else left.intersect(right)
