"""Sequences that give ids in blocks."""

from __future__ import annotations

from threading import Lock

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


class Sequence:
    """Ids from `next_id`; `cache` of them are reserved at a time, and what is left of a block is used first."""

    def __init__(self, next_id: int = 1, cache: int = 1000):
        self.next_id, self.cache = next_id, cache
        self._at = self._end = next_id
        self._lock = Lock()

    def take(self, n: int) -> int:
        """The first of n ids in a row."""
        with self._lock:
            if n <= 0:
                return self._at
            if self._at + n > self._end:
                blocks = -(-(n - (self._end - self._at)) // self.cache)
                if self._at == self._end:
                    self._at = self.next_id
                self._end = self.next_id + blocks * self.cache
                self.next_id = self._end
            first, self._at = self._at, self._at + n
            return first


def numbered(rows: DataFrame, column: str, sequence: Sequence) -> DataFrame:
    """rows whose nulls in `column` are replaced by the sequence's ids, densely: partitions are counted first, then
    each numbers its own rows from where the one before it ends. No task sees all rows."""
    marked = rows.withColumns({"__pid": F.spark_partition_id(), "__at": F.monotonically_increasing_id()})
    open_rows = marked.filter(F.col(column).isNull())
    counts = {r["__pid"]: r["n"] for r in open_rows.groupBy("__pid").agg(F.count(F.lit(1)).alias("n")).collect()}
    first = sequence.take(sum(counts.values()))
    starts, at = [], first
    for pid in sorted(counts):
        starts.append((pid, at))
        at += counts[pid]
    if not starts:
        return rows
    bases = rows.sparkSession.createDataFrame(starts, "__pid int, __base long")
    place = F.row_number().over(W.partitionBy("__pid", F.col(column).isNull()).orderBy("__at"))
    kind = rows.schema[column].dataType
    out = marked.withColumn("__place", place).join(F.broadcast(bases), "__pid", "left")
    return out.withColumn(column, F.coalesce(F.col(column), (F.col("__base") + F.col("__place") - 1).cast(kind))).select(*rows.columns)
