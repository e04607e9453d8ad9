"""What the engine knows of tables: keyspaces, shard keys, split tables, reference tables and sequences."""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from decimal import Decimal
from functools import cached_property
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marlstone.functions.hashing import ALGORITHMS, shard_column, shards_of, split_column
from marlstone.plans.errors import SqlError
from marlstone.sources.sequence import Sequence as IdSequence
from marlstone.sources.store import PART, Store

SYSTEM_SCHEMAS = ("information_schema", "performance_schema", "mysql", "sys")


@dataclass
class Table:
    """kind: unsharded, sharded (rows by the range of the key's hash), split (by an algorithm over actual tables),
    reference (small, joined everywhere) or pinned (all rows on one shard).

    rows: the rows, with the column PART if the table is dealt over partitions. A table that can be changed has a store.
    """

    name: str
    rows: Callable[[Sequence[int] | None], DataFrame]
    kind: str = "unsharded"
    key: str | None = None
    shards: tuple[str, ...] = ()
    algorithm: str | None = None
    actual: tuple[str, ...] = ()
    primary_key: tuple[str, ...] = ()
    auto_increment: str | None = None
    sequence: IdSequence | None = None
    store: Store | None = None
    #: Of other columns: the keys of rows with certain values, or None if there are too many.
    lookups: dict[str, Callable[[Sequence[Any]], list[Any] | None]] = field(default_factory=dict)
    views: dict[tuple[int, ...] | None, str] = field(default_factory=dict)

    @cached_property
    def key_type(self) -> T.DataType:
        schema = self.store.schema if self.store is not None else self.rows(None).schema
        return next(f.dataType for f in schema if f.name.lower() == self.key.lower())

    def key_of(self, value: Any) -> tuple[bool, Any]:
        """Whether the rows whose key equals the value have one key only, as it is hashed, and that key. Integers are
        also written as decimals, floats and text; values that equal several keys, or none for certain, are not known."""
        if value is None or isinstance(self.key_type, T.StringType):
            return value is None or isinstance(value, str), value
        if not isinstance(self.key_type, T.IntegralType) or not isinstance(value, (int, float, Decimal, str)):
            return False, None
        try:
            number = Decimal(str(int(value)) if isinstance(value, bool) else str(value).strip())
            return (True, int(number)) if number.is_finite() and number == number.to_integral_value() and abs(number) < 1 << 63 else (False, None)
        except ArithmeticError:
            return False, None

    @property
    def parts(self) -> int:
        return len(self.shards) if self.kind == "sharded" else len(self.actual) if self.kind == "split" else 1

    def place(self, values: Sequence[Any]) -> list[int]:
        """The partitions of keys."""
        if self.kind == "sharded":
            return shards_of(values, self.shards)
        if any(v is None for v in values):
            raise SqlError("cannot calculate split table, logic table: " + self.name)
        return [ALGORITHMS[self.algorithm](v, self.parts) for v in values]

    def placed(self, rows: DataFrame) -> DataFrame:
        """rows with their partitions."""
        if self.kind == "sharded":
            return rows.withColumn(PART, shard_column(F.col(self.key), self.shards))
        if self.kind == "split":
            return rows.withColumn(PART, F.coalesce(split_column(F.col(self.key), self.algorithm, self.parts), F.raise_error(F.lit(f"cannot calculate split table, logic table: {self.name}")).cast("int")))
        return rows.withColumn(PART, F.lit(0))


class Catalog:
    def __init__(self, spark: SparkSession, keyspace: str = "commerce"):
        self.spark, self.keyspace = spark, keyspace
        self.keyspaces: dict[str, dict[str, Table]] = {keyspace.lower(): {}}
        self.made = 0

    def add(self, table: Table, keyspace: str | None = None) -> Table:
        self.keyspaces.setdefault((keyspace or self.keyspace).lower(), {})[table.name.lower()] = table
        return table

    def add_frame(self, name: str, rows: DataFrame, keyspace: str | None = None, kind: str = "unsharded") -> Table:
        """A table that is only read. A reference table keeps its small size in view of the planner; whether it is
        broadcast is decided by that size."""
        return self.add(Table(name, lambda parts: rows, kind), keyspace)

    def add_folder(self, folder: str, names: Sequence[str], keyspace: str | None = None) -> None:
        """Tables <name>.parquet of a folder."""
        for n in names:
            self.add_frame(n, self.spark.read.parquet(f"{folder}/{n}.parquet"), keyspace)

    def add_sharded(self, name: str, rows: DataFrame, key: str, shards: Sequence[str], keyspace: str | None = None) -> Table:
        """rows carry the column PART, as write_sharded() leaves it in folders."""

        def read(parts: Sequence[int] | None) -> DataFrame:
            return rows if parts is None else rows.filter(F.col(PART).isin(list(parts)))

        return self.add(Table(name, read, "sharded", key, tuple(shards)), keyspace)

    def add_sequence(self, name: str, next_id: int = 1, cache: int = 1000, keyspace: str | None = None) -> Table:
        """A sequence table, for SELECT NEXT n VALUES."""
        sequence = IdSequence(next_id, cache)
        row = lambda parts: self.spark.createDataFrame([(0, sequence.next_id, sequence.cache)], "id int, next_id long, cache long")
        return self.add(Table(name, row, "sequence", sequence=sequence), keyspace)

    def add_lookup(self, table: Table, column: str, rows: DataFrame, value: str, key: str, most: int = 10_000) -> None:
        """A lookup table for another column of a sharded table: rows' `value` holds the column's values and `key` the
        shard keys of their rows. Values with more than `most` keys are looked for everywhere."""

        def keys_of(values: Sequence[Any]) -> list[Any] | None:
            found = rows.filter(F.col(value).isin(list(values))).select(key).distinct().limit(most + 1).collect()
            return [r[0] for r in found] if len(found) <= most else None

        table.lookups[column] = keys_of

    def add_split(self, name: str, actual: Mapping[str, DataFrame], key: str, algorithm: str, keyspace: str | None = None) -> Table:
        """A logical table of several actual ones; only those that a predicate on the key asks for are read."""
        frames = list(actual.values())

        def read(parts: Sequence[int] | None) -> DataFrame:
            chosen = [frames[p].withColumn(PART, F.lit(p)) for p in (range(len(frames)) if parts is None else parts)] or [frames[0].limit(0).withColumn(PART, F.lit(0))]
            out = chosen[0]
            for f in chosen[1:]:
                out = out.unionByName(f)
            return out

        return self.add(Table(name, read, "split", key, algorithm=algorithm, actual=tuple(actual)), keyspace)

    def create(
        self,
        name: str,
        schema: str | T.StructType,
        path: str,
        keyspace: str | None = None,
        shard_key: str | None = None,
        shards: Sequence[str] = (),
        split_key: str | None = None,
        algorithm: str | None = None,
        actual: Sequence[str] = (),
        primary_key: Sequence[str] = (),
        auto_increment: str | None = None,
        sequence: IdSequence | None = None,
    ) -> Table:
        """A table that can be changed, kept in a store under path; one that is there already is opened."""
        schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
        kind = "sharded" if shard_key else "split" if split_key else "unsharded"
        if auto_increment and sequence is None:
            sequence = IdSequence()
        table = Table(name, lambda parts: None, kind, shard_key or split_key, tuple(shards), algorithm, tuple(actual), tuple(primary_key), auto_increment, sequence)
        table.store = Store(self.spark, path, schema, table.parts)
        table.rows = lambda parts: table.store.read(None if parts is None else list(parts), with_part=True)
        return self.add(table, keyspace)

    def add_rules(self, rules: Mapping[str, Any], frames: Callable[[str, str], DataFrame]) -> None:
        """Split tables of a rule file's content: schemas with logicTables. frames(schema, actual name) gives rows."""
        for s in rules["schemas"]:
            for t in s["logicTables"]:
                actual = {n: frames(s["schema"], n) for n in actual_names(t["actualTableExprs"])}
                self.add_split(t["logicTable"], actual, t["shardingColumnName"], t["shardingAlgorithms"], s["schema"])

    def find(self, parts: Sequence[str], default: str | None = None) -> Table:
        keyspace = parts[-2].lower() if len(parts) > 1 else (default or self.keyspace).lower()
        tables = self.keyspaces.get(keyspace)
        if tables is None:
            raise SqlError(f"Unknown database '{keyspace}'")
        table = tables.get(parts[-1].lower())
        if table is None:
            raise SqlError(f"Table '{keyspace}.{parts[-1]}' doesn't exist")
        return table

    def view(self, table: Table, parts: Sequence[int] | None, shown: bool = False) -> str:
        """The name of a temporary view over the table's rows, of some partitions or of all."""
        chosen = None if parts is None or len(parts) == table.parts else tuple(parts)
        if table.store is None and chosen in table.views:
            return table.views[chosen]
        self.made += 1
        name = f"marlstone_{id(self) & 0xFFFFFF:x}_{self.made}"
        rows = table.rows(chosen)
        (rows.drop(PART) if PART in rows.columns else rows).createOrReplaceTempView(name)
        table.views[chosen] = name
        return name

    def information(self, name: str) -> DataFrame:
        """information_schema's schemata, tables and columns."""
        tables = [(k, t) for k, found in self.keyspaces.items() for t in found.values()]
        if name == "schemata":
            return self.spark.createDataFrame([("def", k) for k in self.keyspaces], "catalog_name string, schema_name string")
        if name == "tables":
            return self.spark.createDataFrame([("def", k, t.name, "BASE TABLE", t.kind) for k, t in tables], "table_catalog string, table_schema string, table_name string, table_type string, table_kind string")
        if name == "columns":
            rows = [("def", k, t.name, f.name, i, "YES" if f.nullable else "NO", f.dataType.simpleString(), "PRI" if f.name in t.primary_key else "") for k, t in tables for i, f in enumerate((f for f in t.rows(None).schema if f.name != PART), 1)]
            return self.spark.createDataFrame(rows, "table_catalog string, table_schema string, table_name string, column_name string, ordinal_position int, is_nullable string, data_type string, column_key string")
        raise SqlError(f"Unknown table '{name}' in information_schema")


def actual_names(expression: str) -> list[str]:
    """t_${1..4} stands for t_1 to t_4."""
    m = re.fullmatch(r"(.*)\$\{(\d+)\.\.(\d+)\}(.*)", expression.strip())
    return [f"{m[1]}{i}{m[4]}" for i in range(int(m[2]), int(m[3]) + 1)] if m else [x.strip() for x in expression.split(",")]
