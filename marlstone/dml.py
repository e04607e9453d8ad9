"""INSERT, REPLACE, UPDATE and DELETE by copy on write.

A change reads and rewrites only the partitions that its WHERE can concern; an insert writes new folders only.
"""

from __future__ import annotations

from collections.abc import Mapping
from typing import TYPE_CHECKING, Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from marlstone.plans.ast import Delete, Expr, Insert, Order, Query, Statement, Update, conjuncts, expr, rebuilt
from marlstone.plans.errors import SqlError
from marlstone.plans.render import Renderer
from marlstone.sources.catalog import Table
from marlstone.sources.sequence import numbered
from marlstone.sources.store import PART

if TYPE_CHECKING:
    from marlstone.engine import Engine


def run(engine: Engine, statement: Statement, binds: Mapping[str, Any], shard: str | None) -> int:
    body = statement.body
    table = engine.catalog.find(body.table.parts, engine.keyspace)
    if table.store is None:
        raise SqlError(f"table '{table.name}' can only be read")
    if isinstance(body, Insert):
        if shard is not None:
            raise SqlError("unsupported: INSERT with a destination")
        return insert(engine, table, body, binds)
    if isinstance(body, Update):
        return update(engine, table, body, binds, shard)
    return delete(engine, table, body, binds, shard)


def value(engine: Engine, binds: Mapping[str, Any], e: Expr) -> Column:
    return F.expr(engine._renderer(binds, None, []).expr(e))


def insert(engine: Engine, table: Table, body: Insert, binds: Mapping[str, Any]) -> int:
    schema, store = table.store.schema, table.store
    names = {f.name.lower(): f for f in schema}
    columns = [c.lower() for c in body.columns] or list(names)
    unknown = [c for c in columns if c not in names]
    if unknown:
        raise SqlError(f"Unknown column '{unknown[0]}' in 'field list'")
    if body.rows is not None:
        if any(len(r) != len(columns) for r in body.rows):
            raise SqlError("Column count doesn't match value count at row 1")
        if table.kind == "split":
            keys = [dict(zip(columns, r, strict=True)).get(table.key.lower()) for r in body.rows]
            if any(k is None or (k.kind == "lit" and k.args[0] is None) for k in keys):
                raise SqlError(f"cannot calculate split table, logic table: {table.name}")
        renderer: Renderer = engine._renderer(binds, None, [])
        default = lambda e: "NULL" if e.kind == "col" and e.args[0][-1].upper() == "DEFAULT" else renderer.expr(e)
        selects = []
        for r in body.rows:
            given = dict(zip(columns, r, strict=True))
            selects.append("SELECT " + ", ".join(f"CAST({default(given[c]) if c in given else 'NULL'} AS {f.dataType.simpleString()}) AS `{f.name}`" for c, f in names.items()))
        new = engine.spark.sql(" UNION ALL ".join(selects)).coalesce(1)
    else:
        rows = engine._query(Statement(body.query), binds, None)
        if len(rows.columns) != len(columns):
            raise SqlError("Column count doesn't match value count at row 1")
        rows = rows.toDF(*[f"c{i}" for i in range(len(columns))])
        new = rows.select(*[(F.col(f"c{columns.index(c)}") if c in columns else F.lit(None)).cast(f.dataType).alias(f.name) for c, f in names.items()])
    if table.auto_increment:
        before = table.sequence.next_id
        first = table.sequence._at if table.sequence._at < table.sequence._end else before
        new = numbered(new, table.auto_increment, table.sequence)
        engine.last_insert_id = first
    if table.key:
        new = table.placed(new)
    else:
        new = new.withColumn(PART, F.lit(0))
    key = list(table.primary_key)
    if not key:
        if body.replace or body.on_duplicate:
            raise SqlError(f"table '{table.name}' has no primary key")
        count = new.count()
        store.append(new)
        return count
    return keyed_insert(engine, table, body, binds, new, key)


def keyed_insert(engine: Engine, table: Table, body: Insert, binds: Mapping[str, Any], new: DataFrame, key: list[str]) -> int:
    """The insert of rows whose keys may be there already."""
    store = table.store
    data = store.schema.names
    new = new.persist()
    try:
        parts = [r[0] for r in new.select(PART).distinct().collect()]
        old = store.read(None if table.key and table.key not in key else parts, with_part=True)
        total = new.count()
        if body.replace:
            numbered_rows = new.withColumn("__at", F.monotonically_increasing_id())
            latest = numbered_rows.withColumn("__rank", F.row_number().over(W.partitionBy(*key).orderBy(F.desc("__at")))).filter("__rank = 1").drop("__at", "__rank")
            replaced = old.join(new.select(*key).distinct(), key, "left_semi").count()
            store.replace(old.join(new.select(*key), key, "left_anti").select(*data, PART).unionByName(latest.select(*data, PART)), None if table.key and table.key not in key else parts)
            return total + replaced
        if body.ignore or body.on_duplicate:
            ranked = new.withColumn("__at", F.monotonically_increasing_id())
            ranked = ranked.withColumn("__rank", F.row_number().over(W.partitionBy(*key).orderBy("__at"))).drop("__at")
            most = ranked.agg(F.max("__rank")).first()[0] or 1
            if body.on_duplicate and most > 1:
                # rows with one key follow each other: the second one finds the first
                return sum(keyed_insert(engine, table, body, binds, ranked.filter(F.col("__rank") == r).drop("__rank"), key) for r in range(1, most + 1))
            unique = ranked.filter("__rank = 1").drop("__rank")
        else:
            unique = new.dropDuplicates(key)
        met = unique.join(old.select(*key), key, "left_semi")
        if body.on_duplicate:
            forbidden = {(table.key or "").lower(), *(k.lower() for k in key)}
            if any(c.lower() in forbidden for c, _ in body.on_duplicate):
                raise SqlError("unsupported: DML cannot change vindex column")
            fresh = unique.join(old.select(*key), key, "left_anti")
            renamed = met.select(*[F.col(c).alias(f"new__{c}") for c in data])
            matched = old.join(renamed, [F.col(k) == F.col(f"new__{k}") for k in key], "left")
            hit = F.col(f"new__{key[0]}").isNotNull()
            sets = {c.lower(): e for c, e in body.on_duplicate}
            changed = matched.select(*[(F.when(hit, value(engine, binds, new_values(sets[c.lower()])).cast(store.schema[c].dataType)).otherwise(F.col(c)) if c.lower() in sets else F.col(c)).alias(c) for c in data], PART)
            affected = fresh.count() + 2 * met.count()
            store.replace(changed.unionByName(fresh.select(*data, PART)), None if table.key and table.key not in key else parts)
            return affected
        if body.ignore:
            fresh = unique.join(old.select(*key), key, "left_anti")
            count = fresh.count()
            if count:
                store.append(fresh)
            return count
        if unique.count() < total or not met.isEmpty():
            raise SqlError("Duplicate entry for key 'PRIMARY'")
        store.append(new)
        return total
    finally:
        new.unpersist()


def new_values(e: Expr) -> Expr:
    """VALUES(c) is the value that was to be inserted."""
    if e.kind == "call" and e.args[0] == "VALUES":
        return expr("col", ("new__" + e.args[1][0].args[0][-1],))
    return rebuilt(e, new_values)


def concerned(engine: Engine, table: Table, ref: Any, where: Expr | None, binds: Mapping[str, Any], shard: str | None) -> list[int] | None:
    """The partitions that can hold matching rows; None for all."""
    if table.kind not in ("sharded", "split"):
        return None
    return list(engine._route(table, ref, conjuncts(where), binds, shard, True).parts)


def marked(engine: Engine, table: Table, ref: Any, where: Expr | None, order: list[Order], limit: Expr | None, binds: Mapping[str, Any], parts: list[int] | None) -> DataFrame:
    """The rows of the partitions, with `__hit` where the statement concerns them."""
    rows = table.store.read(parts, with_part=True).alias(ref.name)
    renderer: Renderer = engine._renderer(binds, None, [])
    hit = F.coalesce(F.expr(renderer.boolean(where)), F.lit(False)) if where is not None else F.lit(True)
    if where is not None and has_subquery(where):
        # subqueries are planned with the rows as a view
        view = engine.catalog.view(table, parts)
        text = f"SELECT *, coalesce({renderer.boolean(where)}, FALSE) AS __hit FROM {view} AS `{ref.name}`"
        rows = table.placed(engine.spark.sql(text))
    else:
        rows = rows.withColumn("__hit", hit)
    if limit is None:
        return rows
    n = int(renderer.bound(limit))
    rows = rows.withColumn("__id", F.monotonically_increasing_id())
    keys = [value(engine, binds, o.value).desc() if o.descending else value(engine, binds, o.value) for o in order]
    first = rows.filter("__hit").orderBy(*keys, "__id").limit(n).select(F.col("__id").alias("__chosen"))
    return rows.join(first, F.col("__id") == F.col("__chosen"), "left").withColumn("__hit", F.col("__chosen").isNotNull()).drop("__id", "__chosen")


def has_subquery(e: Any) -> bool:
    if isinstance(e, Query):
        return True
    if isinstance(e, Expr):
        return any(has_subquery(a) for a in e.args)
    return isinstance(e, tuple) and any(map(has_subquery, e))


def update(engine: Engine, table: Table, body: Update, binds: Mapping[str, Any], shard: str | None) -> int:
    names = {f.name.lower(): f for f in table.store.schema}
    for c, _ in body.sets:
        if c.lower() not in names:
            raise SqlError(f"Unknown column '{c}' in 'field list'")
        if table.key and c.lower() == table.key.lower():
            raise SqlError(f"unsupported: You can't update primary vindex columns. Invalid update on vindex: {table.key}")
    parts = concerned(engine, table, body.table, body.where, binds, shard)
    rows = marked(engine, table, body.table, body.where, body.order, body.limit, binds, parts)
    count = rows.filter("__hit").count()
    if count:
        sets = {c.lower(): e for c, e in body.sets}
        out = [(F.when(F.col("__hit"), value(engine, binds, sets[n]).cast(f.dataType)).otherwise(F.col(f.name)) if n in sets else F.col(f.name)).alias(f.name) for n, f in names.items()]
        table.store.replace(rows.select(*out, PART), parts)
    return count


def delete(engine: Engine, table: Table, body: Delete, binds: Mapping[str, Any], shard: str | None) -> int:
    parts = concerned(engine, table, body.table, body.where, binds, shard)
    rows = marked(engine, table, body.table, body.where, body.order, body.limit, binds, parts)
    count = rows.filter("__hit").count()
    if count:
        table.store.replace(rows.filter(~F.col("__hit")), parts)
    return count
