import pytest
from pyspark.sql import functions as F

from marlstone.functions import columns as C
from marlstone.operators import aggregates, joins, order, sets
from marlstone.plans.errors import SqlError
from marlstone.streaming import events


@pytest.fixture(scope="module")
def pair(spark):
    left = spark.createDataFrame([(1, "a"), (2, "b"), (2, "c"), (None, "d")], "k int, x string")
    right = spark.createDataFrame([(2, 20), (3, 30), (None, 0)], "k int, y int")
    return left, right


def values(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_joins(pair):
    left, right = pair
    assert values(joins.join(left, right, "k")) == [(2, "b", 20), (2, "c", 20)]
    assert len(values(joins.join(left, right, "k", "full"))) == 6
    assert values(joins.join(left, right, "k", "anti")) == [(1, "a"), (None, "d")]
    assert joins.join(left, right, how="cross").count() == 12
    for how in ("inner", "left", "semi", "anti"):
        plain = left.join(right, "k", {"semi": "left_semi", "anti": "left_anti"}.get(how, how))
        assert values(joins.salted_join(left, right, ["k"], 3, how)) == values(plain)
    assert values(joins.not_in(left, "k", right, "k")) == []
    assert values(joins.not_in(left, "k", right.filter("k is not null"), "k")) == [(1, "a")]
    assert len(values(joins.not_in(left, "k", right.limit(0), "k"))) == 4


def test_aggregates(pair):
    left, _ = pair
    assert values(aggregates.grouped(left.filter("k = 2"), ["k"], F.count("x").alias("n")))[0] == (2, 2)
    assert values(aggregates.grouped(left.limit(0), [], F.count("x").alias("n"), F.sum("k").alias("s"))) == [(0, None)]
    assert str(left.agg(aggregates.average(F.col("k"), 4).alias("a")).first().a) == "1.6667"
    assert values(aggregates.salted_sum(left, ["k"], "k")) == values(left.groupBy("k").agg(F.sum("k"), F.count("k")))


def test_sets(pair):
    left, right = pair
    assert sets.union(left.select("k"), left.select("k")).count() == 3
    assert sets.union_all(left, right).count() == 7
    with pytest.raises(SqlError, match="type does not match"):
        sets.union_all(left, right, strict=True)
    with pytest.raises(SqlError, match="number of columns"):
        sets.except_rows(left, right.select("k"))
    assert values(sets.intersect_rows(left.select("k"), right.select("k"))) == [(2,), (None,)]


def test_order(pair):
    left, _ = pair
    assert [r.x for r in order.ordered(left, ["k", ("x", "desc")]).collect()] == ["d", "a", "c", "b"]
    assert [r.x for r in order.top(left, ["x"], 2, 1).collect()] == ["b", "c"]
    assert values(order.top_of_each(left, ["k"], ["x"], 1)) == [(1, "a"), (2, "b"), (None, "d")]
    with pytest.raises(SqlError, match="negative"):
        order.limited(left, -1)


def test_columns(spark):
    r = spark.range(1).select(
        C.known(F.acos(F.lit(2.0))).alias("a"), C.divide(F.lit(1), F.lit(0)).alias("b"), C.modulo(F.lit(5), F.lit(3)).alias("c"), C.greatest(F.lit(1), F.lit(None).cast("int")).alias("d"), C.elt(F.lit(3), F.lit("x"), F.lit("y")).alias("e"),
        C.insert(F.lit("Quadratic"), F.lit(3), F.lit(100), F.lit("What")).alias("f"), C.xor(F.lit(1), F.lit(0)).alias("g"), C.to_number(F.lit("12.5x")).alias("h"), C.to_number(F.lit("x")).alias("i"), C.truncate(F.lit(-1.999), 2).alias("j"),
    ).first()
    assert tuple(r) == (None, None, 2, None, None, "QuWhat", True, 12.5, 0.0, -1.99)
    with pytest.raises(Exception, match="out of range"):
        spark.range(1).select(C.unsigned(F.lit(-1))).collect()


def test_stream(spark):
    folder = "/root/testdata/sf0.001"
    query = events.windowed(events.read(spark, folder)).writeStream.outputMode("complete").format("memory").queryName("windows").start()
    query.processAllAvailable()
    query.stop()
    assert spark.table("windows").agg(F.sum("n")).first()[0] == spark.read.parquet(f"{folder}/events.parquet").count()
