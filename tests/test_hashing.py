import pytest
from pyspark.sql import functions as F

from marlstone.functions import hashing as h
from marlstone.plans.errors import SqlError

# keyspace ids as bytes; fixed values
IDS = {
    0: "140 166 77 233 193 177 35 167",
    -(2**63): "149 248 165 229 221 49 217 0",
    "18446744073709551615": "53 85 80 178 21 14 36 81",
    "18446744073709551620": "44 112 54 208 203 110 69 154",
    "你好世界，の": "170 169 41 44 13 235 46 205",
    "2023-05-15 02:39:26.602": "68 104 115 235 9 58 76 63",
}


def test_keyspace_ids():
    assert {k: " ".join(map(str, v)) for k, v in zip(IDS, h.keyspace_ids(list(IDS)), strict=True)} == IDS


def test_murmur():
    assert h.murmur3_128(b"") == 0
    assert len({h.murmur3_128(bytes(range(n))) for n in range(40)}) == 40


def test_text_keys_ignore_case_and_space():
    assert h.keyspace_ids([" AbC "]) == h.keyspace_ids(["abc"])


def test_shards():
    names = h.even_shards(4)
    assert names == ["-40", "40-80", "80-c0", "c0-"]
    assert h.shards_of([0, 1, 2], names) == [2, 0, 0]
    with pytest.raises(SqlError, match="didn't match any shards"):
        h.shards_of([0], ["-40"])


def test_split_algorithms():
    assert [h.split_by_polynomial("11", 4), h.split_by_polynomial("", 4)] == [abs((2 * 31 + 49) * 31 + 49) % 4, 1]
    assert all(0 <= f(v, 7) < 7 for f in h.ALGORITHMS.values() for v in ("1", "22", "-9223372036854775808"))


def test_columns(spark):
    names = h.even_shards(8)
    rows = spark.createDataFrame([(i, f"key{i % 7}") for i in range(200)] + [(None, None)], "k long, t string")
    out = rows.select("k", "t", h.shard_column(F.col("k"), names).alias("s"), h.split_column(F.col("t"), "ShardTableByMurmur", 5).alias("p")).collect()
    assert all((r.s, r.p) == ((h.shards_of([r.k], names)[0], h.split_by_murmur(r.t, 5)) if r.k is not None else (None, None)) for r in out)
