"""Sharding by weighted rendezvous hashing of record keys.

Each shard draws a number in (0, 1) from the digest of (key, shard); the shard with the largest
weight / -ln(draw) takes the record. A shard that is added only takes records into itself, and a shard's
share of the records is its share of the weights.

Defined results: a null key is the key 'null' (all null keys go to one shard); a null text has no bytes;
repeated rows get one slot each, in an order that the row's values decide; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from marlstone.llm.common import table

#: Parts of a shard that are numbered apart; the slots of a part begin where the part before it ends.
PARTS = 512
SHARDS = 24


def draw(key: Column, salt: str) -> Column:
    """52 bits of the digest of key and salt, as a long."""
    return F.conv(F.substring(F.md5(F.concat(key, F.lit(f":{salt}"))), 1, 13), 16, 10).cast("long")


def rendezvous(key: Column, weights: Sequence[float]) -> Column:
    """The shard 0..len(weights)-1 of a string key. Shards of equal weight are compared by their draws alone."""
    if not weights or min(weights) <= 0:
        raise ValueError("every shard needs a weight above 0")
    even = len(set(weights)) == 1
    unit = 2.0**52

    def score(i: int, w: float) -> Column:
        d = draw(key, str(i))
        return d if even else F.lit(float(w)) / -F.ln((d.cast("double") + 0.5) / unit)

    return F.array_max(F.array(*[F.struct(score(i, w).alias("score"), F.lit(i).alias("shard")) for i, w in enumerate(weights)]))["shard"]


def shard_documents(docs: DataFrame, weights: Sequence[float] = (1.0,) * SHARDS, grown: Sequence[float] | None = None, parts: int = PARTS) -> DataFrame:
    """doc_id, size, text_crc32, shard, slot, grown_shard: where each record goes, and its place in the shard.

    Slots are gapless from 0 in each shard. No task sees a whole shard: each shard is numbered in `parts` parts,
    whose sizes come from a first pass that reads keys only; their running sums (shards x parts rows, a fixed
    number) are broadcast. Only digests of the text are shuffled.
    """
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))
    shard = rendezvous(key, weights).alias("shard")
    part = F.pmod(draw(key, "part"), F.lit(parts)).cast("int").alias("part")
    sizes = docs.select(shard, part).groupBy("shard", "part").agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(W.partitionBy("shard").orderBy("part").rowsBetween(W.unboundedPreceding, -1))
    starts = sizes.select("shard", "part", F.coalesce(before, F.lit(0)).alias("base"))
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    rows = docs.select(
        F.col("doc_id"),
        (F.octet_length(text) + 8).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        shard,
        part,
        (rendezvous(key, grown) if grown else F.lit(None).cast("int")).alias("grown_shard"),
    )
    within = F.row_number().over(W.partitionBy("shard", "part").orderBy("doc_id", "text_crc32", "size"))
    return rows.withColumn("within", within).join(F.broadcast(starts), ["shard", "part"]).select("doc_id", "size", "text_crc32", "shard", (F.col("base") + F.col("within") - 1).cast("long").alias("slot"), "grown_shard")


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = shard_documents(table(spark, sf_dir, "documents"), (1.0,) * SHARDS, (1.0,) * (SHARDS + 1))
    return out.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")


_DRAW = "('0x' || substr(md5(doc_id::varchar || ':{0}'), 1, 13))::bigint"
_SHARD = "list_aggregate([{0}], 'max').s"


def _shard(n: int) -> str:
    return _SHARD.format(", ".join(f"{{'d': {_DRAW.format(i)}, 's': {i}}}" for i in range(n)))


SQL = {
    "op5_sharding": f"""
with crc as (
    select list(c order by i) as t from (select i, list_reduce(list_prepend(i, range(8)), lambda c, k: case when c % 2 = 1 then xor(c // 2, 3988292384) else c // 2 end) as c from range(256) r(i))
), placed as (
    select doc_id, strlen(coalesce(text, '')) + 8 as size, hex(encode(coalesce(text, ''))) as h, {_shard(SHARDS)} as shard, {_shard(SHARDS + 1)} as grown_shard, {_DRAW.format("part")} % {PARTS} as part from documents
), summed as (
    select *, xor(list_reduce(list_prepend(4294967295, list_transform(range(0, size - 8), lambda i: ('0x' || h[2 * i + 1:2 * i + 2])::bigint)), lambda c, b: xor(c // 256, t[xor(c % 256, b) + 1])), 4294967295) as text_crc32 from placed, crc
)
select doc_id, size::bigint as size, text_crc32::bigint as text_crc32, 'key' as law, shard::int as shard, (row_number() over (partition by shard order by part, doc_id, text_crc32, size) - 1)::bigint as slot, grown_shard::int as grown_shard from summed""",
}
QUERIES = {"op5_sharding": op5_sharding}
