"""Document fingerprints: Merkle trees over sections and paragraphs, by built-in functions only.

A text's sections are parted by empty lines and its paragraphs by line ends; a paragraph's leaves are runs of LEAF_WORDS
words, counted from its beginning, so an edit changes the leaves from its place to the end of its paragraph and no
other. A leaf's digest is that of its characters, a paragraph's that of its leaves' digests, a section's that of its
paragraphs', the root's that of its sections'. Splitting loses no character: roots are equal just when texts are.

A fingerprint is written as the root, a colon, the sections parted by `|`, their paragraphs parted by `;` and their
leaves' digests, cut to 8 digits, parted by `,`. The likeness of two fingerprints is 1 for equal roots, else twice the
number of different leaves that they share over the sum of their numbers of different leaves. Paragraph digests that
differ locate an edit.

Defined results: a null text is empty; null ids come last; rows with the same id are ordered by their texts' digests; a
table's only row is its own next; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from marlstone.llm.common import sha256_hex, stored_bytes, table

LEAF_WORDS = 8
#: Input bytes as stored for each range of ids, and the most ranges.
RANGE_BYTES, MOST_RANGES = 8 << 20, 4096


def tree(text: Column, leaf_words: int = LEAF_WORDS) -> Column:
    """Leaf digests by section and paragraph: array<array<array<string>>>."""
    leaf = F.lit("(?s)(?:[^ ]++ ?+| ++){1,%d}+" % leaf_words)

    def leaves(paragraph: Column) -> Column:
        return F.transform(F.regexp_extract_all(paragraph, leaf, F.lit(0)), lambda x: F.md5(x.cast("binary")))

    return F.transform(F.split(text, "\n\n", -1), lambda s: F.transform(F.split(s, "\n", -1), leaves))


def paragraph_digests(nodes: Column) -> Column:
    """Digests of paragraphs, by section."""
    return F.transform(nodes, lambda s: F.transform(s, lambda p: F.md5(F.concat_ws(",", p).cast("binary"))))


def root(paragraphs: Column) -> Column:
    sections = F.transform(paragraphs, lambda s: F.md5(F.concat_ws(";", s).cast("binary")))
    return sha256_hex(F.concat_ws("|", sections).cast("binary"))


def leaf_set(nodes: Column) -> Column:
    return F.array_distinct(F.flatten(F.flatten(nodes)))


def written(root_digest: Column, nodes: Column) -> Column:
    leaves = lambda p: F.concat_ws(",", F.transform(p, lambda x: F.substring(x, 1, 8)))
    return F.concat_ws(":", root_digest, F.concat_ws("|", F.transform(nodes, lambda s: F.concat_ws(";", F.transform(s, leaves)))))


def likeness(same: Column, a: Column, b: Column) -> Column:
    """Of two sets of leaves; same tells whether the roots are equal."""
    both = F.size(a) + F.size(b)
    return F.when(same, 1.0).when(both == 0, 0.0).otherwise(2.0 * F.size(F.array_intersect(a, b)) / both)


def first_difference(a: Column, b: Column) -> Column:
    """Number, from 0, of the first paragraph that differs; null where none does."""
    at = F.array_position(F.zip_with(F.flatten(a), F.flatten(b), lambda x, y: ~x.eqNullSafe(y)), F.lit(True))
    return F.when(at > 0, at - 1)


def id_ranges(docs: DataFrame, n: int) -> list[int]:
    """At most n - 1 ids that part the documents into ranges of about equal numbers; found from the ids alone."""
    if n < 2:
        return []
    got = docs.agg(F.percentile_approx("doc_id", [i / n for i in range(1, n)], 100 * n)).first()[0]
    return sorted(set(got or []))


def range_of(doc_id: Column, bounds: list[int]) -> Column:
    """How many bounds lie below the id, by binary search; 0 for a null id."""
    steps, size = [], 1
    while size <= len(bounds):
        steps.append(size)
        size *= 2
    if not steps:
        return F.lit(0)
    held = F.lit(bounds)

    def step(at: Column, s: Column) -> Column:
        return at + F.when((at + s <= len(bounds)) & (F.try_element_at(held, at + s) < doc_id), s).otherwise(0)

    return F.aggregate(F.lit(steps[::-1]), F.lit(0), step)


def with_next(docs: DataFrame) -> DataFrame:
    """doc_id, text, nodes and the struct `next` (text, nodes) of the row after it, by descending id, around.

    Texts move once, to the task that holds their range of ids, where the next row is the next in order. Only the
    first row of each range (at most MOST_RANGES rows, with their texts, joined by the range) is the next of a row
    elsewhere.
    """
    bounds = id_ranges(docs, int(min(max(stored_bytes(docs) // RANGE_BYTES, 1), MOST_RANGES)))
    rows = docs.withColumn("rng", range_of(F.col("doc_id"), bounds))
    order = [F.col("doc_id").desc_nulls_last(), F.xxhash64("text"), F.col("text")]
    # the ids that begin the ranges; one row a range
    heads = {r["rng"]: r["id"] for r in rows.groupBy("rng").agg(F.max("doc_id").alias("id")).collect()}
    chain = sorted(heads, reverse=True)
    follows = [(chain[i - 1], r, heads[r]) for i, r in enumerate(chain)]
    small = docs.sparkSession.createDataFrame(follows, "before int, head_rng int, head_id long")
    first = rows.join(F.broadcast(small), F.col("rng").eqNullSafe(F.col("head_rng")) & F.col("doc_id").eqNullSafe(F.col("head_id")))
    first = first.withColumn("place", F.row_number().over(W.partitionBy("rng").orderBy(*order))).filter("place = 1").drop("place")
    first = first.select(F.col("before"), F.col("text").alias("head_text"))
    dealt = rows.repartition("rng").withColumn("nodes", tree(F.col("text")))
    by = W.partitionBy("rng").orderBy(*order)
    dealt = dealt.withColumn("follower", F.lead(F.struct("text", "nodes")).over(by))
    joined = dealt.join(first, (F.col("rng") == F.col("before")) & F.col("follower").isNull(), "left")
    head = F.struct(F.col("head_text").alias("text"), tree(F.col("head_text")).alias("nodes"))
    return joined.select("doc_id", "text", "nodes", F.when(F.col("follower").isNull(), head).otherwise(F.col("follower")).alias("next"))


def fingerprint_documents(docs: DataFrame) -> DataFrame:
    """Each text's fingerprint, that of its edited text, and the likenesses to that and to the next document's."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    n = F.char_length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), n - half), F.substring(F.col("next.text"), F.lit(1), half))
    rows = with_next(rows).select("doc_id", n.cast("long").alias("n_chars"), F.col("nodes"), F.col("next.nodes").alias("next_nodes"), edited.alias("edited"))
    rows = rows.withColumn("edited_nodes", tree(F.col("edited"))).withColumn("edited_sha256", sha256_hex(F.col("edited").cast("binary"))).drop("edited")
    sides = ("", "edited_", "next_")
    rows = rows.withColumns({f"{s}paragraphs": paragraph_digests(F.col(f"{s}nodes")) for s in sides} | {f"{s}leaves": leaf_set(F.col(f"{s}nodes")) for s in sides})
    rows = rows.withColumns({f"{s}root": root(F.col(f"{s}paragraphs")) for s in sides})
    near = lambda s: likeness(F.col("root") == F.col(f"{s}root"), F.col("leaves"), F.col(f"{s}leaves"))
    return rows.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        written(F.col("root"), F.col("nodes")).alias("fingerprint"),
        written(F.col("edited_root"), F.col("edited_nodes")).alias("edited_fingerprint"),
        near("edited_").alias("near_edited"),
        near("next_").alias("near_next"),
        first_difference(F.col("paragraphs"), F.col("edited_paragraphs")).cast("long").alias("edited_paragraph"),
    )


def op4_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint_documents(table(spark, sf_dir, "documents"))


_NODES = "list_transform(string_split({0}, chr(10) || chr(10)), lambda s: list_transform(string_split(s, chr(10)), lambda p: list_transform(regexp_extract_all(p, '(?s)(?:[^ ]+ ?| +){{1,8}}'), lambda x: md5(x))))"
_PARAGRAPHS = "list_transform({0}, lambda s: list_transform(s, lambda p: md5(array_to_string(p, ','))))"
_ROOT = "sha256(array_to_string(list_transform({0}, lambda s: md5(array_to_string(s, ';'))), '|'))"
_WRITTEN = "{0} || ':' || array_to_string(list_transform({1}, lambda s: array_to_string(list_transform(s, lambda p: array_to_string(list_transform(p, lambda x: substr(x, 1, 8)), ',')), ';')), '|')"
_NEAR = "case when {0} = {1} then 1.0 when len({2}) + len({3}) = 0 then 0.0 else 2.0 * len(list_intersect({2}, {3})) / (len({2}) + len({3})) end"

SQL = {
    "op4_fingerprints": f"""
with docs as (select doc_id, coalesce(text, '') as text from documents),
followed as (select *, coalesce(lead(text) over (order by doc_id desc), first_value(text) over (order by doc_id desc)) as next from docs),
texts as (select *, substr(text, 1, length(text) - length(text) // 2) || substr(next, 1, length(text) // 2) as edited from followed),
trees as (select *, {_NODES.format("text")} as a, {_NODES.format("edited")} as e, {_NODES.format("next")} as n from texts),
digests as (select *, {_PARAGRAPHS.format("a")} as pa, {_PARAGRAPHS.format("e")} as pe, {_PARAGRAPHS.format("n")} as pn from trees),
roots as (select *, {_ROOT.format("pa")} as ra, {_ROOT.format("pe")} as re, {_ROOT.format("pn")} as rn, list_distinct(flatten(flatten(a))) as la, list_distinct(flatten(flatten(e))) as le, list_distinct(flatten(flatten(n))) as ln, flatten(pa) as fa, flatten(pe) as fe from digests)
select doc_id, length(text)::bigint as n_chars, sha256(edited) as edited_sha256, {_WRITTEN.format("ra", "a")} as fingerprint, {_WRITTEN.format("re", "e")} as edited_fingerprint,
    {_NEAR.format("ra", "re", "la", "le")} as near_edited, {_NEAR.format("ra", "rn", "la", "ln")} as near_next,
    list_position(list_transform(range(1, greatest(len(fa), len(fe)) + 1), lambda i: fa[i] is distinct from fe[i]), true) - 1 as edited_paragraph
from roots""",
}
QUERIES = {"op4_fingerprints": op4_fingerprints}
