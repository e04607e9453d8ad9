"""N-gram Jaccard join by adaptive multi-match prefixes.

Documents with equal sets of shingles are one node. Each node's shingles are put in one global order, rare ones first,
by a frequency class and the shingle's hash. If two sets of sizes x and y have a similarity of at least t = 0.75, they
share at least a = ceil(3 (x + y) / 7) shingles, so their first l shared ones lie among the first x - a + l of the one
and the first y - a + l of the other. A node chooses its l by the estimated cost of its candidates: a prefix longer by
one shingle costs one more row and asks each candidate for one more match. Two nodes are a candidate pair if they
share min(l, l') shingles at such places. What their prefixes share in all must leave a chance; then whole sets are compared.

Frequencies come from a sketch of fixed size (a count of all shingles by 2^SKETCH_BITS buckets), over all documents.
They only order shingles and price prefixes: any estimate gives the same links.

Groups are never expanded into all pairs. First every node is compared with one other, the node which shares the
most of its prefix among those that begin a shingle's list (the earliest place of the shingle); linked nodes join
components, and pairs are then only made across components, where places and sizes allow a link. A list of one node
(nearly all) ends where it was shuffled to; a shingle whose estimated frequency is over HOT is dealt over several tasks.

Defined results: null texts and texts without words have no shingles and are linked with nothing, component_id being
their own doc_id; rows with the same text, also under one doc_id, have one node and so one component; a component whose
ids are all null has component_id null; an empty table gives no rows. Sets and shingles are told apart by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marlstone.llm.common import Scratch, cut, id_text, likely, record, table, texts_of, tidied
from marlstone.llm.components import components
from marlstone.llm.shingles import node_of, shingler

SKETCH_BITS, BLOCK_BITS = 21, 15
MOST_MATCHES = 4
#: What a candidate costs, in rows of the prefix index.
CANDIDATE_COST = 1.0
#: Estimated frequency from which a shingle's list is dealt over SALTS tasks.
HOT, SALTS = 10_000, 64
#: Nodes of a list that meet the whole list in one task.
LIST = 1000
#: Nodes whose prefixes a task remembers to have sent.
SENT = 500_000


def least_shared(x: Column, y: Column) -> Column:
    """How many shingles sets of sizes x and y share if their similarity is 0.75 or more."""
    return F.ceil(3 * (x + y) / 7)


def sizes_allow(x: Column, y: Column) -> Column:
    return (4 * x >= 3 * y) & (4 * y >= 3 * x)


def nodes_and_sketch(docs: DataFrame) -> DataFrame:
    """Rows of two kinds: doc_id, node and n of each document; and blocks of the tasks' counts of shingles."""
    schema = pa.schema([("doc_id", pa.int64()), ("node", pa.int64()), ("n", pa.int64()), ("block", pa.int32()), ("counts", pa.binary())])

    @tidied
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = shingler()
        sketch = np.zeros(1 << SKETCH_BITS, dtype=np.uint32)
        for batch in batches:
            ids, nodes, sizes, held = [], [], [], []
            for doc, text in zip(batch.column(0).to_pylist(), texts_of(batch), strict=True):
                s = shingles(text)
                ids.append(doc)
                nodes.append(node_of(s) if len(s) else None)
                sizes.append(len(s))
                held.append((s >> np.uint64(64 - SKETCH_BITS)).astype(np.int32))
                if len(held) >= 2000:
                    sketch += np.bincount(np.concatenate(held), minlength=len(sketch)).astype(np.uint32)
                    held = []
            if held:
                sketch += np.bincount(np.concatenate(held), minlength=len(sketch)).astype(np.uint32)
            if ids:
                none = [None] * len(ids)
                yield record(schema, [ids, nodes, sizes, none, none])
        if sketch.any():
            for i, part in enumerate(sketch.reshape(-1, 1 << BLOCK_BITS)):
                yield record(schema, [[None], [None], [None], [i], [zstandard.compress(part.tobytes(), 3)]])

    return docs.mapInArrow(run, "doc_id long, node long, n long, block int, counts binary")


def whole_sketch(blocks: DataFrame) -> np.ndarray:
    """The sum of the tasks' sketches: blocks are summed apart, and 2^SKETCH_BITS numbers reach the driver."""

    def add(group: pa.Table) -> pa.Table:
        total = np.zeros(1 << BLOCK_BITS, dtype=np.uint64)
        for c in group.column("counts"):
            total += np.frombuffer(zstandard.decompress(c.as_py()), dtype=np.uint32)
        total = np.minimum(total, np.uint64(0xFFFFFFFF)).astype(np.uint32)
        return pa.table([group.column("block")[:1], pa.array([zstandard.compress(total.tobytes(), 3)], pa.binary())], names=["block", "counts"])

    out = np.zeros(1 << SKETCH_BITS, dtype=np.uint32)
    for r in blocks.groupBy("block").applyInArrow(add, "block int, counts binary").toLocalIterator():
        out[r["block"] << BLOCK_BITS : (r["block"] + 1) << BLOCK_BITS] = np.frombuffer(zstandard.decompress(r["counts"]), dtype=np.uint32)
    return out


def prefix(shingles: np.ndarray, sketch: np.ndarray, noise: float) -> tuple[np.ndarray, int, np.ndarray]:
    """The shingles of a node's prefix in global order, the matches that it asks for, and estimated frequencies."""
    n = len(shingles)
    count = sketch[(shingles >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)].astype(float)
    over = np.maximum((count - noise) / (2 * np.sqrt(noise) + 2), 1)  # 1: no more than others that fell in the bucket
    kind = np.floor(2 * np.log2(over)).astype(np.int32)
    order = np.lexsort((shingles, kind))
    first = n + 3 * -n // 4 + 1  # n - ceil(3 n / 4) + 1
    frequency = np.where(kind > 0, count - noise, 0.0)[order]
    spent = np.concatenate([[0.0], np.cumsum(frequency)])
    best = min(range(1, MOST_MATCHES + 1), key=lambda k: first + k - 1 + CANDIDATE_COST * spent[min(first + k - 1, n)] / k if first + k - 1 <= n else float("inf"))
    keep = order[: first + best - 1]
    return shingles[keep], best, frequency[: len(keep)]


def prefix_rows(docs: DataFrame, sketch: np.ndarray) -> DataFrame:
    """token, node, n, matches, place, salt of every shingle in a prefix."""
    sent = docs.sparkSession.sparkContext.broadcast(sketch)
    noise = float(sketch.sum(dtype=np.float64) / len(sketch))
    schema = pa.schema([("token", pa.int64()), ("node", pa.int64()), ("n", pa.int32()), ("matches", pa.int32()), ("place", pa.int32()), ("salt", pa.int32())])

    @tidied
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles, counts, done = shingler(), sent.value, set()
        for batch in batches:
            parts: list[tuple] = []
            size = 0

            def emit() -> pa.RecordBatch:
                return pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*parts, strict=True)], schema=schema)

            for text in texts_of(batch):
                s = shingles(text)
                if not len(s) or (node := node_of(s)) in done:
                    continue
                if len(done) >= SENT:
                    done.clear()
                done.add(node)
                tokens, matches, frequency = prefix(s, counts, noise)
                k = len(tokens)
                salt = np.where(frequency > HOT, 1 + node % SALTS, 0).astype(np.int32)
                parts.append((tokens.view(np.int64), np.full(k, node), np.full(k, len(s), np.int32), np.full(k, matches, np.int32), np.arange(k, dtype=np.int32), salt))
                size += k
                if size >= 100_000:
                    yield emit()
                    parts, size = [], 0
            if parts:
                yield emit()

    return docs.mapInArrow(run, "token long, node long, n int, matches int, place int, salt int")


def shared_rows(rows: DataFrame) -> DataFrame:
    """The rows of shingles that stand in the prefixes of two nodes or more; a node's repeated rows once. Rows arrive
    sorted, and one row is held back at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, joined = None, False  # the last row, and whether the one before it was of the same shingle
        for batch in batches:
            if not batch.num_rows:
                continue
            now = pa.Table.from_batches([batch])
            if held is not None:
                now = pa.concat_tables([held, now])
            token, node, salt = (now.column(c).to_numpy() for c in ("token", "node", "salt"))
            same = token[1:] == token[:-1]
            new = np.concatenate([[True], ~(same & (node[1:] == node[:-1]))])
            now = now.filter(pa.array(new))
            token, salt = token[new], salt[new]
            same = token[1:] == token[:-1]
            keep = (salt > 0) | np.concatenate([[joined], same]) | np.concatenate([same, [False]])
            held = now.slice(len(token) - 1)
            joined = bool(same[-1]) if len(same) else joined
            out = now.slice(0, len(token) - 1).filter(pa.array(keep[:-1]))
            yield from out.combine_chunks().to_batches()
        if held is not None and (joined or held.column("salt")[0].as_py()):
            yield from held.combine_chunks().to_batches()

    dealt = rows.repartition("token", "salt").sortWithinPartitions("token", "salt", "node")
    return dealt.mapInArrow(run, rows.schema).drop("salt")


def texts_of_nodes(docs: DataFrame, nodes: DataFrame, wanted: DataFrame) -> DataFrame:
    """node and its text, compressed, of the wanted nodes. One document stands for each node; a filter of fixed size
    keeps most others from being shingled and shuffled, and a join settles the rest."""
    ids = nodes.join(wanted, "node").groupBy("node").agg(F.min("doc_id").alias("doc_id"))
    rows = likely(docs, ids.select("doc_id"))
    schema = pa.schema([("node", pa.int64()), ("text", pa.binary())])

    @tidied
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles, pack = shingler(), zstandard.ZstdCompressor(level=3).compress
        for batch in batches:
            out: list[tuple[int, bytes]] = []
            for text in texts_of(batch):
                s = shingles(text)
                if len(s):
                    out.append((node_of(s), pack(text.encode())))
                if len(out) >= 500:
                    yield record(schema, list(map(list, zip(*out, strict=True))))
                    out = []
            if out:
                yield record(schema, list(map(list, zip(*out, strict=True))))

    found = rows.mapInArrow(run, "node long, text binary")
    return found.join(wanted, "node", "left_semi").dropDuplicates(["node"])


def promising(pairs: DataFrame, rows: DataFrame) -> DataFrame:
    """The pairs(a, b) that their prefixes leave a chance: what two sets share beyond their prefixes lies in the rest
    of the one whose prefix ends first, so they share no more than their prefixes do and the larger rest holds."""
    pairs = pairs.select("a", "b").distinct()
    side = lambda s: rows.select("token", F.col("node").alias(s), *[F.col(c).alias(f"{c}_{s}") for c in ("n", "matches")])
    met = pairs.join(side("a"), "a").join(side("b"), ["b", "token"])
    counted = met.groupBy("a", "b").agg(F.count(F.lit(1)).alias("k"), *[F.first(c).alias(c) for c in ("n_a", "n_b", "matches_a", "matches_b")])
    rest = [F.ceil(3 * F.col(f"n_{s}") / 4) - F.col(f"matches_{s}") for s in "ab"]  # sizes less the prefixes' lengths
    return counted.filter(F.col("k") + F.greatest(*rest) >= least_shared(F.col("n_a"), F.col("n_b"))).select("a", "b")


def verified(docs: DataFrame, nodes: DataFrame, pairs: DataFrame, rows: DataFrame, scratch: Scratch) -> DataFrame:
    """The pairs(a, b) whose sets are similar."""
    pairs = scratch.cut(promising(pairs, rows))
    wanted = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
    texts = scratch.cut(texts_of_nodes(docs, nodes, wanted))
    left = texts.select(F.col("node").alias("a"), F.col("text").alias("x"))
    right = texts.select(F.col("node").alias("b"), F.col("text").alias("y"))
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    @tidied
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles, unpack = shingler(), zstandard.ZstdDecompressor().decompress
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2), batch.column(3), strict=True):
                p, q = (shingles(unpack(v.as_py()).decode()) for v in (x, y))
                both = len(np.intersect1d(p, q, assume_unique=True))
                keep.append(100 * both >= 75 * (len(p) + len(q) - both))
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(pa.array(keep, pa.bool_())), batch.column(1).filter(pa.array(keep, pa.bool_()))], schema=schema)

    return scratch.cut(pairs.join(left, "a").join(right, "b").select("a", "b", "x", "y").mapInArrow(run, "a long, b long"))


def star_pairs(rows: DataFrame) -> DataFrame:
    """For each node one other: of the nodes that hold a shared shingle earliest, the one that does for most shingles."""
    first = rows.groupBy("token").agg(F.min(F.struct("place", "node", "n")).alias("f")).select("token", F.col("f.node").alias("hub"), F.col("f.n").alias("hub_n"))
    met = rows.join(first, "token").filter((F.col("node") != F.col("hub")) & sizes_allow(F.col("n"), F.col("hub_n")))
    counted = met.groupBy("node", "hub").agg(F.count(F.lit(1)).alias("k"))
    return counted.groupBy("node").agg(F.max(F.struct("k", "hub")).alias("best")).select(F.col("node").alias("a"), F.col("best.hub").alias("b"))


def cross_pairs(rows: DataFrame, known: DataFrame, scratch: Scratch) -> DataFrame:
    """All candidate pairs of nodes in different components: those with min(l, l') matches at places that a link allows."""
    placed = rows.join(known, "node", "left").withColumn("component", F.coalesce("component", "node"))
    mixed_lists = placed.groupBy("token").agg(F.min("component").alias("p"), F.max("component").alias("q")).filter("p <> q").select("token")
    placed = scratch.cut(placed.join(mixed_lists, "token"))
    sides = [placed.select("token", *[F.col(c).alias(f"{c}_{s}") for c in ("node", "n", "matches", "place", "component")]) for s in "ab"]
    return candidates(sides[0].join(sides[1], "token").filter(F.col("component_a") != F.col("component_b")))


def all_pairs(rows: DataFrame, scratch: Scratch) -> DataFrame:
    """All candidate pairs of nodes, those within components too. A long list meets itself in several tasks."""
    length = rows.groupBy("token").agg((1 + F.floor(F.count(F.lit(1)) / LIST)).cast("int").alias("parts"))
    placed = scratch.cut(rows.join(length, "token"))
    sides = [placed.select("token", "parts", *[F.col(c).alias(f"{c}_{s}") for c in ("node", "n", "matches", "place")]) for s in "ab"]
    left = sides[0].withColumn("part", F.pmod(F.xxhash64("node_a"), F.col("parts")).cast("int")).drop("parts")
    right = sides[1].withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).drop("parts")
    return candidates(left.join(right, ["token", "part"]))


def candidates(met: DataFrame) -> DataFrame:
    """Of nodes a and b that met at a shingle, the pairs with min(l, l') matches at places that a link allows."""
    shared = least_shared(F.col("n_a"), F.col("n_b"))
    asked = F.least("matches_a", "matches_b")
    near = [F.col(f"place_{s}") <= F.col(f"n_{s}") - shared + asked - 1 for s in "ab"]
    condition = (F.col("node_a") < F.col("node_b")) & sizes_allow(F.col("n_a"), F.col("n_b")) & near[0] & near[1]
    counted = met.filter(condition).groupBy("node_a", "node_b").agg(F.count(F.lit(1)).alias("k"), F.first(asked).alias("asked"))
    return counted.filter("k >= asked").select(F.col("node_a").alias("a"), F.col("node_b").alias("b"))


def near_duplicates(docs: DataFrame, count_links: bool = False) -> DataFrame:
    """doc_id, node, n_shingles and component_id of each document, and with count_links n_links: how many other nodes
    (sets of shingles; copies are one) its own is linked with. Components need few of the links; to count them all,
    every candidate pair is compared, those within components too, and a group of k near copies has up to k^2 / 2."""
    spark = docs.sparkSession
    rows = id_text(docs)
    with Scratch(spark) as scratch:
        both = scratch.cut(nodes_and_sketch(rows))
        nodes = both.filter(F.col("block").isNull()).select("doc_id", "node", "n")
        sketch = whole_sketch(both.filter(F.col("block").isNotNull()).select("block", "counts"))
        shared = scratch.cut(shared_rows(prefix_rows(rows, sketch)))
        links = verified(rows, nodes, star_pairs(shared), shared, scratch)
        first = components(links, scratch)
        links = links.unionByName(verified(rows, nodes, cross_pairs(shared, first, scratch), shared, scratch))
        whole = components(links, scratch)
        placed = nodes.join(whole, "node", "left").withColumn("component", F.coalesce("component", "node"))
        least = nodes.join(whole, "node", "left").withColumn("component", F.coalesce("component", "node")).filter("node is not null").groupBy("component").agg(F.min("doc_id").alias("least"))
        out = placed.join(least, "component", "left")
        alone = F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("least"))
        out = out.select("doc_id", "node", F.col("n").alias("n_shingles"), alone.alias("component_id"))
        if count_links:
            every = verified(rows, nodes, all_pairs(shared, scratch), shared, scratch)
            degree = every.select(F.explode(F.array("a", "b")).alias("node")).groupBy("node").agg(F.count(F.lit(1)).alias("n_links"))
            out = out.join(degree, "node", "left").select(*out.columns, F.coalesce("n_links", F.lit(0)).alias("n_links"))
        return cut(out)


def with_node(docs: DataFrame) -> DataFrame:
    """docs with a column __node, the node of each row's text."""

    @tidied
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = shingler()
        for batch in batches:
            nodes = [node_of(s) if len(s) else None for s in map(shingles, texts_of(batch, "text"))]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(nodes, pa.int64())], [*batch.schema.names, "__node"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return docs.mapInArrow(run, f"{schema}, __node long")


def keep_one(docs: DataFrame) -> DataFrame:
    """docs without all but one document of each component: the one whose id is the component's. Documents without
    words are no copies of each other and stay. Of equal rows with the kept id one stays; a row that shares the kept
    id, but not its text, stays as well. Of rows that share another id, but not their texts, only those go whose own
    text is a copy. The columns of docs stay."""
    every = near_duplicates(docs)
    found = every.filter(F.col("node").isNotNull())
    copies = found.filter(~F.col("doc_id").eqNullSafe(F.col("component_id"))).select(F.col("doc_id").alias("id"), "node").distinct()
    several = every.groupBy("doc_id").agg((F.count_distinct("node") + F.max(F.col("node").isNull().cast("int"))).alias("k")).filter("k > 1").select("doc_id")
    mixed = several.join(copies, several["doc_id"].eqNullSafe(copies["id"]), "left_semi")
    gone = copies.select(F.col("id").alias("doc_id")).distinct()
    kept = docs.join(gone, docs["doc_id"].eqNullSafe(gone["doc_id"]), "left_anti")
    if not mixed.isEmpty():
        again = with_node(docs.join(mixed, docs["doc_id"].eqNullSafe(mixed["doc_id"]), "left_semi"))
        again = again.join(copies, again["doc_id"].eqNullSafe(copies["id"]) & (again["__node"] == copies["node"]), "left_anti").drop("__node")
        kept = kept.unionByName(again)
    twice = found.groupBy("doc_id", "node").count().filter("count > 1").select("doc_id").distinct()
    if twice.isEmpty():
        return kept
    same = kept["doc_id"].eqNullSafe(twice["doc_id"])
    return kept.join(twice, same, "left_anti").unionByName(kept.join(twice, same, "left_semi").dropDuplicates(["doc_id", "text"]))


def op2_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


SQL = {
    "op2_jaccard_join": r"""
with recursive words as (
    select doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') as w from documents
), sets as (
    select doc_id, list_distinct(case when len(w) >= 5 then list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) when len(w) > 0 then [array_to_string(w, ' ')] else [] end) as s from words
), shingles as (
    select doc_id, unnest(s) as t from sets
), shared as (
    select a.doc_id as x, b.doc_id as y, count(*) as k from shingles a join shingles b on a.t = b.t and a.doc_id <> b.doc_id group by all
), links as (
    select x, y from shared join sets p on p.doc_id = x join sets q on q.doc_id = y where 100 * k >= 75 * (len(p.s) + len(q.s) - k)
), reached(x, y) as (
    select x, y from links union select r.x, l.y from reached r join links l on r.y = l.x
)
select doc_id, len(s)::bigint as n_shingles, least(doc_id, coalesce((select min(y) from reached where x = doc_id), doc_id)) as component_id from sets""",
}
QUERIES = {"op2_jaccard_join": op2_jaccard_join}
