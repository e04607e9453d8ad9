"""Removal of repeated byte strings, by prefix-free parsing and suffix arrays.

A byte goes if a string of LENGTH bytes that covers it also starts anywhere else in the corpus.

Parsing. The trigger of a window is the place with the smallest rolling hash among its first SPREAD places (the last one
of equals). Triggers cut texts into phrases; as they depend on a window's bytes alone, equal windows are cut
alike, and every window of LENGTH bytes holds a trigger. Windows with one trigger at `a` start in one stretch,
[a - hi, a - lo], and all hold the core, the bytes from `a` that even the first of them has.

1. Parse: each trigger's core, and its whole context (from the first window's start to the last one's end), are
   digested where the text is read. Only triggers whose cores occur twice can begin a repeat; nearly all others end here.
2. Dictionary: equal contexts are one entry with its number of occurrences. Two or more occurrences settle all windows of the
   entry, and so does a core that has one entry only. What is left are entries at the edges of repeats.
3. Suffix arrays: the bytes of those entries are fetched, once each. For each core, its entries' right sides are sorted
   (the order of the corpus' suffixes from that trigger) with the common prefixes of neighbours, and their left sides, the
   phrase suffixes, likewise from their ends. A window l bytes left of the trigger has a twin if another entry shares
   l bytes on the left and LENGTH - l on the right: both orders combine into the corpus' order of all those windows.
4. The spans of repeated windows return to their documents, whose bytes are then removed.

Skew. Occurrences of a core within a batch show at once that it repeats; they are dealt over many tasks and send
one witness to the core's task. Entries are counted by partial sums. A core with more than MOST_ENTRIES entries is not
gathered: each window of its entries is digested and counted, exactly as well.

Defined results: a null text is empty; a text shorter than LENGTH has nothing to remove; repeated rows, under the same id
too, are occurrences each; an empty table gives no rows. Long texts are cut into stretches of SEGMENT places, which
changes entries at the cuts and no result. Bytes are told apart by 64 and 128-bit digests in steps 1 and 2, and
compared as they are in step 3.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marlstone.llm.common import Scratch, cut, record, table, tidied

LENGTH, SPREAD = 400, 200
#: What `cleaned` looks for: strings of SHORT bytes (51 words have that many in 99 of 100 places of ordinary prose), of whose runs those
#: over MOST_WORDS words or of LENGTH bytes go.
SHORT, SHORT_SPREAD, MOST_WORDS = 224, 112, 50
#: Bytes in the rolling hash: 2^ROLL.
ROLL = 4
SEGMENT = 1 << 20
#: Entries of a core that one task sorts (about 600 bytes each).
MOST_ENTRIES = 8192
#: Up to so many entries, pairs are met one by one; beyond, windows by their distance from the trigger.
FEW = 24
#: Parts that a core's occurrences are dealt into: many times the tasks, so that no task gets several large ones.
SALTS = 4096

_BYTE = np.random.default_rng(400).integers(0, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = [np.uint64(pow(0x9E3779B97F4A7C15, 1 << i, 2**64)) for i in range(ROLL)]
_PLACE = np.uint64((1 << 24) - 1)


def rolling(data: np.ndarray) -> np.ndarray:
    """Hashes of the runs of 2^ROLL bytes, each from the hashes of its halves."""
    h = _BYTE[data]
    for i in range(ROLL):
        h = h[: -(1 << i)] * _BASE[i] + h[1 << i :]
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def first_triggers(data: np.ndarray, spread: int) -> np.ndarray:
    """For each start, the place of the smallest hash among `spread` places from it; the last of equal ones."""
    h = rolling(data)
    n = len(h)
    key = (h & ~_PLACE) | (_PLACE - np.arange(n, dtype=np.uint64))
    rows = np.concatenate([key, np.full(-n % spread, np.uint64(2**64 - 1))]).reshape(-1, spread)
    upto = np.minimum.accumulate(rows, axis=1).ravel()
    onward = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    starts = n - spread + 1
    least = np.minimum(onward[:starts], upto[spread - 1 : spread - 1 + starts])
    return (_PLACE - (least & _PLACE)).astype(np.int64)


def parse(raw: bytes, length: int = LENGTH, spread: int = SPREAD) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Triggers and, of the windows that each is the first trigger of, the first and last start."""
    windows = len(raw) - length + 1
    if windows < 1:
        none = np.zeros(0, dtype=np.int64)
        return none, none, none
    data = np.frombuffer(raw, dtype=np.uint8)
    out = []
    for at in range(0, windows, SEGMENT):
        n = min(SEGMENT, windows - at)
        place = first_triggers(data[at : at + n + spread + (1 << ROLL) - 2], spread)[:n]
        first = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
        last = np.concatenate([first[1:], [n]]) - 1
        out.append((place[first] + at, first + at, last + at))
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


ANCHORS = pa.schema([("core", pa.int64()), ("entry", pa.int64()), ("lo", pa.int32()), ("hi", pa.int32()), ("key", pa.int64()), ("place", pa.int64()), ("salt", pa.int32())])
ANCHOR_DDL = "core long, entry long, lo int, hi int, key long, place long, salt int"


def anchors(docs: DataFrame, length: int, spread: int) -> DataFrame:
    """A row for each trigger of docs(key, raw). salt 0: the only one of its core in its batch; else the core
    repeats for certain. place -1: a witness of that for the task of salt 0."""
    core_bytes = length - spread + 1

    @tidied
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = xxhash.xxh3_64_intdigest

        def dealt(parts: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
            core, entry, lo, hi, key, place = (np.concatenate(x) for x in zip(*parts, strict=True))
            _, at, inverse, count = np.unique(core, return_index=True, return_inverse=True, return_counts=True)
            mixed = (key.view(np.uint64) ^ place.view(np.uint64)) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(32)
            salt = np.where(count[inverse] > 1, 1 + (mixed % np.uint64(SALTS)).astype(np.int64), 0)
            at = at[count > 1]
            columns = [np.concatenate([x, x[at]]) for x in (core, entry, lo, hi, key)]
            columns += [np.concatenate([place, np.full(len(at), -1)]), np.concatenate([salt, np.zeros(len(at), dtype=salt.dtype)])]
            return pa.RecordBatch.from_arrays([pa.array(c.astype(f.type.to_pandas_dtype())) for c, f in zip(columns, ANCHORS, strict=True)], schema=ANCHORS)

        for batch in batches:
            parts: list[tuple[np.ndarray, ...]] = []
            held = 0
            for key, value in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                raw = value.as_py()
                place, first, last = parse(raw, length, spread)
                n = len(place)
                if not n:
                    continue
                spans = list(zip(place.tolist(), first.tolist(), last.tolist(), strict=True))
                core = np.fromiter((digest(raw[a : a + core_bytes]) for a, _, _ in spans), dtype=np.uint64, count=n).view(np.int64)
                entry = np.fromiter((digest(raw[i : j + length], seed=1) for _, i, j in spans), dtype=np.uint64, count=n).view(np.int64)
                parts.append((core, entry, place - last, place - first, np.full(n, key), place))
                held += n
                if held >= 400_000:
                    yield dealt(parts)
                    parts, held = [], 0
            if parts:
                yield dealt(parts)

    return docs.mapInArrow(run, ANCHOR_DDL)


def repeating(rows: DataFrame) -> DataFrame:
    """The rows whose cores occur twice or more. Rows arrive sorted; one is held back at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, joined = None, False
        for batch in batches:
            if not batch.num_rows:
                continue
            now = pa.Table.from_batches([batch])
            if held is not None:
                now = pa.concat_tables([held, now])
            core, salt, place = (now.column(c).to_numpy() for c in ("core", "salt", "place"))
            same = core[1:] == core[:-1]
            keep = ((salt > 0) | np.concatenate([[joined], same]) | np.concatenate([same, [False]])) & (place >= 0)
            held = now.slice(len(core) - 1)
            joined = bool(same[-1]) if len(same) else joined
            out = now.slice(0, len(core) - 1).filter(pa.array(keep[:-1]))
            yield from out.combine_chunks().to_batches()
        if held is not None and held.column("place")[0].as_py() >= 0 and (joined or held.column("salt")[0].as_py()):
            yield from held.combine_chunks().to_batches()

    return rows.repartition("core", "salt").sortWithinPartitions("core", "salt").mapInArrow(run, ANCHOR_DDL).drop("salt")


def common_prefix(a: bytes, b: bytes) -> int:
    low, high = 0, min(len(a), len(b))
    if a[:high] == b[:high]:
        return high
    while low < high:
        mid = (low + high + 1) // 2
        if a[:mid] == b[:mid]:
            low = mid
        else:
            high = mid - 1
    return low


#: lo, hi, occurrences, left side, right side
Entry = tuple[int, int, int, bytes, bytes]
Stretch = tuple[int, int]


def suffix_order(sides: list[bytes]) -> tuple[list[int], list[int]]:
    """Indices in the order of the sides, and of each the common prefix with the one before."""
    order = sorted(range(len(sides)), key=sides.__getitem__)
    return order, [0] + [common_prefix(sides[i], sides[j]) for i, j in zip(order, order[1:], strict=False)]


def merged(stretches: list[Stretch]) -> list[Stretch]:
    out: list[Stretch] = []
    for a, b in sorted(stretches):
        if out and a <= out[-1][1] + 1:
            out[-1] = (out[-1][0], max(out[-1][1], b))
        else:
            out.append((a, b))
    return out


def settle(entries: list[Entry], length: int) -> list[list[Stretch]]:
    """Of each entry of a core, the stretches of distances l from the trigger whose windows have a twin."""
    right, lcp = suffix_order([e[4] for e in entries])
    left, lcs = suffix_order([e[3][::-1] for e in entries])
    m = len(entries)
    if m <= FEW:
        found: list[list[Stretch]] = [[(e[0], e[1])] if e[2] > 1 else [] for e in entries]
        suffix = {}
        for p in range(m):
            least = length
            for q in range(p + 1, m):
                least = min(least, lcs[q])
                i, j = left[p], left[q]
                suffix[min(i, j), max(i, j)] = least
        for p in range(m):
            least = length
            for q in range(p + 1, m):
                least = min(least, lcp[q])
                i, j = sorted((right[p], right[q]))
                lo = max(entries[i][0], entries[j][0], length - least)
                hi = min(entries[i][1], entries[j][1], suffix[i, j])
                if lo <= hi:
                    found[i].append((lo, hi))
                    found[j].append((lo, hi))
        return [merged(x) for x in found]
    lo, hi, n = (np.array([e[k] for e in entries]) for k in range(3))
    by_right, by_left = np.array(lcp), np.array(lcs)
    twin = np.zeros((m, int(hi.max()) + 2), dtype=bool)
    a, b = np.empty(m, dtype=np.int64), np.empty(m, dtype=np.int64)
    for l in range(int(lo.min()), int(hi.max()) + 1):
        a[right] = np.cumsum(by_right < length - l)
        b[left] = np.cumsum(by_left < l)
        has = np.flatnonzero((lo <= l) & (l <= hi))
        if len(has):
            _, inverse = np.unique(a[has] * (m + 1) + b[has], return_inverse=True)
            twin[has, l] = np.bincount(inverse, weights=n[has])[inverse] > 1
    out = []
    for row in twin:
        edge = np.flatnonzero(np.diff(np.concatenate([[False], row]).astype(np.int8)))
        out.append([(int(edge[i]), int(edge[i + 1]) - 1) for i in range(0, len(edge), 2)])
    return out


SETTLED = pa.schema([("core", pa.int64()), ("entry", pa.int64()), ("lo", pa.int32()), ("hi", pa.int32()), ("near", pa.list_(pa.int32())), ("far", pa.list_(pa.int32()))])
SETTLED_DDL = "core long, entry long, lo int, hi int, near array<int>, far array<int>"


def settled(entries: DataFrame, length: int) -> DataFrame:
    """Stretches of the entries (with left and right), core by core."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group: list[dict] = []
        out: list[tuple] = []

        def finish() -> None:
            for r, found in zip(group, settle([(r["lo"], r["hi"], r["n"], r["left"], r["right"]) for r in group], length), strict=True):
                if found:
                    out.append((r["core"], r["entry"], r["lo"], r["hi"], [a for a, _ in found], [b for _, b in found]))

        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                for r in batch.slice(at, 1024).to_pylist():
                    if group and group[0]["core"] != r["core"]:
                        finish()
                        group = []
                    group.append(r)
                if len(out) >= 4096:
                    yield record(SETTLED, list(map(list, zip(*out, strict=True))))
                    out = []
        if group:
            finish()
        if out:
            yield record(SETTLED, list(map(list, zip(*out, strict=True))))

    return entries.repartition("core").sortWithinPartitions("core").mapInArrow(run, SETTLED_DDL)


def counted(entries: DataFrame, length: int, scratch: Scratch) -> DataFrame:
    """The same for cores with many entries: every window is digested, and digests are counted."""
    schema = pa.schema([("core", pa.int64()), ("entry", pa.int64()), ("lo", pa.int32()), ("hi", pa.int32()), ("n", pa.int64()), ("l", pa.int32()), ("p", pa.int64()), ("q", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                out = []
                for r in batch.slice(at, 256).to_pylist():
                    whole = r["left"] + r["right"]
                    for l in range(r["lo"], r["hi"] + 1):
                        start = len(r["left"]) - l
                        p, q = np.frombuffer(xxhash.xxh3_128_digest(whole[start : start + length]), dtype=np.int64).tolist()
                        out.append((r["core"], r["entry"], r["lo"], r["hi"], r["n"], l, p, q))
                if out:
                    yield record(schema, list(map(list, zip(*out, strict=True))))

    windows = scratch.cut(entries.mapInArrow(run, "core long, entry long, lo int, hi int, n long, l int, p long, q long"))
    twice = windows.groupBy("p", "q").agg(F.sum("n").alias("all")).filter("all > 1").select("p", "q")
    return windows.join(twice, ["p", "q"]).groupBy("core", "entry", "lo", "hi").agg(F.collect_list("l").alias("near")).select("core", "entry", "lo", "hi", "near", F.col("near").alias("far"))


def compressed(docs: DataFrame) -> DataFrame:
    """docs(key, raw, ...) with raw compressed, for its way through a shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=3).compress
        for batch in batches:
            at = batch.schema.get_field_index("raw")
            columns = list(batch.columns)
            columns[at] = pa.array([pack(v.as_py()) for v in columns[at]], pa.binary())
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)

    return docs.mapInArrow(run, docs.schema)


def entry_bytes(docs: DataFrame, wanted: DataFrame, length: int) -> DataFrame:
    """core, entry, lo, hi, n, many, left, right of the wanted entries, whose key and place tell where to find one."""
    lists = wanted.groupBy("key").agg(F.collect_list(F.struct("core", "entry", "lo", "hi", "n", "many", "place")).alias("entries"))
    schema = pa.schema([("core", pa.int64()), ("entry", pa.int64()), ("lo", pa.int32()), ("hi", pa.int32()), ("n", pa.int64()), ("many", pa.bool_()), ("left", pa.binary()), ("right", pa.binary())])

    @tidied
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            out = []
            for raw, entries in zip(batch.column(0), batch.column(1), strict=True):
                raw = unpack(raw.as_py())
                for e in entries.as_py():
                    a = e["place"]
                    out.append((e["core"], e["entry"], e["lo"], e["hi"], e["n"], e["many"], raw[a - e["hi"] : a], raw[a : a - e["lo"] + length]))
                if len(out) >= 4096:
                    yield record(schema, list(map(list, zip(*out, strict=True))))
                    out = []
            if out:
                yield record(schema, list(map(list, zip(*out, strict=True))))

    one = compressed(docs.select("key", "raw")).join(lists, "key").dropDuplicates(["key"])
    return one.select("raw", "entries").mapInArrow(run, "core long, entry long, lo int, hi int, n long, many boolean, left binary, right binary")


def row_key(docs: DataFrame) -> Column:
    """Equal for rows with equal ids and texts only."""
    return F.xxhash64(F.col("doc_id"), F.coalesce(F.col("text"), F.lit("")))


def repeated_spans(docs: DataFrame, scratch: Scratch, length: int = LENGTH, spread: int = SPREAD) -> DataFrame:
    """key, starts, ends: the spans that repeated windows cover, of docs(key, raw), unsorted and overlapping."""
    same = ["core", "entry", "lo", "hi"]
    rows = scratch.cut(repeating(anchors(docs.select("key", "raw"), length, spread)))
    entries = scratch.cut(rows.groupBy(*same).agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("key", "place")).alias("at")))
    kinds = entries.groupBy("core").agg(F.count(F.lit(1)).alias("m")).filter("m > 1")
    wanted = entries.join(kinds, "core").select(*same, "n", (F.col("m") > MOST_ENTRIES).alias("many"), "at.key", "at.place")
    held = scratch.cut(entry_bytes(docs, wanted, length))
    edges = settled(held.filter("not many").drop("many"), length)
    many = held.filter("many").drop("many")
    if not many.isEmpty():
        edges = edges.unionByName(counted(many, length, scratch))
    edges = scratch.cut(edges)
    whole = entries.filter("n > 1").select(*same, F.array("lo").alias("near"), F.array("hi").alias("far"))
    found = whole.unionByName(edges.join(whole.select(*same), same, "left_anti"))
    spans = rows.join(found, same).select("key", F.explode(F.arrays_zip("near", "far")).alias("s"), "place")
    spans = spans.select("key", F.struct((F.col("place") - F.col("s.far")).alias("a"), (F.col("place") - F.col("s.near") + length).alias("b")).alias("span"))
    return spans.groupBy("key").agg(F.collect_set("span").alias("spans"))


def disjoint(spans: list[dict]) -> list[Stretch]:
    """Maximal runs of covered bytes, as starts and ends (exclusive)."""
    out: list[Stretch] = []
    for a, b in sorted((s["a"], s["b"]) for s in spans):
        if out and a <= out[-1][1]:
            if b > out[-1][1]:
                out[-1] = (out[-1][0], b)
        else:
            out.append((a, b))
    return out


def without(raw: bytes, runs: list[Stretch]) -> bytes:
    parts, at = [], 0
    for a, b in runs:
        parts.append(raw[at:a])
        at = b
    parts.append(raw[at:])
    return b"".join(parts)


def keyed_spans(docs: DataFrame, scratch: Scratch, length: int, spread: int) -> DataFrame:
    """docs' columns, key, raw (compressed) and spans (null where there are none)."""
    raw = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    own = docs.withColumns({"key": row_key(docs), "raw": raw})
    spans = scratch.cut(repeated_spans(own.select("key", "raw"), scratch, length, spread))
    return compressed(own.drop("text")).join(spans, "key", "left")


def with_spans(docs: DataFrame, scratch: Scratch, length: int, spread: int) -> DataFrame:
    """docs' columns, raw (compressed) and spans (null where there are none)."""
    return keyed_spans(docs, scratch, length, spread).drop("key")


def long_runs(docs: DataFrame, least: int) -> DataFrame:
    """key, at, raw: the runs of at least `least` bytes of docs(key, raw, spans), raw as it is."""
    schema = pa.schema([("key", pa.int64()), ("at", pa.int64()), ("raw", pa.binary())])

    @tidied
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            rows = []
            for key, raw, spans in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2), strict=True):
                runs = [(a, b) for a, b in disjoint(spans.as_py()) if b - a >= least]
                raw = unpack(raw.as_py()) if runs else b""
                rows += [(key, a, raw[a:b]) for a, b in runs]
            if rows:
                yield record(schema, list(map(list, zip(*rows, strict=True))))

    return docs.filter("spans is not null").select("key", "raw", "spans").mapInArrow(run, "key long, at long, raw binary")


def spans_within(runs: DataFrame, scratch: Scratch, length: int, spread: int) -> DataFrame:
    """key, within: the spans that repeated windows of `length` bytes cover, of runs(key, at, raw), by their places in the whole text."""
    parts = runs.select("key", "at", F.xxhash64("key", "at").alias("part"), "raw")
    spans = repeated_spans(parts.select(F.col("part").alias("key"), "raw"), scratch, length, spread).withColumnRenamed("key", "part")
    moved = F.transform("spans", lambda s: F.struct((s["a"] + F.col("at")).alias("a"), (s["b"] + F.col("at")).alias("b")))
    return parts.select("key", "at", "part").join(spans, "part").groupBy("key").agg(F.flatten(F.collect_set(moved)).alias("within"))


def repeats_removed(docs: DataFrame, length: int = LENGTH, spread: int = SPREAD) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of each document."""
    schema = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string())])

    @tidied
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            rows = []
            for doc, raw, spans in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2), strict=True):
                raw, runs = unpack(raw.as_py()), disjoint(spans.as_py() or [])
                rows.append((doc, len(raw), sum(b - a for a, b in runs), len(runs), hashlib.sha256(without(raw, runs)).hexdigest()))
            if rows:
                yield record(schema, list(map(list, zip(*rows, strict=True))))

    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    with Scratch(docs.sparkSession) as scratch:
        return cut(with_spans(own, scratch, length, spread).select("doc_id", "raw", "spans").mapInArrow(run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"))


def passages(raw: bytes, runs: list[Stretch], most_words: int) -> list[Stretch]:
    """The runs of more than most_words words (white-space separated, cut ones counted) or of LENGTH bytes or more."""
    return [(a, b) for a, b in runs if b - a >= LENGTH or len(raw[a:b].split()) > most_words]


def cleaned(docs: DataFrame, length: int = SHORT, spread: int = SHORT_SPREAD, most_words: int = MOST_WORDS) -> DataFrame:
    """docs without their repeated passages: maximal runs of bytes that strings of `length` bytes cover which also start
    anywhere else, if they have more than most_words words or LENGTH bytes. Every occurrence goes; n_chars, where there is such a
    column, is counted anew, and what is left of a character that was cut goes too. A document of which only white
    space is left goes.

    Defined results: a row that had nothing removed stays as it is, nulls included (null texts have nothing to remove);
    rows with equal ids and texts are occurrences of each other; an empty table gives no rows. The columns of docs stay,
    whatever their names, in their order."""
    columns = docs.columns
    inner = {"doc_id": "doc_id", **{c: f"c{i}" for i, c in enumerate(columns) if c not in ("doc_id", "text")}}
    own = docs.select(F.col("text"), F.col("text").isNull().alias("void"), *[F.col(f"`{c}`").alias(n) for c, n in inner.items()])

    @tidied
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            texts, keep, sizes = [], [], []
            for raw, spans, void in zip(batch.column("raw"), batch.column("spans"), batch.column("void"), strict=True):
                raw = unpack(raw.as_py())
                runs = passages(raw, disjoint(spans.as_py() or []), most_words)
                text = without(raw, runs).decode("utf-8", "ignore")
                texts.append(None if void.as_py() else text)
                sizes.append(len(text) if runs else None)
                keep.append(not runs or bool(text.strip()))
            out = {c: batch.column(n) for c, n in inner.items()} | {"text": pa.array(texts, pa.string())}
            if "n_chars" in out:
                out["n_chars"] = pc.coalesce(pa.array(sizes, out["n_chars"].type), out["n_chars"])
            done = pa.RecordBatch.from_arrays([out[c] for c in columns], names=columns)
            yield done.filter(pa.array(keep, pa.bool_()))

    with Scratch(docs.sparkSession) as scratch:
        return cut(with_spans(own, scratch, length, spread).mapInArrow(run, docs.schema))


def repeats_and_passages(docs: DataFrame, length: int = LENGTH, spread: int = SPREAD, short: int = SHORT, short_spread: int = SHORT_SPREAD, most_words: int = MOST_WORDS) -> DataFrame:
    """What `repeats_removed` returns for strings of `length` bytes, and n_passages, n_passage_bytes of what `cleaned` takes out for
    strings of `short` bytes (no more than `length`). A repeated string of `length` bytes lies in a run that repeated strings of `short` bytes
    cover, and so does its twin: only these runs are parsed for the longer ones."""
    schema = pa.schema(
        [("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string()), ("n_passages", pa.int64()), ("n_passage_bytes", pa.int64())]
    )

    @tidied
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            rows = []
            for doc, raw, spans, within in zip(batch.column(0).to_pylist(), *batch.columns[1:], strict=True):
                raw, runs = unpack(raw.as_py()), disjoint(within.as_py() or [])
                found = passages(raw, disjoint(spans.as_py() or []), most_words)
                kept = hashlib.sha256(without(raw, runs)).hexdigest()
                rows.append((doc, len(raw), sum(b - a for a, b in runs), len(runs), kept, len(found), sum(b - a for a, b in found)))
            if rows:
                yield record(schema, list(map(list, zip(*rows, strict=True))))

    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    with Scratch(docs.sparkSession) as scratch:
        held = scratch.cut(keyed_spans(own, scratch, short, short_spread))
        runs = scratch.cut(long_runs(held, length))
        within = spans_within(runs, scratch, length, spread)
        found = held.join(within, "key", "left").select("doc_id", "raw", "spans", "within")
        return cut(found.mapInArrow(run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, n_passages long, n_passage_bytes long"))


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats_and_passages(table(spark, sf_dir, "documents"))


QUERIES = {"op1_suffix_dedup": op1_suffix_dedup}
