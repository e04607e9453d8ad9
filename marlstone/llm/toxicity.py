"""Toxicity by class-conditional Kneser-Ney models.

Two character models of words, one of toxic and one of ordinary text, differ in their highest order only: below it
both use the same Kneser-Ney distributions, made from the counts of both classes, so that an expression too rare for
one class's counts is judged by shared ones and hardly moves the balance. A word's balance is its log-likelihood in the toxic
model less that in the ordinary one. A document's balance, normalised by its length, and those of its most toxic
words and their share are weighed by a logistic regression, which is fitted on documents that the models had not seen.

What is learnt: counts come from all labelled rows given, and grow with them. Every n-gram is kept: totals, continuation
counts and discounts are made from the whole table of counts by grouped sums and joins, and what the n-grams weigh is
looked up in shards of sorted arrays, as many as the n-grams need; the driver and a task hold one or a few of them at a
time. The regression is fitted on about MAX_FIT documents at most, chosen by digests of their ids.

Defined results: a null or empty text, or one without letters, has balance 0 and gets the score of such a text; repeated
rows get equal scores; an empty table gives no rows; without labels of both classes every score is the share of
toxic labels (0 without labels).
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from math import log

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from marlstone.llm.common import Scratch, id_text, likely, record, table, texts_of, tidied

ORDER = 4
#: The number of the model of both halves; theirs are 0 and 1.
WHOLE = 2
#: N-grams of a shard, about.
SHARD = 1 << 20
MAX_FIT = 40_000
#: Score from which a document counts as toxic.
TOXIC = 0.7
#: A run of letters. Longer runs than this are judged in pieces.
LETTERS = re.compile(r"[^\W\d_]{1,40}")
#: Words whose balances a task remembers.
REMEMBER = 200_000
#: Different words that a task counts before it sends their n-grams.
COUNTED = 60_000
FEATURES = 6
PAD, STOP = "\x02", "\x03"


def grams(word: str) -> list[str]:
    """The word's n-grams of highest order, from its first letter to its end."""
    s = PAD * (ORDER - 1) + word + STOP
    return [s[i : i + ORDER] for i in range(len(word) + 1)]


#: Odd multipliers that turn a run of code points into a 64-bit number.
MULTIPLIERS = np.random.default_rng(4).integers(0, 2**63, ORDER, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def numbered(codes: np.ndarray, n: int) -> np.ndarray:
    """Numbers of the runs of n code points that begin at each place."""
    out = codes[: len(codes) - n + 1] * MULTIPLIERS[0]
    for k in range(1, n):
        out += codes[k : len(codes) - n + 1 + k] * MULTIPLIERS[k]
    return out


class Table:
    """Numbers of texts of equal length, looked up by binary search."""

    def __init__(self, values: dict[str, float]):
        texts = list(values)
        n = len(texts[0]) if texts else 1
        codes = np.frombuffer("".join(texts).encode("utf-32-le"), dtype=np.uint32).astype(np.uint64)
        keys = numbered(codes, n)[::n] if texts else np.zeros(0, dtype=np.uint64)
        order = np.argsort(keys)
        self.keys = np.concatenate([keys[order], np.zeros(1, dtype=np.uint64)])
        self.values = np.concatenate([np.fromiter(values.values(), dtype=float, count=len(texts))[order], np.zeros(1)])
        self.size = len(texts)

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The values, 0 where there is none, and whether there is one."""
        at = np.searchsorted(self.keys[: self.size], keys)
        known = (self.keys[at] == keys) & (at < self.size)
        return np.where(known, self.values[at], 0.0), known


class Shards:
    """A Table in broadcast pieces, dealt by the numbers, of which one is in memory at a time."""

    def __init__(self, pieces: list[Broadcast], size: int):
        self.pieces, self.size = pieces, size
        self.held: tuple[int, np.ndarray, np.ndarray] | None = None

    def __getstate__(self) -> dict:
        return {**self.__dict__, "held": None}

    def piece(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        if self.held is None or self.held[0] != i:
            self.held = None
            keys, values = self.pieces[i].value
            vars(self.pieces[i]).pop("_value", None)  # a Broadcast would remember it
            self.held = (i, np.frombuffer(keys, dtype=np.uint64), np.frombuffer(values, dtype=float))
        return self.held[1:]

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The values, 0 where there is none, and whether there is one."""
        value, known = np.zeros(len(keys)), np.zeros(len(keys), dtype=bool)
        dealt = shard_of(keys, len(self.pieces)) if self.pieces else None
        for i in range(len(self.pieces)):
            asked = np.flatnonzero(dealt == i)
            if len(asked):
                own, values = self.piece(i)
                at = np.minimum(np.searchsorted(own, keys[asked]), len(own) - 1)
                found = own[at] == keys[asked]
                value[asked], known[asked] = np.where(found, values[at], 0.0), found
        return value, known


def shard_of(keys: np.ndarray, n: int) -> np.ndarray:
    return ((keys >> np.uint64(32)) % np.uint64(n)).astype(np.int32)


class Model:
    """Log-likelihood ratios of n-grams, and of what follows a context otherwise."""

    def __init__(self, gram: dict[str, float] | Shards, context: dict[str, float] | Shards):
        self.gram, self.context = (x if isinstance(x, Shards) else Table(x) for x in (gram, context))

    def words(self, words: list[str]) -> np.ndarray:
        """The balance of each word."""
        if not words:
            return np.zeros(0)
        codes = np.frombuffer("".join([PAD * (ORDER - 1) + w + STOP for w in words]).encode("utf-32-le"), dtype=np.uint32).astype(np.uint64)
        count = np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1
        first = np.cumsum(count) - count
        places = np.arange(int(count.sum())) + np.repeat(np.arange(len(words)) * (ORDER - 1), count)
        value, known = self.gram.find(numbered(codes, ORDER)[places])
        value += np.where(known, 0.0, self.context.find(numbered(codes, ORDER - 1)[places])[0])
        return np.add.reduceat(value, first)

    def word(self, word: str) -> float:
        return float(self.words([word])[0])


def discount_of(once: int, twice: int) -> float:
    """Kneser and Ney's estimate from the numbers of n-grams seen once and twice."""
    return min(max(once / (once + 2 * twice), 0.1), 0.9) if once else 0.5


def discount(counts: list[int]) -> float:
    return discount_of(counts.count(1), counts.count(2))


def shared_model(pooled: dict[str, int]) -> Callable[[str], float]:
    """The shared distribution of orders below the highest: interpolated Kneser-Ney over continuation counts."""
    levels: list[tuple[dict[str, int], dict[str, tuple[int, int]], float]] = []
    types = set(pooled)
    for _ in range(ORDER - 1):
        count = Counter(g[1:] for g in types)  # of different letters before
        contexts: dict[str, tuple[int, int]] = {}
        for g, n in count.items():
            a, b = contexts.get(g[:-1], (0, 0))
            contexts[g[:-1]] = (a + n, b + 1)
        levels.append((count, contexts, discount(list(count.values()))))
        types = set(count)
    letters = len({g[-1] for g in pooled}) + 1

    def p(g: str) -> float:
        """Probability of the last letter of g, of order ORDER - 1, after the others."""
        value = 1.0 / letters
        for k in range(ORDER - 2, -1, -1):
            count, contexts, d = levels[k]
            own = g[k:]
            total, kinds = contexts.get(own[:-1], (0, 0))
            if total:
                value = (max(count.get(own, 0) - d, 0.0) + d * kinds * value) / total
        return value

    return p


def kneser_ney(counts: dict[str, tuple[int, int]]) -> Model:
    """counts: of each n-gram in ordinary and in toxic text. In memory; log_ratios() makes the same of a table."""
    pooled = {g: a + b for g, (a, b) in counts.items()}
    p = shared_model(pooled)
    d = [discount([x[c] for x in counts.values()]) for c in (0, 1)]
    totals: dict[str, list[int]] = {}
    for g, x in counts.items():
        t = totals.setdefault(g[:-1], [0, 0, 0, 0])
        for c in (0, 1):
            t[c] += x[c]
            t[2 + c] += x[c] > 0
    left = {h: tuple(d[c] * t[2 + c] / t[c] if t[c] else 1.0 for c in (0, 1)) for h, t in totals.items()}
    gram = {}
    for g, x in counts.items():
        h, q = g[:-1], p(g[1:])
        ordinary, toxic = ((max(x[c] - d[c], 0.0) / totals[h][c] if totals[h][c] else 0.0) + left[h][c] * q for c in (0, 1))
        gram[g] = log(toxic / ordinary)
    return Model(gram, {h: log(b / a) for h, (a, b) in left.items()})


class Judge:
    """Features of texts by one model, which remembers words."""

    def __init__(self, model: Model):
        self.model = model
        self.known: dict[str, float] = {}

    def features(self, texts: list[str]) -> list[list[float]]:
        """Of each text: its balance a letter, the balance of its most toxic word, means of the 3 and of the 8 most toxic,
        and the shares of words over 1.5 and over 4."""
        lists = [LETTERS.findall(t.lower()) for t in texts]
        if len(self.known) >= REMEMBER:
            self.known.clear()
        new = list(set().union(*lists).difference(self.known))
        self.known.update(zip(new, self.model.words(new).tolist(), strict=True))
        return [self._of(words) for words in lists]

    def _of(self, words: list[str]) -> list[float]:
        if not words:
            return [0.0] * FEATURES
        each = np.fromiter(map(self.known.__getitem__, words), dtype=float, count=len(words))
        n = len(each)
        top = np.sort(np.partition(each, n - 8)[-8:] if n > 8 else each)[::-1]
        return [float(each.sum() / sum(map(len, words))), float(top[0]), float(top[:3].sum() / 3), float(top.sum() / 8), np.count_nonzero(each > 1.5) / n, np.count_nonzero(each > 4) / n]


def features_of(texts: Iterator[str], judge: Judge, step: int = 500) -> list[list[float]]:
    out: list[list[float]] = []
    held: list[str] = []
    for t in texts:
        held.append(t)
        if len(held) >= step:
            out += judge.features(held)
            held = []
    return out + judge.features(held)


@dataclass
class Scorer:
    models: list[Model]
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    base: float

    def scores(self, x: np.ndarray) -> np.ndarray:
        if not len(self.weights):
            return np.full(len(x), self.base)
        z = np.column_stack([np.ones(len(x)), (x - self.mean) / self.scale]) @ self.weights
        return 1.0 / (1.0 + np.exp(-np.clip(z, -30, 30)))


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, steps: int = 30) -> np.ndarray:
    """Weights by Newton's method; the first is the intercept, which the ridge leaves alone."""
    a = np.column_stack([np.ones(len(x)), x])
    w = np.zeros(a.shape[1])
    r = np.diag([1e-6] + [ridge] * x.shape[1])
    for _ in range(steps):
        p = 1.0 / (1.0 + np.exp(-np.clip(a @ w, -30, 30)))
        step = np.linalg.solve(a.T @ (a * (p * (1 - p))[:, None]) + r, a.T @ (y - p) - r @ w)
        w += step
        if abs(step).max() < 1e-8:
            break
    return w


def count_grams(docs: DataFrame) -> DataFrame:
    """gram, half, ordinary, toxic: counts over docs(text, toxic, half)."""

    @tidied
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("gram", pa.string()), ("half", pa.int32()), ("ordinary", pa.int64()), ("toxic", pa.int64())])
        words: Counter[tuple[str, int, int]] = Counter()

        def emit() -> pa.RecordBatch:
            found: dict[tuple[str, int], list[int]] = {}
            for (word, half, toxic), n in words.items():
                for g in grams(word):
                    found.setdefault((g, half), [0, 0])[toxic] += n
            words.clear()
            return record(schema, [[g for g, _ in found], [h for _, h in found], [n[0] for n in found.values()], [n[1] for n in found.values()]])

        for batch in batches:
            for text, toxic, half in zip(texts_of(batch), batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                words.update((w, half, toxic) for w in LETTERS.findall(text.lower()))
                if len(words) >= COUNTED:
                    yield emit()
        if words:
            yield emit()

    counted = docs.select("text", F.col("toxic").cast("int").alias("toxic"), F.col("half").cast("int").alias("half")).mapInArrow(count, "gram string, half int, ordinary long, toxic long")
    return counted.groupBy("gram", "half").agg(F.sum("ordinary").alias("ordinary"), F.sum("toxic").alias("toxic"))


def by_model(values: dict[int, float]) -> Column:
    out = F.lit(0.5)
    for m, v in values.items():
        out = F.when(F.col("model") == m, F.lit(v)).otherwise(out)
    return out


def discounts(counts: DataFrame, name: str) -> Column:
    """Each model's discount from the column of counts."""
    seen = counts.groupBy("model").agg(F.count_if(F.col(name) == 1).alias("once"), F.count_if(F.col(name) == 2).alias("twice")).collect()
    return by_model({r["model"]: discount_of(r["once"], r["twice"]) for r in seen})


def log_ratios(counts: DataFrame, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """What kneser_ney() makes, as tables of model, text, value: of n-grams, and of contexts. counts has model, gram,
    ordinary and toxic. Each level's counts are grouped from all those above it."""
    head, tail = F.expr("substring(gram, 1, char_length(gram) - 1)"), F.expr("substring(gram, 2)")
    among = Window.partitionBy("model", "before")
    levels, types = [], counts
    for _ in range(ORDER - 1):
        types = scratch.cut(types.groupBy("model", tail.alias("gram")).agg(F.count(F.lit(1)).alias("n")))
        levels.append(types)
    letters = {r["model"]: r["count"] + 1 for r in levels[-1].groupBy("model").count().collect()}
    p = None
    for level in reversed(levels):
        d = discounts(level, "n")
        placed = level.withColumn("before", head).withColumn("total", F.sum("n").over(among)).withColumn("kinds", F.count(F.lit(1)).over(among))
        lower = placed.withColumn("q", 1.0 / by_model(letters)) if p is None else placed.withColumn("after", tail).join(p.select("model", F.col("gram").alias("after"), F.col("p").alias("q")), ["model", "after"])
        p = scratch.cut(lower.select("model", "gram", ((F.greatest(F.col("n") - d, F.lit(0.0)) + d * F.col("kinds") * F.col("q")) / F.col("total")).alias("p")))
    ds = {c: discounts(counts, c) for c in ("ordinary", "toxic")}

    def left(c: str) -> Column:
        return F.when(F.col(f"total_{c}") > 0, ds[c] * F.col(f"kinds_{c}") / F.col(f"total_{c}")).otherwise(1.0)

    def own(c: str) -> Column:
        seen = F.when(F.col(f"total_{c}") > 0, F.greatest(F.col(c) - ds[c], F.lit(0.0)) / F.col(f"total_{c}")).otherwise(0.0)
        return seen + left(c) * F.col("q")

    headed = counts.withColumn("before", head)
    sums = [f(c) for c in ds for f in (lambda c: F.sum(c).alias(f"total_{c}"), lambda c: F.count_if(F.col(c) > 0).alias(f"kinds_{c}"))]
    contexts = scratch.cut(headed.groupBy("model", "before").agg(*sums))
    asked = headed.join(contexts, ["model", "before"]).withColumn("after", tail).join(p.select("model", F.col("gram").alias("after"), F.col("p").alias("q")), ["model", "after"])
    ratios = scratch.cut(asked.select("model", F.col("gram").alias("text"), F.log(own("toxic") / own("ordinary")).alias("value")))
    return ratios, contexts.select("model", F.col("before").alias("text"), F.log(left("toxic") / left("ordinary")).alias("value"))


def sharded(values: DataFrame, n: int) -> dict[int, Shards]:
    """The values(model, text, value) of texts of length n, by model. The driver has a few shards at a time."""
    size = {r["model"]: r["count"] for r in values.groupBy("model").count().collect()}
    pieces = {m: 1 + k // SHARD for m, k in size.items()}

    @tidied
    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes = np.frombuffer("".join(texts_of(batch)).encode("utf-32-le"), dtype=np.uint32).astype(np.uint64)
            keys = numbered(codes, n)[::n] if len(codes) else np.zeros(0, dtype=np.uint64)
            model = batch.column(0).to_numpy()
            shard = np.zeros(len(keys), dtype=np.int32)
            for m, k in pieces.items():
                shard[model == m] = shard_of(keys[model == m], k)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(shard), pa.array(keys.view(np.int64)), batch.column(2)], ["model", "shard", "key", "value"])

    def pack(group: pa.Table) -> pa.Table:
        keys = group.column("key").to_numpy().view(np.uint64)
        order = np.argsort(keys)
        packed = [pa.array([x[order].tobytes()], pa.binary()) for x in (keys, group.column("value").to_numpy())]
        return pa.table([group.column("model")[:1], group.column("shard")[:1], *packed], names=["model", "shard", "keys", "values"])

    dealt = values.mapInArrow(deal, "model int, shard int, key long, value double")
    sent: dict[int, dict[int, Broadcast]] = {m: {} for m in size}
    for r in dealt.groupBy("model", "shard").applyInArrow(pack, "model int, shard int, keys binary, values binary").toLocalIterator():
        sent[r["model"]][r["shard"]] = values.sparkSession.sparkContext.broadcast((bytes(r["keys"]), bytes(r["values"])))
    none = (b"\0" * 8, b"\0" * 8)
    for m, k in pieces.items():
        for i in set(range(k)).difference(sent[m]):
            sent[m][i] = values.sparkSession.sparkContext.broadcast(none)
    return {m: Shards([sent[m][i] for i in range(k)], size[m]) for m, k in pieces.items()}


def estimated(counts: DataFrame, scratch: Scratch) -> dict[int, Model]:
    """The model of each number in counts(model, gram, ordinary, toxic)."""
    grams, contexts = log_ratios(counts, scratch)
    gram, context = sharded(grams, ORDER), sharded(contexts, ORDER - 1)
    return {m: Model(gram[m], context[m]) for m in gram}


def with_features(docs: DataFrame, models: dict[int, Model], by: str) -> DataFrame:
    """docs(doc_id, text, by, ...) without the text and with its features by models[by], whose shards are broadcast."""
    keep = [c for c in docs.columns if c != "text"]
    kept = docs.select("text", *keep)

    @tidied
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judges = {k: Judge(m) for k, m in models.items()}
        at = keep.index(by) + 1
        for whole in batches:
            for k, judge in judges.items():
                batch = whole.filter(pa.array(whole.column(at).to_numpy() == k))
                x = pa.array(features_of(texts_of(batch), judge), pa.list_(pa.float64()))
                yield pa.RecordBatch.from_arrays([*batch.columns[1:], x], [*keep, "features"])

    schema = ", ".join(f"{c} {docs.schema[c].dataType.simpleString()}" for c in keep)
    return kept.mapInArrow(run, f"{schema}, features array<double>")


def learn(labelled: DataFrame, max_fit: int = MAX_FIT) -> Scorer:
    """From labelled(doc_id, text, toxic). The two halves of the ids' digests teach a model each, which gives the
    features of the other half for the regression; scores use both halves' counts."""
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))
    half = F.pmod(F.crc32(F.concat(F.lit("half:"), key).cast("binary")), F.lit(2)).cast("int")
    rows = labelled.filter(F.col("toxic").isin(0, 1)).select("doc_id", "text", F.col("toxic").cast("int").alias("toxic"), half.alias("half"))
    with Scratch(labelled.sparkSession) as scratch:
        rows = scratch.cut(rows)
        counts = scratch.cut(count_grams(rows))
        whole = counts.groupBy("gram").agg(F.sum("ordinary").alias("ordinary"), F.sum("toxic").alias("toxic")).select(F.lit(WHOLE).alias("model"), "gram", "ordinary", "toxic")
        made = estimated(scratch.cut(counts.select(F.col("half").alias("model"), "gram", "ordinary", "toxic").unionByName(whole)), scratch)
        # each half's model gives the features of the other
        models = {1 - h: made.get(h, Model({}, {})) for h in (0, 1)}
        share = max_fit / max(rows.count(), 1)
        place = F.pmod(F.xxhash64(F.concat(F.lit("fit:"), key)), F.lit(1 << 20))
        fit = rows.filter(place < int(share * (1 << 20))) if share < 1 else rows
        got = with_features(fit, models, "half").select("toxic", "features").toPandas()
    y = got["toxic"].to_numpy(dtype=float)
    base = float(y.mean()) if len(y) else 0.0
    none = np.zeros(0)
    if not 0 < base < 1:
        return Scorer([Model({}, {})], none, none, none, base)
    x = np.asarray(got["features"].tolist())
    mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-6
    return Scorer([made.get(WHOLE, Model({}, {}))], mean, scale, logistic((x - mean) / scale, y), base)


def score(docs: DataFrame, scorer: Scorer, name: str = "score") -> DataFrame:
    """docs with a column `name`, which must be new; a narrow map. The other columns stay."""

    @tidied
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge = Judge(scorer.models[0])
        for batch in batches:
            rows = features_of(texts_of(batch, "text"), judge)
            scores = scorer.scores(np.asarray(rows).reshape(-1, FEATURES))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores, pa.float64())], [*batch.schema.names, name])

    if name in docs.columns:
        raise ValueError(f"docs has a column {name!r} already")
    return docs.mapInArrow(run, StructType([*docs.schema, StructField(name, DoubleType())]))


def below(docs: DataFrame, scorer: Scorer, threshold: float = TOXIC) -> DataFrame:
    """The rows of docs whose score is below the threshold, as they are. A null or empty text is scored like any other."""
    name = "score"
    while name in docs.columns:
        name += "_"
    return score(docs, scorer, name).filter(F.col(name) < threshold).drop(name)


def remainder(doc_id) -> F.Column:
    """crc32 of the id as text, modulo 3; null for a null id."""
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(3))


def with_labels(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, text and toxic of the documents that may teach: those with a label that are not held out. One with
    several labels counts with each. Only texts that the labels ask for are shuffled, at every size of the labels."""
    taught = labels.select(F.col("doc_id").cast("long").alias("doc_id"), "toxic").filter(remainder(F.col("doc_id")) != 1)
    return likely(id_text(docs), taught.select("doc_id")).join(taught.hint("merge"), "doc_id")


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = id_text(table(spark, sf_dir, "documents"))
    scorer = learn(with_labels(docs, table(spark, sf_dir, "labels")))
    held = F.coalesce(remainder(F.col("doc_id")) == 1, F.lit(False))
    return score(docs, scorer).select("doc_id", held.alias("held_out"), "score", (F.col("score") >= TOXIC).cast("int").alias("predicted"))


QUERIES = {"op7_toxicity": op7_toxicity}
