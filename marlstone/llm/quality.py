"""Quality rules: robust multivariate outliers of text statistics.

Every text gets base statistics by fixed rules. Those that pass the base rules are judged by four transformed
statistics (letters a word, symbols, repeated lines, repeated words): each language and source has a centre and a
covariance by minimum covariance determinant, and a text whose squared Mahalanobis distance from them exceeds CUTOFF
is rejected. In each concentration step the COVERAGE nearest rows give the next mean and covariance. A group has three
starts (medians and quartiles; correlations of hyperbolic tangents; spatial signs), which TRIAL steps improve; the one
with the smallest determinant goes on until no step lowers it by STILL any more. At last the estimate is reweighted by
the rows within the 97.5 % ellipsoid. A group with fewer than LEAST rows is judged by its language, and a language with
fewer by all rows.

All rows count in every step; a step is two aggregations of narrow rows with partial sums, so a group of any size
costs no task more than others: groups' shapes are broadcast while there are at most MOST_BROADCAST of them, and joined
otherwise. Spreads below FLOOR count as FLOOR: most texts have no symbol or repeated line at all, which without it would
make any such text an outlier; and no direction has less than NARROW of the floors' variance, so that rows on a line
or a plane have a determinant.

Defined results: a null text has no words, fails the base rules and is not kept; null languages and sources are
groups of their own; repeated rows are judged alike; an empty table gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marlstone.llm.common import WORD, cut, record, table, texts_of

WORDS = re.compile(WORD)
SYMBOLS = re.compile(r"[#*$%&|<>]")
DIMS = 4
#: Of logarithms (letters a word; 1 + symbols in 1000 characters) and of angles (arc sine of a share's root).
FLOOR = (0.06, 0.5, 0.15, 0.15)
COVERAGE, TRIAL, LEAST = 0.75, 2, 100
#: What a step has to lower a logarithm of a determinant by for another one to follow; the least variance of a direction.
STILL, NARROW = 0.001, 0.05
#: Rows of shapes that are broadcast; one is about 150 bytes.
MOST_BROADCAST = 100_000
#: Chi-square quantiles of 4 degrees of freedom: of 0.75 and 0.975; and what a kept text may have (0.999995).
CHI_COVERAGE, CHI_WEIGHT, CUTOFF = 5.385, 11.143, 30.0
#: Factors that make the covariance of the rows within those ellipsoids one of all rows: p / P(chi-square of 6 degrees of freedom < quantile)
CONSISTENT_COVERAGE, CONSISTENT_WEIGHT = 0.75 / 0.5047, 0.975 / 0.9159

STATS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, n_lines long"
BASE = pa.schema([(n, pa.int64()) for n in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines")])


def repeated_words(words: list[str]) -> int:
    """Words that stand in a window of three that occurs twice or more in the text."""
    windows = list(zip(words, words[1:], words[2:], strict=False))
    if len(set(windows)) == len(windows):
        return 0
    first: dict[tuple[str, str, str], int] = {}
    within = bytearray(len(words))
    for i, w in enumerate(windows):
        j = first.setdefault(w, i)
        if j != i:
            within[i : i + 3] = b"\1\1\1"
            within[j : j + 3] = b"\1\1\1"
    return sum(within)


def base_statistics(text: str) -> tuple[int, ...]:
    words = WORDS.findall(text)
    lines = [x for x in text.split("\n") if WORDS.search(x)]
    return len(words), sum(map(len, words)), len(SYMBOLS.findall(text)), len(lines) - len(set(lines)), repeated_words(words), len(lines)


def measure(docs: DataFrame, keep: list[str]) -> DataFrame:
    """The columns `keep` and the base statistics; a narrow map."""
    kept = docs.select(F.col("text").cast("string").alias("text"), *keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [base_statistics(t) for t in texts_of(batch)]
            if rows:
                stats = record(BASE, list(map(list, zip(*rows, strict=True))))
                yield pa.RecordBatch.from_arrays([*batch.columns[1:], *stats.columns], [*batch.schema.names[1:], *BASE.names])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields[1:])
    return kept.mapInArrow(run, f"{schema}, {STATS}")


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def vector() -> list[Column]:
    """The transformed statistics."""
    angle = lambda part, whole: F.asin(F.sqrt(F.least(F.lit(1.0), F.col(part) / F.greatest(F.col(whole), F.lit(1)))))
    return [
        F.log(F.greatest(F.col("word_chars"), F.lit(1)) / F.greatest(F.col("n_words"), F.lit(1))),
        F.log1p(1000.0 * F.col("n_symbols") / F.greatest(F.col("word_chars"), F.lit(1))),
        angle("n_dup_lines", "n_lines"),
        angle("n_repeat_words", "n_words"),
    ]


X = [f"x{i}" for i in range(DIMS)]
PAIRS = [(i, j) for i in range(DIMS) for j in range(i + 1)]
#: A group's centre, and the rows of the matrix that turns a difference from it into one of unit covariance.
SHAPE = [f"m{i}" for i in range(DIMS)] + [f"w{i}{j}" for i, j in PAIRS]
#: Rows of a table of shapes: group, start, logarithm of the determinant, shape.
SHAPES = pa.schema([("grp", pa.string()), ("start", pa.int32()), ("logdet", pa.float64()), *((n, pa.float64()) for n in SHAPE)])
SHAPES_DDL = "grp string, start int, logdet double, " + ", ".join(f"{n} double" for n in SHAPE)


def distance() -> Column:
    """Squared Mahalanobis distance of x0.. by m0.. and the lower triangular w00.. ."""
    rows = []
    for i in range(DIMS):
        row = sum((F.col(f"w{i}{j}") * (F.col(f"x{j}") - F.col(f"m{j}")) for j in range(i + 1)), F.lit(0.0))
        rows.append(row * row)
    return sum(rows[1:], rows[0])


def shape_of(m: np.ndarray, c: np.ndarray) -> list[float]:
    """logdet and SHAPE of a centre and a covariance, whose spreads are raised to their floors: that adds variance of its
    own, and correlations fall accordingly."""
    floor = np.array(FLOOR)
    spread = np.sqrt(np.maximum(np.diag(c), 0.0))
    c = c.copy()
    c[np.diag_indices(DIMS)] = np.maximum(spread, floor) ** 2
    values, axes = np.linalg.eigh(c / np.outer(floor, floor))
    c = (axes * np.maximum(values, NARROW)) @ axes.T * np.outer(floor, floor)
    w = np.linalg.inv(np.linalg.cholesky(c))
    return [-2 * float(np.log(np.diag(w)).sum()), *m.tolist(), *(float(w[i, j]) for i, j in PAIRS)]


def matrix(row: dict, name: str) -> np.ndarray:
    c = np.zeros((DIMS, DIMS))
    for i, j in PAIRS:
        c[i, j] = c[j, i] = row[f"{name}{i}{j}"]
    return c


def vector_of(row: dict, name: str) -> np.ndarray:
    return np.array([row[f"{name}{i}"] for i in range(DIMS)])


def product_sums(names: list[str], out: str) -> list[Column]:
    return [F.sum(F.col(names[i]) * F.col(names[j])).alias(f"{out}{i}{j}") for i, j in PAIRS]


def made(stats: DataFrame, shapes: Callable[[dict], list[list]]) -> DataFrame:
    """A table of the shapes that each row of sums gives, its lineage cut."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [x for r in batch.to_pylist() for x in shapes(r)]
            if out:
                yield record(SHAPES, [list(x) for x in zip(*out, strict=True)])

    return cut(stats.mapInArrow(run, SHAPES_DDL))


def moments(rows: DataFrame, factor: float) -> DataFrame:
    """The shape of each grp and start by means and covariances of its rows, times factor."""

    def shapes(r: dict) -> list[list]:
        m = vector_of(r, "s") / r["n"]
        return [[r["grp"], r["start"], *shape_of(m, (matrix(r, "p") / r["n"] - np.outer(m, m)) * factor)]]

    sums = [F.sum(x).alias(f"s{i}") for i, x in enumerate(X)]
    return made(rows.groupBy("grp", "start").agg(F.count(F.lit(1)).alias("n"), *sums, *product_sums(X, "p")), shapes)


def starts(rows: DataFrame, held: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Three shapes a group, all with the medians as centre and spreads by the distance between the quartiles: without
    correlations, with those of hyperbolic tangents, and with those of spatial signs."""
    quartiles = rows.groupBy("grp").agg(*[F.percentile_approx(x, [0.25, 0.5, 0.75], 1000).alias(x) for x in X])
    scales = [F.greatest((F.col(x)[2] - F.col(x)[0]) / 1.349, F.lit(f)).alias(f"q{i}") for i, (x, f) in enumerate(zip(X, FLOOR, strict=True))]
    placed = cut(quartiles.select("grp", *[F.col(x)[1].alias(f"m{i}") for i, x in enumerate(X)], *scales))
    z = [f"z{i}" for i in range(DIMS)]
    t, u = [f"t{i}" for i in range(DIMS)], [f"u{i}" for i in range(DIMS)]
    own = rows.join(held(placed), "grp").withColumns({n: (F.col(f"x{i}") - F.col(f"m{i}")) / F.col(f"q{i}") for i, n in enumerate(z)})
    length = F.greatest(F.sqrt(sum((F.col(n) * F.col(n) for n in z), F.lit(0.0))), F.lit(1e-12))
    own = own.withColumns({**{a: F.tanh(n) for a, n in zip(t, z, strict=True)}, **{a: F.col(n) / length for a, n in zip(u, z, strict=True)}})
    kept = [F.first(f"{n}{i}").alias(f"{n}{i}") for n in "mq" for i in range(DIMS)]
    sums = own.groupBy("grp").agg(F.count(F.lit(1)).alias("n"), *kept, *[F.sum(x).alias(f"s{i}") for i, x in enumerate(t)], *product_sums(t, "tt"), *product_sums(u, "uu"))

    def shapes(r: dict) -> list[list]:
        m, q = vector_of(r, "m"), vector_of(r, "q")
        mean = vector_of(r, "s") / r["n"]
        out = []
        for start, c in enumerate([np.eye(DIMS), matrix(r, "tt") / r["n"] - np.outer(mean, mean), matrix(r, "uu") / r["n"]]):
            spread = np.sqrt(np.maximum(np.diag(c), 1e-12))
            out.append([r["grp"], start, *shape_of(m, c / np.outer(spread, spread) * np.outer(q, q))])
        return out

    return made(sums, shapes)


def concentrated(rows: DataFrame, shape: DataFrame, held: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """One step: the shapes of the nearest COVERAGE of each group's rows by each of its shapes."""
    near = rows.join(held(shape), "grp").withColumn("d", distance()).select("grp", "start", "d", *X)
    bound = cut(near.groupBy("grp", "start").agg(F.percentile_approx("d", COVERAGE, 1000).alias("bound")))
    return moments(near.join(held(bound), ["grp", "start"]).filter(F.col("d") <= F.col("bound")), CONSISTENT_COVERAGE)


def least(shapes: DataFrame) -> DataFrame:
    """The shape with the smallest determinant of each group; the first start among equals."""
    row = F.struct("logdet", "start", *SHAPE)
    return shapes.groupBy("grp").agg(F.min_by(row, F.struct("logdet", "start")).alias("s")).select("grp", "s.*")


def determined(rows: DataFrame, held: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """The minimum covariance determinant's shape of each group of rows(grp, x0..)."""
    shape = starts(rows, held)
    for _ in range(TRIAL):
        shape = concentrated(rows, shape, held)
    best = cut(least(shape).withColumn("moves", F.lit(True)))
    while not best.filter("moves").isEmpty():
        # only groups whose determinant still falls take another step; each fall is at least STILL, and floors end them
        moving = held(best.filter("moves").select("grp"))
        new = concentrated(rows.join(moving, "grp"), best.drop("moves"), held)
        old = best.select("grp", F.struct("start", "logdet", *SHAPE, F.lit(False).alias("moves")).alias("old"))
        falls = F.col("logdet") < F.col("old.logdet") - STILL
        taken = F.when(falls, F.struct("start", "logdet", *SHAPE, F.lit(True).alias("moves"))).otherwise(F.col("old")).alias("s")
        best = cut(old.join(new, "grp", "left").select("grp", taken).select("grp", "s.*"))
    return best.drop("moves")


def group_names() -> list[Column]:
    """Names of the group, its language and all, most special first."""
    part = lambda c: F.coalesce(F.concat(F.lit("="), F.col(c)), F.lit("null"))
    return [F.concat(F.lit("2:"), part("lang"), F.lit("\x01"), part("source")), F.concat(F.lit("1:"), part("lang")), F.lit("0:")]


def judge(docs: DataFrame, id_columns: list[str]) -> DataFrame:
    """id_columns, the base statistics, base_failed, kept and the squared distance (null where it was not asked for)."""
    keep = [*id_columns, *(c for c in ("lang", "source") if c not in id_columns)]
    measured = cut(measure(docs, keep))
    rows = measured.withColumn("base_failed", base_failed())
    passed = rows.filter(~F.col("base_failed")).select(*[v.alias(x) for v, x in zip(vector(), X, strict=True)], F.explode(F.array(*group_names())).alias("grp"))
    large = cut(passed.groupBy("grp").count().filter((F.col("count") >= LEAST) | (F.col("grp") == "0:")).select("grp"))
    few = 3 * large.count() <= MOST_BROADCAST

    def held(shapes: DataFrame) -> DataFrame:
        return F.broadcast(shapes) if few else shapes

    passed = passed.join(held(large), "grp")
    near = passed.join(held(determined(passed, held)), "grp").filter(distance() <= CHI_WEIGHT)
    shape = moments(near.select("grp", "start", *X), CONSISTENT_WEIGHT)
    # each row takes the most special of its groups that has a shape
    known = [held(shape.select(F.col("grp").alias(f"g{i}"))) for i in range(2)]
    names = group_names()
    placed = rows.withColumns({"k0": names[0], "k1": names[1]})
    placed = placed.join(known[0], F.col("k0") == F.col("g0"), "left").join(known[1], F.col("k1") == F.col("g1"), "left")
    placed = placed.withColumn("grp", F.coalesce("g0", "g1", names[2]))
    judged = placed.join(held(shape), "grp", "left").withColumns(dict(zip(X, vector(), strict=True)))
    d = F.when(~F.col("base_failed"), distance())
    return judged.select(*id_columns, *BASE.names, "base_failed", (~F.col("base_failed") & F.coalesce(d <= CUTOFF, F.lit(True))).alias("kept"), d.alias("distance2"))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "documents"), ["doc_id"]).drop("n_lines")


QUERIES = {"op6_quality_rules": op6_quality_rules}
