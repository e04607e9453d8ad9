import zlib

import pytest
from pyspark.sql import functions as F

from marlstone.llm import toxicity
from marlstone.llm.toxicity import Model, kneser_ney, learn, score, shared_model

from .helpers import clashing, documents, edge_texts


def counts(words):
    out = {}
    for w, toxic, n in words:
        for g in toxicity.grams(w):
            a = list(out.get(g, (0, 0)))
            a[toxic] += n
            out[g] = tuple(a)
    return out


def test_shared_distribution_sums_to_one():
    pooled = {g: sum(n) for g, n in counts([("house", 0, 3), ("mouse", 0, 1), ("horse", 1, 2)]).items()}
    p = shared_model(pooled)
    letters = sorted({g[-1] for g in pooled})
    n = toxicity.ORDER - 2
    for context in ("\x02" * n, "\x02" * (n - 1) + "h", "hous"[-n:], "z" * n):
        assert sum(p(context + x) for x in letters) == pytest.approx(1 - p(context + "?"))


def test_balance_tells_classes_apart_and_backs_off():
    m = kneser_ney(counts([("idiot", 1, 20), ("garden", 0, 200), ("weather", 0, 100), ("weather", 1, 10), ("garden", 1, 20)]))
    assert m.word("idiot") > 3 > 1 > abs(m.word("weather"))
    assert Model({}, {}).word("anything") == 0.0
    assert abs(m.word("qqqq")) < abs(m.word("idiot"))


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    out = toxicity.op7_toxicity(spark, sf)
    assert out.count() == spark.read.parquet(f"{sf}/documents.parquet").count()
    rows = out.join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and r.predicted == (r.score >= 0.7) and 0 <= r.score <= 1 for r in rows)
    held = [r for r in rows if r.held_out]
    hits = sum(r.predicted == r.toxic == 1 for r in held)
    assert hits / sum(r.predicted for r in held) > 0.9
    assert hits / sum(r.toxic for r in held) > 0.7


def test_edges(spark):
    toxic = [(i, f"you idiot number {i} are stupid garden trash") for i in range(40)]
    clean = [(100 + i, f"the garden number {i} is green in summer weather") for i in range(80)]
    labelled = documents(spark, toxic + clean).withColumn("toxic", (F.col("doc_id") < 100).cast("int"))
    scorer = learn(clashing(labelled))
    rows = edge_texts() + [(900, "stupid idiot trash"), (901, "green garden in summer")]
    out = score(clashing(documents(spark, rows)).drop("score"), scorer).collect()
    got = {r.doc_id: r.score for r in out}
    assert len(out) == len(rows) and all(0 <= r.score <= 1 for r in out)
    assert got[900] > 0.7 > got[901] and got[1] == got[2] == got[3]
    assert score(documents(spark, []), scorer).collect() == []
    empty = learn(labelled.limit(0))
    assert {r.score for r in score(documents(spark, rows), empty).collect()} == {0.0}
