import random

import pytest
from pyspark.sql import functions as F

from marlstone.llm import toxicity
from marlstone.llm.common import Scratch
from marlstone.llm.toxicity import grams, kneser_ney, learn

from .helpers import documents
from .test_toxicity import counts

LETTERS = "abcdefghijklmnopqrstuvwxyz"


def random_words(n, rng, longest=9):
    return ["".join(rng.choices(LETTERS, k=rng.randrange(2, longest))) for _ in range(n)]


def test_tables_give_the_models_of_whole_counts(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "SHARD", 100)
    rng = random.Random(3)
    per_model = {m: counts([(w, rng.randrange(2), rng.randrange(1, 4)) for w in [*random_words(60, rng), "naïve", "über", "日本語"]]) for m in (0, 1)}
    rows = [(m, g, a, b) for m, c in per_model.items() for g, (a, b) in c.items()]
    words = random_words(50, rng) + ["über", "日本", "a", "idiot"]
    with Scratch(spark) as scratch:
        got = toxicity.estimated(spark.createDataFrame(rows, "model int, gram string, ordinary long, toxic long"), scratch)
        for m, c in per_model.items():
            assert len(got[m].gram.pieces) > 1
            assert got[m].words(words) == pytest.approx(kneser_ney(c).words(words))


def test_no_ngram_is_dropped(spark):
    rng = random.Random(4)
    texts = [" ".join(random_words(100, rng, 12)) for _ in range(450)]
    labelled = documents(spark, texts).withColumn("toxic", (F.col("doc_id") % 3 == 0).cast("int"))
    want = {g for t in texts for w in t.split() for g in grams(w)}
    assert len(want) > 1 << 17
    assert learn(labelled).models[0].gram.size == len(want)
