import hashlib

import pytest
from pyspark.sql import functions as F

from marlstone.llm import merkle
from marlstone.llm.merkle import fingerprint_documents, id_ranges, range_of

from .helpers import clashing, documents, edge_texts, real_texts


def check(rows, out):
    """Rows must have different ids."""
    order = sorted(((d, t or "") for d, t in rows), key=lambda x: (x[0] is None, -(x[0] or 0)))
    got = {r.doc_id: r for r in out}
    assert len(out) == len(rows) == len(got)
    root = {}
    for i, (d, t) in enumerate(order):
        nxt = order[(i + 1) % len(order)]
        half = len(t) // 2
        edited = t[: len(t) - half] + nxt[1][:half]
        r = got[d]
        assert r.n_chars == len(t) and r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        assert (r.fingerprint == r.edited_fingerprint) == (t == edited)
        assert (r.near_edited == 1.0) == (t == edited)
        assert (r.fingerprint == got[nxt[0]].fingerprint) == (t == nxt[1])
        assert (r.near_next == 1.0) == (t == nxt[1])
        assert root.setdefault(r.fingerprint, t) == t
    return got


def test_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(merkle, "RANGE_BYTES", 20_000)
    seen, rows = set(), []
    for d, t in real_texts() + [(None if d is None else 100_000 + d, t) for d, t in edge_texts()]:
        if d not in seen:
            seen.add(d)
            rows.append((d, t))
    got = check(rows, fingerprint_documents(clashing(documents(spark, rows))).collect())
    long = [r for r in got.values() if r.n_chars > 400]
    assert sum(0.25 < r.near_edited < 0.75 for r in long) > 0.8 * len(long)


def test_repeated_ids_and_small_tables(spark):
    out = fingerprint_documents(documents(spark, edge_texts())).collect()
    assert len(out) == len(edge_texts())
    (one,) = fingerprint_documents(documents(spark, [(5, "abcdef")])).collect()
    assert one.near_next == 1.0 and one.edited_sha256 == hashlib.sha256(b"abcabc").hexdigest()
    assert fingerprint_documents(documents(spark, [])).collect() == []


def test_edits_are_located(spark):
    text = "\n".join(f"paragraph {i} has some words of its own to tell it from others" for i in range(10))
    out = fingerprint_documents(documents(spark, [(2, text), (1, "zzz " * 400)])).collect()
    assert {r.doc_id: r.edited_paragraph for r in out}[2] == 5


@pytest.mark.parametrize("bounds", [[], [3], [1, 5, 9], list(range(0, 100, 7))])
def test_range_of(spark, bounds):
    df = spark.range(-5, 120).select("id", range_of(F.col("id"), bounds).alias("r"))
    assert all(r.r == sum(b < r.id for b in bounds) for r in df.collect())


def test_id_ranges_are_even(spark):
    df = spark.range(1000).selectExpr("id * id as doc_id")
    assert len(id_ranges(df, 4)) == 3
