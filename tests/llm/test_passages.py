"""op1's passages of over 50 words, beside its law of 400 bytes."""

import random

import pytest

from marlstone.llm import suffix_dedup
from marlstone.llm.suffix_dedup import LENGTH, op1_suffix_dedup, repeats_and_passages

from .helpers import clashing, documents, edge_texts, real_texts, rows_of
from .test_suffix_dedup import brute, hard_texts


def brute_passages(rows, length, most_words):
    """n_passages and n_passage_bytes by row number."""
    raws = [(t or "").encode() for _, t in rows]
    n = {}
    for r in raws:
        for i in range(len(r) - length + 1):
            n[r[i : i + length]] = n.get(r[i : i + length], 0) + 1
    out = []
    for r in raws:
        runs = []
        for i in range(len(r) - length + 1):
            if n[r[i : i + length]] > 1:
                if runs and i <= runs[-1][1]:
                    runs[-1][1] = i + length
                else:
                    runs.append([i, i + length])
        runs = [(a, b) for a, b in runs if b - a >= LENGTH or len(r[a:b].split()) > most_words]
        out.append((len(runs), sum(b - a for a, b in runs)))
    return out


def both(rows, length, short, most_words):
    """The rows that are due: brute() sorts, so each row is looked up by its id, size and digest."""
    found = {}
    for (d, t), p in zip(rows, brute_passages(rows, short, most_words), strict=True):
        found[d, len((t or "").encode())] = p
    return sorted((r + found[r[0], r[1]] for r in brute(rows, length)), key=repr)


@pytest.mark.parametrize("most", [8192, 2])
def test_short_strings_against_brute_force(spark, monkeypatch, most):
    monkeypatch.setattr(suffix_dedup, "MOST_ENTRIES", most)
    rows = hard_texts() + [(None if d is None else 100_000 + d, t) for d, t in edge_texts() if len(t or "") < 10_000]
    df = clashing(documents(spark, rows)).repartition(3)
    assert rows_of(repeats_and_passages(df, 40, 20, 32, 16, 3)) == both(rows, 40, 32, 3)


def test_query_against_brute_force(spark, tmp_path):
    rng = random.Random(51)
    said = lambda n: " ".join("".join(rng.choices("abcdefgh", k=5)) for _ in range(n))
    passage, long, brief = said(55), said(90), said(40)
    assert len(passage) < LENGTH < len(long)
    rows = [(900_000 + i, f"{said(30)} {p} {said(25)}") for i, p in enumerate([passage, passage, long, long, brief, brief, said(60)])]
    rows += [(900_100, passage + " " + said(80) + " " + long), *edge_texts(), *[(d, t) for d, t in real_texts() if len(t) < 8000]]
    documents(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    out = op1_suffix_dedup(spark, str(tmp_path))
    assert out.columns[:5] == ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    assert rows_of(out) == both(rows, 400, 224, 50)
    of = {r.doc_id: r for r in out.collect()}
    assert [(of[900_000 + i].n_spans, of[900_000 + i].n_passages) for i in range(7)] == [(0, 1), (0, 1), (1, 1), (1, 1), (0, 0), (0, 0), (0, 0)]
    assert (of[900_100].n_spans, of[900_100].n_passages) == (1, 2)


def test_empty(spark):
    assert rows_of(repeats_and_passages(documents(spark, []))) == []


def test_occurrences_of_a_core_are_dealt_finely(spark):
    """Text of one character, and lines that repeat at a distance of a power of two."""
    line = "".join(random.Random(8).choices("abcdefgh ", k=1023)) + "\n"
    for text, most in [("a" * 20_000, 50), (line * 200, 10)]:
        own = documents(spark, [(1, text)]).select("doc_id", "text").selectExpr("doc_id as key", "cast(text as binary) as raw")
        dealt = suffix_dedup.anchors(own, 400, 200).filter("place >= 0").groupBy("core", "salt").count()
        assert dealt.agg({"count": "max"}).first()[0] <= most
