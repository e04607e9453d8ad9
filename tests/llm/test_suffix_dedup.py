import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from marlstone.llm import suffix_dedup
from marlstone.llm.suffix_dedup import LENGTH, MOST_WORDS, SHORT, cleaned, parse, repeats_removed, settle

from .helpers import clashing, documents, edge_texts, real_texts


def brute(rows, length):
    raws = [(t or "").encode() for _, t in rows]
    n = Counter(r[i : i + length] for r in raws for i in range(len(r) - length + 1))
    out = []
    for (d, _), r in zip(rows, raws, strict=True):
        gone = bytearray(len(r))
        for i in range(len(r) - length + 1):
            if n[r[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        spans = sum(gone[i] and not (i and gone[i - 1]) for i in range(len(r)))
        kept = bytes(b for b, g in zip(r, gone, strict=True) if not g)
        out.append((d, len(r), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def result(df, **args):
    return sorted((tuple(r) for r in repeats_removed(df, **args).collect()), key=repr)


def hard_texts(seed=2):
    """Repeats of all lengths around the least, within and across texts, shifted, nested, periodic and many-byte."""
    rng = random.Random(seed)
    noise = lambda n: "".join(rng.choices("abcdefgh é\n", k=n))
    passages = [noise(n) for n in (20, 39, 40, 41, 45, 60, 90, 200)]
    rows = []
    for _ in range(60):
        parts = []
        for _ in range(rng.randrange(1, 6)):
            p = rng.choice(passages)
            a = rng.randrange(0, 8)
            parts.append(rng.choice([noise(rng.randrange(0, 120)), p, p[a:], p[: len(p) - a]]))
        rows.append((len(rows) + 5000, "".join(parts)))
    rows += [(6000, "a" * 300), (6001, "ab" * 90), (6002, "ab" * 25 + noise(30)), (6003, "a" * 39), (6004, noise(500)), (6005, rows[3][1]), (6005, rows[3][1])]
    return rows


@pytest.mark.parametrize("most", [8192, 2])
def test_short_strings_against_brute_force(spark, monkeypatch, most):
    monkeypatch.setattr(suffix_dedup, "MOST_ENTRIES", most)
    rows = hard_texts() + [(None if d is None else 100_000 + d, t) for d, t in edge_texts() if len(t or "") < 10_000]
    assert result(clashing(documents(spark, rows)).repartition(3), length=40, spread=20) == brute(rows, 40)


def test_against_brute_force(spark):
    rows = [(d, t) for d, t in real_texts() if len(t) < 12_000] + edge_texts()
    assert result(documents(spark, rows).repartition(2)) == brute(rows, 400)


def test_empty_and_cleaned(spark):
    assert result(documents(spark, [])) == []
    rng = random.Random(7)
    passage, own = "".join(rng.choices("abcdef ", k=500)), ["".join(rng.choices("uvwxyz ", k=100)) for _ in range(3)]
    df = documents(spark, [(1, own[0] + passage), (2, passage + own[1]), (3, own[2]), (4, passage), (5, None)])
    out = {r.doc_id: r for r in cleaned(df).collect()}
    assert cleaned(df).columns == df.columns and set(out) == {1, 2, 3, 5}
    assert (out[1].text, out[2].text, out[3].text) == tuple(own) and out[1].n_chars == 100


@pytest.mark.parametrize("segment", [1 << 20, 300])
def test_triggers_depend_on_the_window_alone(monkeypatch, segment):
    monkeypatch.setattr(suffix_dedup, "SEGMENT", segment)
    rng = random.Random(3)
    raw = bytes(rng.choices(range(97, 100), k=3000))
    place = {i: a for a, f, l in zip(*map(np.ndarray.tolist, parse(raw, 400, 200)), strict=True) for i in range(f, l + 1)}
    assert sorted(place) == list(range(3000 - 400 + 1))
    for i in rng.sample(sorted(place), 40):
        (a,), _, _ = parse(raw[i : i + 400], 400, 200)
        assert place[i] == a + i and 0 <= a < 200


def test_both_ways_to_settle_agree(monkeypatch):
    rng = random.Random(4)
    entries = []
    for _ in range(40):
        left = bytes(rng.choices(b"ab", k=rng.randrange(0, 6)))
        lo = rng.randrange(0, len(left) + 1)
        entries.append((lo, len(left), rng.choice([1, 1, 1, 2]), left, b"core" + bytes(rng.choices(b"xy", k=10 - lo - 4))))
    many = settle(entries, 10)
    monkeypatch.setattr(suffix_dedup, "FEW", 100)
    assert settle(entries, 10) == many


def brute_cleaned(rows, length=SHORT):
    """Texts by row number; None for rows that go. Only runs of over MOST_WORDS words, or LENGTH bytes, are removed."""
    raws = [(t or "").encode() for _, t in rows]
    n = Counter(r[i : i + length] for r in raws for i in range(len(r) - length + 1))
    out = []
    for (d, t), r in zip(rows, raws, strict=True):
        gone = bytearray(len(r))
        for i in range(len(r) - length + 1):
            if n[r[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        i, kept, cut = 0, [], False
        while i < len(r):
            j = i
            while j < len(r) and gone[j] == gone[i]:
                j += 1
            if gone[i] and (j - i >= LENGTH or len(r[i:j].split()) > MOST_WORDS):
                cut = True
            else:
                kept.append(r[i:j])
            i = j
        text = b"".join(kept).decode("utf-8", "ignore") if cut else t
        if not cut or text.strip():
            out.append((d, text))
    return sorted(out, key=repr)


def test_cleaned_against_brute_force(spark):
    rng = random.Random(11)
    word = lambda: "".join(rng.choices("abcdefghijé", k=rng.randrange(3, 8)))
    said = lambda n: " ".join(word() for _ in range(n))
    shared = {n: said(n) for n in (30, 45, 51, 52, 60, 90, 200)}
    rows = [(10**7 + i * 10 + j, f"{said(40)}. {p} {said(30)}") for i, p in enumerate(shared.values()) for j in range(3)]
    rows += [(900, said(60)), (901, f"{shared[60]}"), (902, f"{shared[60]} \n"), *edge_texts(), *[(d, t) for d, t in real_texts() if len(t) < 8000]]
    out = cleaned(clashing(documents(spark, rows)).repartition(3))
    assert sorted(((r.doc_id, r.text) for r in out.collect()), key=repr) == brute_cleaned(rows)
    caught = {d: t for d, t in brute_cleaned(rows)}
    for i, (n, p) in enumerate(shared.items()):
        assert all((p in caught[10**7 + i * 10 + j]) == (n <= MOST_WORDS - 2) for j in range(3)), n


def test_cleaned_keeps_nulls_and_all_names(spark):
    df = documents(spark, [(1, None), (2, "own words"), (None, None)])
    names = ["key", "raw", "spans", "void", "c0", "Span with blanks", "core", "place"]
    from pyspark.sql import functions as F

    wide = df.select(*[F.lit(n).alias(n) for n in names], "*")
    out = cleaned(wide)
    assert out.columns == wide.columns
    assert sorted(map(tuple, out.collect()), key=repr) == sorted(map(tuple, wide.collect()), key=repr)
