import random
import re

import numpy as np
import pytest

from marlstone.llm import jaccard_join
from marlstone.llm.common import Scratch
from marlstone.llm.components import components
from marlstone.llm.jaccard_join import keep_one, near_duplicates, prefix
from marlstone.llm.shingles import shingler

from .helpers import clashing, documents, edge_texts, real_texts


def shingle_set(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4)))


def brute(rows):
    sets = [shingle_set(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    where = {}
    for i, s in enumerate(sets):
        for x in s:
            where.setdefault(x, []).append(i)
    done = set()
    for group in where.values():
        for i in group:
            for j in group:
                if i < j and (i, j) not in done:
                    done.add((i, j))
                    both = len(sets[i] & sets[j])
                    if 100 * both >= 75 * (len(sets[i]) + len(sets[j]) - both):
                        root[find(j)] = find(i)
    least = {}
    for i, (d, _) in enumerate(rows):
        r = find(i)
        least[r] = d if least.get(r) is None else least[r] if d is None else min(least[r], d)
    return sorted(((d, len(sets[i]), least[find(i)] if sets[i] else d) for i, (d, _) in enumerate(rows)), key=repr)


def result(df):
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in near_duplicates(df).collect()), key=repr)


def near_copies(seed=5):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    rows = []
    for _ in range(12):
        base = [rng.choice(vocabulary) for _ in range(rng.choice([3, 7, 30, 120, 300]))]
        for _ in range(rng.choice([2, 5, 30])):
            words = list(base)
            for _ in range(rng.randrange(0, 1 + len(words) // 20)):
                i = rng.randrange(len(words))
                words[i : i + rng.choice([0, 1, 2])] = rng.choices(vocabulary, k=rng.choice([0, 1, 3]))
            rows.append((len(rows) + 1000, " ".join(words).title()))
    return rows


@pytest.mark.parametrize("hot", [10_000, 0.5])
def test_against_brute_force(spark, monkeypatch, hot):
    monkeypatch.setattr(jaccard_join, "HOT", hot)
    rows = real_texts(sf="/root/testdata/sf0.001") + [(None if d is None else 100_000 + d, t) for d, t in edge_texts()] + near_copies()
    assert result(clashing(documents(spark, rows)).repartition(3)) == brute(rows)


def test_sf001(spark):
    rows = real_texts(sf="/root/testdata/sf0.01")
    assert result(documents(spark, rows)) == brute(rows)


def test_empty_and_wordless(spark):
    assert result(documents(spark, [])) == []
    assert result(documents(spark, [(1, None), (2, ""), (None, " ")])) == sorted([(1, 0, 1), (2, 0, 2), (None, 0, None)], key=repr)


def test_prefix_asks_for_more_matches_where_shingles_are_frequent():
    s = shingler()(" ".join(f"word{i}" for i in range(104)))
    sketch = np.zeros(1 << jaccard_join.SKETCH_BITS, dtype=np.uint32)
    tokens, matches, _ = prefix(s, sketch, 0.0)
    assert matches == 1 and len(tokens) == 26
    sketch[(s >> np.uint64(64 - jaccard_join.SKETCH_BITS)).astype(int)] = 50_000
    tokens, matches, _ = prefix(s, sketch, 1.0)
    assert matches == jaccard_join.MOST_MATCHES and len(tokens) == 25 + matches


def test_components(spark):
    rng = random.Random(1)
    links = [(i, i + 1) for i in range(0, 40)] + [(100 + rng.randrange(50), 100 + rng.randrange(50)) for _ in range(40)] + [(500, i) for i in range(501, 600)]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in links:
        if a != b:
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    with Scratch(spark) as scratch:
        got = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long"), scratch).collect()}
        assert components(spark.createDataFrame([], "a long, b long"), scratch).collect() == []
    assert got == {x: find(x) for x in root}


def test_one_of_each_group_stays(spark):
    rows = real_texts() + near_copies() + [(9, None), (9, None)]
    df = documents(spark, rows)
    kept = keep_one(df)
    assert kept.columns == df.columns
    copies = documents(spark, [(1, "a b c d e f"), (1, "a b c d e f"), (2, "a b c d e f"), (None, None), (None, None)])
    assert sorted(((r.doc_id, r.text) for r in keep_one(copies).collect()), key=repr) == [(1, "a b c d e f"), (None, None), (None, None)]
    want = {c for _, n, c in brute(rows) if n}
    got = [r.doc_id for r in kept.collect()]
    assert sorted(d for d in got if d != 9) == sorted(x for x in want if x != 9) and 9 in got
