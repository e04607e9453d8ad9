import random

import pytest

from marlstone.llm import jaccard_join
from marlstone.llm.jaccard_join import near_duplicates

from .helpers import documents
from .test_jaccard_join import near_copies, shingle_set


def brute_links(rows):
    sets = {shingle_set(t) for _, t in rows} - {frozenset()}
    linked = {s: sum(s != o and 100 * len(s & o) >= 75 * len(s | o) for o in sets) for s in sets}
    return sorted((d, linked.get(shingle_set(t), 0)) for d, t in rows)


def counted(df):
    return sorted((r.doc_id, r.n_links) for r in near_duplicates(df, count_links=True).collect())


@pytest.mark.parametrize("most", [1000, 3])
def test_all_links_of_groups_are_counted(spark, monkeypatch, most):
    monkeypatch.setattr(jaccard_join, "LIST", most)
    words = random.Random(2).sample([f"word{i}" for i in range(500)], 100)
    three = [(i, " ".join([*words[:-1], f"end{i}"])) for i in range(3)]
    assert [n for d, n in brute_links(three)] == [2, 2, 2]
    rows = [*three, (10, three[0][1]), (11, None), (12, ""), *near_copies()]
    assert counted(documents(spark, rows)) == brute_links(rows)
