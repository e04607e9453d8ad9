import zlib
from collections import defaultdict

from marlstone.llm.sharding import shard_documents

from .helpers import clashing, documents, edge_texts, real_texts, rows_of


def test_rendezvous_is_stable_and_slots_are_gapless(spark):
    rows = real_texts() + edge_texts()
    out = shard_documents(clashing(documents(spark, rows)), (1.0,) * 24, (1.0,) * 25).collect()
    assert len(out) == len(rows)
    want = sorted(((d, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for d, t in rows), key=repr)
    assert sorted(((r.doc_id, r.size, r.text_crc32) for r in out), key=repr) == want
    slots = defaultdict(list)
    for r in out:
        slots[r.shard].append(r.slot)
        assert r.grown_shard in (r.shard, 24)
    assert set(slots) <= set(range(24)) and all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert len({(r.doc_id, r.shard) for r in out}) == len({r.doc_id for r in out})


def test_weights_give_shares(spark):
    df = spark.range(4000).selectExpr("id as doc_id", "'x' as text")
    n = defaultdict(int)
    for r in shard_documents(df, (1.0, 3.0)).collect():
        n[r.shard] += 1
        assert r.grown_shard is None
    assert 0.70 < n[1] / 4000 < 0.80


def test_empty(spark):
    assert rows_of(shard_documents(documents(spark, []))) == []
