import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers as P
from tokenizers import Tokenizer

from marlstone.llm.packing import Packer, end_to_end, pack_documents

from .helpers import clashing, documents, edge_texts, real_texts


def check(rows, out, length=2048, waste=0.03):
    own = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    ids = defaultdict(list)
    for d, t in rows:
        ids[d].append(np.asarray([*own.encode(t or "", add_special_tokens=False).ids, 1], dtype="<u4"))
    windows = defaultdict(list)
    pieces = defaultdict(list)
    for r in out:
        windows[r.sequence_id].append(r)
        pieces[r.doc_id, r.doc_tokens].append(r)
    for w in windows.values():
        at = 0
        for r in sorted(w, key=lambda r: r.offset):
            assert r.offset == at and r.length > 0
            at += r.length
        assert at <= length
    for d, lists in ids.items():
        if len(lists) == 1:
            at = 0
            for r in sorted(pieces[d, len(lists[0])], key=lambda r: r.start):
                assert r.start == at and r.ids_crc32 == zlib.crc32(lists[0][at : at + r.length].tobytes())
                at += r.length
            assert at == len(lists[0])
    total = sum(len(x) for v in ids.values() for x in v)
    assert sum(r.length for r in out) == total
    assert len(windows) * length <= total * (1 + waste) + length


def test_pieces_cover_every_id_once(spark):
    rows = real_texts() + [(None if d is None else 100_000 + d, t) for d, t in edge_texts()]
    check(rows, pack_documents(clashing(documents(spark, rows)).repartition(3)).collect())


def test_empty(spark):
    assert pack_documents(documents(spark, [])).collect() == []


def test_packer_keeps_few_windows():
    rng = np.random.default_rng(1)
    p, n = Packer(100, 4, 3), 0
    for d in range(500):
        ids = np.arange(rng.integers(0, 260), dtype="<u4")
        n += len(ids)
        p.add((d, 0, ids, len(ids)))
        assert len(p.gaps) <= 4
    done = p.closed()
    assert all(100 - 3 <= sum(len(x[2]) for x in w) <= 100 for w in done)
    rest = end_to_end(p.rest(), 100)
    assert all(sum(len(x[2]) for x in w) == 100 for w in rest[:-1])
    assert sum(len(x[2]) for w in done + rest for x in w) == n
