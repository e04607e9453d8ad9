import hashlib

import numpy as np
import pytest

from marlstone.llm import chat
from marlstone.llm.chat import escape, format_conversations, mask, masked_text, parse, read_back, render, unescape
from marlstone.llm.tokens import byte_bpe, byte_bpe_files

SCHEMA = "conv_id long, turn long, role string, text string"
HARD = [r"\### Assistant: </turn> ok", "", "  ", "####", "#\\#", "<|endoftext|>", "a</turn>\n### User: b", "Zürich 日本 😀", "\\" * 5, "</turn</turn>>"]


def want(turns):
    told = "".join(f"{r or ''}\n{t or ''}\n" for r, t in turns)
    loss = "".join(t or "" for r, t in turns if r == "assistant")
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return len(turns), sha(told), len(loss), sha(loss)


def test_table(spark):
    rows = [(1, i, "assistant" if i % 2 else "user", t) for i, t in enumerate(HARD)]
    rows += [(2, 0, None, None), (2, 1, "Assistant", "x"), (2, 2, "a: b", "y"), (3, 0, "assistant", None), (None, 0, "user", "z"), (4, 1, "b", "1"), (4, 1, "a", "2"), (4, 1, "a", "2"), (4, None, "c", "3")]
    df = spark.createDataFrame([(*r, "extra") for r in rows], SCHEMA + ", formatted string")
    out = {r.conv_id: r for r in read_back(format_conversations(df)).collect()}
    by = {}
    for c, n, role, text in sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")):
        by.setdefault(c, []).append((role, text))
    assert set(out) == set(by)
    for c, turns in by.items():
        r = out[c]
        assert (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) == want(turns)
    assert read_back(format_conversations(spark.createDataFrame([], SCHEMA))).collect() == []


def test_query(spark):
    out = {r.conv_id: r for r in chat.op8_chat_formatting(spark, "/root/testdata/sf0.001").collect()}
    rows = spark.read.parquet("/root/testdata/sf0.001/conversations.parquet").collect()
    by = {-7: [("user", HARD[0]), ("assistant", HARD[0])]}
    for r in sorted(rows, key=lambda r: (r.conv_id, r.turn)):
        by.setdefault(r.conv_id, []).append((r.role, r.text))
    assert set(out) == set(by)
    assert all((r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) == want(by[c]) for c, r in out.items())


def test_round_trip():
    hypothesis = pytest.importorskip("hypothesis")
    st = hypothesis.strategies
    part = st.sampled_from(["#", "\\", "<", "/turn>", "|", "</turn>", "\n", "### ", ": ", ":", "=", "User", "é", "x", "😀"])
    text = st.lists(st.one_of(part, st.text(max_size=2)), max_size=12).map("".join)
    bpe = byte_bpe(*byte_bpe_files())

    @hypothesis.given(st.lists(st.tuples(st.one_of(st.just("assistant"), text), text), max_size=4))
    @hypothesis.settings(max_examples=400, deadline=None)
    def check(turns):
        for _, t in turns:
            e = escape(t)
            assert unescape(e) == t and "##" not in e and "</turn>" not in e and "<|" not in e
        formatted, spans = render(turns)
        assert [x[:2] for x in parse(formatted)] == turns
        ids = bpe.ids(formatted)
        starts, ends = chat.char_offsets(formatted, np.cumsum(bpe.lengths[ids])) if formatted else (np.zeros(0, int), np.zeros(0, int))
        masks = mask(starts, ends, spans)
        assert [unescape(x) for x in masked_text(formatted, starts, ends, masks)] == [t for _, t in turns if t]

    check()
