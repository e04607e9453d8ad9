import hashlib

import public_tokenizers as P
import pytest
from tokenizers import Tokenizer

from marlstone.llm.bpe_table import encode_decode, word_table, words_of

from .helpers import clashing, documents, edge_texts, real_texts

PATH = P.path("word_bpe_49k.json")


def whole(own, text):
    ids = own.encode(text or "", add_special_tokens=False).ids
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return len(ids), sha(" ".join(map(str, ids))), sha(own.decode(ids, skip_special_tokens=False))


def test_equals_the_library(spark):
    own = Tokenizer.from_file(PATH)
    rows = real_texts() + [(None if d is None else 100_000 + d, t) for d, t in edge_texts()]
    out = encode_decode(clashing(documents(spark, rows)).repartition(3), PATH, chunk_bytes=50_000).collect()
    want = sorted(((d, *whole(own, t)) for d, t in rows), key=repr)
    assert sorted((tuple(r) for r in out), key=repr) == want


def test_empty(spark):
    assert encode_decode(documents(spark, []), PATH).collect() == []


def test_words_alone_encode_as_in_the_text():
    hypothesis = pytest.importorskip("hypothesis")
    st = hypothesis.strategies
    own, table = Tokenizer.from_file(PATH), word_table(PATH)
    parts = st.sampled_from(["Word", "é", "é", "J̌", ".", ",", "...", "'s", "'LL", " ", "  ", "\n", "\t", "\x0b", "\x1c", "\x85", "\xa0", " ", "İ", "ΑΣ", "3", "½", "-", "😀", "日本", "<|endoftext|>", "<|ENDOFTEXT|>", "́", "x"])

    @hypothesis.given(st.lists(st.one_of(parts, st.text(max_size=3)), max_size=20).map("".join))
    @hypothesis.settings(max_examples=500, deadline=None)
    def check(text):
        assert [i for ids in table.encode(words_of(text)) for i in ids] == own.encode(text, add_special_tokens=False).ids

    check()


def test_every_letter_before_every_mark():
    own, table = Tokenizer.from_file(PATH), word_table(PATH)
    letters = [chr(c) for c in range(0x41, 0x250)]
    texts = [f"{a}{letter}{mark}{punctuation}{z}" for letter in letters for a in ("", "x") for mark in ("", "\u0301", "\u0307") for punctuation in (".", ",", ";", ":", "!", "?", "...", "?!") for z in ("", " b")]
    whole_ids = [e.ids for e in own.encode_batch_fast(texts, add_special_tokens=False)]
    words = [words_of(t) for t in texts]
    distinct = sorted({w for x in words for w in x})
    ids = dict(zip(distinct, table.encode(distinct), strict=True))
    assert [t for t, x, want in zip(texts, words, whole_ids, strict=True) if [i for w in x for i in ids[w]] != want] == []


def test_equal_chunks_and_words_without_ids(spark):
    own = Tokenizer.from_file(PATH)
    rows = [(7, t) for t in ("a \u0301 b \u200b, c", None, "same text.")] * 4
    out = encode_decode(documents(spark, rows).repartition(4), PATH, chunk_bytes=1).collect()
    assert sorted(tuple(r) for r in out) == sorted((d, *whole(own, t)) for d, t in rows)
