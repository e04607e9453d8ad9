"""BPE encoding and decoding through a table of distinct words.

Words are split on white space, and closing punctuation from a letter before it: the tokenizer's pattern breaks
there whatever stands around, so a text's ids are its words' ids one after the other. Scan tasks gather chunks of
a few MB of text, split each text once, list the chunk's distinct words by bucket of the word's checksum, and keep the
texts as places in that list. Both go to the chunk's task by one shuffle. A bucket's distinct words, from all chunks, are
encoded once, by the tokenizers library; the ids return to each chunk in the order of its list, so texts travel as
numbers only. There the ids are joined by position, and decoded through the id-to-piece table
(as large as the vocabulary).

No table of the corpus is broadcast: a chunk holds its own words only, a bucket 1/buckets of the vocabulary and of the
chunks' lists (compressed, opened one at a time), and the number of buckets follows the size of the input.

Defined results: a null text is empty, has no ids and decodes to ''; repeated rows are encoded alike; an empty
table gives no rows. Places and lists are made by the same task, so they agree however the scan was split; a lost task's
rows are made again from the same split, and a list that does not fit its chunk is an error, never a wrong result.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import defaultdict
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession

from marlstone.llm.common import id_text, one_thread, record, stored_bytes, table, texts_of, tidied

CHUNK_BYTES = 8 << 20
#: Input bytes as stored for each bucket of words.
BUCKET_BYTES = 8 << 20
#: Unicode spaces, and separators that str.split() takes for spaces and the tokenizer's pattern does not.
ODD_SPACE = re.compile("[\x1c-\x1f\x85\xa0  -     　]")
SPACE = re.compile(r"[ \t\n\r\x0b\x0c]+")
#: Closing punctuation after a letter and before white space or the end. U+0130 is no such letter: its lower case ends in a
#: combining mark, which the punctuation then belongs to.
CLOSING = re.compile(r"(?<=[A-Za-zÀ-ÖØ-öø-įı-ɏ])([.,;:!?]+)(?=[ \t\n\r]|\Z)")
#: Texts with a mark that combines with a letter, or with what may be a special token, are not lower-cased beforehand.
KEEP_CASE = re.compile("[̀-ͯ]|<\\|")


def words_of(text: str) -> list[str]:
    """Words, each encoded alone, whose ids concatenated are the text's."""
    if not KEEP_CASE.search(text):
        text = text.encode().lower().decode()  # ASCII letters only
    text = CLOSING.sub(r" \1", text)
    return [w for w in SPACE.split(text) if w] if ODD_SPACE.search(text) else text.split()


class WordTable:
    """Ids as decimal text, pieces as text and number of ids of words."""

    def __init__(self, path: str):
        one_thread()
        from tokenizers import Tokenizer

        self.own = Tokenizer.from_file(path)
        self.own.no_truncation()
        self.own.no_padding()
        size = self.own.get_vocab_size()
        self.number = [str(i) for i in range(size)]
        self.piece = [self.own.id_to_token(i) for i in range(size)]

    def encode(self, words: list[str]) -> list[list[int]]:
        return [e.ids for e in self.own.encode_batch_fast(words, add_special_tokens=False)]


@lru_cache(maxsize=2)
def word_table(path: str) -> WordTable:
    return WordTable(path)


def bucketed(words: Iterable[str], buckets: int) -> dict[int, list[str]]:
    """Sorted words by bucket."""
    out: dict[int, list[str]] = {}
    for w in sorted(words):
        out.setdefault(zlib.crc32(w.encode()) % buckets, []).append(w)
    return out


def squeezed(numbers: np.ndarray) -> bytes:
    """32-bit numbers, compressed byte plane by byte plane."""
    return zstandard.compress(np.ascontiguousarray(numbers.astype("<u4").view("u1").reshape(-1, 4).T).tobytes(), 3)


def opened(blob: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(blob), dtype="u1").reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").ravel()


def packed_ids(ids: list[list[int]]) -> bytes:
    """Number of lists, the numbers of ids, then the ids."""
    n = [len(ids), *map(len, ids)]
    return squeezed(np.fromiter((i for x in (n, *ids) for i in x), dtype="<u4", count=len(n) + sum(n[1:])))


def unpacked_ids(blob: bytes) -> list[list[int]]:
    raw = opened(blob)
    n = raw[1 : 1 + int(raw[0])]
    ends = np.cumsum(n)
    flat = raw[1 + len(n) :].tolist()
    return [flat[e - k : e] for e, k in zip(ends.tolist(), n.tolist(), strict=True)]


Chunk = tuple[int, list[int | None], list[str]]


def chunks(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[Chunk]:
    """Consecutive rows of about `size` bytes, with a key that depends on their content alone."""
    ids: list[int | None] = []
    texts: list[str] = []
    held, key = 0, hashlib.blake2b(digest_size=8)

    for batch in batches:
        for doc, text in zip(batch.column(0), texts_of(batch), strict=True):
            raw = text.encode()
            ids.append(doc.as_py())
            texts.append(text)
            key.update(f"{ids[-1]}:{len(raw)}:{zlib.crc32(raw)};".encode())
            held += len(raw) + 16
            if held >= size:
                yield int.from_bytes(key.digest(), "big", signed=True), ids, texts
                ids, texts, held, key = [], [], 0, hashlib.blake2b(digest_size=8)
    if ids:
        yield int.from_bytes(key.digest(), "big", signed=True), ids, texts


CODED = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())])
#: Two kinds of rows: a bucket's words of a chunk; a chunk's texts as places, with the place of each listed word.
SPLIT = pa.schema([("chunk", pa.int64()), ("bucket", pa.int32()), ("words", pa.binary()), ("ids", pa.list_(pa.int64())), ("lengths", pa.list_(pa.int64())), ("listed", pa.binary()), ("places", pa.binary())])
SPLIT_DDL = "chunk long, bucket int, words binary, ids array<long>, lengths array<long>, listed binary, places binary"


def split_chunk(texts: list[str], buckets: int) -> tuple[dict[int, list[str]], list[int], np.ndarray, np.ndarray]:
    """Distinct words by ascending bucket, number of words of each text, places of the listed words, places of all
    texts' words. A word's place is the number of distinct words before its first occurrence."""
    place: defaultdict[str, int] = defaultdict()
    place.default_factory = place.__len__
    lengths, parts = [], []
    for text in texts:
        own = words_of(text)
        lengths.append(len(own))
        parts.append(np.fromiter(map(place.__getitem__, own), dtype="<u4", count=len(own)))
    found = bucketed(place, buckets)
    found = {b: found[b] for b in sorted(found)}
    listed = np.fromiter((place[w] for words in found.values() for w in words), dtype="<u4", count=len(place))
    return found, lengths, listed, np.concatenate(parts)


def digests(lengths: list[int], places: np.ndarray, coded: list[list[int]], words: WordTable) -> tuple[list[int], list[str], list[str]]:
    """Numbers of ids, digests of the ids and digests of the decoded texts; `coded` are the ids by place."""
    number, piece = words.number, words.piece
    as_ids = [" ".join([number[i] for i in ids]) for ids in coded]
    as_text = [" ".join([piece[i] for i in ids]) for ids in coded]
    count = np.fromiter(map(len, coded), dtype=np.int64, count=len(coded))
    n = count[places]
    ends = np.cumsum(lengths)
    total = np.concatenate([[0], np.cumsum(n)])
    n_tokens = total[ends] - total[ends - np.asarray(lengths, dtype=np.int64)]
    if len(n) and not n.all():  # words without ids leave no space behind
        ends = np.concatenate([[0], np.cumsum(n > 0)])[ends]
        places = places[n > 0]
    out_ids, out_text, start = [], [], 0
    for end in ends.tolist():
        own = places[start:end].tolist()
        out_ids.append(hashlib.sha256(" ".join(map(as_ids.__getitem__, own)).encode()).hexdigest())
        out_text.append(hashlib.sha256(" ".join(map(as_text.__getitem__, own)).encode()).hexdigest())
        start = end
    return n_tokens.tolist(), out_ids, out_text


def encode_decode(docs: DataFrame, path: str, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every whole text."""
    buckets = min(max(stored_bytes(docs) // BUCKET_BYTES, 16), 1 << 20)

    @tidied
    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, ids, texts in chunks(batches, chunk_bytes):
            found, lengths, listed, places = split_chunk(texts, buckets)
            n = len(found)
            if n:
                yield record(SPLIT, [[key] * n, list(found), [zstandard.compress(" ".join(w).encode(), 3) for w in found.values()], *[[None] * n] * 4])
            yield record(SPLIT, [[key], [None], [None], [ids], [lengths], [squeezed(listed)], [squeezed(places)]])

    def encode(group: pa.Table) -> pa.Table:
        def words(blob: pa.Scalar) -> list[str]:
            return zstandard.decompress(blob.as_py()).decode().split(" ")

        lists = group.column("words")
        distinct = sorted(set().union(*map(words, lists)))
        coder = word_table(path)
        known: dict[str, list[int]] = {}
        for at in range(0, len(distinct), 4096):
            part = distinct[at : at + 4096]
            known.update(zip(part, coder.encode(part), strict=True))
        return pa.table([group.column("chunk"), group.column("bucket"), pa.array([packed_ids([known[w] for w in words(x)]) for x in lists], pa.binary())], schema=pa.schema([("chunk", pa.int64()), ("bucket", pa.int32()), ("coded", pa.binary())]))

    def join(left: pa.Table, right: pa.Table) -> pa.Table:
        coder, out = word_table(path), []
        coded = {b.as_py(): i.as_py() for b, i in zip(right.column("bucket"), right.column("coded"), strict=True)}
        by_list = [ids for b in sorted(coded) for ids in unpacked_ids(coded[b])]
        for row in left.filter(left.column("places").is_valid()).select(["ids", "lengths", "listed", "places"]).to_pylist():
            by_place: list[list[int]] = [[]] * len(by_list)
            for p, ids in zip(opened(row["listed"]).tolist(), by_list, strict=True):
                by_place[p] = ids
            out.append(record(CODED, [row["ids"], *digests(row["lengths"], opened(row["places"]), by_place, coder)]))
        return pa.Table.from_batches(out, schema=CODED)

    def only_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = batch.select(["chunk", "bucket", "words"])
            yield batch.filter(batch.column(2).is_valid())

    # one shuffle by chunk, which both sides read: words by way of their buckets, places where they are
    dealt = id_text(docs).mapInArrow(split, SPLIT_DDL).repartition("chunk")
    coded = dealt.mapInArrow(only_words, "chunk long, bucket int, words binary").groupBy("bucket").applyInArrow(encode, "chunk long, bucket int, coded binary")
    return dealt.groupBy("chunk").cogroup(coded.groupBy("chunk")).applyInArrow(join, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def op3_bpe_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers as P

    return encode_decode(table(spark, sf_dir, "documents"), P.path("word_bpe_49k.json"))


QUERIES = {"op3_bpe_table": op3_bpe_table}
