"""Packing of token ids into sequences: bounded-space online best fit.

Every partition keeps at most `windows` open windows. A document's full windows leave at once; its rest goes to the
open window with the smallest gap that holds it. When none does and no more may be opened, the fullest window is
emitted; if its gap is over `slack` ids, the piece is cut so that it fills the gap first. What is open when the
partition ends (at most `windows` x `length` ids) is left over; left-overs are packed once more in groups of
bounded size, and what is open at a group's end is laid end to end and cut at `length`, so a group pads once.

Defined results: a null text is empty and yields its end id alone; repeated rows are packed each for itself; an
empty table gives no rows; an empty sequence is never emitted.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marlstone.llm.common import cut, id_text, record, table, texts_of, tidied
from marlstone.llm.tokens import byte_bpe, byte_bpe_files

LENGTH, WINDOWS, SLACK, END = 2048, 64, 16, 1
#: Ids in a group of left-overs, on average; a group is packed by one task.
GROUP_IDS = 8 << 20
#: Sequences that are made of left-overs are numbered from here.
MERGED = 1 << 62

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
PACKED = pa.schema([(n, pa.int64()) for n in ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")])
OPEN = pa.schema([*PACKED, ("ids", pa.binary())])

#: doc_id, ids before the piece in its document, the piece's ids, ids of the document
Piece = tuple[int | None, int, np.ndarray, int]


class Packer:
    """Best fit over at most `windows` open windows; closed ones are appended to `out` as lists of pieces."""

    def __init__(self, length: int = LENGTH, windows: int = WINDOWS, slack: int = SLACK):
        self.length, self.windows, self.slack = length, windows, slack
        self.gaps: list[tuple[int, int]] = []  # of open windows, sorted
        self.open: dict[int, list[Piece]] = {}
        self.made = 0
        self.out: list[list[Piece]] = []

    def add(self, piece: Piece) -> None:
        doc, start, ids, total = piece
        whole = len(ids) // self.length * self.length
        for at in range(0, whole, self.length):
            self.out.append([(doc, start + at, ids[at : at + self.length], total)])
        if whole < len(ids):
            self._place((doc, start + whole, ids[whole:], total))

    def _place(self, piece: Piece) -> None:
        doc, start, ids, total = piece
        at = bisect_left(self.gaps, (len(ids), -1))
        if at < len(self.gaps):
            gap, key = self.gaps.pop(at)
            self.open[key].append(piece)
            self._keep(key, gap - len(ids))
            return
        if len(self.gaps) >= self.windows:
            gap, key = self.gaps.pop(0)
            if gap > self.slack:
                self.open[key].append((doc, start, ids[:gap], total))
                start, ids = start + gap, ids[gap:]
            self.out.append(self.open.pop(key))
            if gap > self.slack:
                self._place((doc, start, ids, total))
                return
        self.made += 1
        self.open[self.made] = [(doc, start, ids, total)]
        self._keep(self.made, self.length - len(ids))

    def _keep(self, key: int, gap: int) -> None:
        if gap:
            insort(self.gaps, (gap, key))
        else:
            self.out.append(self.open.pop(key))

    def closed(self) -> list[list[Piece]]:
        out, self.out = self.out, []
        return out

    def rest(self) -> list[list[Piece]]:
        """The open windows, fullest first; the packer is empty afterwards."""
        out = [self.open[key] for _, key in self.gaps]
        self.gaps, self.open = [], {}
        return out


def end_to_end(windows: list[list[Piece]], length: int = LENGTH) -> list[list[Piece]]:
    """Windows laid one after the other and cut at `length`: all but the last are full."""
    out: list[list[Piece]] = []
    room = 0
    for doc, start, ids, total in (p for w in windows for p in w):
        while len(ids):
            if not room:
                out.append([])
                room = length
            out[-1].append((doc, start, ids[:room], total))
            taken = min(room, len(ids))
            start, ids, room = start + taken, ids[taken:], room - taken
    return out


def rows_of(windows: list[list[Piece]], first_id: int, with_ids: bool) -> list[tuple]:
    rows = []
    for k, window in enumerate(windows):
        offset = 0
        for doc, start, ids, total in window:
            raw = ids.astype("<u4", copy=False).tobytes()
            rows.append((doc, start, len(ids), zlib.crc32(raw), total, first_id + k, offset, *((raw,) if with_ids else ())))
            offset += len(ids)
    return rows


def batch_of(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return record(schema, list(map(list, zip(*rows, strict=True))))


def pack_documents(docs: DataFrame, length: int = LENGTH, windows: int = WINDOWS, slack: int = SLACK, end: int = END, files: tuple[str, str, str] | None = None) -> DataFrame:
    """One row a piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    Partitions are packed where they are read; only left-overs move. The first phase is written to the shared
    checkpoint folder, so its sequence ids, which carry the partition's number, are those of one run.
    """
    files = files or byte_bpe_files()

    @tidied
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, packer = byte_bpe(*files), Packer(length, windows, slack)
        next_id = TaskContext.get().partitionId() << 33
        tail = np.asarray([end], dtype="<u4")
        for batch in batches:
            for doc, text in zip(batch.column(0), texts_of(batch), strict=True):
                ids = np.concatenate([bpe.ids(text), tail])
                packer.add((doc.as_py(), 0, ids, len(ids)))
                if len(packer.out) >= 2048:
                    out = packer.closed()
                    yield batch_of([(*r, None) for r in rows_of(out, next_id, False)], OPEN)
                    next_id += len(out)
        if out := packer.closed():
            yield batch_of([(*r, None) for r in rows_of(out, next_id, False)], OPEN)
        next_id += len(out)
        if left := packer.rest():
            yield batch_of(rows_of(left, next_id, True), OPEN)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer, group, next_id = Packer(length, windows, 0), None, 0

        def finish() -> Iterator[pa.RecordBatch]:
            out = packer.closed() + end_to_end(packer.rest(), length)
            if out:
                yield batch_of(rows_of(out, MERGED + (group << 33) + next_id, False), PACKED)

        for batch in batches:
            for row in batch.to_pylist():
                if row["part"] != group:
                    if group is not None:
                        yield from finish()
                    group, next_id = row["part"], 0
                packer.add((row["doc_id"], row["start"], np.frombuffer(row["ids"], dtype="<u4"), row["doc_tokens"]))
            if len(packer.out) >= 2048:
                out = packer.closed()
                yield batch_of(rows_of(out, MERGED + (group << 33) + next_id, False), PACKED)
                next_id += len(out)
        if group is not None:
            yield from finish()

    first = cut(id_text(docs).mapInArrow(pack, PIECES + ", ids binary"))
    left = first.filter(F.col("ids").isNotNull())
    groups = 1 + (left.agg(F.sum("length")).first()[0] or 0) // GROUP_IDS
    dealt = left.withColumn("part", F.pmod(F.shiftright("sequence_id", 33), F.lit(groups)).cast("long"))
    merged = dealt.repartition(groups, "part").sortWithinPartitions("part", "sequence_id", "offset").mapInArrow(merge, PIECES)
    return first.filter(F.col("ids").isNull()).drop("ids").unionByName(merged)


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"))


QUERIES = {"op10_packing": op10_packing}
