"""Helpers that the training-data operators share."""

from __future__ import annotations

import ctypes
import os
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import suppress
from functools import wraps

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space that separates words: space and \t \n \v \f \r.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_text(docs: DataFrame) -> DataFrame:
    """Only the two columns that an operator needs: extra columns, whatever their names, are not read."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the cluster's spark.checkpoint.dir; a folder of our own only where none is set, as in local tests."""
    sc = spark.sparkContext
    if sc._jsc.sc().getCheckpointDir().isDefined():
        return
    named = spark.conf.get("spark.checkpoint.dir", None)
    sc.setCheckpointDir(named or tempfile.mkdtemp(prefix="checkpoint-"))


def cut(df: DataFrame) -> DataFrame:
    """Materialise df in the shared checkpoint folder and cut its lineage."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def checkpoint_dir(spark: SparkSession) -> str:
    ensure_checkpoint_dir(spark)
    return spark.sparkContext._jsc.sc().getCheckpointDir().get()


class Scratch:
    """Tables written to the shared checkpoint folder, which are deleted together when the work is done.

    Parquet files there outlive executors and take less room than a checkpoint of rows.
    """

    def __init__(self, spark: SparkSession):
        self.spark, self.root = spark, f"{checkpoint_dir(spark)}/scratch-{uuid.uuid4().hex}"
        self.made = 0

    def cut(self, df: DataFrame) -> DataFrame:
        """df written, and read again without its lineage."""
        self.made += 1
        path = f"{self.root}/{self.made}"
        df.write.option("compression", "zstd").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def close(self) -> None:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.root)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)

    def __enter__(self) -> Scratch:
        return self

    def __exit__(self, *_: object) -> None:
        self.close()


#: Bits of the filter that keeps rows which a join will not need from being shuffled.
FILTER_BITS = 23


def id_filter(ids: DataFrame) -> np.ndarray:
    """A bitmap of 2^FILTER_BITS bits of the hashes of the ids, the only column."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.zeros(1 << FILTER_BITS, dtype=bool)
        for batch in batches:
            bits[batch.column(0).to_numpy()] = True
        yield record(pa.schema([("bits", pa.binary())]), [[zstandard.compress(np.packbits(bits).tobytes(), 3)]])

    out = np.zeros(1 << (FILTER_BITS - 3), dtype=np.uint8)
    places = ids.select(F.pmod(F.xxhash64(ids.columns[0]), F.lit(1 << FILTER_BITS)).cast("long").alias("h"))
    for r in places.coalesce(16).mapInArrow(run, "bits binary").toLocalIterator():
        out |= np.frombuffer(zstandard.decompress(r["bits"]), dtype=np.uint8)
    return out


def likely(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows of docs(doc_id, ...) whose ids are among `ids`, and some others: a bitmap of fixed size is broadcast,
    which drops most other rows while it is not full. A join by id has to follow."""
    bits = docs.sparkSession.sparkContext.broadcast(id_filter(ids))
    names = docs.columns
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1 << FILTER_BITS)).cast("long")

    @tidied
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        passing = np.unpackbits(bits.value).astype(bool)
        for batch in batches:
            kept = batch.filter(pa.array(passing[batch.column(0).to_numpy()]))
            yield pa.RecordBatch.from_arrays(kept.columns[1:], names=names)

    return docs.select(place.alias("__place"), *names).mapInArrow(run, docs.schema)


def stored_bytes(df: DataFrame) -> int:
    """The optimiser's estimate of the size of df."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def sha256_hex(data: Column) -> Column:
    return F.sha2(data, 256)


def one_thread() -> None:
    """A Python worker is one of many on its machine: keep native tokenisers to one thread."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    os.environ["RAYON_NUM_THREADS"] = "1"


def tidied(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """run, after which the memory it no longer uses goes back to the system: a worker stays for other tasks."""

    @wraps(run)
    def inner(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            with suppress(OSError, AttributeError):
                ctypes.CDLL(None).malloc_trim(0)

    return inner


def texts_of(batch: pa.RecordBatch, name: str = "text") -> Iterator[str]:
    """The column's values as str, null as the empty text, without a list of all of them."""
    for value in batch.column(batch.schema.get_field_index(name)):
        yield value.as_py() or ""


def record(schema: pa.Schema, columns: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) if not isinstance(c, (pa.Array, pa.ChunkedArray)) else c for c, f in zip(columns, schema, strict=True)], schema=schema)
