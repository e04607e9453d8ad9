"""From documents to packed token sequences: toxic documents go, one of each group of near copies stays, repeated
passages and secrets are taken out, and what is left is packed.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; run() writes each stage's rows as Parquet in the
shared checkpoint folder and reads them again as the next one's docs. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from marlstone.llm import jaccard_join, packing, secrets, suffix_dedup, toxicity
from marlstone.llm.common import Scratch
from marlstone.shipping import ship


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose score is below the threshold, as they are. Labels teach by the documents that carry them, but for
    those held out; no label is looked at to decide on a document. Null and empty texts get the score of a text without
    words; repeated rows share their fate; an empty table gives no rows; other columns may have any name."""
    ship(spark)
    labelled = toxicity.with_labels(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.below(docs, toxicity.learn(labelled))


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that links of a similarity of 0.75 or more hold together: the one with the smallest id.
    Null texts, and texts without words, are linked with nothing and stay; of rows with equal ids and texts one stays."""
    ship(spark)
    return jaccard_join.keep_one(docs)


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages of over 50 words, or of 400 bytes, that repeat anywhere; every occurrence goes. Rows with
    nothing to remove stay as they are, nulls included; a document of which only white space is left goes."""
    ship(spark)
    return suffix_dedup.cleaned(docs)


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with a mark in the place of every secret. Rows without one stay as they are, nulls included."""
    ship(spark)
    return secrets.redact_secrets(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of at most 2048 tokens. A null text is empty and has its end mark only; repeated rows are packed
    each; an empty table gives no rows."""
    ship(spark)
    return packing.pack_documents(docs)


STAGES = [
    ("toxicity", without_toxic),
    ("n-gram Jaccard join", without_near_copies),
    ("suffix-array dedup", without_repeats),
    ("secret scans", without_secrets),
    ("packing", packed),
]

#: SQL has no tokeniser and no model; the stages are tested against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    with Scratch(spark) as scratch:
        for _, stage in STAGES[:-1]:
            docs = scratch.cut(stage(spark, docs, sf_dir))
        return STAGES[-1][1](spark, docs, sf_dir)  # its rows are in the checkpoint folder when the others go
