"""Queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from marlstone.llm import bpe_table, chat, jaccard_join, merkle, packing, quality, secrets, sharding, suffix_dedup, toxicity
from marlstone.shipping import ship

MODULES = (suffix_dedup, jaccard_join, bpe_table, merkle, sharding, quality, toxicity, chat, secrets, packing)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def shipped(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship(spark)
            return f(spark, sf_dir)

        return run

    return {name: shipped(f) for m in MODULES for name, f in m.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for m in MODULES for name, sql in getattr(m, "SQL", {}).items()}
