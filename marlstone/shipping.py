"""Sending this package to the executors, whose Python workers import it."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession


def ship(spark: SparkSession) -> None:
    """Once a session, as Spark sends any Python library."""
    top = Path(__file__).resolve().parent
    sc = spark.sparkContext
    if getattr(sc, f"_{top.name}_sent", False):
        return
    with zipfile.ZipFile(Path(tempfile.mkdtemp()) / f"{top.name}.zip", "w") as z:
        for p in sorted(top.rglob("*.py")):
            z.write(p, p.relative_to(top.parent))
    sc.addPyFile(z.filename)
    setattr(sc, f"_{top.name}_sent", True)
