"""Sending this package to the executors of a session."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_shipped: set[str] = set()


def ship(spark: SparkSession) -> SparkSession:
    """Makes ``lineloom`` importable in Python workers, once per application."""
    app = spark.sparkContext.applicationId
    if app not in _shipped:
        home = Path(__file__).resolve().parent
        at = Path(tempfile.mkdtemp(prefix="lineloom-ship-")) / "lineloom.zip"
        with zipfile.ZipFile(at, "w") as z:
            for p in sorted(home.rglob("*.py")):
                z.write(p, p.relative_to(home.parent))
        spark.sparkContext.addPyFile(str(at))
        _shipped.add(app)
    return spark


def table(spark: SparkSession, sf_dir: str, name: str):
    """One of the given tables, with the package shipped."""
    return ship(spark).read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
