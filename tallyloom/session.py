"""Sessions for tests and benches, and the package for Python workers that don't have it installed."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

ROOT = Path(__file__).resolve().parent.parent


def local(cores: int = 8, partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A local session with what the queries assume: UTC and adaptive execution."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.driver.memory", memory)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ship(spark: SparkSession) -> None:
    """Makes the package importable in Python workers, once for each Spark context."""
    sc = spark.sparkContext
    if getattr(sc, "_tallyloom_shipped", False):
        return
    path = Path(tempfile.mkdtemp(prefix="tallyloom-")) / "tallyloom.zip"
    with zipfile.ZipFile(path, "w") as z:
        for f in sorted(Path(ROOT, "tallyloom").rglob("*.py")):
            z.write(f, os.fspath(f.relative_to(ROOT)))
    sc.addPyFile(os.fspath(path))
    sc._tallyloom_shipped = True
