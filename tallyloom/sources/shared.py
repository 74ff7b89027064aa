"""The folder that driver and executors share, and tables written there."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def folder(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir. Where none is set, as in tests, a temporary one, on a local master only."""
    sc = spark.sparkContext
    found = sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if not found:
        if not (sc.master or "").startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        found = tempfile.mkdtemp(prefix="tallyloom-")
        sc.setCheckpointDir(found)
    return found.rstrip("/")


def new_path(spark: SparkSession) -> str:
    return f"{folder(spark)}/{uuid.uuid4().hex}"


def written(rows: DataFrame) -> DataFrame:
    """rows as a Parquet table in the shared folder."""
    path = new_path(rows.sparkSession)
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)
