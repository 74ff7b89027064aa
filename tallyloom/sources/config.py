"""Small configurations as DataFrames: rules, keywords, prices. They are read on the driver, which knows their size."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def load(path: str) -> dict:
    """A JSON or YAML file; YAML needs the yaml package."""
    text = Path(path).read_text(encoding="utf-8")
    if path.endswith(".json"):
        return json.loads(text)
    try:
        import yaml
    except ImportError as e:
        raise ImportError("YAML files need the yaml package") from e
    return yaml.safe_load(text)


def rules(spark: SparkSession, found: Sequence[Mapping]) -> DataFrame:
    """Rules as rows, in the order of the file."""
    from ..operators.rules import RULE

    rows = [(r["id"], r.get("name", ""), r.get("domains", []), r.get("tool_triggers", []), float(r.get("consequence", 0.1)), {k: float(v) for k, v in r.get("connections", {}).items()}, r.get("reminder", ""), float(r.get("adaptive_spike", 0.0)), bool(r.get("dormant", False)), i) for i, r in enumerate(found)]
    return spark.createDataFrame(rows, RULE)


def keyed(spark: SparkSession, values: Mapping[str, float], key: str, value: str) -> DataFrame:
    return spark.createDataFrame([(k, float(v)) for k, v in values.items()], f"{key} string, {value} double")
