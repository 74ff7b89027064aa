"""State documents: JSON without a fixed schema, kept as VARIANT values; fields are taken by path where they are there."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def parsed(rows: DataFrame, text: str = "text", into: str = "state") -> DataFrame:
    """rows with a VARIANT of the text; null where it is no JSON."""
    return rows.withColumn(into, F.try_parse_json(F.col(text)))


def fields(state: Column, paths: Mapping[str, tuple[str, str]], defaults: Mapping[str, object] | None = None) -> list[Column]:
    """A column for each name, from (path, type); where the path is missing or holds another type, the default, else null."""
    found = {n: F.try_variant_get(state, p, t) for n, (p, t) in paths.items()}
    return [(F.coalesce(c, F.lit(defaults[n])) if defaults and n in defaults else c).alias(n) for n, c in found.items()]


def first_of(state: Column, type_: str, *paths: str) -> Column:
    """The first path that is there, for documents that name the same thing otherwise."""
    return F.coalesce(*[F.try_variant_get(state, p, type_) for p in paths])


def shapes(rows: DataFrame, state: str = "state") -> DataFrame:
    """shape, n: the documents' schemas (null: no JSON), and how many have each."""
    return rows.groupBy(F.schema_of_variant(F.col(state)).alias("shape")).agg(F.count("*").alias("n"))


def merged_shape(rows: DataFrame, state: str = "state") -> str | None:
    """One schema that all documents fit."""
    return rows.agg(F.schema_of_variant_agg(F.col(state))).first()[0]
