"""Many checks in one pass: each table is scanned once, by whatever is done with it anyway, and its checks ride along.

A check is an aggregate and the bounds that it must keep. The checks of a table are observed metrics, so that writing or
counting the table makes them, too; what they say is a small table of one row for each check.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

REPORT = "name string, source string, value double, status string"


@dataclass(frozen=True)
class Check:
    """An aggregate, and what it may be: from `least` to `most`; `severe` says whether beyond that is a failure or a warning."""

    name: str
    value: Column
    least: float | None = None
    most: float | None = None
    severe: bool = True

    def status(self, value: float | None) -> str:
        if value is None:
            return "no rows"
        beyond = (self.least is not None and value < self.least) or (self.most is not None and value > self.most)
        return ("failed" if self.severe else "warning") if beyond else "ok"


class Watch:
    """A table's checks. `rows` is the table, to be used in any one action; `report` says what that action found."""

    def __init__(self, source: str, rows: DataFrame, checks: list[Check]):
        names = [c.name for c in checks]
        if len({*names}) < len(names):
            raise ValueError("checks of a table need different names")
        self.source, self.checks, self.observation = source, checks, Observation()
        self.rows = rows.observe(self.observation, *[c.value.cast("double").alias(c.name) for c in checks])

    def report(self) -> list[tuple]:
        """(name, source, value, status) of each check; waits for the action."""
        found = self.observation.get
        return [(c.name, self.source, found[c.name], c.status(found[c.name])) for c in self.checks]


def run(watches: list[Watch], use: Callable[[DataFrame], None] = lambda rows: rows.write.format("noop").mode("overwrite").save()) -> list[tuple]:
    """Uses each table once, and gives what all checks found; a table that can't be read fails its checks only."""
    found: list[tuple] = []
    for w in watches:
        try:
            use(w.rows)
            found += w.report()
        except Exception as error:  # noqa: BLE001
            found += [(c.name, w.source, None, f"crash: {type(error).__name__}") for c in w.checks]
    return found


def table_of(spark: SparkSession, found: list[tuple]) -> DataFrame:
    """REPORT, failures first."""
    rank = F.when(F.col("status").startswith("crash"), 0).when(F.col("status") == "failed", 1).when(F.col("status") == "warning", 2).otherwise(3)
    return spark.createDataFrame(found, REPORT).orderBy(rank, "source", "name")


def summary(found: list[tuple]) -> Mapping[str, int]:
    """How many checks have each status."""
    out: dict[str, int] = {}
    for *_, status in found:
        out[status.split(":")[0]] = out.get(status.split(":")[0], 0) + 1
    return out
