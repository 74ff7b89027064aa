"""The event log as a stream: sliding windows, sessions, daily counts, per-rule state, alert changes, new files once.

Batch queries are the reference semantics; these give the same rows once the watermark has passed. Each takes a
streaming (or, for tests, a batch) DataFrame with ts, and returns one; starting a query and its checkpoint folder are
the caller's.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..functions import patterns as P
from ..functions import scoring as S


def events(spark: SparkSession, path: str, schema, files_per_trigger: int = 16) -> DataFrame:
    """Files of a folder as a stream, some at a time."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(path)


def sliding_usage(rows: DataFrame, hours: int = 5, step: str = "1 minute", late: str = "10 minutes") -> DataFrame:
    """start, end, n, total of every window of so many hours, moved by a step. Events are first summed by step, so that each step, not each event, is copied to the windows that hold it."""
    steps = rows.withWatermark("ts", late).groupBy(F.window("ts", step).alias("step")).agg(F.count("*").alias("n"), F.sum("value").alias("total"))
    out = steps.groupBy(F.window(F.window_time("step"), f"{hours} hours", step).alias("w")).agg(F.sum("n").alias("n"), F.sum("total").alias("total"))
    return out.select("w.start", "w.end", "n", "total")


def sessions(rows: DataFrame, key: str = "user_id", minutes: int = 30, late: str = "10 minutes") -> DataFrame:
    """key, start, end, n, total of sessions that a gap ends."""
    out = rows.withWatermark("ts", late).groupBy(key, F.session_window("ts", f"{minutes} minutes").alias("w")).agg(F.count("*").alias("n"), F.sum("value").alias("total"))
    return out.select(key, "w.start", "w.end", "n", "total")


def daily_counts(rows: DataFrame, late: str = "1 day") -> DataFrame:
    """day, event_type, n; a day's state goes once the watermark is past it."""
    out = rows.withWatermark("ts", late).groupBy(F.window("ts", "1 day").alias("w"), "event_type").agg(F.count("*").alias("n"))
    return out.select(F.col("w.start").alias("day"), "event_type", "n")


def unique_events(rows: DataFrame, keys: tuple[str, ...] = ("event_id",), late: str = "1 hour") -> DataFrame:
    """Each event once, however often it is delivered within the watermark."""
    return rows.withWatermark("ts", late).dropDuplicatesWithinWatermark(list(keys))


RULE_STATE = "spike double, dormant boolean, idle_days long, activations long, reactivations long"
RULE_OUTPUT = f"rule string, {RULE_STATE}"


def stepped(state: tuple, kind: str, source: str, n: int) -> tuple:
    """The state after one event."""
    spike, dormant, idle, hits, woken = state
    if kind == "violation":
        return (P.IMMUNE_SPIKE, False, idle, hits, woken + 1) if dormant else (min(spike + P.SPIKES.get(source, P.OTHER_SPIKE), P.SPIKE_CAP), dormant, idle, hits, woken)
    if kind == "activation":
        return spike, dormant, 0, hits + 1, woken
    if kind == "sleep":
        return spike, True, idle, hits, woken
    days = min(int(n), P.MOST_DAYS)
    left = max(0.0, spike - P.DECAY_PER_DAY * days)
    return (0.0 if left <= 0.001 else left), dormant, idle + days, hits, woken


def rule_states(rows: DataFrame) -> DataFrame:
    """RULE_OUTPUT after each batch's events (rule, at, kind, source, n), for the rules that had any; the state lives with the key."""

    def update(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        now = tuple(state.get) if state.exists else (0.0, False, 0, 0, 0)
        for kind, source, n in pd.concat(parts).sort_values("at")[["kind", "source", "n"]].itertuples(index=False):
            now = stepped(now, kind, source, n)
        state.update(now)
        yield pd.DataFrame([(*key, *now)], columns=["rule", "spike", "dormant", "idle_days", "activations", "reactivations"])

    return rows.groupBy("rule").applyInPandasWithState(update, RULE_OUTPUT, RULE_STATE, "update", GroupStateTimeout.NoTimeout)


def alert_changes(rows: DataFrame) -> DataFrame:
    """key, before, level: when a key's alert level (of its pct) changes from one event to the next."""

    def update(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        before = state.get[0] if state.exists else None
        found = []
        for level in pd.concat(parts).sort_values("at")["level"]:
            if before is not None and level != before:
                found.append((*key, before, level))
            before = level
        state.update((before,))
        yield pd.DataFrame(found, columns=["key", "before", "level"])

    leveled = rows.select("key", "at", S.alert_level(F.col("pct")).alias("level"))
    return leveled.groupBy("key").applyInPandasWithState(update, "key string, before string, level string", "level string", "append", GroupStateTimeout.NoTimeout)


def process_once(rows: DataFrame, handle: Callable[[DataFrame, int], None], checkpoint: str):
    """Starts a query that hands each batch of new rows to `handle` once, and stops when all are done."""
    return rows.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def append_once(rows: DataFrame, path: str, checkpoint: str, form: str = "json"):
    """Starts a query that appends each batch to a folder of files once, however often the batch is tried, and stops when all is done.

    A batch has a folder of its own, named by its number, which a second try replaces: whether the first one died
    before, while or after writing it, the batch is there once. `read_appended` leaves out what a dead try has begun.
    """

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").format(form).save(f"{path}/batch={number}")

    return rows.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def read_appended(spark: SparkSession, path: str, schema, form: str = "json") -> DataFrame:
    """All rows that `append_once` has written, and batch, the number of each row's batch."""
    return spark.read.schema(schema).option("basePath", path).format(form).load(f"{path}/batch=*")
