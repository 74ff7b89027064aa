"""Rules whose state changes as time passes, without any event: decay, idleness, and the cool-down of pairs set apart.

Each key's processor holds its state and one timer, set to the next midnight of event time. When the watermark has
passed it, the days since the last change are applied at once (decay is linear, so that is as many single steps), and
the timer is set anew. A key is forgotten when nothing is left that time could change: a rule that isn't dormant after
FORGET idle days without a spike, a pair when its cool-down is over. Needs the session's RocksDB state store (`STORE`).
"""

from __future__ import annotations

from collections.abc import Iterator
from datetime import UTC, datetime

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..functions import patterns as P
from .streams import stepped

#: What the session needs for timers.
STORE = ("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
DAY = 86_400_000
#: Idle days after which a rule without a spike is no longer kept.
FORGET = 365
STATE = "spike double, dormant boolean, idle_days long, activations long, reactivations long, day long"
OUTPUT = "rule string, spike double, dormant boolean, idle_days long, activations long, reactivations long, day long, candidate boolean, cause string"
COOLING = "pair string, days_left long, free boolean"


def _milliseconds(at: pd.Series) -> pd.Series:
    return at.astype("datetime64[ms]").astype("int64")


class Rules(StatefulProcessor):
    """Events (rule, at, kind, source): violation, activation or sleep; days come from timers."""

    def __init__(self, sleep_after: int = P.INACTIVE_DAYS, forget: int = FORGET):
        self.sleep_after, self.forget = sleep_after, forget

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("rule", STATE)

    def passed(self, state: tuple, day: int) -> tuple:
        """The state at a later day: decayed, and idle for longer."""
        days = max(0, day - state[5])
        now = state[:5]
        while days > 0:  # a step has a limit of its own
            now, days = stepped(now, "day", "", min(days, P.MOST_DAYS)), days - P.MOST_DAYS
        return *now, max(day, state[5])

    def row(self, key, known: tuple, *cause: str) -> pd.DataFrame:
        """With whether the rule may be put to sleep."""
        names = [c.split(" ")[0] for c in OUTPUT.split(", ")]
        return pd.DataFrame([(*key, *known, not known[1] and known[2] >= self.sleep_after, *cause)], columns=names[: len(known) + 2 + len(cause)])

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        events = pd.concat(rows).sort_values(["at", "kind", "source"])
        known = self.state.get() if self.state.exists() else None
        for at, kind, source in zip(_milliseconds(events["at"]), events["kind"], events["source"], strict=True):
            known = known or (0.0, False, 0, 0, 0, at // DAY)
            known = self.passed(known, at // DAY)
            known = (*stepped(known[:5], kind, source, 0), known[5])
        self.state.update(known)
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        self.handle.registerTimer((known[5] + 1) * DAY)
        yield self.row(key, known, "event")

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        known = self.passed(self.state.get(), timerValues.getCurrentWatermarkInMs() // DAY)
        if known[2] >= self.forget and known[0] == 0.0 and not known[1]:
            self.state.clear()
        else:
            self.state.update(known)
            self.handle.registerTimer((known[5] + 1) * DAY)
        yield self.row(key, known, "time")


class Cooling(StatefulProcessor):
    """Pairs that were set apart (pair, at): they may merge again after so many days, which a timer tells."""

    def __init__(self, days: int):
        self.days = days

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.until = handle.getValueState("until", "at long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        last = max(int(_milliseconds(part["at"]).max()) for part in rows)
        until = max(last // DAY + self.days, self.until.get()[0] if self.until.exists() else 0)
        self.until.update((until,))
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        self.handle.registerTimer(until * DAY)
        yield pd.DataFrame([(*key, until - last // DAY, False)], columns=["pair", "days_left", "free"])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.until.clear()
        yield pd.DataFrame([(*key, 0, True)], columns=["pair", "days_left", "free"])


def rule_states(events: DataFrame, late: str = "0 seconds", sleep_after: int = P.INACTIVE_DAYS, forget: int = FORGET) -> DataFrame:
    """OUTPUT rows: a rule's state after each batch of its events, and after days without any. events: rule, at (timestamp), kind, source."""
    rows = events.select("rule", "at", "kind", "source").withWatermark("at", late)
    return rows.groupBy("rule").transformWithStateInPandas(Rules(sleep_after, forget), OUTPUT, "update", "eventTime")


def cooling(pairs: DataFrame, days: int = 30, late: str = "0 seconds") -> DataFrame:
    """COOLING rows: when a pair is set apart, and when its cool-down is over. pairs: pair, at (timestamp)."""
    rows = pairs.select("pair", "at").withWatermark("at", late)
    return rows.groupBy("pair").transformWithStateInPandas(Cooling(days), COOLING, "update", "eventTime")


def rule_states_in_batch(events: DataFrame, until: datetime, sleep_after: int = P.INACTIVE_DAYS) -> DataFrame:
    """OUTPUT without its cause: the states at a time, from all events at once."""
    day = until.replace(tzinfo=UTC).timestamp() * 1000 // DAY
    columns = OUTPUT.rpartition(",")[0]

    def fold(pdf: pd.DataFrame) -> pd.DataFrame:
        rules, known = Rules(sleep_after), None
        pdf = pdf.sort_values(["at", "kind", "source"])
        for at, kind, source in zip(_milliseconds(pdf["at"]), pdf["kind"], pdf["source"], strict=True):
            known = rules.passed(known or (0.0, False, 0, 0, 0, at // DAY), at // DAY)
            known = (*stepped(known[:5], kind, source, 0), known[5])
        return rules.row((pdf["rule"].iloc[0],), rules.passed(known, int(day)))

    return events.select("rule", "at", "kind", "source").groupBy("rule").applyInPandas(fold, columns)
