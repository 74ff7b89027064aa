"""Operators on event logs: windows, gaps, costs, energy, gates, trends. The reference time is an argument.

Events have event_id, ts, user_id, event_type, value. A user stands for a session, a type for a model or an action.
Where a query asks for an order over all events (gaps of the whole stream), events are first reduced to hours or to
what a window function needs, and the order is taken over the days' small tables where it can be.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import dates as D
from ..functions import patterns as P
from ..functions import scoring as S


def in_window(events: DataFrame, as_of: Column, hours: int = 5) -> DataFrame:
    """Events of the hours before as_of, both ends included."""
    at = D.seconds(F.col("ts"))
    return events.where((at >= D.seconds(as_of) - hours * 3600) & (at <= D.seconds(as_of)))


def rolling(events: DataFrame, seconds: int, by: str | None = None) -> DataFrame:
    """Each event with the count and sum of values of the trailing window, its own time included."""
    w = Window.partitionBy(by) if by else Window.partitionBy()
    w = w.orderBy("sec").rangeBetween(-seconds, Window.currentRow)
    return events.withColumn("sec", F.floor(D.seconds(F.col("ts"))).cast("long")).withColumns({"n": F.count("*").over(w), "total": F.sum("value").over(w)}).drop("sec")


def gap_starts(events: DataFrame, minutes: int = 30) -> DataFrame:
    """ts of the events that follow a gap of the whole stream, the first one included.

    A gap can only lie between the last event of one minute and the first of the next minute that has any, so minutes
    are compared, not events: one row for each minute, whatever the rate.
    """
    minute = events.groupBy(F.date_trunc("minute", "ts").alias("minute")).agg(F.min("ts").alias("first"), F.max("ts").alias("last"))
    before = F.lag("last").over(Window.orderBy("minute"))
    gap = D.seconds(F.col("first")) - D.seconds(F.col("before"))
    return minute.withColumn("before", before).where(F.col("before").isNull() | (gap >= minutes * 60)).select(F.col("first").alias("start"))


def stream_sessions(events: DataFrame, minutes: int = 30) -> DataFrame:
    """Sessions of the whole stream: start, end, events, value. Minutes are put in order, not events."""
    minute = events.groupBy(F.date_trunc("minute", "ts").alias("minute")).agg(F.min("ts").alias("first"), F.max("ts").alias("last"), F.count("*").alias("n"), F.sum("value").alias("value"))
    w = Window.orderBy("minute")
    gap = D.seconds(F.col("first")) - D.seconds(F.lag("last").over(w))
    number = F.sum(F.when(gap < minutes * 60, 0).otherwise(1)).over(w.rowsBetween(Window.unboundedPreceding, 0))
    return minute.withColumn("session", number).groupBy("session").agg(F.min("first").alias("start"), F.max("last").alias("end"), F.sum("n").alias("n"), F.sum("value").alias("value")).drop("session")


def gap_sessions(events: DataFrame, minutes: int, by: str) -> DataFrame:
    """Sessions of each key that end where nothing happens for so many minutes: start, end, events, value."""
    window = F.session_window("ts", f"{minutes} minutes")
    out = events.groupBy(window.alias("w"), by).agg(F.min("ts").alias("start"), F.max("ts").alias("end"), F.count("*").alias("n"), F.sum("value").alias("value"))
    return out.drop("w")


def since_last_gap(events: DataFrame, as_of: Column, minutes: int = 30, hours: int = 12) -> DataFrame:
    """One row: start, events and value since the last gap of the hours before as_of."""
    recent = in_window(events, as_of, hours)
    last = gap_starts(recent, minutes).agg(F.max("start").alias("start"))
    return recent.join(F.broadcast(last), F.col("ts") >= F.col("start")).agg(F.min("start").alias("start"), F.count("*").alias("n"), F.sum("value").alias("value"))


def energy(calls: DataFrame, cls: str = "class", n: str = "calls") -> DataFrame:
    """By class and in total (class null): calls, Wh with the building's overhead, g CO2e."""
    rows = calls.withColumn("wh", S.watt_hours(F.col(cls), F.col(n)))
    return rows.rollup(cls).agg(F.sum(n).alias("calls"), F.round(F.sum("wh"), 1).alias("wh"), F.round(F.sum(S.grams(F.col("wh"))), 1).alias("grams"))


def priced(usage: DataFrame, prices: Mapping[str, tuple[float, float]] = P.PRICES, by_class: bool = True) -> DataFrame:
    """usage (model, input, output, cache_write, cache_read) with cost: at the model's price, else that of its class, else the default one."""
    choose = lambda i: F.coalesce(
        *[F.when(F.col("model") == m, F.lit(p[i])) for m, p in prices.items()],
        *([F.when(S.model_class(F.col("model")) == m.split("-")[0], F.lit(p[i])) for m, p in prices.items()] if by_class else []),
        F.lit(prices[P.DEFAULT_MODEL][i]),
    )
    price_in, price_out = choose(0), choose(1)
    cost = F.col("input") * price_in + F.col("output") * price_out + F.col("cache_write") * price_in * P.CACHE_WRITE + F.col("cache_read") * price_in * P.CACHE_READ
    return usage.withColumn("cost", cost)


def last_n_rate(rows: DataFrame, group: str, order: str, ok: Column, n: int = 20, least: int = 5) -> DataFrame:
    """By group: success of the last n calls; fewer than `least` calls give no verdict."""
    w = Window.partitionBy(group).orderBy(F.desc(order))
    recent = rows.select(group, order, ok.cast("int").alias("ok")).withColumn("place", F.row_number().over(w)).where(F.col("place") <= n)
    rate = F.col("good") / F.col("calls")
    verdict = F.when(F.col("calls") < least, "insufficient").when(rate < 0.5, "disabled").when(rate < 0.7, "warn").otherwise("ok")
    return recent.groupBy(group).agg(F.count("*").alias("calls"), F.sum("ok").alias("good")).select(group, "calls", "good", F.round(rate, 6).alias("rate"), verdict.alias("verdict"))


def latest(rows: DataFrame, key: str, order: list[str], columns: list[str]) -> DataFrame:
    """The last row of each key: an upsert's result. An aggregate, so a key with many versions is reduced before the shuffle."""
    pick = F.max_by(F.struct(*columns), F.struct(*order))
    return rows.groupBy(key).agg(pick.alias("r")).select(key, "r.*")


def precedence(events: DataFrame, key: str, first: Column, then: Column) -> DataFrame:
    """By key: `then` events, and how many have no earlier `first` event of the same key."""
    earliest = events.groupBy(key).agg(F.min(F.when(first, F.struct("ts", "event_id"))).alias("f"))
    later = events.where(then).join(earliest, key)
    missing = F.col("f").isNull() | (F.struct("ts", "event_id") <= F.col("f"))
    return later.groupBy(key).agg(F.count("*").alias("n"), F.count_if(missing).alias("without_first"))
