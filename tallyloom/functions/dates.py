"""Dates and times as columns; the reference time is always an argument."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def quarter_label(d: Column) -> Column:
    return F.concat(F.year(d).cast("string"), F.lit("-Q"), F.quarter(d).cast("string"))


def quarter_start(d: Column) -> Column:
    return F.trunc(d, "quarter").cast("date")


def is_due(frequency: Column, last: Column, today: Column) -> Column:
    """Never run is due; then by frequency."""
    days = F.datediff(today, last)
    weekday = F.weekday(today)
    return (
        F.when(last.isNull(), frequency != "on_demand")
        .when(frequency == "daily", days >= 1)
        .when(frequency == "weekly_monday", (weekday == 0) & (days >= 1))
        .when(frequency == "weekly_friday", (weekday == 4) & (days >= 1))
        .when(frequency == "monthly", days >= 28)
        .when(frequency == "quarterly", quarter_label(last) != quarter_label(today))
        .otherwise(False)
    )


def is_overdue(frequency: Column, last: Column, today: Column) -> Column:
    days = F.datediff(today, last)
    limit = F.when(frequency == "daily", 2).when(frequency.startswith("weekly"), 8).when(frequency == "monthly", 35).when(frequency == "quarterly", 100)
    return F.coalesce(days > limit, F.lit(False))


def next_due(frequency: Column, last: Column, today: Column) -> Column:
    """The next date on which it is due; null for what runs on demand."""
    return (
        F.when(frequency == "on_demand", None)
        .when(last.isNull(), today)
        .when(frequency == "daily", F.date_add(last, 1))
        .when(frequency == "weekly_monday", F.next_day(last, "Mon"))
        .when(frequency == "weekly_friday", F.next_day(last, "Fri"))
        .when(frequency == "monthly", F.date_add(last, 28))
        .when(frequency == "quarterly", F.add_months(quarter_start(last), 3))
        .cast("date")
    )


def age_label(seconds: Column) -> Column:
    whole = lambda n: F.floor(seconds / n).cast("string")
    return F.when(seconds < 60, F.concat(whole(1), F.lit("s"))).when(seconds < 3600, F.concat(whole(60), F.lit("m"))).when(seconds < 86400, F.concat(whole(3600), F.lit("h"))).otherwise(F.concat(whole(86400), F.lit("d")))


def freshness(days: Column) -> Column:
    return F.when(days > 60, "HIGH").when(days > 30, "MEDIUM").otherwise("OK")


def recency_boost(date_text: Column, year: Column) -> Column:
    """By calendar year: the same or a later one 1.2, up to three years 1.0, older 0.8; without a year from 2010 to 2029, 1.0."""
    found = F.regexp_extract(F.coalesce(date_text, F.lit("")), "20[12]\\d", 0)
    age = year - F.try_to_number(found, F.lit("9999")).cast("int")
    return F.when(age.isNull(), 1.0).when(age < 1, 1.2).when(age <= 3, 1.0).otherwise(0.8)


def safe_date(text: Column) -> Column:
    return F.try_to_date(F.left(text, F.lit(10)), "yyyy-MM-dd")


def duration_label(seconds: Column) -> Column:
    return F.when(seconds < 60, F.format_string("%.1fs", seconds.cast("double"))).when(seconds < 3600, F.format_string("%dm %ds", F.floor(seconds / 60), F.floor(seconds % 60))).otherwise(F.format_string("%dh %dm", F.floor(seconds / 3600), F.floor(seconds % 3600 / 60)))


def seconds(ts: Column) -> Column:
    """Seconds since 1970 of a timestamp, whichever kind, with the session in UTC."""
    return F.unix_micros(ts.cast("timestamp")) / 1_000_000
