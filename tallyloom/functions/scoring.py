"""Scores, ladders and estimates as columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import patterns as P


def model_class(model: Column, classes: Mapping[str, Sequence[str]] = P.MODEL_CLASSES) -> Column:
    """The first class one of whose words stands in the model's id; else `other`."""
    low = F.lower(F.coalesce(model, F.lit("")))
    return F.coalesce(*[F.when(reduce(or_, [low.contains(w) for w in words]), F.lit(name)) for name, words in classes.items()], F.lit("other"))


def watt_hours(cls: Column, calls: Column) -> Column:
    each = F.lit(P.WATT_HOURS_OTHER)
    for name, wh in P.WATT_HOURS.items():
        each = F.when(cls == name, wh).otherwise(each)
    return calls * each * P.OVERHEAD


def grams(wh: Column) -> Column:
    return wh / 1000 * P.GRAMS_PER_KWH


def alert_level(pct: Column) -> Column:
    return F.when(pct >= 95, "limit").when(pct >= 85, "critical").when(pct >= 70, "warning").when(pct >= 50, "info").otherwise("ok")


def recommendation(pct: Column) -> Column:
    return F.when(pct >= 95, "wind_down").when(pct >= 70, "medium").otherwise("large")


def highest_alert(pct: Column) -> Column:
    """The highest threshold reached; null below 50."""
    out = F.lit(None).cast("int")
    for t in (50, 60, 70, 80, 90, 95, 100):
        out = F.when(pct >= t, t).otherwise(out)
    return out


def equivalence_label(g: Column) -> Column:
    """A comparison for a person: the first scale that gives at least one."""
    return (
        F.when(g < P.EQUIVALENTS["charges"], F.format_string("%.1f searches", g / P.EQUIVALENTS["searches"]))
        .when(g < P.EQUIVALENTS["miles"], F.format_string("%.1f charges", g / P.EQUIVALENTS["charges"]))
        .otherwise(F.format_string("%.1f miles", g / P.EQUIVALENTS["miles"]))
    )


def idf(n: Column, df: Column) -> Column:
    """ln(n / (1 + df)); negative where a term is in all documents."""
    return F.log(n / (1 + df))


def bm25_part(tf: Column, length: Column, mean_length: Column, n: Column, df: Column, k1: float = 1.2, b: float = 0.75) -> Column:
    """One term's part of the score; a weight that isn't positive counts as 1e-6."""
    weight = F.log((n - df + 0.5) / (df + 0.5))
    weight = F.when(weight <= 0, 1e-6).otherwise(weight)
    return weight * tf * (k1 + 1) / (tf + k1 * (1 - b + b * length / mean_length))


def composite(a: Column, b: Column, c: Column, d: Column) -> Column:
    return a * 0.40 + b * 0.25 + c * 0.20 + d * 0.15


def grade(score: Column) -> Column:
    return F.when(score >= 90, "A").when(score >= 80, "B").when(score >= 70, "C").when(score >= 60, "D").otherwise("F")


def trend(recent: Column, older: Column) -> Column:
    """Rates: below 0.7 times improving, above 1.3 times worsening."""
    return F.when(older == 0, F.when(recent == 0, "stable").otherwise("worsening")).when(recent < older * 0.7, "improving").when(recent > older * 1.3, "worsening").otherwise("stable")


def snapshot_trend(now: Column, before: Column) -> Column:
    change = (now - before) / before
    return F.when(before.isNull() | (before == 0), "new").when(change > 0.05, "up").when(change < -0.05, "down").otherwise("flat")


def rule_score(explicit: Column, universal: Column, consequence: Column, tool: Column, spike: Column) -> Column:
    """In this order of addition, so that a score at the threshold is the same everywhere."""
    domain = F.when(explicit, P.EXPLICIT).when(universal, P.UNIVERSAL).otherwise(0.0)
    return domain + consequence + F.when(tool, P.TOOL).otherwise(0.0) + F.least(spike, F.lit(P.SPIKE_CAP))


def decayed(spike: Column, days: Column) -> Column:
    left = F.greatest(F.lit(0.0), spike - P.DECAY_PER_DAY * F.least(days, F.lit(P.MOST_DAYS)))
    return F.when(left <= 0.001, 0.0).otherwise(left)
