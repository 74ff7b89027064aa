"""Prompts and outputs: kinds, gates, routes, checks; all as columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions import text as X


def keyword_pattern(keyword: str) -> str:
    """A keyword as a pattern: as it stands if it is one, else as a whole word."""
    return keyword if any(c in keyword for c in r".*+\()[]{}|^$?") else rf"\b{keyword}\b"


def kind_of(text: Column, kinds: Mapping[str, Sequence[str]], otherwise: str) -> Column:
    """The first kind, as listed, one of whose keywords is found."""
    low = F.lower(text)
    out = F.lit(otherwise)
    for name, keywords in reversed(kinds.items()):
        out = F.when(X.any_match(low, tuple(keyword_pattern(k) for k in keywords)), name).otherwise(out)
    return out


def route(text: Column, kinds: Mapping[str, Sequence[str]], routes: Mapping[str, str], otherwise: str) -> Column:
    """Gates in order: size, secrets, follow-up; then the kind's route. An unclear kind goes to `otherwise`."""
    size = X.size_issue(text)
    out = F.lit(otherwise)
    kind = kind_of(text, kinds, "")
    for name, to in routes.items():
        out = F.when(kind == name, to).otherwise(out)
    return F.when(size == "empty", "reject").when(size == "oversized", "split").when(X.has_secret(text), "local").when(X.is_follow_up(text), "previous").otherwise(out)


def fallback(text: Column, chosen: Column, chains: Sequence[tuple[Sequence[str], Sequence[str]]], none: Sequence[str]) -> Column:
    """The chain of the first group one of whose words the text contains (a group without words is the last), without the chosen one."""
    low = F.lower(text)
    out = F.array().cast("array<string>")
    for words, chain in reversed(chains):
        own = F.array(*[F.lit(c) for c in chain])
        out = F.when(X.any_contained(low, tuple(words)), own).otherwise(out) if words else own
    return F.when(chosen.isin(*none), F.array().cast("array<string>")).otherwise(F.filter(out, lambda c: c != chosen))


def rejection(text: Column, least: int, most: int, prefixes: Sequence[str], needed: Column) -> Column:
    """The first reason to reject an output; null for none."""
    low = F.lower(F.trim(text))
    prefixed = F.lit(False)
    for p in prefixes:
        prefixed = prefixed | low.startswith(p)
    return F.when(F.length(F.trim(text)) < least, "too short").when(F.length(text) > most, "too long").when(prefixed, "error prefix").otherwise(needed)


def warnings(text: Column, most: int) -> Column:
    """What is suspicious in an output."""
    numbers = F.slice(F.regexp_extract_all(text, F.lit("[0-9]+"), F.lit(0)), 1, 20)
    large = F.exists(numbers, lambda n: F.coalesce(n.try_cast("decimal(38,0)") > 1_000_000, F.lit(False)))
    return F.array_compact(
        F.array(
            F.when(F.length(text) > most, "large"),
            F.when(text.rlike("(?i)ignore (all )?previous"), "injection"),
            F.when(text.rlike("(/etc/|[.]ssh|[.]env)"), "path"),
            F.when(large, "number"),
        )
    )
