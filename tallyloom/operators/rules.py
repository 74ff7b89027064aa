"""Rules: classify a prompt, score rules, spread to linked ones, and the state that decays from day to day."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import patterns as P
from ..functions import scoring as S

RULE = "id string, name string, domains array<string>, tools array<string>, consequence double, links map<string,double>, reminder string, spike double, dormant boolean, ord int"


def keyword_hits(text: Column, words: Sequence[str]) -> Column:
    """How many of the words the text contains, in whatever case."""
    low = F.lower(text)
    return sum((F.when(low.contains(w), 1).otherwise(0) for w in words), F.lit(0))


def stem_hits(text: Column, words: Sequence[str]) -> Column:
    """How many of the words are a word of the text, begin one or are begun by one."""
    found = F.array_distinct(F.regexp_extract_all(F.lower(text), F.lit("[a-z][a-z_/-]+"), F.lit(0)))
    return sum((_any_stem(found, w) for w in words), F.lit(0))


def _any_stem(found: Column, word: str) -> Column:
    return F.when(F.exists(found, lambda x: x.startswith(word) | F.lit(word).startswith(x)), 1).otherwise(0)


def best(scores: Mapping[str, Column], otherwise: str) -> Column:
    """The name with the largest score above 0; the first listed of equal ones."""
    top = F.greatest(*scores.values()) if len(scores) > 1 else next(iter(scores.values()))
    out = F.lit(otherwise)
    for name, score in reversed(scores.items()):
        out = F.when((score == top) & (score > 0), name).otherwise(out)
    return out


def classified(text: Column, domains: Mapping[str, Sequence[str]], tools: Mapping[str, Sequence[str]]) -> tuple[Column, Column]:
    """domain and tool of a prompt."""
    return best({d: keyword_hits(text, w) for d, w in domains.items()}, "all"), best({t: stem_hits(text, w) for t, w in tools.items()}, "read")


def activated(prompts: DataFrame, rules: DataFrame, spread_once: bool = True) -> DataFrame:
    """prompt_id, id, score, place, spread: up to BUDGET rules at or above the threshold for each prompt.

    prompts: prompt_id, domain, tool. Rules are a configuration: prompts are first reduced to their distinct domains
    and tools, which are few, and only these meet the rules. Rules linked from activated ones fill the remaining
    places; a rule linked twice takes one place (or two, as it was once, with spread_once false).
    """
    kinds = prompts.select("domain", "tool").distinct()
    base = kinds.join(F.broadcast(rules))
    explicit, universal = F.array_contains("domains", F.col("domain")), F.array_contains("domains", "all")
    score = F.when(F.col("dormant"), 0.0).otherwise(S.rule_score(explicit, universal, F.col("consequence"), F.array_contains("tools", F.col("tool")), F.col("spike")))
    specific = F.when(explicit, 1).when(universal, 0).otherwise(-1)
    scored = base.select("domain", "tool", "id", "links", "dormant", "ord", score.alias("score"), specific.alias("specific"))
    w = Window.partitionBy("domain", "tool")
    first = scored.where(F.col("score") >= P.THRESHOLD).withColumn("place", F.row_number().over(w.orderBy(F.desc("score"), F.desc("specific"), "ord"))).where(F.col("place") <= P.BUDGET)
    linked = first.select("domain", "tool", F.col("place").alias("from_place"), F.explode("links").alias("id", "weight"))
    near = linked.join(first.select("domain", "tool", "id"), ["domain", "tool", "id"], "left_anti").join(scored.where("NOT dormant").select("domain", "tool", "id", "score", "ord"), ["domain", "tool", "id"])
    near = near.withColumn("score", F.col("score") + F.col("weight") * P.SPREAD).where(F.col("score") >= P.THRESHOLD)
    if spread_once:
        near = near.groupBy("domain", "tool", "id").agg(F.max("score").alias("score"), F.min("from_place").alias("from_place"), F.min("ord").alias("ord"))
    taken = first.groupBy("domain", "tool").agg(F.count("*").alias("taken"))
    near = near.withColumn("more", F.row_number().over(w.orderBy(F.desc("score"), "from_place", "ord"))).join(taken, ["domain", "tool"])
    near = near.where(F.col("more") + F.col("taken") <= P.BUDGET)
    both = first.select("domain", "tool", "id", "score", F.col("place").cast("long").alias("place"), F.lit(False).alias("spread")).unionByName(
        near.select("domain", "tool", "id", "score", (F.col("more") + F.col("taken")).cast("long").alias("place"), F.lit(True).alias("spread"))
    )
    return prompts.join(F.broadcast(both), ["domain", "tool"]).select("prompt_id", "id", "score", "place", "spread")


def co_activations(rows: DataFrame, prompt: Sequence[str], rule: str, excluded: Sequence[str] = ()) -> DataFrame:
    """a, b, together, either, ratio, merge for pairs a < b of rules of the same prompt.

    Pairs come from each prompt's sorted list of rules, which the budget bounds.
    """
    lists = rows.where(~F.col(rule).isin(*excluded) if excluded else F.lit(True)).groupBy(*prompt).agg(F.array_sort(F.collect_set(rule)).alias("ids"))
    each = lists.select(F.explode("ids").alias("id")).groupBy("id").agg(F.count("*").alias("n"))
    pairs = lists.select("ids", F.posexplode("ids").alias("p", "a")).select("a", F.explode(F.slice("ids", F.col("p") + 2, F.greatest(F.size("ids") - F.col("p") - 1, F.lit(0)))).alias("b"))
    both = pairs.groupBy("a", "b").agg(F.count("*").alias("together"))
    out = both.join(each.select(F.col("id").alias("a"), F.col("n").alias("na")), "a").join(each.select(F.col("id").alias("b"), F.col("n").alias("nb")), "b")
    either = F.col("na") + F.col("nb") - F.col("together")
    ratio = F.col("together") / either
    return out.select("a", "b", "together", either.alias("either"), F.round(ratio, 6).alias("ratio"), ((either >= P.MERGE_LEAST) & (ratio >= P.MERGE_RATIO)).alias("merge"))


def kept_pairs(pairs: DataFrame) -> DataFrame:
    """Beyond MOST_PAIRS, pairs that were seen seldom go, then all but the most frequent."""
    if pairs.limit(P.MOST_PAIRS + 1).count() <= P.MOST_PAIRS:
        return pairs
    return pairs.where(F.col("either") >= P.LEAST_EITHER).orderBy(F.desc("either"), "a", "b").limit(P.MOST_PAIRS)


STATE = "rule string, spike double, dormant boolean, idle_days long, activations long, reactivations long"


def folded(events: DataFrame) -> DataFrame:
    """STATE of each rule after its events in order: (rule, at, kind, source), kind being violation, activation, day or sleep.

    The state after an event depends on the one before, with limits at both ends, so each rule's events are folded one
    by one; rules are dealt out over tasks. `n` lets a caller give days without events as one row.
    """

    def fold(pdf: pd.DataFrame) -> pd.DataFrame:
        spike, dormant, idle, hits, woken = 0.0, False, 0, 0, 0
        for kind, source, n in pdf.sort_values("at")[["kind", "source", "n"]].itertuples(index=False):
            if kind == "violation" and dormant:
                dormant, spike, woken = False, P.IMMUNE_SPIKE, woken + 1
            elif kind == "violation":
                spike = min(spike + P.SPIKES.get(source, P.OTHER_SPIKE), P.SPIKE_CAP)
            elif kind == "activation":
                hits, idle = hits + 1, 0
            elif kind == "sleep":
                dormant = True
            else:
                days = min(int(n), P.MOST_DAYS)
                spike = max(0.0, spike - P.DECAY_PER_DAY * days)
                spike = 0.0 if spike <= 0.001 else spike
                idle += days
        return pd.DataFrame([(pdf["rule"].iloc[0], spike, dormant, idle, hits, woken)], columns=[c.split(" ")[0] for c in STATE.split(", ")])

    return events.groupBy("rule").applyInPandas(fold, STATE)


def candidates_for_sleep(state: DataFrame, pinned: Sequence[str] = ()) -> DataFrame:
    return state.where((F.col("idle_days") >= P.INACTIVE_DAYS) & ~F.col("dormant") & ~F.col("rule").isin(*pinned or [""])).select("rule", "idle_days")


def lifecycle(state: DataFrame) -> DataFrame:
    """One row: rules, active, dormant, spiked, candidates for sleep."""
    d = F.col("dormant")
    return state.agg(F.count("*").alias("total"), F.count_if(~d).alias("active"), F.count_if(d).alias("dormant"), F.count_if(~d & (F.col("spike") > 0)).alias("spiked"), F.count_if(~d & (F.col("idle_days") >= P.INACTIVE_DAYS)).alias("inactive"))


def problems(rules: DataFrame, domains: Sequence[str]) -> DataFrame:
    """id, problem: what is wrong with each rule: an unknown domain, a consequence out of range, a link to no rule."""
    found = F.array_compact(
        F.array(
            F.when(F.exists("domains", lambda d: ~d.isin(*domains, "all")), "unknown domain"),
            F.when(~F.col("consequence").between(0.1, 0.3), "consequence out of range"),
            F.when(F.size("domains") == 0, "no domain"),
        )
    )
    own = rules.select("id", F.explode(found).alias("problem"))
    links = rules.select("id", F.explode(F.map_keys("links")).alias("to")).join(rules.select(F.col("id").alias("to")), "to", "left_anti")
    return own.unionByName(links.select("id", F.concat(F.lit("unknown link "), "to").alias("problem")))
