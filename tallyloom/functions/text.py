"""Text as columns: counting, cleaning, splitting and comparing, in built-in functions."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import patterns as P

SPACE = "[ \\t\\n\\f\\r]+"


def words(text: Column) -> Column:
    """Parts between white space."""
    return F.filter(F.split(text, SPACE), lambda w: w != "")


def word_count(text: Column) -> Column:
    return F.size(words(F.coalesce(text, F.lit("")))).cast("long")


def normalised(text: Column) -> Column:
    """Lower case, white space collapsed: what duplicates are compared by."""
    return F.trim(F.regexp_replace(F.lower(text), SPACE, " "))


def slug(title: Column, most: int = 50) -> Column:
    kept = F.regexp_replace(F.lower(F.trim(title)), "(?U)[^\\w\\s-]", "")
    return F.left(F.regexp_replace(kept, "[-\\s]+", "-"), F.lit(most))


def without_wiki_links(text: Column) -> Column:
    return F.regexp_replace(text, "\\[\\[(.*?)\\]\\]", "$1")


def without_front_matter(text: Column) -> Column:
    """What follows a leading `---` block; an unterminated block is kept."""
    return F.regexp_replace(text, "(?s)\\A---\\r?\\n.*?\\r?\\n---[ \\t]*(?:\\r?\\n|\\z)", "")


def body_words(text: Column) -> Column:
    """Words of the body, without front matter, images, links' targets and markup."""
    body = without_front_matter(text)
    for pattern, to in (("!\\[.*?\\]\\(.*?\\)", ""), ("\\[(.*?)\\]\\(.*?\\)", "$1"), ("(?m)^#{1,6}\\s+", ""), ("[*_`>|]", " ")):
        body = F.regexp_replace(body, pattern, to)
    return word_count(body)


def is_stub(text: Column, least: int = 150) -> Column:
    return F.length(F.trim(without_front_matter(text))) < least


def sentences(text: Column) -> Column:
    return F.filter(F.transform(F.split(text, f"(?<=[.!?]){SPACE}"), lambda s: F.trim(s)), lambda s: s != "")


def excerpt(text: Column, lines: int = 8) -> Column:
    """The first lines of the body, without images and links' targets."""
    body = F.regexp_replace(F.regexp_replace(without_front_matter(text), "!\\[.*?\\]\\(.*?\\)", ""), "\\[(.*?)\\]\\(.*?\\)", "$1")
    return F.array_join(F.slice(F.split(F.regexp_replace(body, "\\n{3,}", "\n\n"), "\n"), 1, lines), "\n")


def tokens_estimate(text: Column) -> Column:
    return F.greatest(F.lit(1), (F.length(text) / 3.8).cast("int")).cast("long")


def bytes_estimate(text: Column) -> Column:
    return F.floor(F.octet_length(text) / 4).cast("long")


def any_match(text: Column, found: tuple[str, ...]) -> Column:
    return reduce(lambda a, b: a | b, [text.rlike(p) for p in found])


def any_contained(text: Column, terms: tuple[str, ...]) -> Column:
    return F.exists(F.array(*[F.lit(t) for t in terms]), lambda t: text.contains(t))


def has_secret(text: Column) -> Column:
    return any_match(text, P.SECRETS)


def is_follow_up(text: Column) -> Column:
    return any_match(text, P.FOLLOW_UPS)


def size_issue(text: Column, most: int = 500_000) -> Column:
    return F.when(text.isNull() | (F.trim(text) == ""), "empty").when(F.length(text) > most, "oversized")


def confidence(text: Column, hedges=P.HEDGES, refusals=P.REFUSALS) -> Column:
    low = F.lower(text)
    lost = sum((F.when(low.contains(w), 20).otherwise(0) for w in hedges), F.lit(0)) + sum((F.when(low.contains(w), 30).otherwise(0) for w in refusals), F.lit(0))
    return F.greatest(F.lit(0), 100 - lost).cast("long")


def masked_code(text: Column) -> Column:
    """text with code blocks, fenced or indented, replaced by a word."""
    fenced = F.when(text.contains("```"), F.regexp_replace(text, "```[\\s\\S]*?```", "```CODE_BLOCK```")).otherwise(text)
    return F.when(text.contains("    ") | text.contains("\t"), F.regexp_replace(fenced, "(?m)(?:^(?:    |\\t).+\\n){2,}", "INDENTED_CODE_BLOCK\n")).otherwise(fenced)


def category_hits(scan: Column, low: Column, categories: dict = P.CONTAMINATION, needs: dict = P.CONTAMINATION_NEEDS) -> dict[str, Column]:
    """Matches by category in scan, a text whose code is masked; low is scan in lower case. A pattern runs where one of the literals that it needs stands."""

    def matches(pattern: str, literals: Sequence[str]) -> Column:
        n = F.regexp_count(scan, F.lit(pattern))
        return F.when(reduce(or_, [low.contains(x) for x in literals]), n).otherwise(F.lit(0)) if literals else n

    def of(name: str) -> Column:
        found = categories[name]
        literals = needs.get(name, ())
        return sum((matches(p, literals[i] if i < len(literals) else ()) for i, p in enumerate(found)), F.lit(0)).cast("long")

    return {name: of(name) for name in categories}


def decontaminated(text: Column, categories: dict = P.CONTAMINATION, needs: dict | None = None) -> Column:
    """text without the patterns that occur outside code (they then go inside code, too); unchanged if it is blocked.

    A pattern runs where one of the literals that it needs stands, and goes from texts in which it was found. needs: these
    literals, as in P.CONTAMINATION_NEEDS, which holds those of P.CONTAMINATION.
    """
    needs = needs if needs is not None else P.CONTAMINATION_NEEDS if categories is P.CONTAMINATION else {}
    given = [(name, p, needs[name][i] if i < len(needs.get(name, ())) else ()) for name, found in categories.items() for i, p in enumerate(found)]

    def found_in(scan: Column) -> Column:
        def of(low: Column) -> Column:
            may = lambda literals: reduce(or_, [low.contains(x) for x in literals], F.lit(not literals))
            return F.array_compact(F.array(*[F.when(may(literals) & scan.rlike(p), F.struct(F.lit(name).alias("name"), F.lit(p).alias("p"))) for name, p, literals in given]))

        return once(F.lower(scan), of)

    def without(found: Column) -> Column:
        cut = F.aggregate(found, text, lambda t, x: F.regexp_replace(t, x["p"], F.lit("")))
        return F.when(F.size(F.array_distinct(F.transform(found, lambda x: x["name"]))) >= P.BLOCK_CATEGORIES, text).otherwise(F.regexp_replace(cut, "\\n{3,}", "\n\n"))

    return once(once(masked_code(text), found_in), without)


def cleaned_response(text: Column) -> Column:
    """Without headings' marks, bold, italic, rules and bullets."""
    out = text
    for pattern, to in (("(?m)^#{1,6}\\s+", ""), ("\\*\\*(.+?)\\*\\*", "$1"), ("(?<!\\*)\\*(?!\\*)(.+?)(?<!\\*)\\*(?!\\*)", "$1"), ("(?m)^[-*_]{3,}\\s*$", ""), ("(?m)^\\s*[-*]\\s+", ""), ("\\n{3,}", "\n\n")):
        out = F.regexp_replace(out, pattern, to)
    return F.trim(out)


def without_fences(text: Column) -> Column:
    return F.trim(F.regexp_replace(F.regexp_replace(text, "\\A\\s*```[a-zA-Z]*\\n", ""), "\\n```\\s*\\z", ""))


def concept_tokens(text: Column, stop: tuple[str, ...]) -> Column:
    """Phrases of two or three words of four letters and more, then single words of five letters and more; none with a stop word."""
    low = text
    for pattern, to in (("\\[\\[(.*?)\\]\\]", "$1"), ("https?://\\S+", ""), ("!\\[.*?\\]\\(.*?\\)", ""), ("\\[.*?\\]\\(.*?\\)", "")):
        low = F.regexp_replace(low, pattern, to)
    low = F.lower(low)
    stops = F.array(*[F.lit(s) for s in stop]).cast("array<string>")
    phrases = F.filter(F.regexp_extract_all(low, F.lit("\\b([a-z]{4,}(?:\\s+[a-z]{4,}){1,2})\\b"), F.lit(1)), lambda p: ~F.arrays_overlap(F.split(p, "\\s+"), stops))
    singles = F.filter(F.regexp_extract_all(low, F.lit("\\b[a-z]{5,}\\b"), F.lit(0)), lambda w: ~F.array_contains(stops, w))
    return F.concat(phrases, singles)


def once(value: Column, f: Callable[[Column], Column]) -> Column:
    """f of a value that is computed once, however often f uses it."""
    return F.transform(F.array(value), f)[0]


def tallied(words: Column) -> Column:
    """(word, n) of the distinct words of an array column, in the words' order."""
    return once(F.sort_array(words), _tallied)


def _tallied(words: Column) -> Column:
    size = F.size(words)
    found = F.filter(F.sequence(F.lit(0), F.greatest(size - 1, F.lit(0))), lambda i: (i < size) & ((i == 0) | (F.get(words, i) != F.get(words, i - 1))))
    run = lambda starts: lambda i, k: F.struct(F.get(words, i).alias("word"), (F.coalesce(F.get(starts, k + 1), size) - i).cast("long").alias("n"))
    return once(found, lambda starts: F.transform(starts, run(starts)))


def ngrams(tokens: Column, n: int) -> Column:
    """Runs of n tokens, as strings."""
    last = F.size(tokens) - n
    return F.when(last >= 0, F.transform(F.sequence(F.lit(0), last), lambda i: F.array_join(F.slice(tokens, i + 1, F.lit(n)), " "))).otherwise(F.array().cast("array<string>"))


def overlap_precision(a: Column, b: Column, n: int) -> Column:
    """Share of a's n-grams that b has, each counted at most as often as b has it; null if a or b has none."""
    ga, gb = ngrams(a, n), ngrams(b, n)
    count = lambda x, g: F.size(F.filter(x, lambda y: y == g))
    matches = F.aggregate(F.transform(F.array_distinct(ga), lambda g: F.least(count(ga, g), count(gb, g))), F.lit(0), lambda acc, v: acc + v)
    return F.when((F.size(ga) > 0) & (F.size(gb) > 0), matches / F.size(ga))


def self_bleu(a: Column, b: Column, most: int = 4) -> Column:
    """Geometric mean of the precisions up to the first n without n-grams; precisions below 1e-10 count as that."""
    found = F.filter(F.array(*[overlap_precision(a, b, n) for n in range(1, most + 1)]), lambda p: p.isNotNull())
    logs = F.transform(found, lambda p: F.log(F.greatest(p, F.lit(1e-10))))
    return F.when(F.size(found) == 0, 0.0).otherwise(F.exp(F.aggregate(logs, F.lit(0.0), lambda acc, v: acc + v) / F.size(found)))


def jaccard(a: Column, b: Column) -> Column:
    union = F.size(F.array_union(a, b))
    return F.when(union == 0, 0.0).otherwise(F.size(F.array_intersect(a, b)) / union)


def snippets(text: Column, term: str, most: int = 5) -> Column:
    return F.slice(F.regexp_extract_all(text, F.lit(f".{{0,50}}{term}.{{0,50}}"), F.lit(0)), 1, most)


def numbers_with_units(text: Column) -> Column:
    units = ("tokens?", "messages?", "requests?", "minutes?", "hours?", "%")
    return F.concat(*[F.regexp_extract_all(text, F.lit(f"(?i)\\d[\\d,.]*\\s*{u}"), F.lit(0)) for u in units])


def safe_name(title: Column, url: Column) -> Column:
    return F.concat_ws("-", F.left(F.regexp_replace(F.regexp_replace(title, "(?U)[^\\w\\s-]", ""), "[-\\s]+", "-"), F.lit(60)), F.left(F.md5(url), F.lit(8)))


def short_hash(text: Column) -> Column:
    return F.left(F.sha2(text, 256), F.lit(16))
