"""What SQL can't express, over whole tables, against other ways to say the same."""

import html as entities
import re
from pathlib import Path

import pytest

from tallyloom import catalogue
from tallyloom.operators import texts

DIR = "/root/testdata/sf0.01"
pytestmark = pytest.mark.skipif(not Path(DIR).exists(), reason="no test tables")


def measured(base):
    """How many runs of vowels a consonant follows."""
    return len(re.sub("[aeiou]+$", "", re.sub("^[^aeiou]+", "", re.sub("([aeiou])[aeiou]*", r"\1", re.sub("([^aeiou])[^aeiou]*", r"\1", base))))) // 2


def plain_stem(word):
    """The rules one after the other, each as a pattern over the whole word."""
    if len(word) < 3:
        return word
    if m := re.fullmatch("(.*)(?:sses|ies)", word):
        word = m[1] + ("ss" if word.endswith("sses") else "i")
    elif re.fullmatch(".*..[^s]s", word):
        word = word[:-1]
    if word.endswith("eed"):
        word = word[:-1] if measured(word[:-3]) else word
    elif (m := re.fullmatch("(.*?)(?:ed|ing)", word)) and (re.search("[aeiou]", m[1]) or re.search("[^aeiou]y", m[1])):
        base = m[1]
        if re.fullmatch(".*(?:at|bl|iz)", base):
            base += "e"
        elif re.fullmatch(r".*([^aeioulsz])\1", base):
            base = base[:-1]
        elif measured(base) == 1 and re.fullmatch(".*[^aeiou][aeiou][^aeiouwxy]", base):
            base += "e"
        word = base
    if re.fullmatch("..+y", word) and (re.search("[aeiou]", word[:-1]) or re.search("[^aeiou]y", word[:-1])):
        word = word[:-1] + "i"
    for endings in (texts.SECOND, texts.THIRD):
        m = re.fullmatch("(.*?)(" + "|".join(sorted(endings, key=len, reverse=True)) + ")", word)
        if m and measured(m[1]):
            word = m[1] + endings[m[2]]
    return word


def test_stems_of_all_words(spark):
    words = {w for r in spark.read.parquet(f"{DIR}/documents.parquet").select("text").collect() for w in re.findall("[a-z]{3,}", (r["text"] or "").lower())}
    got = {r["term"]: r["stem"] for r in catalogue.QUERIES["stem_terms"](spark, DIR).collect()}
    assert got.keys() == words and len(words) > 10_000
    assert [(w, s, plain_stem(w)) for w, s in got.items() if s != plain_stem(w)] == []


def plain_markdown(page):
    """Content as Markdown, by patterns over the whole page."""
    for tag in ("article", "main", "body"):
        if m := re.search(rf"(?is)<{tag}\b[^>]*>(.*)</{tag}>", page):
            page = m[1]
            break
    page = re.sub(r"(?is)<(script|style|nav|header|footer|aside|noscript|template)\b.*?</\1>|<!--.*?-->|<!DOCTYPE[^>]*>", "", page)
    page = re.sub(r"\s+", " ", page)
    page = re.sub(r'<a href="([^"]+)"[^>]*>(.*?)</a>', r"[\2](\1)", page)
    page = re.sub("<h([1-6])[^>]*>", lambda m: "\n\n" + "#" * int(m[1]) + " ", page)
    page = re.sub("</h[1-6]>", "\n\n", re.sub("<li[^>]*>", "\n- ", page))
    page = re.sub(r"</?(?:p|div|article|section|br|ul|ol|table|tr|blockquote)\b[^>]*>", "\n\n", page)
    page = re.sub(r"\s+(?=\n)|(?<=\n) +", lambda m: "\n" * m[0].count("\n"), entities.unescape(re.sub("<[^>]+>", "", page)))
    return re.sub("\n{3,}", "\n\n", re.sub(r"[ \t]*\n[ \t]*", "\n", page)).strip()


def test_markdown_of_all_pages(spark):
    pages = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{DIR}/pages.parquet").collect()}
    got = {r["page_id"]: (r["markdown"], r["words"]) for r in catalogue.QUERIES["html_to_markdown"](spark, DIR).collect()}
    assert got.keys() == pages.keys() and len(got) == 250
    wrong = [(i, m, plain_markdown(pages[i])) for i, (m, _) in got.items() if m != plain_markdown(pages[i])]
    assert not wrong, (len(wrong), wrong[0])
    assert all(n == len(m.split()) for m, n in got.values())
