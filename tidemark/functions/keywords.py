"""Keyword predicates and counts. Keywords with ASCII letters or digits need boundaries, others are plain substrings."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import col, search_text

_SPECIAL = re.compile(r"([\\.^$|?*+()\[\]{}\-])")


def escaped(word: str) -> str:
    return _SPECIAL.sub(r"\\\1", word)


def pattern(word: str) -> str:
    """A regular expression for the lower-cased keyword in lower-cased text.

    The word comes first and its boundaries are looked at behind it, so that the
    engine searches for a literal.
    """
    word = escaped(word.strip().lower())
    return rf"{word}(?<![a-z0-9]{word})(?![a-z0-9])" if re.search("[a-z0-9]", word) else word


def any_pattern(words: list[str]) -> str:
    """One alternation for a dictionary, so that the text is scanned once."""
    return "|".join(pattern(w) for w in sorted(set(words), key=lambda w: (-len(w), w)) if w.strip())


def contains(text: Column | str, word: str) -> Column:
    return F.lower(col(text)).rlike(pattern(word)) if word.strip() else F.lit(False)


def mentions(text: Column | str, words: list[str]) -> Column:
    """Non-overlapping mentions of each word, summed."""
    text, total = F.lower(col(text)), F.lit(0)
    for w in words:
        if w.strip():
            total = total + F.regexp_count(text, F.lit(pattern(w)))
    return total


def alias_mentions(text: Column | str, aliases: list[str], vetoes: dict[str, str] | None = None) -> Column:
    """As mentions, but an alias followed by one of its vetoed characters doesn't count."""
    text, total = F.lower(col(text)), F.lit(0)
    for a in aliases:
        if a.strip():
            followers = (vetoes or {}).get(a, "")
            total = total + F.regexp_count(text, F.lit(pattern(a) + (f"(?![{escaped(followers)}])" if followers else "")))
    return total


def distinct_hits(text: Column | str, words: list[str]) -> Column:
    """How many of the words occur."""
    total = F.lit(0)
    for w in words:
        total = total + contains(text, w).cast("int")
    return total


def first_index(text: Column | str, words: list[str]) -> Column:
    """Place (from 1) of the earliest word, null without any; case-insensitive."""
    text = F.lower(col(text))
    places = F.array(*(F.instr(text, w.lower()) for w in words if w))
    return F.array_min(F.filter(places, lambda i: i > 0))


def highlight(text: Column | str, terms: list[str], most: int = 2) -> Column:
    """Terms in brackets, the longest first, each at its first places up to `most`; terms with letters whatever the case."""
    text = col(text)
    for term in sorted(filter(None, terms), key=len, reverse=True):
        found = ("(?i)" if re.search("[A-Za-z]", term) else "") + escaped(term)
        places = F.regexp_count(text, F.lit(found))
        marked = text
        for n in range(1, most + 1):
            # The first n places, with what stands before each.
            before = "".join(f"${2 * i + 1}[${2 * i + 2}]" for i in range(n))
            marked = F.when(places >= n, F.regexp_replace(text, "^(?s)" + rf"(.*?)({found})" * n, before)).otherwise(marked)
        text = marked
    return text


# Units that make a number a key figure, in the order in which they are tried.
UNITS = "%|亿美元|亿元|万亿|GWh|GW|MW|美元|人民币|倍|bps|bp|页|个|家|万吨|美元/桶"
NUMBER = rf"\d+(?:\.\d+)?\s?(?:{UNITS})|\$\s?\d+(?:\.\d+)?\s?[BMK]?"


def key_numbers(text: Column | str, most: int = 12, around: int = 24) -> Column:
    """The first distinct snippets around figures with a unit or a currency sign, cleaned of markup."""
    text = col(text)
    place = rf"(?s)(?=[$0-9])(?<=(^.{{0,{around}}}|.{{{around}}}))({NUMBER})(?=(.{{0,{around}}}))"
    before, number, after = (F.regexp_extract_all(text, F.lit(place), F.lit(i)) for i in (1, 2, 3))
    whole = F.zip_with(F.zip_with(before, number, lambda a, b: F.concat(a, b)), after, lambda a, b: F.concat(a, b))
    return F.slice(F.array_distinct(F.filter(F.transform(whole, search_text), lambda x: x != "")), 1, most)


# Forms in which titles name a company: before a colon, before a ticker in brackets, before a signal word.
COMPANY = [
    "^([^:：]{2,40})[:：]",
    r"([A-Z][\w&.-]+(?: [A-Z][\w&.-]+){0,3})\s*[(（][A-Z0-9]{1,6}(?:\.[A-Z]{1,3})?[)）]",
    r"^([A-Z][\w&.-]+(?: [A-Z][\w&.-]+){0,2})\s+(?:initiates|upgrade|downgrade|earnings|results|outlook)",
]
#: Words that open a title and belong to no name.
OPENING = r"^(?i)(?:the|a|an|on|re|update|note)\s+"


def companies_in(title: Column | str) -> Column:
    """Names of companies that a title gives away, in the order of the forms, each once."""
    names = F.concat(*(F.regexp_extract_all(col(title), F.lit(p), F.lit(1)) for p in COMPANY))
    names = F.transform(names, lambda x: F.btrim(F.regexp_replace(x, OPENING, ""), F.lit(" .-")))
    return F.array_distinct(F.filter(names, lambda x: F.length(x).between(2, 40)))


# Fixed value: what a query's tokens are.
TOKEN = r"[A-Za-z][A-Za-z0-9.+-]*|\d+(?:\.\d+)?|[一-鿿]{2,}"


def query_tokens(query: str, grams: tuple[int, ...] = (3,), whole: bool = True, stop: tuple[str, ...] = (), least: int = 2) -> list[str]:
    """Words, numbers and runs of Han characters of a query; long runs give n-grams too (or instead)."""
    out: list[str] = []
    for token in re.findall(TOKEN, query):
        long_run = re.fullmatch(r"[一-鿿]{5,}", token)
        if whole or not long_run:
            out.append(token)
        if long_run:
            out += [token[i : i + n] for n in grams for i in range(len(token) - n + 1)]
    return list(dict.fromkeys(t for t in out if len(t) >= least and t not in stop and not any(s in t for s in stop if len(s) > 1)))
