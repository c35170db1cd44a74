"""Entities, themes and statuses of notes, by rules that the driver holds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.keywords import any_pattern, mentions
from ..functions.text import col

Rule = tuple[str, list[str]]


def scored(df: DataFrame, keep: list[str], title: str, body: str, rules: list[Rule], title_weight: int = 4) -> DataFrame:
    """(keep, name, title_hits, body_hits, score): one row per rule that a row mentions, by one pass over its text."""
    each = [F.struct(F.lit(name).alias("name"), mentions(title, words).alias("title_hits"), mentions(body, words).alias("body_hits")) for name, words in rules]
    rows = df.select(*keep, F.explode(F.array(*each)).alias("r")).select(*keep, "r.*")
    return rows.where("title_hits + body_hits > 0").withColumn("score", F.col("title_hits") * title_weight + F.col("body_hits"))


def dictionary_hits(df: DataFrame, key: str, text: str, dictionary: DataFrame, words: list[str], word: str = "word") -> DataFrame:
    """(key, the dictionary's columns, hits): the text is scanned once with one alternation, and what it finds joins the dictionary by equality."""
    found = df.select(key, F.explode(F.regexp_extract_all(F.lower(col(text)), F.lit(any_pattern(words)), F.lit(0))).alias(word))
    return found.groupBy(key, word).agg(F.count("*").alias("hits")).join(dictionary, word)


def rule_match(title: Column, excluded: list[str], standalone: list[str], regions: list[str], required: list[str]) -> tuple[Column, Column]:
    """(matched, rule): an excluded word vetoes; a standalone word is enough; else a region and a required word."""
    low = F.lower(title)

    def found(words: list[str]) -> Column:
        return F.filter(F.array(*map(F.lit, sorted(set(words)))), lambda w: F.contains(low, F.lower(w)))

    alone, both = found(standalone), F.array_sort(F.array_union(found(regions), found(required)))
    vetoed = F.size(found(excluded)) > 0
    paired = (F.size(found(regions)) > 0) & (F.size(found(required)) > 0)
    none = F.array().cast("array<string>")
    matched = F.when(vetoed, none).when(F.size(alone) > 0, alone).when(paired, both).otherwise(none)
    rule = F.when(vetoed, None).when(F.size(alone) > 0, "standalone").when(paired, "region_plus_topic")
    return matched, rule


def statuses(*conditions: tuple[Column, str], default: str) -> Column:
    """The names of the conditions that hold, in order; the default alone if none does."""
    own = F.array_compact(F.array(*(F.when(c, F.lit(n)) for c, n in conditions)))
    return F.when(F.size(own) == 0, F.array(F.lit(default))).otherwise(own)


def confidence(*present: Column) -> Column:
    """The share of the fields that are there, to two digits."""
    total = F.lit(0)
    for p in present:
        total = total + F.coalesce(p, F.lit(False)).cast("int")
    return F.bround(total / len(present), 2)
