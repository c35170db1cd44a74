"""BM25 recall on substring statistics, composite score, snippets and rerank."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.keywords import contains, escaped, first_index, mentions
from ..functions.text import col, search_text


def in_blocks(queries: DataFrame, key: str, size: int) -> DataFrame:
    """A table (block: array of at most about `size` structs): the rows of a set of queries, dealt out by a hash of the key.

    Joined to a table without a condition, each of its rows meets a block and not
    a query, so the rows of the product grow with queries / size only.
    """
    blocks = max(1, -(-queries.count() // size))
    at = F.pmod(F.xxhash64(key), F.lit(blocks))
    return queries.groupBy(at.alias("__at")).agg(F.collect_list(F.struct(*queries.columns)).alias("block")).select("block")


def document_length(columns: list[str]) -> Column:
    """Trigrams of all indexed columns."""
    total = F.lit(0)
    for c in columns:
        total = total + F.greatest(F.length(F.coalesce(col(c), F.lit(""))) - 2, F.lit(0))
    return total


def frequency(columns: list[str], term: str) -> Column:
    """Overlapping occurrences of the term in all columns, whatever the case."""
    total = F.lit(0)
    for c in columns:
        total = total + F.regexp_count(F.lower(F.coalesce(col(c), F.lit(""))), F.lit(f"(?={escaped(term.lower())})"))
    return total


def bm25(docs: DataFrame, key: str, columns: list[str], terms: list[str], require_all: bool = True, k1: float = 1.2, b: float = 0.75) -> DataFrame:
    """(key, bm25): documents that hold the terms (all, or any), the best have the least score.

    Terms under three characters match nothing. One pass counts documents,
    lengths and document frequencies; a second scores. Only those few sums pass
    between them, as a scalar subquery's one row.
    """
    terms = [t for t in terms if len(t) >= 3]
    if not terms:
        return docs.select(key, F.lit(0.0).alias("bm25")).where(F.lit(False))
    tf = docs.select(F.col(key), document_length(columns).alias("__len"), *(frequency(columns, t).alias(f"__f{i}") for i, t in enumerate(terms)))
    sums = tf.agg(F.count("*").alias("__n"), F.avg("__len").alias("__avg"), *(F.count_if(F.col(f"__f{i}") > 0).alias(f"__d{i}") for i in range(len(terms))))
    hits = [F.col(f"__f{i}") > 0 for i in range(len(terms))]
    found = hits[0]
    for h in hits[1:]:
        found = found & h if require_all else found | h
    score = F.lit(0.0)
    for i in range(len(terms)):
        f, d = F.col(f"__f{i}"), F.col(f"__d{i}")
        raw = F.log((F.col("__n") - d + 0.5) / (d + 0.5))
        idf = F.when(raw <= 0, 1e-6).otherwise(raw)
        score = score - idf * f * (k1 + 1) / (f + k1 * (1 - b + b * F.col("__len") / F.col("__avg")))
    # sums is one row: this adds columns, it doesn't multiply rows.
    return tf.where(found).join(F.broadcast(sums)).select(key, score.alias("bm25"))


def recall(docs: DataFrame, key: str, columns: list[str], primary: list[str], fallback: list[str], limit: int) -> DataFrame:
    """(key, source, bm25): the best of all terms, then those of any fallback term that are new, each up to the limit."""
    first = bm25(docs, key, columns, primary).orderBy("bm25", key).limit(limit).withColumn("source", F.lit(0))
    then = bm25(docs, key, columns, fallback, require_all=False).orderBy("bm25", key).limit(limit).withColumn("source", F.lit(1))
    both = first.unionByName(then)
    return both.groupBy(key).agg(F.min(F.struct("source", "bm25")).alias("__b")).select(key, "__b.source", "__b.bm25")


# The weights and limits of the three scores below.
def composite_score(title: str, body: str, tags: str, position: Column, recency: Column, terms: list[str], focus: str | None, query: str) -> Column:
    """Position up to 18, recency (a column), focus 35/18/8 or tag mentions up to 20, title up to 30, body up to 24, whole query in the title 14."""
    score = F.greatest(F.lit(0.0), F.lit(18.0) - position * 0.3) + recency
    if focus:
        for c, weight in ((tags, 35.0), (title, 18.0), (body, 8.0)):
            score = score + F.when(contains(c, focus), weight).otherwise(0.0)
    else:
        score = score + F.least(F.lit(20.0), mentions(tags, terms) * 6.0)
    score = score + F.least(F.lit(30.0), mentions(title, terms) * 5.0) + F.least(F.lit(24.0), mentions(body, terms) * 1.2)
    return score + (F.when(contains(title, query), 14.0).otherwise(0.0) if query.strip() else F.lit(0.0))


def recency(day: Column, least: Column, most: Column, weight: float = 18.0) -> Column:
    """Share of the span of days; half the weight for a date without a span, 0 without a date."""
    return F.when(day.isNull(), 0.0).when(most > least, weight * (day - least) / (most - least)).otherwise(weight / 2)


def snippet(fields: list[str], terms: list[str], width: int = 180) -> Column:
    """Of the first field with a term a window that begins a third before the earliest; else the start of the first field."""
    options = []
    for f in fields:
        at = first_index(f, terms) - 1
        start = F.greatest(F.lit(0), at - width // 3)
        options.append(F.when(at.isNotNull(), F.trim(F.substring(col(f), start + 1, F.lit(width)))))
    return F.coalesce(*options, *(F.trim(F.substring(col(f), 1, width)) for f in fields))


def rerank_score(weighted: list[tuple[int, str]], terms: list[str], focus: list[tuple[int, str]] = (), focus_terms: list[str] = (), all_bonus: int = 10) -> Column:
    """Weights of the parts by term they hold, a bonus if all terms occur, and focus mentions by part."""
    total = F.lit(0)
    present = []
    for t in sorted(terms):
        any_part = F.lit(False)
        for w, c in weighted:
            has = F.contains(F.lower(col(c)), F.lit(t.lower()))
            total = total + F.when(has, w).otherwise(0)
            any_part = any_part | has
        present.append(any_part)
    every = F.lit(bool(present))
    for p in present:
        every = every & p
    total = total + F.when(every, all_bonus).otherwise(0)
    for w, c in focus:
        for t in focus_terms:
            total = total + F.when(contains(c, t), w).otherwise(0)
    return total


# The columns that a search looks through, in the index's order.
INDEXED = ["title", "broker", "companies", "themes", "subthemes", "core_conclusions", "core_questions_answers", "summary_text"]


def index_rows(reports: DataFrame, key: str, keep: list[str] = ()) -> DataFrame:
    """(key, the indexed columns, the columns to keep, doc_len): texts cleaned of markup, lists joined by spaces, missing columns empty; doc_len counts trigrams."""
    out = []
    for c in INDEXED:
        if c not in reports.columns:
            value = F.lit("")
        elif reports.schema[c].dataType.simpleString().startswith("array"):
            value = F.array_join(F.coalesce(F.col(c), F.array().cast("array<string>")), " ")
        else:
            value = search_text(F.coalesce(F.col(c).cast("string"), F.lit("")))
        out.append(value.alias(c))
    rows = reports.select(key, *out, *keep)
    return rows.withColumn("doc_len", document_length(INDEXED))


def rebuild_index(reports: DataFrame, key: str, path: str, keep: list[str] = ()) -> int:
    """Replaces the index at the path, a Parquet table that later searches read instead of the notes; returns its rows."""
    index_rows(reports, key, keep).write.mode("overwrite").parquet(path)
    return reports.sparkSession.read.parquet(path).count()


def parsed(query: str) -> tuple[list[str], bool] | None:
    """(terms, whether all must occur) of a query of words and quoted phrases, joined by AND (or nothing) or by OR throughout; None if it is malformed."""
    tokens, rest = [], query.strip()
    while rest:
        m = re.match(r'"((?:[^"]|"")*)"|([^\s"():*^]+)', rest)
        if not m:
            return None
        tokens.append((m[1].replace('""', '"'), False) if m[1] is not None else (m[2], m[2] in ("AND", "OR", "NOT")))
        rest = rest[m.end() :].lstrip()
    operators = {t for t, is_operator in tokens if is_operator}
    turns = [is_operator for _, is_operator in tokens]
    ends_badly = not tokens or turns[0] or turns[-1] or any(a and b for a, b in zip(turns, turns[1:]))
    if ends_badly or "NOT" in operators or len(operators) > 1:
        return None
    return [t for t, is_operator in tokens if not is_operator], "OR" not in operators


def matched(docs: DataFrame, key: str, columns: list[str], query: str) -> DataFrame:
    """bm25 of a written query; a malformed one finds nothing and is no error."""
    terms = parsed(query)
    if terms is None:
        return docs.select(key, F.lit(0.0).alias("bm25")).where(F.lit(False))
    return bm25(docs, key, columns, terms[0], terms[1])
