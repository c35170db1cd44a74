"""The registry of queries, and frames that several of them begin with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None):
    """Registers a function under its name, with the SQL that gives the same rows."""

    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _literal(v) -> str:
    if v is None:
        return "NULL"
    if isinstance(v, str):
        assert "'" not in v and "\\" not in v
        return f"'{v}'"
    return str(v).lower() if isinstance(v, bool) else str(v)


def values(columns: str, rows: list[tuple]) -> str:
    """A constant table that both SQL dialects read."""
    body = ", ".join("(" + ", ".join(map(_literal, r)) + ")" for r in rows)
    return f"(VALUES {body}) AS t({columns})"


def inline(spark: SparkSession, columns: str, rows: list[tuple]) -> DataFrame:
    """The same table as a local relation: its size is known, so joins with it broadcast it."""
    return spark.sql(f"SELECT * FROM {values(columns, rows)}")


def notes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents as notes: with a title (the first line), a report date and a content hash."""
    day = F.date_format(F.date_add(F.lit("2024-01-01").cast("date"), (F.col("doc_id") % 365).cast("int")), "yyyy-MM-dd")
    return table(spark, sf_dir, "documents").select(
        "doc_id", "text", "lang", "source", "n_chars",
        F.substring_index("text", "\n", 1).alias("title"), day.alias("report_date"), F.sha2("text", 256).alias("sha"),
    )


NOTES = """notes AS (
    SELECT doc_id, text, lang, source, n_chars, split_part(text, chr(10), 1) AS title,
           strftime(DATE '2024-01-01' + CAST(doc_id % 365 AS INTEGER), '%Y-%m-%d') AS report_date, sha256(text) AS sha
    FROM documents)"""


def sql_strip(x: str) -> str:
    return f"regexp_replace({x}, '^\\s+|\\s+$', '', 'g')"


def sql_lines(x: str) -> str:
    return f"list_filter(list_transform(str_split({sql_strip(x)}, chr(10)), lambda l: {sql_strip('l')}), lambda l: l <> '')"


def sql_mentions(text: str, word: str) -> str:
    """Mentions of an ASCII word with boundaries: RE2 has no lookaround, so separators are doubled first."""
    w = word.lower()
    doubled = f"regexp_replace(lower({text}), '([^a-z0-9])', '\\1\\1', 'g')"
    return f"len(regexp_extract_all({doubled}, '(^|[^a-z0-9]){w}($|[^a-z0-9])'))"
