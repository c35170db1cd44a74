"""Upserts, fills and appends as joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.identity import blank


def upsert(old: DataFrame, new: DataFrame, key: str, clearing: tuple[str, ...] = ()) -> DataFrame:
    """old with new's rows merged by key: values that aren't blank win, blank ones keep the old.

    Of the clearing columns a new value counts even if it is the empty string.
    """
    a, b = old.alias("a"), new.alias("b")
    out = [F.coalesce(F.col(f"a.{key}"), F.col(f"b.{key}")).alias(key)]
    for c in old.columns:
        if c == key:
            continue
        if c not in new.columns:
            out.append(F.col(f"a.{c}").alias(c))
        elif c in clearing:
            out.append(F.coalesce(F.col(f"b.{c}"), F.col(f"a.{c}")).alias(c))
        elif old.schema[c].dataType.simpleString() == "string":
            out.append(F.coalesce(blank(F.col(f"b.{c}")), F.col(f"a.{c}")).alias(c))
        else:
            out.append(F.coalesce(F.col(f"b.{c}"), F.col(f"a.{c}")).alias(c))
    return a.join(b, F.col(f"a.{key}") == F.col(f"b.{key}"), "full_outer").select(*out)


def overwrite(old: DataFrame, new: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """old with the columns of new's rows taken as they are, nulls included."""
    fresh = new.select(key, F.lit(True).alias("__new"), *(F.col(c).alias(f"__{c}") for c in columns))
    joined = old.join(fresh, key, "left")
    return joined.select(*(F.when(F.col("__new"), F.col(f"__{c}")).otherwise(F.col(c)).alias(c) if c in columns else F.col(c) for c in old.columns))


def changed_only(old: DataFrame, new: DataFrame, key: str, value: str) -> DataFrame:
    """new's rows that old doesn't hold with the same content."""
    seen = old.select(F.col(key).alias("__k"), F.sha2(F.col(value).cast("string"), 256).alias("__h"))
    return new.withColumn("content_hash", F.sha2(F.col(value).cast("string"), 256)).join(seen, (F.col(key) == F.col("__k")) & (F.col("content_hash") == F.col("__h")), "left_anti")


def moved(pending: DataFrame, known: DataFrame, acknowledged: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """(still pending, known): acknowledged keys leave pending for known; unknown ones get a row of the key alone."""
    still = pending.join(acknowledged.select(key).distinct(), key, "left_anti")
    gone = acknowledged.select(key).distinct().join(pending, key, "left")
    return still, known.join(gone.select(key), key, "left_anti").unionByName(gone.select(*known.columns))
