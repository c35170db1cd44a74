"""Planned against actual: matches with preference, leftovers, coverage and invariants."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def prefer_exact(files: DataFrame, plan: DataFrame, exact: str, loose: str, order: str) -> DataFrame:
    """Each file with its plan row: one of the same exact name, else of the same loose key; the smallest order decides.

    Two equality joins, no OR; each side of the choice is reduced to a row per key first.
    """
    def best(key: str) -> DataFrame:
        rows = F.struct(*(plan[c] for c in plan.columns))
        return plan.groupBy(F.col(key).alias(f"__{key}")).agg(F.min_by(rows, F.col(order)).alias(f"__by_{key}"))

    joined = files.join(best(exact), F.col(exact) == F.col(f"__{exact}"), "left").join(best(loose), F.col(loose) == F.col(f"__{loose}"), "left")
    chosen = F.coalesce(f"__by_{exact}", f"__by_{loose}")
    how = F.when(F.col(f"__by_{exact}").isNotNull(), "exact").when(F.col(f"__by_{loose}").isNotNull(), "normalized")
    return joined.select(*files.columns, chosen.alias("plan"), how.alias("matched_by"))


def missing(expected: DataFrame, done: DataFrame, keys: list[str]) -> DataFrame:
    """Expected rows that no done row equals in any of the keys: an anti-join for each."""
    for k in keys:
        expected = expected.join(done.where(F.col(k).isNotNull()).select(F.col(k).alias("__k")).distinct(), F.col(k) == F.col("__k"), "left_anti")
    return expected


def coverage(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """(key, side, left_rows, right_rows): both sides' rows by key, ok where each has one."""
    a = left.groupBy(key).agg(F.count("*").alias("left_rows"))
    b = right.groupBy(key).agg(F.count("*").alias("right_rows"))
    both = a.join(b, key, "full_outer").fillna(0, ["left_rows", "right_rows"])
    side = F.when(F.col("right_rows") == 0, "missing").when(F.col("left_rows") == 0, "unexpected").when((F.col("left_rows") == 1) & (F.col("right_rows") == 1), "ok").otherwise("repeated")
    return both.select(key, side.alias("side"), "left_rows", "right_rows")


def violations(*rules: tuple[Column, str]) -> Column:
    """The codes of the rules that a row breaks."""
    return F.array_compact(F.array(*(F.when(broken, F.lit(code)) for broken, code in rules)))
