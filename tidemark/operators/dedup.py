"""First, newest, best and latest rows by key; identity components."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import col
from .tables import components, written


def one_per_key(df: DataFrame, keys: list[str], *order: Column) -> DataFrame:
    """The first row of each key in that order, which must be total for a defined result.

    An aggregate and no window: partial aggregation keeps one row per key and
    task before the shuffle, so a key of any weight costs its task no more.
    """
    rows = F.struct(*(df[c] for c in df.columns))
    kept = df.groupBy(*keys).agg(F.min_by(rows, F.struct(*order)).alias("__row"))
    return kept.select("__row.*")


def first_wins(first: DataFrame, then: DataFrame, key: str) -> DataFrame:
    """Union; of equal keys the row of the first frame, within a frame that of the smallest seq."""
    both = first.withColumn("__from", F.lit(0)).unionByName(then.withColumn("__from", F.lit(1)))
    return one_per_key(both, [key], F.col("__from"), F.col("seq")).drop("__from")


def arg_max(df: DataFrame, keys: list[str], *rank: Column, names: list[str]) -> DataFrame:
    """Of each key the named columns of the row with the largest rank."""
    best = F.max_by(F.struct(*names), F.struct(*rank)).alias("__best")
    return df.groupBy(*keys).agg(best).select(*keys, "__best.*")


def top_per_key(df: DataFrame, keys: list[str], k: int, *order: Column) -> DataFrame:
    """The first k rows of each key; Spark cuts each task's rows to k per key before the shuffle."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def numbered(df: DataFrame, order: str, name: str = "seq") -> DataFrame:
    """df with consecutive numbers from 1 in the order of a column, without one task for all rows.

    Rows are sorted over partitions by range; a count by partition, bounded by
    the number of partitions, gives each its first number.
    """
    spark = df.sparkSession
    rows = written(df.repartitionByRange(order).sortWithinPartitions(order).withColumn("__part", F.spark_partition_id()).withColumn("__id", F.monotonically_increasing_id()))
    counts = {r["__part"]: r["count"] for r in rows.groupBy("__part").count().collect()}
    total, firsts = 0, []
    for p in sorted(counts):
        firsts.append((p, total))
        total += counts[p]
    bases = spark.createDataFrame(firsts or [(0, 0)], "__part int, __first bigint")
    at = F.col("__id") - F.shiftleft(F.col("__part").cast("bigint"), 33)
    return rows.join(F.broadcast(bases), "__part").withColumn(name, F.col("__first") + at + 1).drop("__part", "__id", "__first")


def identity_components(df: DataFrame, node: str, keys: list[str]) -> DataFrame:
    """(node, component): nodes that share any non-null key, transitively; the component is its smallest node.

    Every key's nodes are linked to its smallest node, an aggregate that
    combines before the shuffle; the links' components are the answer.
    """
    own = F.explode(F.array_compact(F.array(*(F.concat(F.lit(f"{k}:"), col(k).cast("string")) for k in keys))))
    held = written(df.select(F.col(node).alias("node"), own.alias("key")).distinct(), "keys")
    least = held.groupBy("key").agg(F.min("node").alias("least"))
    pairs = held.join(least, "key").where("node <> least").select(F.col("node").alias("a"), F.col("least").alias("b"))
    linked = written(components(pairs), "components")
    nodes = df.select(F.col(node).alias("node")).distinct()
    return nodes.join(linked, "node", "left").select("node", F.coalesce("label", "node").alias("component"))
