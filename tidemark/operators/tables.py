"""Tables in the folder that the driver and all executors share, and connected components, which are built of them."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """URI of a new folder below spark.checkpoint.dir, in this application's own folder there.

    The setting is the cluster's. Where it is unset a temporary folder takes its
    place if the master is local, as in a test; on a cluster, whose machines
    don't share one, that is an error.
    """
    context = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not base:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="tidemark-"))
        base = context.getCheckpointDir()
    return f"{base.rstrip('/')}/tidemark-{context.applicationId}/{uuid.uuid4().hex}"


def written(df: DataFrame, name: str = "table") -> DataFrame:
    """df written once as Parquet in the shared folder and read again.

    This cuts the lineage, survives lost executors and gives later joins the
    real size of the table. path_of tells where it is; dropped deletes it, and
    delete_tables all that this application wrote.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.__dict__["_written_to"] = path
    for made in _made:
        made.append(out)
    return out


_made: list[list[DataFrame]] = []


@contextmanager
def scratch() -> Iterator[list[DataFrame]]:
    """Within it, every table of written also goes to the list that it gives: once a step's result is a table, dropped can delete those it was made of."""
    _made.append([])
    try:
        yield _made[-1]
    finally:
        _made.pop()


def path_of(table: DataFrame) -> str:
    """Where written put the table."""
    return table.__dict__["_written_to"]


def _delete(spark: SparkSession, path: str) -> None:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def dropped(*tables: DataFrame) -> None:
    """Deletes tables of written that nothing reads any more."""
    for t in tables:
        _delete(t.sparkSession, path_of(t).rsplit("/", 1)[0])


def delete_tables(spark: SparkSession) -> None:
    """Deletes everything that this application wrote to the shared folder; for its end, when no result is read any more."""
    _delete(spark, shared_dir(spark).rsplit("/", 1)[0])


def components(pairs: DataFrame, max_rounds: int = 50) -> DataFrame:
    """(node, label): the smallest node that each node of the pairs (a, b) reaches; nodes without a pair have no row.

    Alternates large-star and small-star steps until the edges no longer
    change; each round's edges are a table in the shared folder. Hubs are
    spread by the minimum's partial aggregation and by a join that can be split.
    """
    edges = written(pairs.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), "edges")

    def star(edges: DataFrame, large: bool) -> DataFrame:
        """Every node's neighbours (large: the larger ones, small: the smaller ones) move to its smallest neighbour."""
        near = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))) if large else edges
        least = written(near.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "least")
        moved = near.where("v > u") if large else near
        moved = moved.join(least, "u").select(F.col("v").alias("x"), "m")
        if not large:
            moved = moved.unionByName(least.select(F.col("u").alias("x"), "m"))
        out = written(moved.where("x <> m").select(F.greatest("x", "m").alias("u"), F.least("x", "m").alias("v")).distinct(), "edges")
        dropped(edges, least)
        return out

    def state(e: DataFrame):
        return e.agg(F.count("*"), F.expr("bit_xor(xxhash64(u, v))"), F.expr("bit_xor(xxhash64(v, u))")).first()

    seen = state(edges)
    for _ in range(max_rounds):
        if not seen[0]:
            break
        edges = star(star(edges, True), False)
        now = state(edges)
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError(f"the components didn't settle in {max_rounds} rounds")
    heads = edges.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("label")).unionByName(heads)
