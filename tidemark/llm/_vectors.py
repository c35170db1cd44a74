"""What the vector searches share: usable vectors, shards that stay in place, blocks of queries sent to them, and the merge of shard results."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ._shared import filesystem, path_of, written


def usable(table: DataFrame, id_col: str, vector_col: str, zero: bool) -> DataFrame:
    """A table (vec_id, v array<double>) of the vectors that take part.

    Null ids, null or empty vectors and those with null or non-finite components
    take no part; zero vectors only if asked for. Rows that repeat an id count
    once, with the smallest vector.
    """
    v = F.col(vector_col).cast("array<double>")
    rows = table.select(F.col(id_col).cast("bigint").alias("vec_id"), v.alias("v")).where("vec_id is not null and size(v) > 0")
    rows = rows.where(F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))))
    if not zero:
        rows = rows.where(F.exists("v", lambda x: x != 0))
    return written(rows.groupBy("vec_id").agg(F.min("v").alias("v")), "vectors")


def _matrices(batches: list) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(ids, vectors) by length of vector, from Arrow batches (vec_id, v); ids ascend."""
    by_length: dict[int, list] = {}
    for b in batches:
        v = b.column(1)
        ends = v.offsets.to_numpy()
        flat, sizes, ids = v.values.to_numpy(zero_copy_only=False), np.diff(ends), b.column(0).to_numpy()
        for n in np.unique(sizes):
            rows = np.flatnonzero(sizes == n)
            by_length.setdefault(int(n), []).append((ids[rows], flat[ends[rows][:, None] + np.arange(n)]))
    for n in sorted(by_length):
        ids, vectors = (np.concatenate(x) for x in zip(*by_length[n]))
        order = np.argsort(ids)
        yield ids[order], vectors[order]


def read_blocks(folder: str, rows: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(ids, vectors) of a table (vec_id, v) in the shared folder, about so many rows at a time."""
    import pyarrow.dataset as ds

    fs, path = filesystem(folder)
    held, count = [], 0
    for b in ds.dataset(path, filesystem=fs, format="parquet").to_batches(columns=["vec_id", "v"], batch_size=rows, batch_readahead=1, fragment_readahead=1):
        held.append(b)
        count += b.num_rows
        if count >= rows:
            yield from _matrices(held)
            held, count = [], 0
    yield from _matrices(held)


def searched(
    vectors: DataFrame,
    queries: DataFrame,
    k: int,
    shard_rows: int,
    block_rows: int,
    index: Callable[[np.ndarray, np.ndarray], dict],
    block: Callable[[np.ndarray, np.ndarray], dict],
    search: Callable[[dict, dict, int], Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]],
    score: str,
) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's k best of all shards.

    A shard is one task's: it is indexed where its rows arrive and stays there,
    while the queries, a table in the shared folder, pass by in blocks. So a vector
    is shuffled once, a query is read once a shard, and a task holds one shard's
    index and one block, whatever the size of either table. A lost task builds
    its index anew. search yields (query ids, vector ids, scores) arrays.
    """
    shards = max(1, math.ceil(vectors.count() / shard_rows))
    folder = path_of(written(queries.select("vec_id", "v"), "queries"))
    rows = vectors.select("vec_id", "v", F.pmod(F.xxhash64("vec_id", F.lit("shard")), F.lit(shards)).cast("int").alias("shard"))
    dealt = rows.repartitionById(shards, F.col("shard")).select("vec_id", "v")

    def run(batches):
        import pyarrow as pa

        kind = pa.float64() if score == "double" else pa.int64()
        indexes = {v.shape[1]: index(ids, v) for ids, v in _matrices(list(batches))}
        for ids, v in read_blocks(folder, block_rows) if indexes else ():
            if v.shape[1] in indexes:
                for q, c, s in search(indexes[v.shape[1]], block(ids, v), k):
                    yield pa.RecordBatch.from_arrays([pa.array(q, pa.int64()), pa.array(c, pa.int64()), pa.array(s, kind)], names=["query_id", "vec_id", "score"])

    found = dealt.mapInArrow(run, f"query_id bigint, vec_id bigint, score {score}")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def top(ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest scores, ties to the smaller id."""
    if len(scores) > k:
        least = np.partition(scores, len(scores) - k)[len(scores) - k]
        at = np.flatnonzero(scores >= least)
    else:
        at = np.arange(len(scores))
    return at[np.lexsort((ids[at], -scores[at]))][:k]
