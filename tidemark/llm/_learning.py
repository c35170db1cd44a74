"""Bounded samples of labelled rows, drawn alike at every size."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._shared import written

SLICES = 1 << 30


def sampled_labels(labels: DataFrame, label: str, fold: int, left_out: int, most: int, by_class: bool = True, id_col: str = "doc_id") -> DataFrame:
    """(id, label): labels for learning, of which crc32(id as text) mod fold isn't left_out.

    Of each class (or of all labels) about `most` are taken at most, by a hash
    of the id, so the sample is bounded whatever the number of labels. Null
    labels and ids are skipped; of an id's several labels the largest counts.
    """
    own = labels.where(F.col(id_col).isNotNull() & F.col(label).isNotNull())
    own = own.where(F.crc32(F.col(id_col).cast("string")) % fold != left_out)
    own = own.groupBy(id_col).agg(F.max(F.col(label).cast("int")).alias("label"))
    counts = {r["label"]: r["count"] for r in own.groupBy("label").count().collect()}
    total = sum(counts.values())
    share = {k: min(1.0, most / (v if by_class else total)) for k, v in counts.items()}
    limit = F.lit(0)
    for k, v in share.items():
        limit = F.when(F.col("label") == k, int(v * SLICES)).otherwise(limit)
    return own.where(F.pmod(F.xxhash64(F.col(id_col), F.lit("sample")), F.lit(SLICES)) < limit)


def labelled(docs: DataFrame, sample: DataFrame, text_col: str = "text", id_col: str = "doc_id", max_bytes: int | None = None) -> DataFrame:
    """(text, label) of the sampled documents; the sample is bounded, so each executor gets all of it.

    With max_bytes, of texts that are larger together a share by a hash is left
    that has about that size: long documents don't widen the bound.
    """
    few = F.broadcast(sample.select(F.col(id_col).alias("__id"), F.col("label").alias("__label")))
    got = docs.select(F.col(id_col).alias("__doc"), F.col(text_col).cast("string").alias("text"))
    got = got.join(few, F.col("__doc") == F.col("__id")).select("__id", "text", F.col("__label").alias("label"))
    if max_bytes is None:
        return got.drop("__id")
    got = written(got, "labelled")
    total = got.agg(F.coalesce(F.sum(F.octet_length("text").cast("long")), F.lit(0))).first()[0]
    return got.where(F.pmod(F.xxhash64("__id", F.lit("bytes")), F.lit(SLICES)) < int(min(1.0, max_bytes / max(total, 1)) * SLICES)).drop("__id")
