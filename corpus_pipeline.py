"""From raw documents to packed training sequences, each stage on all that its predecessor kept.

STAGES lists (name, function); a function takes (spark, docs, sf_dir) and returns
a DataFrame, with the columns of documents but for the last one. run() writes each
stage's result as Parquet in the shared folder and reads it as the next stage's
documents, so a lost executor costs a part of one stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import packing, pii, quality, simhash, toxicity
from tidemark.operators.tables import dropped, scratch, written


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents under the toxicity threshold stay.

    A null text is scored as an empty one; repeated rows and rows without an id are scored as
    others are. Without labels of both classes every score is the labels' mean. Other columns come along.
    """
    return toxicity.keep_clean(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_poor(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of the quality threshold or more stay.

    A null text is scored as an empty one; repeated rows and rows without an id are scored as
    others are. Without labels of both classes every score is the labels' mean. Other columns come along.
    """
    return quality.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of documents that share 0.8 or more of their five-word shingles that with the smallest id stays.

    Null and empty texts are copies of each other. Rows that repeat an id are one document;
    rows without an id stay. Other columns come along.
    """
    return simhash.keep_one(docs)


def replace_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Entities become surrogates; n_chars follows the text.

    Null and empty texts are unchanged; repeated rows are replaced alike. Other columns come along.
    """
    return pii.replace_entities(docs, length_col="n_chars")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their token ids and their places in the sequences.

    A null text is an empty one, whose only id is the end id. Repeated rows and rows without an
    id are documents of their own. packing.sequences joins the pieces to whole sequences.
    """
    return packing.packed(docs, keep_ids=True)


STAGES = [
    ("toxicity", drop_toxic),
    ("quality", drop_poor),
    ("near_duplicates", drop_near_copies),
    ("pii", replace_pii),
    ("packing", pack),
]

# Fingerprints, trained classifiers and token ids are beyond SQL; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), []
    for name, stage in STAGES[:-1]:
        with scratch() as made:
            docs = written(stage(spark, docs, sf_dir), name)
        # What the stage was made of, and its input, are done with.
        dropped(*before, *made[:-1])
        before = [docs]
    return STAGES[-1][1](spark, docs, sf_dir)
