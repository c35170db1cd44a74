"""The pipeline against its stages by hand, and the contract of its stages."""

import corpus_pipeline
import numpy as np
from tests_brute import components

from tidemark.llm import quality, toxicity

SF = "/root/testdata/sf0.01"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    columns, now = docs.columns, docs
    seen = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        now = stage(spark, now, SF)
        assert now.columns == columns and dict(now.dtypes) == dict(docs.dtypes)
        now = spark.createDataFrame(now.collect(), docs.schema)
        seen[name] = {r.doc_id: r for r in now.collect()}
    whole = {r.doc_id: r for r in docs.collect()}
    f = toxicity.fit(docs, labels).scorer()
    clean = {i: r for i, r in whole.items() if f(r.text) < 0.7}
    assert seen["toxicity"] == clean
    model = quality.fit(spark.createDataFrame(list(clean.values()), docs.schema), labels)
    scores = model.scores(np.array([quality.statistics(r.text) for r in clean.values()]))
    good = {i: r for (i, r), s in zip(clean.items(), scores) if s >= 0.3}
    assert seen["quality"] == good
    group, _ = components([(i, r.text) for i, r in good.items()])
    one = {i: r for i, r in good.items() if group[i] == i}
    # Every group keeps its smallest; of the rest, nine in ten at least go.
    assert one.items() <= seen["near_duplicates"].items() <= good.items()
    assert len(good) - len(seen["near_duplicates"]) >= 0.9 * (len(good) - len(one)) > 0
    assert seen["pii"].keys() == seen["near_duplicates"].keys()
    assert all(r.n_chars == len(r.text) for r in seen["pii"].values())
    own = corpus_pipeline.run(spark, SF).collect()
    assert {r.doc_id for r in own} == seen["pii"].keys()
    assert sum(r.piece == 0 for r in own) == len(seen["pii"])


def test_stages_on_an_empty_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("false")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, SF).count() == 0


def test_queries_are_registered(spark):
    import __spark_entry__ as entry

    names = set(entry.queries())
    assert "pipeline" in names and all(any(n.startswith(f"op{i}_") for n in names) for i in range(1, 11))
    assert set(entry.oracle_sql()) <= names


def test_covertree_equals_its_sql(spark):
    import duckdb

    from tidemark.llm import queries

    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{SF}/embeddings.parquet'")
    wanted = sorted(con.execute(queries.oracle_sql()["op7_covertree"]).fetchall())
    assert sorted(tuple(r) for r in queries.op7_covertree(spark, SF).collect()) == wanted
