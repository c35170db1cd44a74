"""Operators on small frames: edge cases with literal results."""


import pytest
from pyspark.sql import functions as F

from tidemark.functions import keywords
from tidemark.operators import dedup, merge, metadata, reconcile, search
from tidemark.sources import files


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_numbered_over_partitions(spark):
    df = spark.range(0, 1000, 1, 7).select((F.col("id") * 37 % 1000).alias("x"))
    own = dedup.numbered(df, "x").collect()
    assert sorted(r.seq for r in own) == list(range(1, 1001))
    assert all(r.seq == r.x + 1 for r in own)
    assert dedup.numbered(df.where("x < 0"), "x").count() == 0


def test_identity_is_transitive(spark):
    df = spark.createDataFrame([(1, "a", None), (2, "a", "x"), (3, "b", "x"), (4, "c", None), (5, None, None), (6, "d", "y"), (7, "e", "y")], "id int, k string, m string")
    own = dict(rows(dedup.identity_components(df, "id", ["k", "m"])))
    assert own == {1: 1, 2: 1, 3: 1, 4: 4, 5: 5, 6: 6, 7: 6}


def test_long_chain_settles(spark):
    df = spark.range(200).select(F.col("id"), (F.floor(F.col("id") / 2)).alias("a"), (F.floor((F.col("id") + 1) / 2)).alias("b"))
    assert dedup.identity_components(df, "id", ["a", "b"]).select("component").distinct().count() == 1


def test_one_per_key_and_first_wins(spark):
    a = spark.createDataFrame([("k", 2, "late"), ("k", 1, "early"), ("m", 1, "only")], "key string, seq int, v string")
    b = spark.createDataFrame([("k", 0, "other"), ("n", 0, "new")], "key string, seq int, v string")
    assert rows(dedup.one_per_key(a, ["key"], F.col("seq"))) == [("k", 1, "early"), ("m", 1, "only")]
    assert rows(dedup.first_wins(a, b, "key").select("key", "v")) == [("k", "early"), ("m", "only"), ("n", "new")]


def test_upsert_keeps_old_values_for_blanks(spark):
    old = spark.createDataFrame([(1, "one", "bad"), (2, "two", None)], "k int, name string, error string")
    new = spark.createDataFrame([(1, " ", ""), (2, "zwei", None), (3, "three", None)], "k int, name string, error string")
    assert rows(merge.upsert(old, new, "k", clearing=("error",))) == [(1, "one", ""), (2, "zwei", None), (3, "three", None)]
    assert rows(merge.overwrite(old, new, "k", ["name"])) == [(1, " ", "bad"), (2, "zwei", None)]


def test_moved(spark):
    pending = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int")
    known = spark.createDataFrame([("c", 3)], "k string, v int")
    acked = spark.createDataFrame([("a",), ("z",), ("a",)], "k string")
    still, after = merge.moved(pending, known, acked, "k")
    assert rows(still) == [("b", 2)]
    assert rows(after) == [("a", 1), ("c", 3), ("z", None)]


def test_rule_match_tiers(spark):
    df = spark.createDataFrame([("Asia semis outlook",), ("Asia spam semis",), ("deep dive",), ("semis only",)], "t string")
    m, r = metadata.rule_match(F.col("t"), ["spam"], ["deep"], ["asia"], ["semis"])
    assert [tuple(x) for x in df.select(F.array_join(m, ","), r).collect()] == [("asia,semis", "region_plus_topic"), ("", None), ("deep", "standalone"), ("", None)]


def test_dictionary_hits_prefers_longer_words(spark):
    docs = spark.createDataFrame([(1, "New York and York, new york"), (2, None)], "id int, t string")
    d = spark.createDataFrame([("new york", "city"), ("york", "town")], "word string, kind string")
    own = metadata.dictionary_hits(docs, "id", "t", d, ["new york", "york"])
    assert rows(own.select("id", "word", "kind", "hits")) == [(1, "new york", "city", 2), (1, "york", "town", 1)]


def test_coverage_and_missing(spark):
    a = spark.createDataFrame([("x",), ("y",), ("y",), ("w",)], "k string")
    b = spark.createDataFrame([("x",), ("y",), ("z",)], "k string")
    assert rows(reconcile.coverage(a, b, "k").select("k", "side")) == [("w", "missing"), ("x", "ok"), ("y", "repeated"), ("z", "unexpected")]
    e = spark.createDataFrame([("1", "n1"), (None, "n2"), ("3", "n3")], "id string, name string")
    d = spark.createDataFrame([("1", None), (None, "n2")], "id string, name string")
    assert rows(reconcile.missing(e, d, ["id", "name"])) == [("3", "n3")]


def bm25_by_hand(docs, terms):
    import math

    tf = {k: [sum(t[i : i + len(p)] == p for i in range(len(t))) for p in terms] for k, t in docs.items()}
    size = {k: max(len(t) - 2, 0) for k, t in docs.items()}
    avg, n = sum(size.values()) / len(docs), len(docs)
    out = {}
    for k in docs:
        if all(tf[k]):
            s = 0
            for i in range(len(terms)):
                df = sum(tf[d][i] > 0 for d in docs)
                idf = math.log((n - df + 0.5) / (df + 0.5))
                s -= (idf if idf > 0 else 1e-6) * tf[k][i] * 2.2 / (tf[k][i] + 1.2 * (0.25 + 0.75 * size[k] / avg))
            out[k] = s
    return out


def test_bm25_counts_overlaps(spark):
    docs = {1: "aaaa-aaa", 2: "nothing here", 3: "aaa and more text about it", 4: "zzz", 5: "still other text", 6: "and one more"}
    df = spark.createDataFrame(list(docs.items()), "id int, t string")
    own = dict(rows(search.bm25(df, "id", ["t"], ["aaa"])))
    wanted = bm25_by_hand(docs, ["aaa"])
    assert own.keys() == wanted.keys()
    assert all(abs(own[k] - wanted[k]) < 1e-9 for k in own)
    assert search.bm25(df, "id", ["t"], ["aa"]).count() == 0  # under three characters


def test_recall_prefers_the_primary_hit(spark):
    df = spark.createDataFrame([(1, "alpha beta"), (2, "beta gamma"), (3, "delta")], "id int, t string")
    assert [(r.id, r.source) for r in search.recall(df, "id", ["t"], ["alpha"], ["beta"], 10).orderBy("id").collect()] == [(1, 0), (2, 1)]


def test_snippet_and_highlight(spark):
    df = spark.createDataFrame([("x" * 100 + " needle " + "y" * 100,)], "t string")
    s = df.select(search.snippet(["t"], ["needle"], 30).alias("s")).first().s
    assert "needle" in s and len(s) <= 30
    assert df.select(keywords.highlight("t", ["needle"]).alias("h")).first().h.count("[needle]") == 1


def test_files_and_notes(spark, tmp_path):
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "x.pdf").write_bytes(b"%PDF-1.7 body")
    (tmp_path / "a" / "bad.pdf").write_bytes(b"<html>")
    (tmp_path / "a" / ".hidden.pdf").write_bytes(b"%PDF-")
    (tmp_path / "a" / "~$open.pdf").write_bytes(b"%PDF-")
    own = {r.path.rsplit("/", 1)[1]: r for r in files.scan(spark, [str(tmp_path)]).collect()}
    assert {k: r.valid for k, r in own.items()} == {"x.pdf": "ok", "bad.pdf": "bad_magic"}
    note = tmp_path / "n" / "one.md"
    note.parent.mkdir()
    note.write_text("---\ntitle: 'T'\ntags: a\ntags: b\n---\n# Head\n\n## Summary\nwords [[Page|shown]] [[Page]] [[Other]]\n\n## Next\n")
    r = files.notes(spark, str(tmp_path)).first()
    assert r.title == "Head" and r.frontmatter["tags"] == "b" and r.frontmatter["title"] == "T"
    df = files.notes(spark, str(tmp_path))
    assert df.select(files.linked_targets("body").alias("l")).first().l == ["Page", "Other"]
    assert df.select(files.section("body", "Summary").alias("s")).first().s.startswith("words")
    assert df.select(files.section("body", "Absent").alias("s")).first().s == ""


def test_json_lines_skip_broken_ones(spark, tmp_path):
    (tmp_path / "log.jsonl").write_text('{"a": 1}\nnot json\n{"a": 2}\n')
    assert rows(files.json_lines(spark, str(tmp_path / "log.jsonl"), "a int")) == [(1,), (2,)]
    files.append(spark.createDataFrame([(1, "x")], "a int, stage string"), str(tmp_path / "events"), "stage")
    files.append(spark.createDataFrame([(2, "x")], "a int, stage string"), str(tmp_path / "events"), "stage")
    assert spark.read.parquet(str(tmp_path / "events")).count() == 2


def test_render_notes(spark):
    df = spark.createDataFrame([("T", None, "body")], "title string, lang string, text string")
    assert files.render_notes(df, ["title", "lang"], "text").first().value == "---\ntitle: T\nlang: \n---\n\nbody"


@pytest.mark.parametrize("most", [2, 3])
def test_top_per_key(spark, most):
    df = spark.createDataFrame([(k, i) for k in "ab" for i in range(5)], "k string, v int")
    own = dedup.top_per_key(df, ["k"], most, F.desc("v")).collect()
    assert sorted((r.k, r.v) for r in own) == sorted((k, v) for k in "ab" for v in range(5 - most, 5))




def test_scratch_tables_are_told_and_dropped(spark):
    from tidemark.operators import tables

    with tables.scratch() as made:
        a = tables.written(spark.range(3))
        b = tables.written(a.where("id > 0"))
    assert made == [a, b] and tables.path_of(a) != tables.path_of(b)
    tables.dropped(a)
    assert b.count() == 2
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(tables.path_of(a))
    c = tables.written(spark.range(1))
    assert len(made) == 2 and c.count() == 1
