"""Answers, outcomes, backfills and scans: literal cases."""

from pyspark.sql import functions as F

from tidemark.operators import answers as A


def one(spark, column, **row):
    return spark.createDataFrame([tuple(row.values())], ", ".join(f"{k} string" for k in row)).select(column.alias("v")).first().v


def test_evidence(spark):
    row = {"t": "T", "d": "2024-01-02", "b": None, "s": "**x** [[a|b]]"}
    assert one(spark, A.evidence_line(F.lit(2), "t", "d", "b", "s"), **row) == "- [S2] T（2024-01-02）：x b"
    assert one(spark, A.evidence_line(F.lit(1), "t", "d", "b", "s"), t=None, d=" ", b=None, s=None) == "- [S1] "


def test_claims_or_snippets(spark):
    df = spark.createDataFrame([(1, "cost falls", "a"), (2, "Costs rise", "a"), (3, "orders", ""), (4, "cost", "b"), (5, "cost", "c"), (6, "cost", "d")], "place int, text string, snippet string")
    rules = [(["COST"], "costs move"), (["none"], "no"), (["orders"], "orders grow"), (["order"], "orders grow")]

    def told(query):
        return [r.claim for r in sorted(A.claims(df, query, ["margin"], rules).collect(), key=lambda r: r.place)]

    assert told("the MARGIN?") == ["- [S1、S2、S4、S5] costs move", "- [S3] orders grow"]
    assert told("else") == ["- [S1] a", "- [S2] a", "- [S4] b"]
    assert A.claims(df.where("place > 4"), "margin", ["margin"], [(["zzz"], "no")]).count() == 0
    assert A.claims(df.where("false"), "margin", ["margin"], rules).count() == 0


def test_sections_without_lines_say_so(spark):
    df = spark.createDataFrame([("p", "A", 2, "- y"), ("p", "A", 1, "- x")], "page string, section string, place int, line string")
    assert A.rendered(df, ["A", "B"]).first().text == "## A\n- x\n- y\n\n## B\n- 暂无\n"


def test_outcomes(spark):
    rows = [("partial_success", "published", 0), ("partial_success", "ack_failed", 1), ("success", "completed_with_quarantine", 0), ("paused", "published", 0), ("success", "dry_run", 0), ("env_failed", "x", 0), ("success", None, 0)]
    df = spark.createDataFrame(rows, "status string, state string, ready int").withColumns({"published": F.lit(0), "quarantined": F.lit(0)})
    own = [tuple(r) for r in df.select(*A.run_outcome("status", "state", "ready", "published", "quarantined")).collect()]
    assert own == [("failed", "failed", "blocked"), ("partial_success", "partial_success", "blocked"), ("success", "completed_with_quarantine", "degraded"), ("paused", "waiting", "degraded"), ("success", "noop", "healthy"), ("env_failed", "failed", "blocked"), ("success", "success", "healthy")]


def test_error_summaries(spark):
    for text, wanted in {
        'x\n{"summary": " s "}': "s", '{"a": 1}\n[plugins] p\n  why\n': '{"a": 1}', '{"status": "st"}\ntail': '{"status": "st"}', '{"result": {"payloads": [{"text": ""}, {"text": "l1\\nl2"}]}}': "l1",
        '{\n "summary": "whole"\n}': "whole", "": None, "[plugins] only": None, "z" * 300: "z" * 200,
    }.items():
        assert one(spark, A.error_summary("t"), t=text) == wanted, text


def test_versions_ignore_order_and_other_fields(spark):
    a = '{"records": [{"label": "a", "exists": true, "sha256": "1"}, {"label": "b"}], "x": 1}'
    b = '{"records": [{"label": "b", "exists": false}, {"sha256": "1", "label": "a", "exists": true}, {"label": ""}]}'
    assert one(spark, A.retry_version("t"), t=a) == one(spark, A.retry_version("t"), t=b) != one(spark, A.retry_version("t"), t=a.replace("1", "2"))


def test_backfill(spark):
    own = spark.createDataFrame([(1, None, " ", "k"), (2, "p", "t", "k")], "id int, path string, type string, keep string")
    reports, found = spark.createDataFrame([(1, "db")], "id int, path string"), spark.createDataFrame([(1, "new"), (2, "new")], "id int, type string")
    assert sorted(map(tuple, A.backfilled(own, reports, found, "id", ["path"], ["type"]).collect())) == [(1, "db", "new", "k", ["path", "type"]), (2, "p", "t", "k", [])]
    assert sorted(map(tuple, A.backfilled(own, reports, found, "id", ["path"], ["type"], force=True).collect()))[1] == (2, "p", "new", "k", ["type"])


def test_a_scan_ends_at_the_window_or_an_error(spark):
    def page(*times):
        return '{"resp_data": {"topics": [' + ", ".join(f'{{"create_time": "{t}"}}' for t in times) + "]}}"

    def read(*pages):
        df = spark.createDataFrame([(i, True, "200", p) for i, p in enumerate(pages)], "page int, ok boolean, status string, text string")
        return sorted((r.page, r.reason, r.topic and r.topic[-4:-2]) for r in A.scanned(df, "2024-02").collect())

    assert read(page("2024-03", "2024-02"), page("2024-02", "2024-01"), page("2023-01")) == [(0, None, "02"), (0, None, "03"), (1, None, "01"), (1, None, "02")]
    assert read(page("2024-03"), "<html>", page("2024-01")) == [(1, "api_invalid_json", None)]
    assert read(page("2024-01"), "<html>") == [(0, None, "01")] and read(page()) == [] and read(page("2024-03")) == [(0, None, "03")]


def test_memberships_and_folders(spark):
    pages = spark.createDataFrame([("a",), ("b",)], "name string")
    index = spark.createDataFrame([("[[companies/a|A]] [[themes/b]]",)], "t string")
    assert [r.name for r in A.listed_pages(pages, "name", index, "t", "companies").collect()] == ["a"]
    assert A.listed_pages(pages, "name", index, "t", "other").count() == 2 == A.listed_pages(pages, "name", index.where("false"), "t", "companies").count()
    assert one(spark, A.parents("p"), p="/a/b/c.pdf") == ["/a/b", "/a"] and one(spark, A.parents("p"), p="x") == []
