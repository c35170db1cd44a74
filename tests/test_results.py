"""Events, run results, quarantine, overlays, notes edited, lists and queries: literal cases."""

import pytest
from pyspark.sql import functions as F

from tidemark.operators import events as E, results as R, search as S
from tidemark.sources import files


def one(spark, column, **row):
    schema = ", ".join(f"{k} {'int' if isinstance(v, int) else 'array<string>' if isinstance(v, list) else 'string'}" for k, v in row.items()) or "x int"
    return spark.createDataFrame([tuple(row.values()) or (0,)], schema).select(column.alias("v")).first().v


def reason(spark, code, log=None, downloaded=0, given=None, **more):
    row = {"code": code, "log": log, "downloaded": downloaded, "given": given}
    df = spark.createDataFrame([tuple(row.values())], "code int, log string, downloaded int, given string")
    return df.select(R.reason_code(F.col("code"), F.col("downloaded"), F.col("given"), F.col("log"), **more).alias("v")).first().v


def test_reasons(spark):
    assert reason(spark, 20) == "need_reauth" and reason(spark, 21) == "blocked_browser_missing"
    assert reason(spark, 22, "BrowserType.connect_over_cdp: TIMEOUT") == "blocked_browser_cdp_unresponsive"
    assert reason(spark, 22, "timeout") == "blocked_browser_unavailable_or_interrupted"
    assert reason(spark, 1, "Timed out waiting for cloud requirements after 9 s") == "cloud_requirements_timeout"
    assert reason(spark, 0, "Timed out waiting for cloud requirements after 9 s") == "no_download_reason_unknown"
    assert reason(spark, 0, downloaded=2) == "download_completed" and reason(spark, 7) == "task_failed"
    assert reason(spark, 20, given=" own ") == "own"
    log = "[BLOCKED] no_route: x\n  [BLOCKED] disk_full: y\nsay [BLOCKED] no_route: z\n[BLOCKED] other: z"
    assert reason(spark, 20, log, known=["disk_full", "no_route"]) == "disk_full" and reason(spark, 20, log, known=["missing"]) == "need_reauth"
    assert reason(spark, 143, "Terminated: 15 pgrep me", killed="pgrep me") == "self_terminated_codex_runner" and reason(spark, 143, "Terminated: 15") == "task_interrupted_sigterm"


def test_stages_and_artifacts(spark):
    for status, stage in {"raw_md_done": "raw_md", " text_extract_x": "text_extract", "pdf_archived": "pdf", "downloaded": "pdf", "needs_review": "review", "odd": "odd", None: ""}.items():
        assert one(spark, E.stage_of("s"), s=status) == stage
    row = {"s": "clean_md_done", "clean_md_path": " ", "raw_md_path": " r ", "path": "p"}
    assert one(spark, E.artifact_of("s", [*row]), **row) == "r"
    assert one(spark, E.artifact_of("s", [*row]), **(row | {"s": "other"})) == "p"


def test_events_without_an_identity_are_left_out(spark):
    rows = [("success", "ocr", None, ""), ("success", "ocr", "r1", None), ("success", "markitdown_clean", "r2", None), ("failed", None, None, "sha"), (None, None, "r3", None)]
    df = spark.createDataFrame(rows, "text_extract_status string, text_source string, report_id string, pdf_sha256 string").withColumn("text_extract_error", F.lit(None).cast("string"))
    assert sorted(r.status for r in E.extraction_events(df).collect()) == ["text_extract_failed", "text_extract_fallback_success"]
    assert sorted(r.report_id or "" for r in E.started_events(df.withColumn("there", F.lit(True)), "there").collect()) == ["", "r1", "r3"]


def test_payloads(spark):
    def told(ok, text):
        df = spark.createDataFrame([(ok, "500", text)], "ok boolean, status string, text string")
        r = df.select(files.payload_reason("ok", "status", "text").alias("r"), files.payload_topics("ok", "status", "text").alias("t")).first()
        return r.r, r.t

    assert told(None, "{}") == ("api_status_500", []) and told(True, "<a>") == ("api_invalid_json", []) and told(True, "[1]") == ("api_invalid_json", [])
    assert told(True, None) == (None, []) and told(True, '{"code": "0"}') == (None, []) and told(True, '{"succeeded": false}') == ("api_error_unknown", [])
    assert told(True, '{"code": 7}') == ("api_error_7", []) and told(True, '{"resp_data": {"topics": "x"}}') == ("api_invalid_topics", [])
    assert told(True, '{"resp_data": {"topics": [{"a":1}, 2]}}') == (None, ['{"a":1}'])


def test_lists_overlays_and_cursor(spark):
    assert one(spark, R.listed(F.col("a")), a=[" x", "X", "", None, "y"]) == ["x", "y"]
    assert one(spark, R.updated(F.col("a"), F.col("b"), "add"), a=["x"], b=["X", "z"]) == ["x", "z"]
    assert one(spark, R.updated(F.col("a"), F.col("b"), "remove"), a=["x", "y"], b=["Y"]) == ["x"]
    assert one(spark, R.effective(F.col("a"), F.col("b"), F.lit(True)), a=["x"], b=[]) == [] and one(spark, R.effective(F.col("a"), F.col("b"), F.lit(None)), a=["x"], b=["y"]) == ["x"]
    df = spark.createDataFrame([("s", 1, "2024-01-01", 2, 2), ("s", 2, "2024-01-02", 2, 1), ("s", 3, "2024-01-03", 1, 1)], "stream string, run_id int, at string, planned int, reconciled int")
    assert [r.window_start for r in R.cursor(df, "2023").orderBy("run_id").collect()] == ["2023", "2024-01-01", "2024-01-01"]


def test_quarantine_and_summaries(spark):
    df = spark.createDataFrame([("a/b.pdf", "env_failure", "x", "broken"), (None, None, None, None)], "path string, error_type string, error_code string, error string")
    a, b = sorted(R.quarantine_entries(df).collect(), key=lambda r: r.path, reverse=True)
    assert (a.filename, a.diagnosis, a.status) == ("b.pdf", "broken", "needs_transform")
    assert (b.error_type, b.error_code, b.next_step) == ("content_failure", "unknown_failure", "人工复核这份 PDF")
    batches = spark.createDataFrame([(i, p) for i in range(6) for p in ("a", "b")], "batch int, path string")
    entries = [(0, "a"), (0, "b"), (1, "a"), (2, "a"), (2, "a"), (3, "a"), (3, "c"), (4, "a"), (4, "b")]
    own = spark.createDataFrame([(b, p, "t", " " if b == 4 and p == "b" else "m") for b, p in entries], "batch int, path string, title string, markdown string")
    done = spark.createDataFrame([(i, "success", 2) for i in range(5)], "batch int, status string, handled_count int")
    got = {r.batch: r.verdict for r in R.summary_verdicts(batches, own, done).collect()}
    assert got == {0: "valid", 1: "summary_count_mismatch", 2: "duplicate", 3: "outside_batch", 4: "empty_entry", 5: "not_successful"}


def test_notes_edited(spark):
    assert one(spark, files.with_field("t", "a", F.lit(1)), t="---\na: 0\nb: 2\n---\nx") == "---\na: 1\nb: 2\n---\nx"
    assert one(spark, files.with_field("t", "c", F.lit("z")), t="---\na: 0\n---\nx") == "---\na: 0\nc: z\n---\nx"
    assert one(spark, files.with_field("t", "c", F.lit("z")), t="x") == "---\nc: z\n---\n\nx" and one(spark, files.with_field("t", "c", F.lit("z")), t="---\nopen") == "---\nopen"
    page = "# A\n\n## Links\n- [[x]]\n\n## End\nlast"
    assert one(spark, files.with_section("t", "Links", F.lit("n")), t=page) == "# A\n\n## Links\nn\n\n## End\nlast"
    assert one(spark, files.with_section("t", "More", F.lit(None)), t="x") == "x\n\n## More\n"
    assert one(spark, files.with_link("t", "Links", F.lit("x"), F.lit("[[x]]")), t=page) == page
    assert one(spark, files.with_link("t", "End", F.lit("y"), F.lit("[[y]]")), t=page) == page + "\n- [[y]]\n" and one(spark, files.with_link("t", "No", F.lit("y"), F.lit("[[y]]")), t=page) == page


def test_paths_times_and_errors(spark):
    assert one(spark, files.listed_paths("t"), t='["a", "a", " b ", ""]') == ["a", "b"] and one(spark, files.listed_paths("t"), t='{"notes": [], "note_paths": ["p"]}') == ["p"]
    assert one(spark, files.listed_paths("t"), t="a\n\n b\r\na") == ["a", "b"] and one(spark, files.listed_paths("t"), t=None) == [] and one(spark, files.listed_paths("t"), t="17") == []
    day = F.lit("2024-03-01").cast("date")
    assert one(spark, files.since("t", day), t="30d") == "2024-01-31" and one(spark, files.since("t", day), t="d") == "d" and one(spark, files.since("t", day), t=None) == ""
    assert one(spark, files.display_time("t"), t="2024-01-02T03:04:05") == "01-02 03:04" and one(spark, files.display_time("t"), t=" ") == "未知" and one(spark, files.display_time("t"), t="soon") == "soon"


@pytest.mark.parametrize("query, wanted", [("a b", (["a", "b"], True)), ('"a b" OR c', (["a b", "c"], False)), ('"a""b"', (['a"b'], True)), ('"a', None), ("a AND", None), ("AND a", None), ("a OR OR b", None), ("a AND b OR c", None), ("a*", None), ("", None), ("(a)", None), ('"OR"', (["OR"], True))])
def test_queries_as_typed(query, wanted):
    assert S.parsed(query) == wanted


def test_the_index_is_written_and_read(spark, tmp_path):
    df = spark.createDataFrame([(1, "**T** [[a|b]]", ["x", "y"], None)], "id int, title string, themes array<string>, summary_text string")
    assert S.rebuild_index(df, "id", str(tmp_path / "index")) == 1
    r = spark.read.parquet(str(tmp_path / "index")).first()
    assert (r.title, r.themes, r.summary_text, r.broker, r.doc_len) == ("T b", "x y", "", "", 2)
