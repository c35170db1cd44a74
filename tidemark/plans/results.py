"""Report events, run results, quarantine, overlays, windows: the rules of operators/events.py and operators/results.py on the test tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import events as E, results as R
from ..sources import files
from .base import notes, query, table


def both(sql: str):
    """An expression that both dialects read, for Spark."""
    return F.expr(sql.replace("AS VARCHAR", "AS STRING"))


ID = "CAST(event_id AS VARCHAR)"
STATUS = "CASE event_id % 10 WHEN 0 THEN ' raw_md_done' WHEN 1 THEN 'clean_md_failed' WHEN 2 THEN 'text_extract_failed' WHEN 3 THEN 'summary_ready' WHEN 4 THEN 'feishu_published' WHEN 5 THEN 'obsidian_linked' WHEN 6 THEN 'pdf_archived' WHEN 7 THEN 'downloaded' WHEN 8 THEN 'needs_review' ELSE event_type END"
PATHS = {
    "raw_md_path": f"CASE WHEN user_id % 2 = 0 THEN 'raw/' || {ID} ELSE ' ' END",
    "path": f"CASE WHEN user_id % 3 = 0 THEN NULL ELSE 'in/' || {ID} END",
    "pdf_path": f"'pdf/' || {ID}",
    "clean_md_path": f"CASE WHEN user_id % 5 = 0 THEN '' ELSE ' clean/' || {ID} END",
    "extracted_text_path": f"CASE WHEN user_id % 7 = 0 THEN 'text/' || {ID} END",
    "summary_md_path": f"CASE WHEN user_id % 4 = 0 THEN 'summary/' || {ID} ELSE '' END",
    "feishu_doc_url": f"CASE WHEN user_id % 6 = 0 THEN 'url/' || {ID} END",
    "obsidian_note_path": f"CASE WHEN user_id % 8 = 0 THEN 'note/' || {ID} END",
}
STAGE_SQL = """CASE WHEN starts_with(s, 'raw_md_') THEN 'raw_md' WHEN starts_with(s, 'clean_md_') THEN 'clean_md' WHEN starts_with(s, 'text_extract_') THEN 'text_extract' WHEN starts_with(s, 'summary_') THEN 'summary'
    WHEN starts_with(s, 'feishu_') THEN 'feishu' WHEN starts_with(s, 'obsidian_') THEN 'obsidian' WHEN starts_with(s, 'pdf_') OR s = 'downloaded' THEN 'pdf' WHEN s = 'needs_review' THEN 'review' ELSE s END"""


def _own(*names):
    return "coalesce(" + ", ".join(f"nullif(trim({n}), '')" for n in names) + ", '')"


ARTIFACT_SQL = f"""CASE WHEN starts_with(s, 'raw_md_') THEN {_own('raw_md_path', 'path', 'pdf_path')} WHEN starts_with(s, 'clean_md_') THEN {_own('clean_md_path', 'raw_md_path')} WHEN starts_with(s, 'text_extract_') THEN {_own('extracted_text_path', 'path', 'pdf_path')}
    WHEN starts_with(s, 'summary_') THEN {_own('summary_md_path')} WHEN starts_with(s, 'feishu_') THEN {_own('feishu_doc_url', 'summary_md_path')} WHEN starts_with(s, 'obsidian_') THEN {_own('obsidian_note_path', 'summary_md_path')} ELSE {_own('path', 'pdf_path')} END"""
ITEMS_SQL = "i AS (SELECT event_id, user_id, value, event_type, trim(" + STATUS + ") AS s, " + ", ".join(f"{v} AS {k}" for k, v in PATHS.items()) + " FROM events)"


def items(spark, sf):
    return table(spark, sf, "events").select("event_id", "user_id", "value", "event_type", both(STATUS).alias("status"), *(both(v).alias(k) for k, v in PATHS.items()))


@query(f"WITH {ITEMS_SQL} SELECT {STAGE_SQL} AS stage, count(*) AS items FROM i GROUP BY stage")
def status_stage_case(spark, sf):
    return items(spark, sf).groupBy(E.stage_of("status").alias("stage")).agg(F.count("*").alias("items"))


@query(f"WITH {ITEMS_SQL} SELECT event_id, {ARTIFACT_SQL} AS artifact FROM i")
def artifact_choice_case(spark, sf):
    rows = items(spark, sf)
    return rows.select("event_id", E.artifact_of("status", rows.columns).alias("artifact"))


@query(f"WITH {ITEMS_SQL} SELECT CASE WHEN user_id % 9 = 0 THEN 'given' ELSE {STAGE_SQL} END AS stage, s AS status, 'r' || CAST(user_id AS VARCHAR) AS report_id, count(*) AS n FROM i GROUP BY ALL")
def event_normalise(spark, sf):
    rows = items(spark, sf).withColumnRenamed("status", "index_status").withColumns({"report_id": both("' r' || CAST(user_id AS VARCHAR)"), "stage": F.when(F.col("user_id") % 9 == 0, "given").otherwise("")})
    return E.normalized(rows).groupBy("stage", "status", "report_id").agg(F.count("*").alias("n"))


TEXT = {
    "text_extract_status": "CASE event_id % 4 WHEN 0 THEN 'failed' WHEN 1 THEN ' success' WHEN 2 THEN 'success' END",
    "text_source": "CASE event_id % 3 WHEN 0 THEN 'markitdown_clean' WHEN 1 THEN 'ocr ' END",
    "text_extract_error": "CASE WHEN event_id % 4 = 0 THEN event_type || ' error' END",
    "report_id": "CASE WHEN user_id % 5 > 0 THEN 'r' || CAST(user_id AS VARCHAR) END",
    "pdf_sha256": "CASE WHEN user_id % 10 = 0 THEN 'sha' ELSE ' ' END",
}
TEXT_SQL = "i AS (SELECT event_id, user_id, " + ", ".join(f"{v} AS {k}" for k, v in (PATHS | TEXT).items()) + " FROM events)"
IDENTIFIED = "(coalesce(report_id, '') <> '' OR trim(coalesce(pdf_sha256, '')) <> '')"


def _texts(spark, sf):
    return table(spark, sf, "events").select("event_id", "user_id", *(both(v).alias(k) for k, v in (PATHS | TEXT).items()))


@query(f"""WITH {TEXT_SQL}, c AS (SELECT *, CASE WHEN trim(coalesce(text_extract_status, '')) = 'success' AND trim(coalesce(text_source, '')) NOT IN ('', 'markitdown_clean') THEN 'text_extract_fallback_success' WHEN text_extract_status = 'failed' THEN 'text_extract_failed' END AS status FROM i)
    SELECT event_id, status, {_own('extracted_text_path', 'path', 'pdf_path')} AS artifact_path, coalesce(text_extract_error, '') AS error_message FROM c WHERE status IS NOT NULL AND {IDENTIFIED}""")
def text_extract_event_filter(spark, sf):
    return E.extraction_events(_texts(spark, sf)).select("event_id", "status", "artifact_path", "error_message")


@query(f"""WITH {TEXT_SQL} SELECT event_id, {_own('extracted_text_path', 'path', 'pdf_path')} AS artifact_path FROM i
    WHERE {IDENTIFIED} AND NOT (trim(coalesce(text_extract_status, '')) = 'success' AND trim(coalesce(text_source, '')) = 'markitdown_clean' AND event_id % 7 > 0)""")
def fallback_started(spark, sf):
    rows = _texts(spark, sf).withColumn("there", F.when(F.col("event_id") % 7 > 0, True))
    return E.started_events(rows, "there").select("event_id", "artifact_path")


@query("""WITH k AS (SELECT user_id, list_sort(list_distinct(list(event_type))) AS t FROM events GROUP BY user_id)
    SELECT user_id, CASE WHEN user_id % 6 = 0 THEN '[]' ELSE '["' || array_to_string(t, '","') || '"]' END AS types_json, CASE WHEN user_id % 4 = 0 THEN '' ELSE 'u' || CAST(user_id AS VARCHAR) END AS name FROM k""")
def metadata_payload(spark, sf):
    rows = table(spark, sf, "events").groupBy("user_id").agg(F.array_sort(F.collect_set("event_type")).alias("types"))
    rows = rows.select("user_id", F.when(F.col("user_id") % 6 > 0, F.col("types")).alias("types"), F.when(F.col("user_id") % 4 > 0, both("'u' || CAST(user_id AS VARCHAR)")).alias("name"))
    return E.as_payload(rows, ["types"], ["name"])


@query("""SELECT doc_id, 'd' || CAST(doc_id AS VARCHAR) || '|note/' || source || '|' || CASE WHEN doc_id % 3 = 0 THEN '' ELSE 'sum/' || lang END || '|Summary|' AS citation FROM documents""")
def citation_struct(spark, sf):
    rows = notes(spark, sf).select("doc_id", both("'d' || CAST(doc_id AS VARCHAR)").alias("r"), F.concat(F.lit("note/"), "source").alias("n"), F.when(F.col("doc_id") % 3 > 0, F.concat(F.lit("sum/"), "lang")).alias("s"), F.lit(None).cast("string").alias("p"))
    c = rows.select("doc_id", E.citation("r", "n", "s", "p", "Summary").alias("c"))
    return c.select("doc_id", F.concat_ws("|", "c.report_id", "c.note_path", "c.summary_path", "c.heading", "c.snippet").alias("citation"))


@query("""SELECT l_orderkey AS batch, min(l_suppkey) FILTER (l_linenumber = first) AS supplier, string_agg(CAST(l_partkey AS VARCHAR) || '/' || CAST(l_linenumber AS VARCHAR), ',' ORDER BY l_linenumber, l_partkey) AS files, count(*) AS file_count
    FROM (SELECT *, min(l_linenumber) OVER (PARTITION BY l_orderkey) AS first FROM lineitem) GROUP BY l_orderkey""")
def ack_batch_from_chunks(spark, sf):
    name = F.concat_ws("/", F.col("l_partkey").cast("string"), F.col("l_linenumber").cast("string"))
    rows = table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("batch"), F.col("l_linenumber").alias("chunk"))
    chunks = rows.agg(F.transform(F.array_sort(F.collect_list(F.struct("l_partkey", name.alias("name")))), lambda x: x["name"]).alias("files"), F.min("l_suppkey").alias("supplier"))
    out = E.acknowledged_batch(chunks, "chunk", "files")
    return out.select("batch", "supplier", F.array_join("files", ",").alias("files"), F.col("file_count").cast("bigint").alias("file_count"))


@query("SELECT o_orderkey, min(l_linenumber) AS line FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey AND l_returnflag = 'R' GROUP BY o_orderkey")
def ordered_lookup(spark, sf):
    lines = table(spark, sf, "lineitem").where("l_returnflag = 'R'").select(F.col("l_orderkey").alias("k"), "l_linenumber", F.col("l_linenumber").alias("o_orderkey"))
    out = E.in_order_of(table(spark, sf, "orders").select("o_orderkey", F.col("o_orderkey").alias("at")).withColumnRenamed("at", "k"), lines, "k", "o_orderkey")
    return out.select("o_orderkey", F.col("found.l_linenumber").alias("line"))


CODE = "CASE event_id % 12 WHEN 0 THEN 20 WHEN 1 THEN 21 WHEN 2 THEN 22 WHEN 3 THEN 22 WHEN 4 THEN 22 WHEN 5 THEN 23 WHEN 6 THEN 143 WHEN 7 THEN 124 WHEN 8 THEN 126 WHEN 9 THEN 1 ELSE 0 END"
LOG = """CASE event_id % 12 WHEN 2 THEN 'BrowserType.connect_over_cdp: Timeout 30 s' WHEN 3 THEN 'CFT CDP endpoint not ready' WHEN 6 THEN CASE WHEN user_id % 2 = 0 THEN 'Terminated: 15 after pgrep -af runner' ELSE 'stopped' END
    WHEN 8 THEN 'start_task.sh: Operation not permitted' WHEN 9 THEN CASE WHEN user_id % 2 = 0 THEN 'Timed out waiting for cloud requirements after 60 s' ELSE 'x' || chr(10) || ' [BLOCKED] disk_full: no room' || chr(10) || '[BLOCKED] made_up: no' END ELSE event_type END"""
GIVEN = "CASE WHEN user_id % 11 = 0 THEN ' own_reason' END"
DOWNLOADED = "CAST(value AS INTEGER) % 3"
KNOWN = ["disk_full", "no_route"]
RUNS_SQL = f"r AS (SELECT event_id, {CODE} AS code, {LOG} AS log, {GIVEN} AS given, {DOWNLOADED} AS downloaded, lower({LOG}) AS low FROM events)"
REASON_SQL = """CASE WHEN trim(coalesce(given, '')) <> '' THEN trim(given) WHEN contains(log, '[BLOCKED] disk_full:') THEN 'disk_full' WHEN code = 20 THEN 'need_reauth' WHEN code = 21 THEN 'blocked_browser_missing'
    WHEN code = 22 AND contains(low, 'browsertype.connect_over_cdp') AND contains(low, 'timeout') THEN 'blocked_browser_cdp_unresponsive' WHEN code = 22 AND contains(low, 'cft cdp endpoint not ready') THEN 'blocked_browser_endpoint_unavailable'
    WHEN code = 22 THEN 'blocked_browser_unavailable_or_interrupted' WHEN code = 23 THEN 'busy_locked' WHEN code = 143 AND contains(low, 'terminated: 15') AND contains(low, 'pgrep -af runner') THEN 'self_terminated_codex_runner' WHEN code = 143 THEN 'task_interrupted_sigterm'
    WHEN code = 124 THEN 'codex_exec_timeout' WHEN code = 126 AND contains(low, 'operation not permitted') AND contains(low, 'start_task.sh') THEN 'blocked_documents_permission'
    WHEN code <> 0 AND contains(low, 'timed out waiting for cloud requirements after') THEN 'cloud_requirements_timeout' WHEN code <> 0 THEN 'task_failed' WHEN downloaded > 0 THEN 'download_completed' ELSE 'no_download_reason_unknown' END"""


def _runs(spark, sf):
    return table(spark, sf, "events").select("event_id", "user_id", both(CODE).alias("code"), both(LOG).alias("log"), both(GIVEN).alias("given"), F.expr("cast(bround(value, 0) as int) % 3").alias("downloaded"))


@query(f"WITH {RUNS_SQL} SELECT event_id, {REASON_SQL} AS reason FROM r")
def reason_derive_case(spark, sf):
    reason = R.reason_code(F.col("code"), F.col("downloaded"), F.col("given"), F.col("log"), KNOWN, killed="pgrep -af runner", refused="start_task.sh")
    return _runs(spark, sf).select("event_id", reason.alias("reason"))


@query(f"""WITH {RUNS_SQL} SELECT CASE WHEN code = 0 AND downloaded > 0 THEN 'downloaded' WHEN code = 0 THEN coalesce(nullif(given, ''), 'unknown') WHEN code = 23 THEN 'busy_locked' WHEN code = 20 THEN 'need_reauth'
    WHEN code IN (21, 22) THEN 'blocked_browser' WHEN code = 143 THEN 'task_interrupted' ELSE 'unknown' END AS reason, count(*) AS n FROM r GROUP BY reason""")
def no_download_reason(spark, sf):
    return _runs(spark, sf).groupBy(R.no_download_reason(F.col("code"), F.col("downloaded"), F.col("given")).alias("reason")).agg(F.count("*").alias("n"))


@query("""WITH c AS (SELECT o_orderkey, o_custkey, CAST(o_orderkey % 3 AS INTEGER) AS code, CASE WHEN o_custkey % 4 = 0 THEN CAST(o_orderkey + 1 AS VARCHAR) WHEN o_custkey % 7 = 0 THEN NULL ELSE CAST(o_orderkey AS VARCHAR) END AS has, CASE WHEN o_custkey % 5 = 0 THEN 9 ELSE CAST(o_orderkey % 3 AS INTEGER) END AS hascode FROM orders),
    m AS (SELECT *, has IS NOT NULL AND has = CAST(o_orderkey AS VARCHAR) AND code = hascode AS mine FROM c)
    SELECT o_orderkey AS slot, CASE WHEN mine THEN hascode WHEN code = 0 THEN 1 ELSE code END AS exit_code, CASE WHEN mine THEN 'stored' ELSE 'task_failed' END AS reason_code, CASE WHEN mine THEN 'w0' WHEN o_orderkey % 2 = 0 THEN 'a' ELSE 'last' END AS window_start,
        CASE WHEN mine THEN 7 ELSE 0 END AS downloaded_count, NOT mine AS replaced, CASE WHEN NOT mine THEN has END AS replaced_run_id FROM m""")
def stale_replace_case(spark, sf):
    o = table(spark, sf, "orders")
    key, code = F.col("o_orderkey"), (F.col("o_orderkey") % 3).cast("int")
    runs = o.select(key.alias("slot"), key.cast("string").alias("run_id"), code.alias("exit_code"), F.when(key % 2 == 0, "a").otherwise(" ").alias("window_start"), F.lit("e").alias("window_end"), F.lit("last").alias("last_success"), F.lit("f").alias("finished_at"))
    has = F.when(F.col("o_custkey") % 4 == 0, (key + 1).cast("string")).otherwise(key.cast("string"))
    stored = o.where((F.col("o_custkey") % 4 == 0) | (F.col("o_custkey") % 7 != 0))
    stored = stored.select(key.alias("slot"), has.alias("run_id"), F.when(F.col("o_custkey") % 5 == 0, 9).otherwise(code).alias("exit_code"), F.lit("stored").alias("reason_code"), F.lit("w0").alias("window_start"), F.lit("w1").alias("window_end"), F.lit(7).alias("downloaded_count"))
    return R.current_results(runs, stored).select("slot", "exit_code", "reason_code", "window_start", "downloaded_count", "replaced", "replaced_run_id")


ERROR_CODE = "CASE user_id % 4 WHEN 0 THEN 'pdf_parse_failure' WHEN 1 THEN ' no_usable_text' WHEN 2 THEN '' END"
ERROR_TYPE = "CASE event_id % 3 WHEN 0 THEN 'env_failure' WHEN 1 THEN 'content_failure' END"


@query(f"""WITH q AS (SELECT event_id, coalesce(nullif(trim({ERROR_CODE}), ''), 'unknown_failure') AS c, coalesce(nullif({ERROR_TYPE}, ''), 'content_failure') AS t, CASE WHEN event_id % 2 = 0 THEN 'late ' || event_type END AS e, CASE WHEN event_id % 5 = 0 THEN 'own step' END AS step FROM events WHERE event_type = 'error')
    SELECT event_id, c AS error_code, t AS error_type, 'f' || CAST(event_id AS VARCHAR) || '.pdf' AS filename,
        CASE WHEN c = 'pdf_parse_failure' THEN 'PDF 结构可能有损坏或页表异常，自动链路没法稳定解析。' WHEN c = 'no_usable_text' THEN '自动提取和 OCR 都没恢复出可用正文，继续盲重试收益很低。' WHEN t = 'content_failure' THEN '这份文件更像内容本身有问题，不像运行环境故障。' ELSE coalesce(e, '这份文件需要人工复核。') END AS diagnosis,
        coalesce(step, CASE c WHEN 'pdf_parse_failure' THEN '确认文件是否损坏' WHEN 'no_usable_text' THEN '人工检查正文质量' ELSE '人工复核这份 PDF' END) AS next_step FROM q""")
def quarantine_case(spark, sf):
    rows = table(spark, sf, "events").where("event_type = 'error'").select(
        "event_id", both("'dir/f' || CAST(event_id AS VARCHAR) || '.pdf'").alias("path"), both(ERROR_CODE).alias("error_code"), both(ERROR_TYPE).alias("error_type"),
        F.when(F.col("event_id") % 2 == 0, F.concat(F.lit("late "), "event_type")).alias("error"), F.when(F.col("event_id") % 5 == 0, "own step").alias("next_step"),
    )
    return R.quarantine_entries(rows).select("event_id", "error_code", "error_type", "filename", "diagnosis", "next_step")


@query("""WITH f AS (SELECT l_orderkey AS b, CAST(l_linenumber AS VARCHAR) AS p FROM lineitem),
    s AS (SELECT b, CASE WHEN b % 11 = 0 AND p = '1' THEN '99' WHEN b % 13 = 0 AND p = '2' THEN '1' ELSE p END AS p, b % 17 = 0 AND p = '1' AS empty FROM f WHERE NOT (b % 7 = 0 AND p = '1')),
    e AS (SELECT b, count(*) AS n, count(*) FILTER (empty) AS empties FROM s GROUP BY b),
    o AS (SELECT s.b, count(*) FILTER (f.b IS NULL) AS outside FROM s LEFT JOIN (SELECT DISTINCT b, p FROM f) f USING (b, p) GROUP BY s.b),
    d AS (SELECT b, count(*) AS repeated FROM (SELECT b, p FROM s GROUP BY b, p HAVING count(*) > 1) GROUP BY b),
    x AS (SELECT b, count(*) AS n FROM f GROUP BY b)
    SELECT x.b AS batch, CASE WHEN x.b % 5 = 0 THEN 'not_successful' WHEN x.b % 19 = 0 THEN 'handled_count_mismatch' WHEN coalesce(e.n, 0) <> x.n THEN 'summary_count_mismatch' WHEN coalesce(outside, 0) > 0 THEN 'outside_batch' WHEN coalesce(repeated, 0) > 0 THEN 'duplicate' WHEN coalesce(empties, 0) > 0 THEN 'empty_entry' ELSE 'valid' END AS verdict
    FROM x LEFT JOIN e USING (b) LEFT JOIN o USING (b) LEFT JOIN d USING (b)""")
def summary_validate(spark, sf):
    f = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("batch"), F.col("l_linenumber").cast("string").alias("path"))
    b, p = F.col("batch"), F.col("path")
    moved = F.when((b % 11 == 0) & (p == "1"), "99").when((b % 13 == 0) & (p == "2"), "1").otherwise(p)
    own = f.where(~((b % 7 == 0) & (p == "1"))).select("batch", moved.alias("path"), F.lit("title").alias("title"), F.when((b % 17 == 0) & (p == "1"), " ").otherwise("text").alias("markdown"))
    done = f.groupBy("batch").agg(F.when(F.first("batch") % 5 == 0, "failed").otherwise(" Success").alias("status"), (F.count("*") + F.when(F.first("batch") % 19 == 0, 1).otherwise(0)).alias("handled_count"))
    return R.summary_verdicts(f, own, done)


PAYLOAD = """CASE event_id % 8 WHEN 0 THEN '<html>' WHEN 1 THEN '{"code": 1059}' WHEN 2 THEN '{"succeeded": false}' WHEN 3 THEN '{"code": 0, "resp_data": {"topics": {"a": 1}}}' WHEN 4 THEN '{"code": "0", "resp_data": {"topics": [{"a": 1}, 5, {"b": 2}]}}' WHEN 5 THEN '' WHEN 6 THEN '{"code": null, "succeeded": true, "resp_data": {"topics": []}}' ELSE '{"code": " 14210 ", "succeeded": true}' END"""


@query("""SELECT event_id, CASE WHEN user_id % 9 = 0 THEN 'api_status_' || CAST(400 + user_id % 5 AS VARCHAR) ELSE CASE event_id % 8 WHEN 0 THEN 'api_invalid_json' WHEN 1 THEN 'api_error_1059' WHEN 2 THEN 'api_error_unknown' WHEN 3 THEN 'api_invalid_topics' WHEN 7 THEN 'api_error_14210' END END AS reason,
    CASE WHEN user_id % 9 > 0 AND event_id % 8 = 4 THEN 2 ELSE 0 END AS topics, user_id % 9 > 0 AND event_id % 8 = 1 AS retryable FROM events""")
def payload_error_case(spark, sf):
    rows = table(spark, sf, "events").select("event_id", (F.col("user_id") % 9 > 0).alias("ok"), (F.col("user_id") % 5 + 400).cast("string").alias("status"), F.expr(PAYLOAD).alias("text"))
    rows = rows.select("event_id", files.payload_reason("ok", "status", "text").alias("reason"), files.payload_topics("ok", "status", "text").alias("t"))
    return rows.select("event_id", "reason", F.size("t").alias("topics"), F.coalesce(R.retryable("reason", ["1059"]), F.lit(False)).alias("retryable"))


@query("""WITH k AS (SELECT user_id, list_sort(list_distinct(list(event_type))) AS t FROM events GROUP BY user_id), c AS (SELECT user_id, t, CASE WHEN user_id % 4 = 0 THEN list_filter(['View', 'extra', 'view'], lambda x: TRUE) ELSE t END AS cur FROM k),
    e AS (SELECT user_id, CASE WHEN user_id % 4 = 0 THEN ['View', 'extra'] ELSE t END AS cur FROM c)
    SELECT user_id, array_to_string(cur, ',') AS effective, array_to_string(list_concat(cur, list_filter(['VIEW', 'new'], lambda x: NOT list_contains(list_transform(cur, lambda y: lower(y)), lower(x)))), ',') AS added, array_to_string(list_filter(cur, lambda x: lower(x) NOT IN ('view', 'error')), ',') AS removed FROM e""")
def overlay_case(spark, sf):
    rows = table(spark, sf, "events").groupBy("user_id").agg(F.array_sort(F.collect_set("event_type")).alias("base"))
    temporary = F.array(F.lit(" View"), F.lit(""), F.lit("extra"), F.lit("view"))
    rows = rows.select("user_id", R.effective(F.col("base"), temporary, F.col("user_id") % 4 == 0).alias("cur"))

    def shown(action, *terms):
        return F.array_join(R.updated(F.col("cur"), F.array(*map(F.lit, terms)), action), ",")

    return rows.select("user_id", F.array_join("cur", ",").alias("effective"), shown("add", "VIEW", "new").alias("added"), shown("remove", "VIEW", "Error").alias("removed"))


@query("""WITH k AS (SELECT user_id, list_sort(list_distinct(list(event_type))) AS t FROM events GROUP BY user_id)
    SELECT user_id, CASE WHEN user_id % 3 = 0 THEN 'own' ELSE array_to_string(list_filter(t, lambda x: x <> 'view'), ',') END AS standalone, CASE WHEN user_id % 2 = 0 THEN 'view' ELSE 'EU' END AS regions,
        CASE WHEN user_id % 3 = 0 THEN 'rates' ELSE coalesce(nullif(array_to_string(list_filter(['Error', 'rates'], lambda x: NOT list_contains(list_filter(t, lambda y: y <> 'view' OR user_id % 2 > 0), lower(x))), ','), ''), 'rates') END AS required FROM (SELECT user_id, t FROM k WHERE user_id % 2 = 0 OR user_id % 3 = 0)""")
def focus_rules(spark, sf):
    rows = table(spark, sf, "events").where("user_id % 2 = 0 or user_id % 3 = 0").groupBy("user_id").agg(F.array_sort(F.collect_set("event_type")).alias("match_keywords"))
    third = F.col("user_id") % 3 == 0
    rows = rows.withColumns({
        "standalone_keywords": F.when(third, F.array(F.lit(" own "), F.lit("OWN"))), "region_keywords": F.when(F.col("user_id") % 2 == 0, F.array(F.lit("view"))),
        "paired_topic_keywords": F.when(~third, F.array(F.lit("Error"), F.lit("rates"))),
    })
    out = R.rules(rows, ["EU"], ["rates"])
    return out.select("user_id", F.array_join("standalone_keywords", ",").alias("standalone"), F.array_join("region_keywords", ",").alias("regions"), F.array_join("region_required_keywords", ",").alias("required"))


@query("""WITH r AS (SELECT user_id, event_id, ts, max(CASE WHEN event_type <> 'error' THEN ts END) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM events)
    SELECT event_id, strftime(coalesce(before, TIMESTAMP '2023-12-31'), '%Y-%m-%d_%H-%M-%S') || '__to__' || strftime(ts, '%Y-%m-%d_%H-%M-%S') AS batch_dir FROM r""")
def window_cursor(spark, sf):
    runs = table(spark, sf, "events").select(F.col("user_id").alias("stream"), F.col("event_id").alias("run_id"), F.col("ts").alias("at"), F.lit(3).alias("planned"), F.when(F.col("event_type") == "error", 2).otherwise(3).alias("reconciled"))
    return R.cursor(runs, "2023-12-31 00:00:00").select(F.col("run_id").alias("event_id"), files.batch_dir("window_start", "window_end").alias("batch_dir"))


@query("WITH r AS (SELECT event_type, event_id, row_number() OVER (PARTITION BY event_type ORDER BY ts DESC, event_id DESC) AS k FROM events) SELECT event_type, event_id FROM r WHERE k <= 200")
def sent_keys_capped(spark, sf):
    return R.capped(table(spark, sf, "events").select("event_type", "event_id", "ts"), "event_type", ["ts", "event_id"]).select("event_type", "event_id")


@query("""SELECT event_id, coalesce(CASE WHEN event_id % 3 = 0 THEN 'core' END, CASE WHEN event_id % 4 > 0 THEN event_type END, 'unknown') AS reason,
    CASE WHEN event_id % 5 = 0 THEN 'never' ELSE strftime(ts, '%m-%d %H:%M') END || ' → ' || strftime(ts, '%m-%d %H:%M') AS window_line FROM events""")
def result_reason_window(spark, sf):
    rows = table(spark, sf, "events").select("event_id", F.when(F.col("event_id") % 3 == 0, " core ").alias("a"), F.when(F.col("event_id") % 4 > 0, F.col("event_type")).otherwise(" ").alias("b"), F.when(F.col("event_id") % 5 == 0, "never").otherwise(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")).alias("s"), F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("e"))
    return rows.select("event_id", R.result_reason("a", "b").alias("reason"), F.concat(files.display_time("s"), F.lit(" → "), files.display_time("e")).alias("window_line"))


@query("SELECT source AS workflow, sha256(string_agg('p' || CAST(doc_id AS VARCHAR) || chr(1) || sha256(text), chr(2) ORDER BY 'p' || CAST(doc_id AS VARCHAR) || chr(1) || sha256(text))) AS fingerprint FROM documents GROUP BY source")
def workflow_fingerprint(spark, sf):
    rows = table(spark, sf, "documents").select(F.col("source").alias("workflow"), both("'p' || CAST(doc_id AS VARCHAR)").alias("path"), "text")
    return R.fingerprint(rows, "workflow", "path", "text")
