"""Run results: reasons, stale results, quarantine entries, summaries against their batch, overlays, windows and cursors."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.identity import blank, first_of
from ..functions.text import col

# Exit codes, what the log must hold (in lower case), and the reason; the first that holds counts.
EXIT_REASONS = [
    (20, (), "need_reauth"),
    (21, (), "blocked_browser_missing"),
    (22, ("browsertype.connect_over_cdp", "timeout"), "blocked_browser_cdp_unresponsive"),
    (22, ("cft cdp endpoint not ready",), "blocked_browser_endpoint_unavailable"),
    (22, (), "blocked_browser_unavailable_or_interrupted"),
    (23, (), "busy_locked"),
    (143, (), "task_interrupted_sigterm"),
    (124, (), "codex_exec_timeout"),
]
# Fixed value: what a log holds when a service's rules couldn't be read in time.
LATE_RULES = "timed out waiting for cloud requirements after"
# Why nothing was downloaded, by exit code.
NO_DOWNLOAD = {23: "busy_locked", 20: "need_reauth", 21: "blocked_browser", 22: "blocked_browser", 143: "task_interrupted"}


def no_download_reason(code: Column, downloaded: Column, given: Column) -> Column:
    """Why a run downloaded nothing: what it says itself if it ended well, else by its exit code."""
    out = F.when((code == 0) & (downloaded > 0), "downloaded").when(code == 0, F.coalesce(blank(given), F.lit("unknown")))
    for number, reason in NO_DOWNLOAD.items():
        out = out.when(code == number, reason)
    return out.otherwise("unknown")


def launcher_reason(log: Column, known: list[str]) -> Column:
    """The last reason that a launcher's own lines name, [BLOCKED] reason: ..., of the known ones; null without any."""
    lines = F.transform(F.split(log, "\\r\\n|\\r|\\n"), lambda x: F.btrim(x))
    named = F.transform(lines, lambda x: F.regexp_extract(x, r"^\[BLOCKED\]\s+([a-z0-9_]+):", 1))
    return F.try_element_at(F.filter(named, lambda x: x.isin(known)), F.lit(-1))


def reason_code(code: Column, downloaded: Column, given: Column, log: Column, known: list[str] = (), nothing: Column | None = None, killed: str | None = None, refused: str | None = None) -> Column:
    """The reason of a run's outcome, by priority: given, the launcher's, by exit code and log, success, why nothing was downloaded.

    killed: what a log holds, beside "terminated: 15", when a run ended itself.
    refused: the name of the script that a system without permission stops with code 126.
    """
    lower = F.lower(F.coalesce(log, F.lit("")))
    out = F.when(blank(given).isNotNull(), F.btrim(given))
    if known:
        named = launcher_reason(F.coalesce(log, F.lit("")), list(known))
        out = out.when(named.isNotNull(), named)
    for number, words, reason in EXIT_REASONS:
        if number == 143 and killed:
            out = out.when((code == 143) & F.contains(lower, F.lit("terminated: 15")) & F.contains(lower, F.lit(killed)), "self_terminated_codex_runner")
        hit = code == number
        for w in words:
            hit = hit & F.contains(lower, F.lit(w))
        out = out.when(hit, reason)
    if refused:
        out = out.when((code == 126) & F.contains(lower, F.lit("operation not permitted")) & F.contains(lower, F.lit(refused)), "blocked_documents_permission")
    out = out.when((code != 0) & F.contains(lower, F.lit(LATE_RULES)), "cloud_requirements_timeout").when(code != 0, "task_failed")
    nothing = blank(nothing) if nothing is not None else F.lit(None).cast("string")
    return out.when(downloaded > 0, "download_completed").otherwise(F.coalesce(nothing, F.lit("no_download_reason_unknown")))


def current_results(runs: DataFrame, results: DataFrame) -> DataFrame:
    """(run_id, exit_code, reason_code, window_start, window_end, downloaded_count, replaced, replaced_run_id): of each slot the result that belongs to its run.

    runs: (slot, run_id, exit_code, window_start, window_end, last_success, finished_at); results: the
    slot's stored result (slot, run_id, exit_code, reason_code, window_start, window_end,
    downloaded_count). A result of another run or another exit code is replaced by a
    row of a failed run; a run that left no result and ended well counts as failed with code 1.
    """
    r, s = runs.alias("r"), results.alias("s")
    both = r.join(s, F.col("r.slot") == F.col("s.slot"), "left")
    mine = F.coalesce((F.btrim("s.run_id") == F.col("r.run_id")) & (F.col("r.run_id") != "") & (F.col("s.exit_code") == F.col("r.exit_code")), F.lit(False))
    code = F.when(F.col("r.exit_code") == 0, 1).otherwise(F.col("r.exit_code"))
    none, zero = F.lit(None).cast("string"), F.lit(0)
    stub = {
        "exit_code": code, "reason_code": reason_code(code, zero, none, none), "window_start": first_of("r.window_start", "r.last_success"), "window_end": first_of("r.window_end", "r.finished_at"), "downloaded_count": zero,
    }
    own = [F.when(mine, F.col(f"s.{c}")).otherwise(value).alias(c) for c, value in stub.items()]
    return both.select("r.slot", "r.run_id", *own, (~mine).alias("replaced"), F.when(~mine, blank("s.run_id")).alias("replaced_run_id"))


# Which error it is (code, or type where the code doesn't tell), the diagnosis, the action and the next step.
QUARANTINE = [
    ("error_code", "pdf_parse_failure", "PDF 结构可能有损坏或页表异常，自动链路没法稳定解析。", "先人工打开 PDF；如果文件损坏，重新下载或换源后再重跑。", "确认文件是否损坏"),
    ("error_code", "no_usable_text", "自动提取和 OCR 都没恢复出可用正文，继续盲重试收益很低。", "先人工检查正文；如果是纯图片或水印太重，考虑换源或手动 OCR。", "人工检查正文质量"),
    ("error_type", "content_failure", "这份文件更像内容本身有问题，不像运行环境故障。", "人工复核 PDF 内容，再决定是放弃还是手动重跑。", None),
]
QUARANTINE_ELSE = ("这份文件需要人工复核。", "先人工复核，再决定下一步处理。", "人工复核这份 PDF")


def quarantine_entries(entries: DataFrame) -> DataFrame:
    """entries (path, filename, error_type, error_code, latest_error, error, ...) with blanks filled: a name from the path, the
    default type and code, and diagnosis, action and next step by the error where they aren't given."""

    def given(name: str) -> Column:
        return blank(F.btrim(F.col(name).cast("string"))) if name in entries.columns else F.lit(None).cast("string")

    rows = entries.withColumns({
        "path": F.coalesce(given("path"), F.lit("")), "filename": F.coalesce(given("filename"), F.element_at(F.split(F.coalesce(given("path"), F.lit("")), "/"), -1)),
        "error_type": F.coalesce(given("error_type"), F.lit("content_failure")), "error_code": F.coalesce(given("error_code"), F.lit("unknown_failure")),
        "latest_error": F.coalesce(given("latest_error"), given("error"), F.lit("")), "status": F.coalesce(given("status"), F.lit("needs_transform")),
    })

    def by_error(place: int, default: Column) -> Column:
        out = None
        for column, value, *texts in QUARANTINE:
            if texts[place] is not None:
                hit = F.col(column) == value
                out = F.when(hit, texts[place]) if out is None else out.when(hit, texts[place])
        return out.otherwise(default)

    own = [F.coalesce(blank("latest_error"), F.lit(QUARANTINE_ELSE[0])), F.lit(QUARANTINE_ELSE[1]), F.lit(QUARANTINE_ELSE[2])]
    return rows.withColumns({name: F.coalesce(given(name), by_error(i, own[i])) for i, name in enumerate(("diagnosis", "recommended_action", "next_step"))})


def summary_verdicts(batches: DataFrame, entries: DataFrame, results: DataFrame) -> DataFrame:
    """(batch, verdict): valid, or the first rule that a batch's summaries break.

    batches: (batch, path), a row each file; entries: (batch, path, title, markdown), a row each
    summary; results: (batch, status, handled_count). Rules: the status is success, the
    handled count and the number of summaries are the number of files, no summary is of
    another file or repeated, none lacks its title or text.
    """
    path = F.btrim(F.coalesce(F.col("path"), F.lit("")))
    files = batches.select("batch", path.alias("path")).where("path <> ''").distinct()
    expected = batches.select("batch", path.alias("path")).groupBy("batch").agg(F.count_if(F.col("path") != "").alias("expected"))
    own = entries.select("batch", path.alias("path"), (blank("title").isNull() | blank("markdown").isNull()).alias("empty"))
    each = own.groupBy("batch", "path").agg(F.count("*").alias("n"), F.bool_or("empty").alias("empty")).join(files.withColumn("there", F.lit(True)), ["batch", "path"], "left")
    sums = each.groupBy("batch").agg(F.sum("n").alias("summaries"), F.count_if(F.col("there").isNull()).alias("outside"), F.count_if(F.col("n") > 1).alias("repeated"), F.count_if("empty").alias("empty"))
    rows = expected.join(sums, "batch", "left").join(results, "batch", "left")
    zero = [F.coalesce(F.col(c), F.lit(0)).alias(c) for c in ("summaries", "outside", "repeated", "empty")]
    rows = rows.select("batch", "expected", *zero, F.lower(F.btrim(F.coalesce(F.col("status"), F.lit("")))).alias("status"), F.coalesce("handled_count", F.lit(-1)).alias("handled"))
    verdict = (
        F.when(F.col("status") != "success", "not_successful").when(F.col("handled") != F.col("expected"), "handled_count_mismatch").when(F.col("summaries") != F.col("expected"), "summary_count_mismatch")
        .when(F.col("outside") > 0, "outside_batch").when(F.col("repeated") > 0, "duplicate").when(F.col("empty") > 0, "empty_entry").otherwise("valid")
    )
    return rows.select("batch", verdict.alias("verdict"))


def listed(values: Column) -> Column:
    """A list's trimmed texts that aren't blank, each once whatever its case, in order."""
    values = F.filter(F.transform(F.coalesce(values, F.array().cast("array<string>")), lambda x: F.btrim(x)), lambda x: x.isNotNull() & (x != ""))
    start = F.array().cast("array<string>")
    return F.aggregate(values, start, lambda a, x: F.when(F.exists(a, lambda y: F.lower(y) == F.lower(x)), a).otherwise(F.concat(a, F.array(x))))


def effective(base: Column, temporary: Column, enabled: Column) -> Column:
    """The list that counts: the temporary one while it is enabled, even if it is empty, else the lasting one."""
    return F.when(F.coalesce(enabled, F.lit(False)), listed(temporary)).otherwise(listed(base))


def updated(current: Column, terms: Column, action: str) -> Column:
    """The list after an action: set, add or remove, whatever the case of the terms."""
    if action == "set":
        return listed(terms)
    if action == "add":
        return listed(F.concat(listed(current), listed(terms)))
    return F.filter(listed(current), lambda x: ~F.exists(listed(terms), lambda y: F.lower(y) == F.lower(x)))


def rules(config: DataFrame, regions: list[str], topics: list[str]) -> DataFrame:
    """config's rows with its keyword lists in their present names: standalone, region, region_required and exclude.

    Rows without standalone keywords take the exact, direct and matching ones of an older form,
    of the last those that aren't regions; paired keywords stand in for those that need a region,
    of which those that stand alone are left out. Missing regions and topics are the defaults.
    """

    def own(name: str) -> Column:
        return listed(F.col(name)) if name in config.columns else F.array().cast("array<string>")

    def first(a: Column, b: Column) -> Column:
        return F.when(F.size(a) > 0, a).otherwise(b)

    rows = config.withColumn("standalone_keywords", first(own("standalone_keywords"), listed(F.concat(own("exact_match_keywords"), own("direct_topic_keywords"), F.array_except(own("match_keywords"), own("region_keywords"))))))
    paired = F.filter(own("paired_topic_keywords"), lambda x: ~F.exists("standalone_keywords", lambda y: F.lower(y) == F.lower(x)))
    rows = rows.withColumn("region_required_keywords", first(first(own("region_required_keywords"), paired), F.array(*map(F.lit, topics))))
    rows = rows.withColumn("region_keywords", first(own("region_keywords"), F.array(*map(F.lit, regions))))
    return rows.withColumn("exclude_keywords", own("exclude_keywords"))


def cursor(runs: DataFrame, start: str) -> DataFrame:
    """Each run with its frozen window: from the last run before it that reconciled all its rows (or the start) up to its own time.

    runs: (stream, run_id, at, planned, reconciled). A run that left rows open doesn't advance the cursor: the
    next one reads its window again. The rows of a stream are ordered; the maximum that runs along needs no sort beside.
    """
    before = Window.partitionBy("stream").orderBy("at", "run_id").rowsBetween(Window.unboundedPreceding, -1)
    done = F.col("planned") == F.col("reconciled")
    begin = F.coalesce(F.max(F.when(done, F.col("at"))).over(before), F.lit(start).cast(runs.schema["at"].dataType))
    return runs.withColumn("window_start", begin).withColumn("window_end", F.col("at")).withColumn("advances", done)


def capped(sent: DataFrame, key: str, order: list[str], most: int = 200) -> DataFrame:
    """The last `most` rows of each key: what a bounded list of sent messages keeps."""
    w = Window.partitionBy(key).orderBy(*(F.desc(c) for c in order))
    return sent.withColumn("__place", F.row_number().over(w)).where(F.col("__place") <= most).drop("__place")


def result_reason(*codes: str, default: str = "unknown") -> Column:
    """The first of the columns that isn't blank, trimmed."""
    return F.btrim(F.coalesce(first_of(*codes), F.lit(default)))


def fingerprint(files: DataFrame, workflow: str, path: str, content: str) -> DataFrame:
    """(workflow, fingerprint): a hash of a workflow's files, by path and content, whatever their order."""
    part = F.concat_ws("\u0001", F.col(path), F.sha2(F.col(content).cast("string"), 256))
    return files.groupBy(workflow).agg(F.sha2(F.concat_ws("\u0002", F.array_sort(F.collect_list(part))), 256).alias("fingerprint"))


def retryable(reason: Column | str, codes: list[str]) -> Column:
    """Whether a payload's error is of a code that may pass."""
    reason = col(reason)
    return F.startswith(reason, F.lit("api_error_")) & F.substring(reason, 11, 1000).isin(codes)
