"""Answers, dashboards, outcomes, backfills and scans: the rules of operators/answers.py on the test tables."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..operators import answers as A, dedup
from .base import NOTES, notes, query, table
from .files import NAME
from .results import both

SQUEEZED = "trim(regexp_replace(regexp_replace({}, '[#*`>]+', ' ', 'g'), '\\s+', ' ', 'g'))"
RANKED_SQL = f"r AS (SELECT row_number() OVER (ORDER BY n_chars DESC, doc_id) AS place, doc_id, title, text, source, report_date FROM notes QUALIFY place <= 40)"


def ranked(spark, sf):
    """The forty longest notes as ranked sources."""
    top = notes(spark, sf).orderBy(F.desc("n_chars"), "doc_id").limit(40)
    return top.withColumn("place", F.row_number().over(Window.orderBy(F.desc("n_chars"), "doc_id"))).withColumn("snippet", F.col("title"))


@query(f"""WITH {NOTES}, {RANKED_SQL} SELECT '- [S' || CAST(place AS VARCHAR) || '] ' || source || CASE WHEN doc_id % 2 = 0 THEN '（' || report_date || CASE WHEN doc_id % 3 = 0 THEN ' / B' ELSE '' END || '）' WHEN doc_id % 3 = 0 THEN '（B）' ELSE '' END
    || CASE WHEN {SQUEEZED.format('title')} <> '' THEN '：' || substr({SQUEEZED.format('title')}, 1, 220) ELSE '' END AS line FROM r""")
def evidence_lines(spark, sf):
    rows = ranked(spark, sf).withColumns({"date": F.when(F.col("doc_id") % 2 == 0, F.col("report_date")), "broker": F.when(F.col("doc_id") % 3 == 0, "B")})
    return rows.select(A.evidence_line(F.col("place"), "source", "date", "broker", "snippet").alias("line"))


RULES = [(["idiot", "scum"], "Tone is harsh"), (["erha"], "A word recurs"), (["no such word"], "Never told"), (["password"], "Secrets occur"), (["Whor", "edst"], "A word recurs")]


def _claim_sql(i, words, claim):
    hit = " OR ".join(f"contains(lower(text), '{w.lower()}')" for w in words)
    return f"SELECT {i} AS spot, '- [' || string_agg('S' || CAST(place AS VARCHAR), '、' ORDER BY place) || '] {claim}' AS claim FROM (SELECT place FROM r WHERE {hit} ORDER BY place LIMIT 4) HAVING count(*) > 0"


@query(f"WITH {NOTES}, {RANKED_SQL}, c AS ({' UNION ALL '.join(f'({_claim_sql(i, w, c)})' for i, (w, c) in enumerate(RULES))}), o AS (SELECT claim, min(spot) AS spot FROM c GROUP BY claim) SELECT CAST(row_number() OVER (ORDER BY spot, claim) AS INTEGER) AS place, claim FROM o")
def synthesis_claims(spark, sf):
    return A.claims(ranked(spark, sf), "What of the margin?", ["margin", "profit"], RULES)


@query(f"WITH {NOTES}, {RANKED_SQL}, c AS (SELECT place, '- [S' || CAST(place AS VARCHAR) || '] ' || substr({SQUEEZED.format('title')}, 1, 220) AS claim FROM r WHERE place <= 4 AND {SQUEEZED.format('title')} <> '') SELECT CAST(row_number() OVER (ORDER BY place) AS INTEGER) AS place, claim FROM c")
def snippet_claims(spark, sf):
    return A.claims(ranked(spark, sf), "What else?", ["margin", "profit"], RULES)


@query(f"""WITH {NOTES}, p AS (SELECT source, report_date, doc_id, row_number() OVER (PARTITION BY source ORDER BY report_date DESC, doc_id) AS k FROM notes),
    a AS (SELECT source AS page, string_agg('- ' || report_date || ' ' || CAST(doc_id AS VARCHAR), chr(10) ORDER BY k) AS l FROM p WHERE k <= 3 GROUP BY source),
    c AS (SELECT source, lang, count(*) AS n FROM notes GROUP BY ALL), b AS (SELECT source AS page, string_agg('- ' || lang || ': ' || CAST(n AS VARCHAR), chr(10) ORDER BY n DESC, lang) AS l FROM c GROUP BY source)
    SELECT page, '## Recent' || chr(10) || a.l || chr(10) || chr(10) || '## Languages' || chr(10) || b.l || chr(10) || chr(10) || '## Open' || chr(10) || '- 暂无' || chr(10) AS text FROM a JOIN b USING (page)""")
def theme_dashboard(spark, sf):
    docs = notes(spark, sf).select(F.col("source").alias("page"), "lang", "report_date", "doc_id")
    recent = dedup.top_per_key(docs, ["page"], 3, F.desc("report_date"), F.col("doc_id"))
    recent = recent.select("page", F.lit("Recent").alias("section"), F.col("rank").alias("place"), F.concat(F.lit("- "), "report_date", F.lit(" "), F.col("doc_id").cast("string")).alias("line"))
    counts = docs.groupBy("page", "lang").agg(F.count("*").alias("n"))
    counts = dedup.top_per_key(counts, ["page"], 12, F.desc("n"), F.col("lang")).select("page", F.lit("Languages").alias("section"), F.col("rank").alias("place"), A.counted_line("lang", "n").alias("line"))
    return A.rendered(recent.unionByName(counts), ["Recent", "Languages", "Open"])


STATE = "CASE user_id % 6 WHEN 0 THEN 'completed_with_quarantine' WHEN 1 THEN 'ack_failed' WHEN 2 THEN 'dry_run' WHEN 3 THEN 'idle_no_new_pdf' ELSE 'published' END"
RUN = "CASE event_id % 7 WHEN 0 THEN 'failed' WHEN 1 THEN 'env_failed' WHEN 2 THEN 'partial_success' WHEN 3 THEN 'waiting' WHEN 4 THEN 'paused' ELSE 'success' END"


@query(f"""WITH r AS (SELECT {RUN} AS status, {STATE} AS state, CAST(event_id % 2 AS INTEGER) AS ready, CAST(user_id % 5 AS INTEGER) AS published FROM events), s AS (SELECT CASE WHEN status = 'partial_success' AND ready = 0 AND published = 0 THEN 'failed' ELSE status END AS status, state FROM r)
    SELECT status, CASE WHEN status IN ('failed', 'env_failed') THEN 'failed' WHEN status = 'partial_success' THEN 'partial_success' WHEN state = 'completed_with_quarantine' THEN 'completed_with_quarantine' WHEN status IN ('waiting', 'paused') THEN 'waiting' WHEN state IN ('dry_run', 'idle_no_new_pdf') THEN 'noop' ELSE 'success' END AS outcome,
        CASE WHEN status IN ('failed', 'env_failed') THEN 'blocked' WHEN status = 'partial_success' THEN CASE WHEN state = 'ack_failed' THEN 'blocked' ELSE 'degraded' END WHEN state = 'completed_with_quarantine' OR status = 'paused' THEN 'degraded' ELSE 'healthy' END AS health, count(*) AS n FROM s GROUP BY ALL""")
def result_outcome(spark, sf):
    rows = table(spark, sf, "events").select(both(RUN).alias("status"), both(STATE).alias("state"), (F.col("event_id") % 2).alias("ready"), (F.col("user_id") % 5).alias("published"), F.lit(0).alias("quarantined"))
    status, outcome, health = A.run_outcome("status", "state", "ready", "published", "quarantined")
    return rows.groupBy(status.alias("status"), outcome.alias("outcome"), health.alias("health")).agg(F.count("*").alias("n"))


RESULT_TEXT = """CASE event_id % 5 WHEN 0 THEN '[plugins] x' || chr(10) || ' failed: ' || event_type || chr(10) || 'more' WHEN 1 THEN 'log' || chr(10) || '{"summary": "sum ' || event_type || '"}' WHEN 2 THEN '{"status": "old"}' || chr(10) || '  {"status": "' || event_type || '"}'
    WHEN 3 THEN '{"result": {"payloads": [{"text": " "}, {"text": "first ' || event_type || '\\nsecond"}]}}' ELSE '{broken' || chr(10) || 'z' END"""


@query("SELECT event_id, CASE event_id % 5 WHEN 0 THEN 'failed: ' || event_type WHEN 1 THEN 'sum ' || event_type WHEN 2 THEN event_type WHEN 3 THEN 'first ' || event_type ELSE '{broken' END AS summary FROM events")
def agent_error_summary(spark, sf):
    text = F.expr(RESULT_TEXT.replace("\\n", "\\\\n"))
    return table(spark, sf, "events").select("event_id", A.error_summary(text).alias("summary"))


@query("""SELECT user_id, sha256(CASE WHEN user_id % 3 = 0 THEN 'no json' ELSE '[{"exists":false,"label":"a","sha256":""},{"exists":true,"label":"b' || CAST(user_id % 4 AS VARCHAR) || '","sha256":"x"}]' END) AS version FROM (SELECT DISTINCT user_id FROM events)""")
def retry_version(spark, sf):
    label = F.concat(F.lit('{"label": "b'), (F.col("user_id") % 4).cast("string"), F.lit('", "exists": true, "sha256": "x"}'))
    other = F.lit('{"label": "a", "note": 1}, {"label": " "}')
    text = F.when(F.col("user_id") % 3 == 0, " no json").otherwise(F.concat(F.lit('{"records": ['), F.when(F.col("user_id") % 2 == 0, F.concat_ws(", ", label, other)).otherwise(F.concat_ws(", ", other, label)), F.lit("]}")))
    return table(spark, sf, "events").select("user_id").distinct().select("user_id", A.retry_version(text).alias("version"))


@query(f"WITH n AS (SELECT event_id, {NAME} AS path FROM events) SELECT event_id, 'summaries/b' || CAST(event_id % 3 AS VARCHAR) || '/' || regexp_replace(regexp_extract(path, '[^/]*$'), '(.)\\.[^.]*$', '\\1') || '.summary.md' AS path FROM n")
def summary_paths(spark, sf):
    return table(spark, sf, "events").select("event_id", A.summary_path(both("'b' || CAST(event_id % 3 AS VARCHAR)"), F.expr(NAME)).alias("path"))


@query("""WITH n AS (SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN 'own/' || source END AS pdf_path, CASE WHEN doc_id % 3 = 0 THEN ' ' WHEN doc_id % 3 = 1 THEN 'macro' END AS report_type FROM documents)
    SELECT doc_id, coalesce(pdf_path, 'db/' || CAST(doc_id AS VARCHAR)) AS pdf_path, CASE WHEN trim(coalesce(report_type, '')) <> '' THEN report_type WHEN doc_id % 5 > 0 THEN 'found' END AS report_type,
        array_to_string(list_filter([CASE WHEN pdf_path IS NULL THEN 'pdf_path' END, CASE WHEN trim(coalesce(report_type, '')) = '' AND doc_id % 5 > 0 THEN 'report_type' END], lambda x: x IS NOT NULL), ',') AS changed FROM n""")
def note_backfill(spark, sf):
    docs = table(spark, sf, "documents")
    kind = F.when(F.col("doc_id") % 3 == 0, " ").when(F.col("doc_id") % 3 == 1, "macro")
    own = docs.select("doc_id", F.when(F.col("doc_id") % 2 == 0, F.concat(F.lit("own/"), "source")).alias("pdf_path"), kind.alias("report_type"))
    reports = docs.select("doc_id", both("'db/' || CAST(doc_id AS VARCHAR)").alias("pdf_path"))
    found = docs.where("doc_id % 5 > 0").select("doc_id", F.lit("found").alias("report_type"))
    return A.backfilled(own, reports, found, "doc_id", ["pdf_path"], ["report_type"]).select("doc_id", "pdf_path", "report_type", F.array_join("changed_fields", ",").alias("changed"))


@query("""WITH t AS (SELECT event_id // 50 AS page, event_id, strftime(TIMESTAMP '2024-06-01' - to_hours(CAST(event_id AS INTEGER)), '%Y-%m-%dT%H:%M:%S') AS made FROM events), e AS (SELECT page, max(event_id) AS last FROM t GROUP BY page),
    s AS (SELECT min(e.page) AS stop FROM e JOIN t ON t.event_id = e.last WHERE t.made < '2024-05-01')
    SELECT page, '{"id":' || CAST(event_id AS VARCHAR) || ',"create_time":"' || made || '"}' AS topic FROM t, s WHERE stop IS NULL OR page <= stop""")
def paged_scan(spark, sf):
    at = F.date_format(F.timestamp_seconds(F.lit(1717200000) - F.col("event_id") * 3600), "yyyy-MM-dd'T'HH:mm:ss")
    topic = F.to_json(F.struct(F.col("event_id").alias("id"), at.alias("create_time")))
    rows = table(spark, sf, "events").select(F.floor(F.col("event_id") / 50).alias("page"), "event_id", topic.alias("topic"))
    topics = F.transform(F.array_sort(F.collect_list(F.struct("event_id", "topic"))), lambda x: x["topic"])
    pages = rows.groupBy("page").agg(F.concat(F.lit('{"succeeded": true, "resp_data": {"topics": ['), F.array_join(topics, ", "), F.lit("]}}")).alias("text"))
    return A.scanned(pages.select("page", F.lit(True).alias("ok"), F.lit("200").alias("status"), "text"), "2024-05-01").select("page", "topic")


@query("""WITH t AS (SELECT event_id AS spot, 'https://api.example.org/v2/' || event_type || '/topics?n=' || CAST(user_id % 7 AS VARCHAR) || CASE WHEN user_id % 2 = 0 THEN '&end_time=1' ELSE '' END AS url, event_id % 4 AS k FROM events WHERE event_type <> 'error')
    SELECT url, min(spot) AS first_at, min(CASE WHEN k IN (1, 2) THEN spot END) AS validated_at, contains(url, '&end_time=') AS supports_end_time FROM t GROUP BY url""")
def endpoint_discovery(spark, sf):
    url = both("'https://api.example.org/v2/' || event_type || '/topics?n=' || CAST(user_id % 7 AS VARCHAR) || CASE WHEN user_id % 2 = 0 THEN '&end_time=1' ELSE '' END")
    k = F.col("event_id") % 4
    body = F.when(k == 1, '{"resp_data": {"topics": []}}').when(k == 2, '{"resp_data": {"topics": [{"topic_id": 1, "create_time": "x"}]}}').when(k == 3, '{"resp_data": {"topics": [{"topic_id": 1}]}}').otherwise('{"resp_data": {"topics": []}}')
    traffic = table(spark, sf, "events").select(F.col("event_id").alias("at"), url.alias("url"), F.when(k == 0, "text/html").otherwise("Application/JSON; charset=utf-8").alias("content_type"), body.alias("body"))
    return A.endpoints(traffic, r"^https://api\.example\.org/v\d+/(?!error/)[a-z]+/topics\b")


@query("SELECT page_id FROM pages WHERE page_id % 50 IN (SELECT doc_id FROM documents WHERE doc_id % 3 = 0)")
def index_membership(spark, sf):
    pages = table(spark, sf, "pages").select("page_id", (F.col("page_id") % 50).cast("string").alias("name"))
    link = F.concat(F.lit("- [["), F.when(F.col("doc_id") % 3 == 0, "companies/").otherwise("themes/"), F.col("doc_id").cast("string"), F.lit("|shown]]"))
    index = table(spark, sf, "documents").select(link.alias("text"))
    return A.listed_pages(pages, "name", index, "text", "companies").select("page_id")


@query(f"WITH n AS (SELECT DISTINCT lower(regexp_extract({NAME}, '[^/]*$')) AS f FROM events) SELECT DISTINCT regexp_replace(regexp_replace(f, '\\.[a-z0-9]{{1,5}}$', ''), '[^\\pL\\pN]', '', 'g') AS name FROM n")
def archived_name_set(spark, sf):
    return A.archived_names(table(spark, sf, "events").select(F.expr(NAME).alias("path")))


@query("SELECT root, count(*) AS files FROM (SELECT unnest(['lib/p' || CAST(user_id % 5 AS VARCHAR) || '/' || event_type, 'lib/p' || CAST(user_id % 5 AS VARCHAR), 'lib']) AS root FROM events) GROUP BY root")
def library_roots(spark, sf):
    path = both("'lib/p' || CAST(user_id % 5 AS VARCHAR) || '/' || event_type || '/x.pdf'")
    return table(spark, sf, "events").select(F.explode(A.parents(path)).alias("root")).groupBy("root").agg(F.count("*").alias("files"))
