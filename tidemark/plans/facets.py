"""Facets, dashboards, roll-ups and reports."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import keywords as K, text as T
from ..operators import dedup, search
from .base import NOTES, inline, notes, query, sql_mentions, table
from .metadata import ENTITIES, SUBTHEMES, THEMES, entities, hits, scored_sql


@query("SELECT source AS value, count(*) AS n FROM documents GROUP BY source ORDER BY n DESC, source LIMIT 12")
def facet_counts(spark, sf):
    return table(spark, sf, "documents").groupBy(F.col("source").alias("value")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "value").limit(12)


@query(f"WITH {NOTES}, {scored_sql([(s, w) for _, s, w in SUBTHEMES])} SELECT name AS value, count(*) AS n FROM scored GROUP BY name")
def facet_subthemes(spark, sf):
    return entities(spark, sf, [(s, w) for _, s, w in SUBTHEMES]).groupBy(F.col("name").alias("value")).agg(F.count("*").alias("n"))


@query(f"WITH {NOTES}, {scored_sql(THEMES)} SELECT name AS theme, count(*) AS notes, min(doc_id) AS first_doc, sum(score) AS score FROM scored GROUP BY name")
def group_by_multivalue(spark, sf):
    return entities(spark, sf, THEMES).groupBy(F.col("name").alias("theme")).agg(F.count("*").alias("notes"), F.min("doc_id").alias("first_doc"), F.sum("score").alias("score"))


@query("""SELECT count(*) AS documents, count(*) FILTER (trim(text) = '') AS empty, count(*) FILTER (n_chars < 500) AS short, count(*) FILTER (n_chars >= 1800) AS full_size, count(*) FILTER (lang = 'en') AS english,
    count(DISTINCT source) AS sources, round(count(*) FILTER (n_chars >= 1800) * 100.0 / count(*), 1) AS full_pct, count(*) FILTER (contains(text, 'password')) AS secrets, count(*) - count(DISTINCT sha256(text)) AS surplus_copies FROM documents""")
def health_summary(spark, sf):
    n = F.col("n_chars")
    own = table(spark, sf, "documents").select("*", F.sha2("text", 256).alias("sha"))
    return own.agg(
        F.count("*").alias("documents"), F.count_if(F.trim("text") == "").alias("empty"), F.count_if(n < 500).alias("short"), F.count_if(n >= 1800).alias("full_size"), F.count_if(F.col("lang") == "en").alias("english"),
        F.countDistinct("source").alias("sources"), F.round(F.count_if(n >= 1800) * 100.0 / F.count("*"), 1).alias("full_pct"), F.count_if(F.contains("text", F.lit("password"))).alias("secrets"), (F.count("*") - F.countDistinct("sha")).alias("surplus_copies"),
    )


@query("SELECT (SELECT count(*) FROM orders WHERE o_orderpriority LIKE '%URGENT%') + (SELECT count(*) FROM events WHERE event_type LIKE 'err%') AS failed")
def like_count_two_tables(spark, sf):
    a = table(spark, sf, "orders").where("o_orderpriority like '%URGENT%'").agg(F.count("*").alias("n"))
    b = table(spark, sf, "events").where("event_type like 'err%'").agg(F.count("*").alias("n"))
    return a.unionByName(b).agg(F.sum("n").alias("failed"))


@query("SELECT lang, count(*) AS documents, count(l.doc_id) AS labelled, round(count(l.doc_id) * 100.0 / count(*), 1) AS pct, round(avg(l.quality), 4) AS quality FROM documents d LEFT JOIN labels l USING (doc_id) GROUP BY lang")
def coverage_pct(spark, sf):
    own = table(spark, sf, "documents").select("doc_id", "lang").join(table(spark, sf, "labels").withColumn("there", F.lit(1)), "doc_id", "left")
    return own.groupBy("lang").agg(F.count("*").alias("documents"), F.count("there").alias("labelled"), F.round(F.count("there") * 100.0 / F.count("*"), 1).alias("pct"), F.round(F.avg("quality"), 4).alias("quality"))


KIND = "CASE WHEN value < 20 THEN 'content' WHEN value < 60 THEN 'environment' ELSE 'transient' END"


@query(f"SELECT coalesce(kind, '*') AS kind, coalesce(step, '*') AS step, count(*) AS n, strftime(max(ts), '%Y-%m-%d %H:%M:%S') AS last_at FROM (SELECT {KIND} AS kind, CAST(user_id % 3 AS VARCHAR) AS step, ts FROM events WHERE event_type = 'error') GROUP BY GROUPING SETS ((kind), (step), ())")
def quarantine_rollup(spark, sf):
    table(spark, sf, "events").where("event_type = 'error'").select(F.expr(KIND).alias("kind"), (F.col("user_id") % 3).cast("string").alias("step"), "ts").createOrReplaceTempView("tidemark_quarantine")
    return spark.sql("SELECT coalesce(kind, '*') AS kind, coalesce(step, '*') AS step, count(*) AS n, date_format(max(ts), 'yyyy-MM-dd HH:mm:ss') AS last_at FROM tidemark_quarantine GROUP BY GROUPING SETS ((kind), (step), ())")


@query("SELECT event_type AS status, count(*) AS n, strftime(min(ts + INTERVAL 5 MINUTE), '%Y-%m-%d %H:%M:%S') AS next_retry FROM events WHERE value > 20 GROUP BY event_type")
def retry_status_counts(spark, sf):
    next_ = F.date_format(F.min(F.expr("ts + interval 5 minutes")), "yyyy-MM-dd HH:mm:ss")
    return table(spark, sf, "events").where("value > 20").groupBy(F.col("event_type").alias("status")).agg(F.count("*").alias("n"), next_.alias("next_retry"))


@query("SELECT user_id, string_agg(DISTINCT event_type, ',' ORDER BY event_type) AS types, count(*) FILTER (value > 30) AS retryable, bool_and(value > 1) AS all_positive, bool_or(event_type = 'error') AS any_error FROM events GROUP BY user_id")
def failure_flags_agg(spark, sf):
    return table(spark, sf, "events").groupBy("user_id").agg(
        F.array_join(F.array_sort(F.collect_set("event_type")), ",").alias("types"), F.count_if(F.col("value") > 30).alias("retryable"), F.bool_and(F.col("value") > 1).alias("all_positive"), F.bool_or(F.col("event_type") == "error").alias("any_error")
    )


@query("""WITH f AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate, l_partkey, l_suppkey) AS k FROM lineitem) WHERE k = 1),
    d AS (SELECT o_custkey, o_orderkey, o_orderdate, count(*) AS files FROM orders JOIN f ON l_orderkey = o_orderkey GROUP BY ALL),
    r AS (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS k FROM d) SELECT o_custkey, o_orderkey, files, files + 3 <= 20 AS fits FROM r WHERE k = 1""")
def doc_capacity_latest(spark, sf):
    lines = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), "l_linenumber").distinct().groupBy("o_orderkey").agg(F.count("*").alias("files"))
    own = table(spark, sf, "orders").join(lines, "o_orderkey")
    best = dedup.arg_max(own, ["o_custkey"], F.col("o_orderdate"), F.col("o_orderkey"), names=["o_orderkey", "files"])
    return best.withColumn("fits", F.col("files") + 3 <= 20)


@query("SELECT CAST(date_trunc('day', ts) AS DATE) AS day, count(*) AS calls, round(sum(value), 2) AS tokens, count(DISTINCT user_id) AS agents FROM events GROUP BY day")
def usage_totals(spark, sf):
    return table(spark, sf, "events").groupBy(F.to_date("ts").alias("day")).agg(F.count("*").alias("calls"), F.round(F.sum("value"), 2).alias("tokens"), F.countDistinct("user_id").alias("agents"))


@query("SELECT event_id, coalesce(CAST(json_extract_string(props, '$.k') AS BIGINT), 0) AS used, coalesce(CAST(json_extract_string(props, '$.missing') AS BIGINT), 0) AS cached FROM events")
def usage_projection(spark, sf):
    own = table(spark, sf, "events").select("event_id", F.from_json("props", "k bigint, missing bigint").alias("p"))
    return own.select("event_id", F.coalesce("p.k", F.lit(0)).alias("used"), F.coalesce("p.missing", F.lit(0)).alias("cached"))


@query("SELECT event_type, count(*) FILTER (ts >= TIMESTAMP '2024-01-24') AS recent, count(*) AS total FROM events GROUP BY event_type")
def recent_and_total_counts(spark, sf):
    return table(spark, sf, "events").groupBy("event_type").agg(F.count_if(F.expr("ts >= timestamp_ntz'2024-01-24 00:00:00'")).alias("recent"), F.count("*").alias("total"))


ALIAS = "regexp_extract(title, '^([A-Z][a-z]{3,8}) ', 1)"


@query(f"WITH {NOTES}, a AS (SELECT {ALIAS} AS alias, doc_id FROM notes), r AS (SELECT alias, doc_id, row_number() OVER (PARTITION BY alias ORDER BY doc_id) AS k, count(*) OVER (PARTITION BY alias) AS n FROM a WHERE alias <> '') SELECT alias, max(n) AS n, string_agg(CAST(doc_id AS VARCHAR), ',' ORDER BY doc_id) AS examples FROM r WHERE k <= 3 GROUP BY alias HAVING max(n) > 1")
def candidate_alias_counts(spark, sf):
    own = notes(spark, sf).select(F.regexp_extract("title", "^([A-Z][a-z]{3,8}) ", 1).alias("alias"), "doc_id").where("alias <> ''")
    counts = own.groupBy("alias").agg(F.count("*").alias("n")).where("n > 1")
    firsts = dedup.top_per_key(own, ["alias"], 3, F.col("doc_id")).groupBy("alias").agg(F.array_join(F.transform(F.array_sort(F.collect_list("doc_id")), lambda x: x.cast("string")), ",").alias("examples"))
    return counts.join(firsts, "alias").select("alias", "n", "examples")


@query("""WITH c AS (SELECT o_custkey, count(*) AS n, count(*) FILTER (o_orderstatus = 'F') AS ok, count(*) FILTER (o_orderstatus = 'P') AS bad FROM orders GROUP BY o_custkey)
    SELECT CASE WHEN ok = n THEN 'success' WHEN ok > 0 AND bad > 0 THEN 'partial' WHEN bad = n THEN 'failed' ELSE 'waiting' END AS outcome, count(*) AS runs FROM c GROUP BY outcome""")
def run_outcome_case(spark, sf):
    s = F.col("o_orderstatus")
    own = table(spark, sf, "orders").groupBy("o_custkey").agg(F.count("*").alias("n"), F.count_if(s == "F").alias("ok"), F.count_if(s == "P").alias("bad"))
    outcome = F.expr("case when ok = n then 'success' when ok > 0 and bad > 0 then 'partial' when bad = n then 'failed' else 'waiting' end")
    return own.groupBy(outcome.alias("outcome")).agg(F.count("*").alias("runs"))


FOCUS = ["erha", "the"]


@query(f"WITH {NOTES} SELECT doc_id, {hits('title', FOCUS)} * 20 + {hits('text', FOCUS)} AS focus FROM notes")
def focus_score(spark, sf):
    return notes(spark, sf).select("doc_id", (K.mentions("title", FOCUS) * 20 + K.mentions("text", FOCUS)).alias("focus"))


@query(f"""WITH {NOTES}, l AS (SELECT lang, doc_id, CASE WHEN n_chars % 2 = 0 THEN 'bull' ELSE 'bear' END AS side, title FROM notes), r AS (SELECT *, row_number() OVER (PARTITION BY lang, side ORDER BY doc_id) AS k FROM l)
    SELECT lang, side, doc_id, title FROM r WHERE k <= 4""")
def bull_bear_lines(spark, sf):
    own = notes(spark, sf).select("lang", F.when(F.col("n_chars") % 2 == 0, "bull").otherwise("bear").alias("side"), "doc_id", "title")
    return dedup.top_per_key(own, ["lang", "side"], 4, F.col("doc_id")).drop("rank")


@query("SELECT d.doc_id, d.source FROM documents d LEFT JOIN labels l USING (doc_id) WHERE l.quality = 0 OR l.toxic = 1 OR d.n_chars < 200")
def saved_view_needs_review(spark, sf):
    own = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id", "left")
    return own.where("quality = 0 or toxic = 1 or n_chars < 200").select("doc_id", "source")


@query(f"WITH {NOTES}, {scored_sql(THEMES)}, h AS (SELECT DISTINCT doc_id FROM scored WHERE title_hits > 0 OR body_hits >= 2) SELECT doc_id, report_date FROM notes SEMI JOIN h USING (doc_id) WHERE report_date >= '2024-06-01' ORDER BY report_date DESC, doc_id LIMIT 40")
def recent_high_value(spark, sf):
    docs = notes(spark, sf)
    themed = K.mentions("text", [w for _, words in THEMES for w in words])
    ok = F.lit(False)
    for _, words in THEMES:
        ok = ok | (K.mentions("title", words) > 0) | (K.mentions("text", words) >= 2)
    return docs.where((F.col("report_date") >= "2024-06-01") & (themed > 0) & ok).orderBy(F.desc("report_date"), "doc_id").limit(40).select("doc_id", "report_date")


@query("""WITH r AS (SELECT l_orderkey, l_partkey, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) AS i, count(*) OVER (PARTITION BY l_orderkey) AS n FROM lineitem)
    SELECT l_orderkey, string_agg(CAST(l_partkey AS VARCHAR), ',' ORDER BY i) || CASE WHEN max(n) > 3 THEN ' and ' || CAST(max(n) - 3 AS VARCHAR) || ' more' ELSE '' END AS preview FROM r WHERE i <= 3 GROUP BY l_orderkey""")
def preview_with_remainder(spark, sf):
    own = table(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey", "l_suppkey"))).alias("f"))
    shown = F.array_join(F.transform(F.slice("f", 1, 3), lambda x: x["l_partkey"].cast("string")), ",")
    more = F.when(F.size("f") > 3, F.concat(F.lit(" and "), (F.size("f") - 3).cast("string"), F.lit(" more"))).otherwise("")
    return own.select("l_orderkey", F.concat(shown, more).alias("preview"))


# Resolutions tried in turn, and the limits of a page image.
DPIS, PIXELS, SIDE, TILE, OVERLAP, TILES, BUDGET = (200, 150, 120, 100), 25_000_000, 30_000, 12_000, 240, 24, 1_200_000_000
WIDTH, HEIGHT = "(100 + l_quantity * 40)", "(200 + l_extendedprice / 10)"


def _plan() -> list[str]:
    def side(x, dpi):
        return f"greatest(1, CAST(ceil({x} * {dpi} / 72.0) AS BIGINT))"

    fits = [(d, f"{side(WIDTH, d)} <= {SIDE} AND {side(HEIGHT, d)} <= {SIDE} AND {side(WIDTH, d)} * {side(HEIGHT, d)} <= {PIXELS}") for d in DPIS]
    dpi = "CASE " + " ".join(f"WHEN {c} THEN {d}" for d, c in fits) + f" ELSE {DPIS[-1]} END"
    strategy = f"CASE WHEN {fits[0][1]} THEN 'standard' WHEN {' OR '.join('(' + c + ')' for _, c in fits[1:])} THEN 'adaptive' ELSE 'tiled' END"
    tile = f"least({TILE}, {SIDE}, CAST(floor({PIXELS} / {side(WIDTH, DPIS[-1])}) AS BIGINT))"
    tiles = f"greatest(1, CAST(ceil(greatest({side(HEIGHT, DPIS[-1])} - {OVERLAP}, 1) / ({tile} - {OVERLAP})) AS BIGINT))"
    pixels = "CASE " + " ".join(f"WHEN {c} THEN {side(WIDTH, d)} * {side(HEIGHT, d)}" for d, c in fits) + f" ELSE {side(WIDTH, DPIS[-1])} * {side(HEIGHT, DPIS[-1])} + {side(WIDTH, DPIS[-1])} * {OVERLAP} * ({tiles} - 1) END"
    return [f"{dpi} AS dpi", f"{strategy} AS strategy", f"{pixels} AS pixels"]


@query(f"SELECT strategy, dpi, count(*) AS pages, CAST(sum(pixels) AS BIGINT) AS pixels FROM (SELECT {', '.join(_plan())} FROM lineitem) GROUP BY strategy, dpi")
def page_plan_case(spark, sf):
    own = table(spark, sf, "lineitem").selectExpr(*_plan())
    return own.groupBy("strategy", "dpi").agg(F.count("*").alias("pages"), F.sum("pixels").alias("pixels"))


@query(f"SELECT l_orderkey, CAST(sum(pixels) AS BIGINT) AS pixels, sum(pixels) <= 60000000 AS within_budget, CASE WHEN count(DISTINCT strategy) = 1 THEN max(strategy) ELSE 'mixed' END AS strategy FROM (SELECT l_orderkey, {', '.join(_plan())} FROM lineitem) GROUP BY l_orderkey")
def page_budget_sum(spark, sf):
    own = table(spark, sf, "lineitem").selectExpr("l_orderkey", *_plan())
    mixed = F.when(F.min("strategy") == F.max("strategy"), F.max("strategy")).otherwise("mixed")
    return own.groupBy("l_orderkey").agg(F.sum("pixels").alias("pixels"), (F.sum("pixels") <= 60_000_000).alias("within_budget"), mixed.alias("strategy"))


@query("SELECT o_orderkey, CAST(100 + o_orderkey % 500 AS DOUBLE) AS width, CAST(200 + o_custkey % 900 AS DOUBLE) AS height FROM orders")
def geometry_parse(spark, sf):
    text = F.format_string("Page %d size: %d x %d pts", F.lit(1), F.lit(100) + F.col("o_orderkey") % 500, F.lit(200) + F.col("o_custkey") % 900)
    found = F.regexp_extract_all(text, F.lit(r"size:\s+([\d.]+) x ([\d.]+) pts"), F.lit(1))
    other = F.regexp_extract_all(text, F.lit(r"size:\s+([\d.]+) x ([\d.]+) pts"), F.lit(2))
    rows = table(spark, sf, "orders").select("o_orderkey", F.explode(F.arrays_zip(found.alias("w"), other.alias("h"))).alias("g"))
    return rows.select("o_orderkey", F.col("g")["w"].cast("double").alias("width"), F.col("g")["h"].cast("double").alias("height"))


BUCKETS = [(["idiot", "scum"], "risks"), (["erha", "dans"], "disagreements"), (["ention", "und"], "changes")]


@query("WITH l AS (SELECT unnest(str_split(text, chr(10))) AS line FROM documents) SELECT CASE WHEN contains(line, 'idiot') OR contains(line, 'scum') THEN 'risks' WHEN contains(line, 'erha') OR contains(line, 'dans') THEN 'disagreements' WHEN contains(line, 'ention') OR contains(line, 'und') THEN 'changes' ELSE 'consensus' END AS bucket, count(*) AS lines FROM l GROUP BY bucket")
def line_bucket_case(spark, sf):
    lines = table(spark, sf, "documents").select(F.explode(F.split("text", "\n")).alias("line"))
    return lines.groupBy(T.ordered_case(F.col("line"), BUCKETS, "consensus").alias("bucket")).agg(F.count("*").alias("lines"))


@query("""WITH m AS (SELECT item_id, doc_id FROM benchmark b JOIN documents d ON contains(lower(d.text), lower(split_part(b.text, ' ', 2)))),
    r AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY doc_id) AS k FROM m) SELECT item_id, string_agg('S' || CAST(doc_id AS VARCHAR), ',' ORDER BY doc_id) AS refs FROM r WHERE k <= 4 GROUP BY item_id""")
def evidence_refs(spark, sf):
    """Each item's word is looked up in all documents; the items, a stated set of queries, meet them in blocks."""
    words = table(spark, sf, "benchmark").select("item_id", F.lower(F.split_part("text", F.lit(" "), F.lit(2))).alias("word"))
    docs = table(spark, sf, "documents").select("doc_id", F.lower("text").alias("body"))
    held = F.filter("block", lambda x: F.contains(F.col("body"), x["word"]))
    found = docs.crossJoin(search.in_blocks(words, "item_id", 64)).select("doc_id", F.explode(F.transform(held, lambda x: x["item_id"])).alias("item_id"))
    firsts = dedup.top_per_key(found, ["item_id"], 4, F.col("doc_id")).groupBy("item_id").agg(F.array_sort(F.collect_list("doc_id")).alias("d"))
    return firsts.select("item_id", F.array_join(F.transform("d", lambda x: F.concat(F.lit("S"), x.cast("string"))), ",").alias("refs"))


@query(f"""WITH {NOTES}, o AS (SELECT lang, doc_id, report_date, substr(report_date, 1, 7) = max(substr(report_date, 1, 7)) OVER (PARTITION BY lang) AS newest FROM notes),
    l AS (SELECT *, row_number() OVER (PARTITION BY lang, newest ORDER BY report_date DESC, doc_id) AS i FROM o),
    b AS (SELECT *, CASE WHEN newest AND i <= 4 THEN 'latest' ELSE 'background' END AS bucket FROM l),
    r AS (SELECT *, row_number() OVER (PARTITION BY lang, bucket ORDER BY report_date DESC, doc_id) AS k FROM b) SELECT lang, bucket, doc_id, report_date FROM r WHERE k <= 4""")
def recency_buckets(spark, sf):
    # The eight newest of a language are all that can be shown; they are cut per task before the shuffle.
    own = dedup.top_per_key(notes(spark, sf).select("lang", "doc_id", "report_date"), ["lang"], 8, F.desc("report_date"), F.col("doc_id"))
    month = F.substring("report_date", 1, 7)
    newest = own.withColumn("newest", month == F.max(month).over(Window.partitionBy("lang")))
    place = F.row_number().over(Window.partitionBy("lang", "newest").orderBy(F.desc("report_date"), "doc_id"))
    split = newest.withColumn("bucket", F.when(F.col("newest") & (place <= 4), "latest").otherwise("background"))
    return dedup.top_per_key(split.drop("rank"), ["lang", "bucket"], 4, F.desc("report_date"), F.col("doc_id")).select("lang", "bucket", "doc_id", "report_date")
