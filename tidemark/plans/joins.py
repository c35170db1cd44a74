"""Upserts, reconciliation and lookups."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import identity as I, text as T
from ..operators import dedup, merge, reconcile
from ..sources import files
from .base import NOTES, inline, notes, query, table, values

INCOMING = "SELECT c_custkey AS k, CASE WHEN c_custkey % 4 = 0 THEN '' ELSE 'new ' || c_name END AS name, CASE WHEN c_custkey % 6 = 0 THEN '' WHEN c_custkey % 6 = 1 THEN 'e' END AS error FROM customer WHERE c_custkey % 2 = 0 OR c_custkey % 3 = 1"
STORED = "SELECT c_custkey AS k, c_name AS name, c_mktsegment AS error FROM customer WHERE c_custkey % 5 <> 0"


def _stored(spark, sf):
    return table(spark, sf, "customer").where("c_custkey % 5 <> 0").select(F.col("c_custkey").alias("k"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("error"))


def _incoming(spark, sf):
    k = F.col("c_custkey")
    name = F.when(k % 4 == 0, "").otherwise(F.concat(F.lit("new "), "c_name"))
    error = F.when(k % 6 == 0, "").when(k % 6 == 1, "e")
    return table(spark, sf, "customer").where((k % 2 == 0) | (k % 3 == 1)).select(k.alias("k"), name.alias("name"), error.alias("error"))


@query(f"WITH a AS ({STORED}), b AS ({INCOMING}) SELECT coalesce(a.k, b.k) AS k, coalesce(nullif(trim(b.name), ''), a.name) AS name, coalesce(b.error, a.error) AS error FROM a FULL JOIN b ON a.k = b.k")
def upsert_merge(spark, sf):
    return merge.upsert(_stored(spark, sf), _incoming(spark, sf), "k", clearing=("error",))


@query(f"WITH a AS ({STORED}), b AS ({INCOMING}) SELECT a.k, CASE WHEN b.k IS NULL THEN a.name ELSE b.name END AS name, CASE WHEN b.k IS NULL THEN a.error ELSE b.error END AS error FROM a LEFT JOIN b ON a.k = b.k")
def metadata_overwrite(spark, sf):
    return merge.overwrite(_stored(spark, sf), _incoming(spark, sf), "k", ["name", "error"])


@query(f"WITH a AS ({STORED}), b AS ({INCOMING}) SELECT b.k, sha256(b.name) AS content_hash FROM b WHERE NOT EXISTS (SELECT 1 FROM a WHERE a.k = b.k AND a.name = b.name)")
def changed_rows_only(spark, sf):
    return merge.changed_only(_stored(spark, sf), _incoming(spark, sf), "k", "name").select("k", "content_hash")


@query(f"WITH a AS ({STORED}), b AS ({INCOMING}) SELECT a.k, coalesce(nullif(trim(a.error), ''), b.error) AS error, array_to_string(list_filter([CASE WHEN coalesce(trim(a.error), '') = '' AND coalesce(b.error, '') <> '' THEN 'error' END], lambda x: x IS NOT NULL), ',') AS changed FROM a LEFT JOIN b ON a.k = b.k")
def fill_missing_merge(spark, sf):
    a, b = _stored(spark, sf), _incoming(spark, sf).select("k", F.col("error").alias("more"))
    filled = F.coalesce(I.blank("error"), F.col("more"))
    changed = F.array_compact(F.array(F.when(I.blank("error").isNull() & I.blank("more").isNotNull(), F.lit("error"))))
    return a.join(b, "k", "left").select("k", filled.alias("error"), F.array_join(changed, ",").alias("changed"))


@query("SELECT event_id, coalesce(c_name, 'user ' || CAST(user_id AS VARCHAR)) AS name, coalesce(c_mktsegment, 'none') AS segment FROM events LEFT JOIN customer ON c_custkey = user_id AND c_custkey % 2 = 0")
def event_backfill_join(spark, sf):
    known = table(spark, sf, "customer").where("c_custkey % 2 = 0").select(F.col("c_custkey").alias("user_id"), "c_name", "c_mktsegment")
    return table(spark, sf, "events").join(known, "user_id", "left").select("event_id", F.coalesce("c_name", F.concat(F.lit("user "), F.col("user_id").cast("string"))).alias("name"), F.coalesce("c_mktsegment", F.lit("none")).alias("segment"))


@query("SELECT l_orderkey, l_linenumber, l_partkey, 'part ' || CAST(l_partkey AS VARCHAR) AS filename, coalesce(p_name, 'unknown') AS title FROM lineitem LEFT JOIN part ON p_partkey = l_partkey")
def batch_to_report_rows(spark, sf):
    lines = table(spark, sf, "lineitem")
    batches = lines.groupBy("l_orderkey").agg(F.collect_list(F.struct("l_linenumber", "l_partkey")).alias("files"))
    items = batches.select("l_orderkey", F.explode("files").alias("f")).select("l_orderkey", "f.*")
    named = items.join(table(spark, sf, "part").select(F.col("p_partkey").alias("l_partkey"), "p_name"), "l_partkey", "left")
    return named.select("l_orderkey", "l_linenumber", "l_partkey", F.concat(F.lit("part "), F.col("l_partkey").cast("string")).alias("filename"), F.coalesce("p_name", F.lit("unknown")).alias("title"))


@query("SELECT l_orderkey AS batch, count(*) AS files, strftime(max(l_shipdate), '%Y-%m-%d') AS latest, string_agg(CAST(l_partkey AS VARCHAR), ',' ORDER BY l_shipdate, l_linenumber, l_partkey) AS parts FROM lineitem GROUP BY l_orderkey")
def batch_build_ordered(spark, sf):
    rows = table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("batch"))
    own = rows.agg(F.count("*").alias("files"), F.date_format(F.max("l_shipdate"), "yyyy-MM-dd").alias("latest"), F.array_sort(F.collect_list(F.struct("l_shipdate", "l_linenumber", "l_partkey"))).alias("f"))
    return own.select("batch", "files", "latest", F.array_join(F.transform("f", lambda x: x["l_partkey"].cast("string")), ",").alias("parts"))


@query("""SELECT 'pending' AS state, count(*) AS n, sum(o_orderkey) AS keys FROM orders WHERE o_orderstatus = 'O' AND o_custkey % 3 <> 0
    UNION ALL SELECT 'known', count(*), sum(o_orderkey) FROM orders WHERE o_orderstatus <> 'O' OR o_custkey % 3 = 0""")
def ack_move_pending(spark, sf):
    own = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    pending, known = own.where("o_orderstatus = 'O'"), own.where("o_orderstatus <> 'O'")
    still, after = merge.moved(pending, known, own.where("o_custkey % 3 = 0"), "o_orderkey")
    count = [F.count("*").alias("n"), F.sum("o_orderkey").alias("keys")]
    return still.agg(*count).withColumn("state", F.lit("pending")).unionByName(after.agg(*count).withColumn("state", F.lit("known")))


@query(f"WITH {NOTES}, a AS (SELECT DISTINCT sha FROM notes WHERE doc_id % 4 = 0) SELECT doc_id, CASE WHEN a.sha IS NULL THEN 'archive' ELSE 'satisfied' END AS outcome FROM notes LEFT JOIN a USING (sha) WHERE doc_id % 4 <> 0")
def archive_dedup_by_sha(spark, sf):
    own = notes(spark, sf).select("doc_id", "sha")
    there = own.where("doc_id % 4 = 0").select("sha").distinct().withColumn("there", F.lit(True))
    return own.where("doc_id % 4 <> 0").join(there, "sha", "left").select("doc_id", F.when(F.col("there"), "satisfied").otherwise("archive").alias("outcome"))


@query("SELECT s_suppkey, s_name, n_name, s_acctbal > 0 AS solvent FROM supplier LEFT JOIN nation ON n_nationkey = s_nationkey AND n_regionkey = 1")
def scan_enrich_left_join(spark, sf):
    known = table(spark, sf, "nation").where("n_regionkey = 1").select(F.col("n_nationkey").alias("s_nationkey"), "n_name")
    return table(spark, sf, "supplier").join(known, "s_nationkey", "left").select("s_suppkey", "s_name", "n_name", (F.col("s_acctbal") > 0).alias("solvent"))


@query("SELECT e.event_id, c.c_name, c.c_mktsegment FROM events e LEFT JOIN customer c ON c.c_custkey = e.user_id WHERE c.c_mktsegment = 'BUILDING' AND e.value > 10")
def search_join_filter(spark, sf):
    joined = table(spark, sf, "events").join(table(spark, sf, "customer"), F.col("c_custkey") == F.col("user_id"), "left")
    return joined.where("c_mktsegment = 'BUILDING' and value > 10").select("event_id", "c_name", "c_mktsegment")


@query("SELECT o_orderkey, o_totalprice, coalesce(c_name, '') AS c_name FROM orders LEFT JOIN customer ON c_custkey = o_custkey WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_quantity >= 50)")
def details_left_join(spark, sf):
    ids = table(spark, sf, "lineitem").where("l_quantity >= 50").select(F.col("l_orderkey").alias("o_orderkey"))
    own = table(spark, sf, "orders").join(ids, "o_orderkey", "left_semi")
    return own.join(table(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_name"), "o_custkey", "left").select("o_orderkey", "o_totalprice", F.coalesce("c_name", F.lit("")).alias("c_name"))


LOOSE = "regexp_replace(lower(name), '[^a-z0-9]', '', 'g')"
FILES_SQL = f"""f AS (SELECT *, {LOOSE} AS loose FROM (SELECT c_custkey AS file, CASE WHEN c_custkey % 2 = 0 THEN c_name ELSE upper(replace(c_name, '#', ' ')) END AS name FROM customer)),
    p AS (SELECT *, {LOOSE} AS loose FROM (SELECT c_custkey AS item, c_name AS name FROM customer WHERE c_custkey % 7 <> 0))"""


def _files_and_plan(spark, sf):
    own = table(spark, sf, "customer")
    loose = F.regexp_replace(F.lower("name"), "[^a-z0-9]", "")
    shown = F.when(F.col("c_custkey") % 2 == 0, F.col("c_name")).otherwise(F.upper(F.replace("c_name", F.lit("#"), F.lit(" "))))
    have = own.select(F.col("c_custkey").alias("file"), shown.alias("name")).withColumn("loose", loose)
    plan = own.where("c_custkey % 7 <> 0").select(F.col("c_custkey").alias("item"), F.col("c_name").alias("name")).withColumn("loose", loose)
    return have, plan


@query(f"WITH {FILES_SQL}, e AS (SELECT name, min(item) AS item FROM p GROUP BY name), l AS (SELECT loose, min(item) AS item FROM p GROUP BY loose) SELECT file, coalesce(e.item, l.item) AS item, CASE WHEN e.item IS NOT NULL THEN 'exact' WHEN l.item IS NOT NULL THEN 'normalized' END AS matched_by FROM f LEFT JOIN e ON e.name = f.name LEFT JOIN l ON l.loose = f.loose")
def plan_match_prefer_exact(spark, sf):
    have, plan = _files_and_plan(spark, sf)
    return reconcile.prefer_exact(have, plan, "name", "loose", "item").select("file", F.col("plan")["item"].alias("item"), "matched_by")


@query(f"WITH {FILES_SQL} SELECT file, name FROM f WHERE loose NOT IN (SELECT loose FROM p)")
def plan_anti_join(spark, sf):
    have, plan = _files_and_plan(spark, sf)
    return reconcile.missing(have, plan, ["loose"]).select("file", "name")


@query("SELECT o_orderkey, o_custkey FROM orders o WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o.o_orderkey AND l_returnflag = 'A') AND NOT EXISTS (SELECT 1 FROM events WHERE user_id = o.o_custkey)")
def missing_candidates_anti(spark, sf):
    own = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    by_id = table(spark, sf, "lineitem").where("l_returnflag = 'A'").select(F.col("l_orderkey").alias("o_orderkey"))
    by_name = table(spark, sf, "events").select(F.col("user_id").alias("o_custkey"))
    return reconcile.missing(reconcile.missing(own, by_id, ["o_orderkey"]), by_name, ["o_custkey"])


@query(f"WITH {NOTES}, r AS (SELECT *, row_number() OVER (PARTITION BY title ORDER BY doc_id) AS k FROM notes WHERE doc_id % 3 <> 0 AND title NOT IN (SELECT title FROM notes WHERE doc_id % 3 = 0)) SELECT doc_id, title FROM r WHERE k = 1")
def archived_anti_join(spark, sf):
    own = notes(spark, sf).select("doc_id", "title")
    fresh = own.where("doc_id % 3 <> 0").join(own.where("doc_id % 3 = 0").select("title").distinct(), "title", "left_anti")
    return fresh.groupBy("title").agg(F.min("doc_id").alias("doc_id")).select("doc_id", "title")


@query("SELECT o_orderkey, c_name, n_name FROM orders LEFT JOIN customer ON c_custkey = o_custkey AND c_acctbal > 0 LEFT JOIN nation ON n_nationkey = c_nationkey AND n_regionkey <> 2")
def backfill_double_left(spark, sf):
    own = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    known = table(spark, sf, "customer").where("c_acctbal > 0").select(F.col("c_custkey").alias("o_custkey"), "c_name", "c_nationkey")
    named = table(spark, sf, "nation").where("n_regionkey <> 2").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    return own.join(known, "o_custkey", "left").join(named, "c_nationkey", "left").select("o_orderkey", "c_name", "n_name")


@query("""WITH n AS (SELECT conv_id, list(DISTINCT role) AS roles FROM conversations GROUP BY conv_id), m AS (SELECT conv_id, list(DISTINCT 'turn' || CAST(turn AS VARCHAR)) AS more FROM conversations WHERE turn < 2 GROUP BY conv_id)
    SELECT n.conv_id, array_to_string(list_sort(list_distinct(list_concat(roles, more))), ',') AS themes, greatest(0.5, len(roles) / 4) AS confidence FROM n LEFT JOIN m USING (conv_id)""")
def membership_merge(spark, sf):
    own = table(spark, sf, "conversations")
    roles = own.groupBy("conv_id").agg(F.collect_set("role").alias("roles"))
    more = own.where("turn < 2").groupBy("conv_id").agg(F.collect_set(F.concat(F.lit("turn"), F.col("turn").cast("string"))).alias("more"))
    return roles.join(more, "conv_id", "left").select("conv_id", F.array_join(F.array_sort(F.array_union("roles", "more")), ",").alias("themes"), F.greatest(F.lit(0.5), F.size("roles") / 4).alias("confidence"))


@query("""WITH a AS (SELECT o_orderkey AS k, 1 AS n FROM orders WHERE o_orderkey % 11 <> 0), b AS (SELECT l_orderkey AS k, count(*) AS n FROM lineitem WHERE l_orderkey % 13 <> 0 AND l_quantity > 40 GROUP BY l_orderkey),
    j AS (SELECT coalesce(a.k, b.k) AS k, coalesce(a.n, 0) AS l, coalesce(b.n, 0) AS r FROM a FULL JOIN b ON a.k = b.k)
    SELECT CASE WHEN r = 0 THEN 'missing' WHEN l = 0 THEN 'unexpected' WHEN l = 1 AND r = 1 THEN 'ok' ELSE 'repeated' END AS side, count(*) AS keys, CAST(sum(r) AS BIGINT) AS right_rows FROM j GROUP BY side""")
def coverage_full_outer(spark, sf):
    a = table(spark, sf, "orders").where("o_orderkey % 11 <> 0").select(F.col("o_orderkey").alias("k"))
    b = table(spark, sf, "lineitem").where("l_orderkey % 13 <> 0 and l_quantity > 40").select(F.col("l_orderkey").alias("k"))
    return reconcile.coverage(a, b, "k").groupBy("side").agg(F.count("*").alias("keys"), F.sum("right_rows").alias("right_rows"))


@query(f"WITH {NOTES}, g AS (SELECT title, count(*) AS n, min(doc_id) AS kept FROM notes GROUP BY title HAVING count(*) > 1) SELECT doc_id, kept FROM notes JOIN g USING (title) WHERE doc_id <> kept")
def same_name_credit(spark, sf):
    own = notes(spark, sf).select("doc_id", "title")
    groups = own.groupBy("title").agg(F.count("*").alias("n"), F.min("doc_id").alias("kept")).where("n > 1")
    return own.join(groups, "title").where("doc_id <> kept").select("doc_id", "kept")


@query("""WITH s AS (SELECT l_orderkey, count(*) AS lines, round(sum(l_extendedprice), 2) AS total FROM lineitem GROUP BY l_orderkey),
    c AS (SELECT o_orderkey, coalesce(lines, 0) AS lines, coalesce(total, 0.0) AS total, o_totalprice FROM orders LEFT JOIN s ON l_orderkey = o_orderkey)
    SELECT o_orderkey, array_to_string(list_filter([CASE WHEN lines = 0 THEN 'no_lines' END, CASE WHEN lines > 7 THEN 'too_many_lines' END, CASE WHEN total > o_totalprice THEN 'sum_exceeds_total' END], lambda x: x IS NOT NULL), ',') AS errors FROM c""")
def manifest_invariants(spark, sf):
    sums = table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.count("*").alias("lines"), F.round(F.sum("l_extendedprice"), 2).alias("total"))
    own = table(spark, sf, "orders").select("o_orderkey", "o_totalprice").join(sums, "o_orderkey", "left").fillna(0, ["lines"]).fillna(0.0, ["total"])
    errors = reconcile.violations((F.col("lines") == 0, "no_lines"), (F.col("lines") > 7, "too_many_lines"), (F.col("total") > F.col("o_totalprice"), "sum_exceeds_total"))
    return own.select("o_orderkey", F.array_join(errors, ",").alias("errors"))


@query("SELECT o_orderkey, sha256(concat_ws(chr(1), CAST(o_orderkey AS VARCHAR), o_orderstatus)) = sha256(concat_ws(chr(1), CAST(o_orderkey AS VARCHAR), CASE WHEN o_orderkey % 9 = 0 THEN 'X' ELSE o_orderstatus END)) AS verified FROM orders")
def plan_hash_check(spark, sf):
    stored = I.key_hash("o_orderkey", "o_orderstatus")
    now = I.key_hash("o_orderkey", F.when(F.col("o_orderkey") % 9 == 0, "X").otherwise(F.col("o_orderstatus")))
    return table(spark, sf, "orders").select("o_orderkey", (stored == now).alias("verified"))


@query("""WITH b AS (SELECT user_id, max(event_id) AS cursor FROM events WHERE ts < TIMESTAMP '2024-01-15' GROUP BY user_id), a AS (SELECT user_id, max(event_id) AS cursor FROM events GROUP BY user_id)
    SELECT a.user_id, b.cursor AS before, a.cursor AS after, CASE WHEN b.cursor IS NULL THEN 'new' WHEN a.cursor > b.cursor THEN 'advanced' ELSE 'unchanged' END AS outcome FROM a LEFT JOIN b USING (user_id)""")
def state_before_after(spark, sf):
    ids = table(spark, sf, "events").groupBy("user_id").agg(F.max(F.when(F.expr("ts < timestamp_ntz'2024-01-15 00:00:00'"), F.col("event_id"))).alias("before"), F.max("event_id").alias("after"))
    return ids.select("user_id", "before", "after", F.when(F.col("before").isNull(), "new").when(F.col("after") > F.col("before"), "advanced").otherwise("unchanged").alias("outcome"))


REASONS = [("error", "download_failed"), ("click", "waiting"), ("view", "no_new_files")]


@query(f"SELECT event_type, coalesce(core, 'unknown:' || event_type) AS core, count(*) AS n FROM events LEFT JOIN (SELECT * FROM {values('reason, core', REASONS)}) m ON m.reason = event_type GROUP BY 1, 2")
def reason_map_join(spark, sf):
    map_ = inline(spark, "event_type, core", REASONS)
    counts = table(spark, sf, "events").groupBy("event_type").agg(F.count("*").alias("n"))
    return counts.join(map_, "event_type", "left").select("event_type", F.coalesce("core", F.concat(F.lit("unknown:"), "event_type")).alias("core"), "n")


@query("""WITH o AS (SELECT user_id, min(ts) AS first_at, count(*) AS n FROM events WHERE event_type = 'error' AND ts < TIMESTAMP '2024-01-20' GROUP BY user_id),
    w AS (SELECT user_id, max(ts) AS last_at, count(*) AS n FROM events WHERE event_type = 'error' AND ts >= TIMESTAMP '2024-01-20' AND value > 5 GROUP BY user_id)
    SELECT coalesce(o.user_id, w.user_id) AS user_id, strftime(coalesce(o.first_at, w.last_at), '%Y-%m-%d %H:%M:%S') AS first_at, coalesce(o.n, 0) + coalesce(w.n, 0) AS failures FROM o FULL JOIN w ON o.user_id = w.user_id""")
def quarantine_upsert(spark, sf):
    errors = table(spark, sf, "events").where("event_type = 'error'")
    old = errors.where("ts < timestamp_ntz'2024-01-20 00:00:00'").groupBy("user_id").agg(F.min("ts").alias("first_at"), F.count("*").alias("n"))
    new = errors.where("ts >= timestamp_ntz'2024-01-20 00:00:00' and value > 5").groupBy("user_id").agg(F.max("ts").alias("last_at"), F.count("*").alias("m"))
    return old.join(new, "user_id", "full_outer").select("user_id", F.date_format(F.coalesce("first_at", "last_at"), "yyyy-MM-dd HH:mm:ss").alias("first_at"), (F.coalesce("n", F.lit(0)) + F.coalesce("m", F.lit(0))).alias("failures"))


@query("SELECT DISTINCT user_id FROM events WHERE event_type = 'error' AND user_id NOT IN (SELECT user_id FROM events WHERE event_type = 'purchase' AND value > 60)")
def quarantine_clear_anti(spark, sf):
    e = table(spark, sf, "events")
    return e.where("event_type = 'error'").select("user_id").distinct().join(e.where("event_type = 'purchase' and value > 60").select("user_id"), "user_id", "left_anti")


GUIDANCE = [("error", "read the log"), ("signup", "welcome")]


@query(f"SELECT event_id, coalesce(advice, 'wait for the next run') AS advice FROM events LEFT JOIN (SELECT * FROM {values('code, advice', GUIDANCE)}) g ON g.code = event_type")
def guidance_lookup_default(spark, sf):
    return table(spark, sf, "events").join(inline(spark, "event_type, advice", GUIDANCE), "event_type", "left").select("event_id", F.coalesce("advice", F.lit("wait for the next run")).alias("advice"))


@query("SELECT DISTINCT l_partkey AS page, l_suppkey AS target FROM lineitem WHERE l_returnflag = 'N' EXCEPT SELECT l_partkey, l_suppkey FROM lineitem WHERE l_returnflag = 'R'")
def incremental_link_anti(spark, sf):
    edges = table(spark, sf, "lineitem").select(F.col("l_partkey").alias("page"), F.col("l_suppkey").alias("target"), "l_returnflag")
    return edges.where("l_returnflag = 'N'").select("page", "target").distinct().join(edges.where("l_returnflag = 'R'").select("page", "target"), ["page", "target"], "left_anti")


@query("""WITH u AS (SELECT user_id, 'retry ' || event_type AS name FROM events WHERE event_type = 'error' UNION SELECT user_id, 'quarantine' FROM events WHERE value > 80 UNION SELECT o_custkey, 'batch ' || o_orderstatus FROM orders),
    r AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY name) AS i, count(*) OVER (PARTITION BY user_id) AS n FROM u)
    SELECT user_id, string_agg(name, ', ' ORDER BY name) AS shown, max(n) - 3 AS more FROM r WHERE i <= 3 GROUP BY user_id""")
def abnormal_files_union(spark, sf):
    e = table(spark, sf, "events")
    a = e.where("event_type = 'error'").select("user_id", F.concat(F.lit("retry "), "event_type").alias("name"))
    b = e.where("value > 80").select("user_id", F.lit("quarantine").alias("name"))
    c = table(spark, sf, "orders").select(F.col("o_custkey").alias("user_id"), F.concat(F.lit("batch "), "o_orderstatus").alias("name"))
    names = a.unionByName(b).unionByName(c).groupBy("user_id").agg(F.array_sort(F.collect_set("name")).alias("names"))
    return names.select("user_id", F.array_join(F.slice("names", 1, 3), ", ").alias("shown"), (F.size("names").cast("bigint") - 3).alias("more"))


@query("WITH r AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) AS k FROM conversations WHERE trim(text) <> '' AND role = 'assistant') SELECT conv_id, turn, length(text) AS chars FROM r WHERE k = 1")
def last_message_per_run(spark, sf):
    own = table(spark, sf, "conversations").where("trim(text) <> '' and role = 'assistant'").select("conv_id", "turn", F.length("text").alias("chars"))
    return dedup.arg_max(own, ["conv_id"], F.col("turn"), names=["turn", "chars"])


@query("SELECT c_custkey FROM customer WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'F')")
def already_sent_semi(spark, sf):
    sent = table(spark, sf, "orders").where("o_orderstatus = 'F'").select(F.col("o_custkey").alias("c_custkey"))
    return table(spark, sf, "customer").select("c_custkey").join(sent, "c_custkey", "left_semi")


@query("SELECT l_orderkey, CAST(max(epoch(l_shipdate)) AS BIGINT) AS latest FROM lineitem GROUP BY l_orderkey")
def latest_modified(spark, sf):
    return table(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.unix_timestamp(F.max("l_shipdate").cast("timestamp")).alias("latest"))


@query("SELECT user_id, string_agg(DISTINCT event_type || ' over limit', '; ' ORDER BY event_type || ' over limit') AS warnings FROM events WHERE value > 50 GROUP BY user_id")
def warning_accumulate(spark, sf):
    own = table(spark, sf, "events").where("value > 50").groupBy("user_id").agg(F.array_sort(F.collect_set(F.concat("event_type", F.lit(" over limit")))).alias("w"))
    return own.select("user_id", F.concat_ws("; ", "w").alias("warnings"))


@query("SELECT source AS page, lang AS target, count(*) AS notes FROM documents GROUP BY source, lang")
def link_membership(spark, sf):
    page = F.concat(F.lit("[["), F.col("lang"), F.lit("|shown]] and [["), F.col("lang"), F.lit("#part]]"))
    rows = table(spark, sf, "documents").select(F.col("source").alias("page"), F.explode(files.linked_targets(page)).alias("target"))
    return rows.groupBy("page", "target").agg(F.count("*").alias("notes"))
