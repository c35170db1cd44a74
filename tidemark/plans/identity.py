"""Duplicates, identities, hashes, keys and numbering."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import arrow, dates, identity as I
from ..operators import dedup, search
from .base import NOTES, inline, notes, query, table, values


@query(f"WITH {NOTES}, r AS (SELECT *, row_number() OVER (PARTITION BY sha ORDER BY report_date DESC, doc_id DESC) AS k FROM notes) SELECT sha, doc_id, report_date FROM r WHERE k = 1")
def dedup_keep_newest(spark, sf):
    return dedup.arg_max(notes(spark, sf), ["sha"], F.col("report_date"), F.col("doc_id"), names=["doc_id", "report_date"])


@query("WITH r AS (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS k FROM events) SELECT event_id, user_id, event_type, value FROM r WHERE k = 1")
def dedup_first_seen(spark, sf):
    own = table(spark, sf, "events").select("event_id", "user_id", "event_type", "value", "ts")
    return dedup.one_per_key(own, ["user_id", "event_type"], F.col("ts"), F.col("event_id")).drop("ts")


@query("WITH r AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linestatus = 'O' DESC, l_quantity DESC, l_shipdate DESC, l_linenumber, l_partkey, l_suppkey) AS k FROM lineitem) SELECT l_orderkey, l_linestatus = 'O' AS open, l_quantity FROM r WHERE k = 1")
def best_copy_argmax(spark, sf):
    open_ = F.col("l_linestatus") == "O"
    own = table(spark, sf, "lineitem").withColumn("open", open_)
    return dedup.arg_max(own, ["l_orderkey"], F.col("open"), F.col("l_quantity"), F.col("l_shipdate"), -F.col("l_linenumber"), -F.col("l_partkey"), -F.col("l_suppkey"), names=["open", "l_quantity"])


@query("WITH r AS (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS k FROM events WHERE event_type <> 'purchase' AND value >= 1) SELECT user_id, event_type, event_id FROM r WHERE k = 1")
def latest_unresolved(spark, sf):
    own = table(spark, sf, "events").where("event_type <> 'purchase' and value >= 1")
    return dedup.arg_max(own, ["user_id", "event_type"], F.col("ts"), F.col("event_id"), names=["event_id"])


@query("WITH r AS (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS k FROM orders WHERE o_orderstatus = 'F') SELECT o_custkey, o_orderkey, o_totalprice FROM r WHERE k = 1")
def latest_success(spark, sf):
    own = table(spark, sf, "orders").where("o_orderstatus = 'F'")
    return dedup.arg_max(own, ["o_custkey"], F.col("o_orderdate"), F.col("o_orderkey"), names=["o_orderkey", "o_totalprice"])


@query(f"""WITH RECURSIVE {NOTES}, k AS (SELECT doc_id, 's' || sha AS key FROM notes UNION SELECT doc_id, 't' || title FROM notes WHERE length(title) >= 30),
    e AS (SELECT DISTINCT a.doc_id AS a, b.doc_id AS b FROM k a JOIN k b USING (key)),
    r(doc_id, seen) AS (SELECT doc_id, doc_id FROM notes UNION SELECT r.doc_id, e.b FROM r JOIN e ON e.a = r.seen)
    SELECT doc_id, min(seen) AS component FROM r GROUP BY doc_id""")
def identity_components(spark, sf):
    own = notes(spark, sf).select("doc_id", "sha", F.when(F.length("title") >= 30, F.col("title")).alias("title"))
    return dedup.identity_components(own, "doc_id", ["sha", "title"]).withColumnRenamed("node", "doc_id")


@query(f"WITH {NOTES} SELECT sha, min(doc_id) AS first_doc, min('path/' || lpad(CAST(doc_id AS VARCHAR), 9, '0')) AS first_path FROM notes GROUP BY sha")
def first_path_per_sha(spark, sf):
    path = F.concat(F.lit("path/"), F.lpad(F.col("doc_id").cast("string"), 9, "0"))
    return notes(spark, sf).groupBy("sha").agg(F.min("doc_id").alias("first_doc"), F.min_by(path, "doc_id").alias("first_path"))


@query(f"WITH {NOTES} SELECT lower(sha) AS sha, max(doc_id) AS last_doc, count(*) AS copies FROM notes GROUP BY lower(sha)")
def sha_reverse_index(spark, sf):
    return notes(spark, sf).groupBy(F.lower("sha").alias("sha")).agg(F.max("doc_id").alias("last_doc"), F.count("*").alias("copies"))


@query(f"WITH {NOTES}, r AS (SELECT *, row_number() OVER (PARTITION BY sha ORDER BY doc_id DESC) AS k FROM notes WHERE sha <> '') SELECT sha, doc_id, source FROM r WHERE k = 1")
def index_by_sha(spark, sf):
    return dedup.arg_max(notes(spark, sf).where("sha <> ''"), ["sha"], F.col("doc_id"), names=["doc_id", "source"])


@query("""WITH u AS (SELECT c_custkey AS k, c_name AS name, 0 AS src, c_custkey AS seq FROM customer WHERE c_custkey % 3 = 0 UNION ALL SELECT s_suppkey, s_name, 1, s_suppkey FROM supplier),
    r AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY src, seq) AS i FROM u) SELECT k, name FROM r WHERE i = 1""")
def merge_first_wins(spark, sf):
    a = table(spark, sf, "customer").where("c_custkey % 3 = 0").select(F.col("c_custkey").alias("k"), F.col("c_name").alias("name"), F.col("c_custkey").alias("seq"))
    b = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("k"), F.col("s_name").alias("name"), F.col("s_suppkey").alias("seq"))
    return dedup.first_wins(a, b, "k").select("k", "name")


@query(f"WITH {NOTES} SELECT doc_id, sha FROM notes WHERE doc_id % 10 >= 5 AND sha NOT IN (SELECT sha FROM notes WHERE doc_id % 10 < 5)")
def new_file_anti_join(spark, sf):
    own = notes(spark, sf).select("doc_id", "sha")
    known = own.where("doc_id % 10 < 5").select("sha").distinct()
    return own.where("doc_id % 10 >= 5").join(known, "sha", "left_anti").select("doc_id", "sha")


@query(f"WITH {NOTES} SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN 'local_' || substr(sha256('notes/' || CAST(doc_id AS VARCHAR)), 1, 16) ELSE 'doc_' || substr(sha, 1, 16) END AS report_id FROM notes")
def stable_report_id(spark, sf):
    sha = F.when(F.col("doc_id") % 3 == 0, "short").otherwise(F.col("sha"))
    return notes(spark, sf).select("doc_id", I.report_id(sha, F.concat(F.lit("notes/"), F.col("doc_id").cast("string"))).alias("report_id"))


@query("SELECT event_id, CASE WHEN event_id % 4 = 0 THEN 'filename:' || event_type ELSE 'file_id:' || CAST(user_id AS VARCHAR) END AS identity FROM events")
def candidate_identity(spark, sf):
    return table(spark, sf, "events").select("event_id", I.candidate_identity(F.when(F.col("event_id") % 4 == 0, " ").otherwise(F.col("user_id").cast("string")), "event_type").alias("identity"))


@query("SELECT page_id, regexp_replace(regexp_replace(lower(url), '\\.[a-z0-9]{1,5}$', ''), '[^\\pL\\pN]', '', 'g') AS key FROM pages")
def filename_key(spark, sf):
    return table(spark, sf, "pages").select("page_id", I.file_key("url").alias("key"))


@query("SELECT page_id, regexp_replace(trim(regexp_replace(url, '\\s+', ' ', 'g')), '/{2,}', '/', 'g') AS key, regexp_replace(lower(regexp_replace(url, '\\.[A-Za-z0-9]{1,5}$', '')), '[^\\pL\\pN]', '', 'g') AS folded FROM pages")
def path_key(spark, sf):
    return table(spark, sf, "pages").select("page_id", I.path_key("url").alias("key"), arrow.filename_key()("url").alias("folded"))


@query(f"WITH {NOTES} SELECT doc_id, regexp_replace(regexp_replace(lower(trim(title)), '\\.(pdf|md)$', ''), '[^\\pL\\pN_]+', '', 'g') AS compact FROM notes")
def compact_title(spark, sf):
    return notes(spark, sf).select("doc_id", I.compact_title("title").alias("compact"))


def _grams(x, n):
    return f"list_distinct(list_transform(range(1, length({x}) - {n - 2}), lambda i: substr({x}, i, {n})))"


def _compact(x):
    return f"regexp_replace(regexp_replace(lower(trim({x})), '\\.(pdf|md)$', ''), '[^\\pL\\pN_]+', '', 'g')"


PAIRS = f"""b AS (SELECT item_id, {_compact("split_part(text, chr(10), 1)")} AS t FROM benchmark),
    b2 AS (SELECT item_id, t, {_grams('t', 1)} AS t1, {_grams('t', 3)} AS t3 FROM b),
    n AS (SELECT doc_id, {_compact('title')} AS c FROM notes), n2 AS (SELECT doc_id, c, {_grams('c', 1)} AS c1, {_grams('c', 3)} AS c3 FROM n),
    s AS (SELECT item_id, doc_id, round(CASE WHEN t = '' OR c = '' THEN 0.0 WHEN contains(c, t) OR contains(t, c) THEN 1.0
        ELSE len(list_intersect(t1, c1)) / greatest(len(t1), 1) * 0.35 + len(list_intersect(t3, c3)) / greatest(len(t3), 1) * 0.65 END, 6) AS similarity FROM b2, n2)"""


@query(f"WITH {NOTES}, {PAIRS} SELECT item_id, doc_id, similarity FROM s")
def title_similarity(spark, sf):
    """Every title against every benchmark item; the items, a stated set of queries, meet the titles in blocks."""
    items = table(spark, sf, "benchmark").select("item_id", I.compact_title(F.substring_index("text", "\n", 1)).alias("t"))
    items = search.in_blocks(items.select("item_id", "t", I.grams("t", 1).alias("t1"), I.grams("t", 3).alias("t3")), "item_id", 64)
    titles = notes(spark, sf).select("doc_id", I.compact_title("title").alias("c"))
    titles = titles.select("doc_id", "c", I.grams("c", 1).alias("c1"), I.grams("c", 3).alias("c3"))
    each = F.transform("block", lambda x: F.struct(x["item_id"].alias("item_id"), F.round(I.similarity_of_grams(x["t"], x["t1"], x["t3"], F.col("c"), F.col("c1"), F.col("c3")), 6).alias("similarity")))
    return titles.crossJoin(items).select("doc_id", F.inline(each)).select("item_id", "doc_id", "similarity")


@query(f"WITH {NOTES}, {PAIRS}, r AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY similarity DESC, item_id) AS k FROM s WHERE similarity >= 0.35) SELECT doc_id, item_id, similarity FROM r WHERE k = 1")
def best_section(spark, sf):
    own = title_similarity(spark, sf).where("similarity >= 0.35")
    return dedup.arg_max(own, ["doc_id"], F.col("similarity"), -F.col("item_id"), names=["item_id", "similarity"])


@query("SELECT o_orderkey, sha256(concat_ws(chr(1), CAST(o_orderkey AS VARCHAR), o_orderstatus, o_orderpriority)) AS hash FROM orders")
def canonical_hash(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", I.key_hash("o_orderkey", "o_orderstatus", "o_orderpriority").alias("hash"))


@query("SELECT l_orderkey, sha256(string_agg(x, chr(1) ORDER BY x)) AS identity FROM (SELECT l_orderkey, CAST(l_partkey AS VARCHAR) || '/' || CAST(l_suppkey AS VARCHAR) AS x FROM lineitem) GROUP BY l_orderkey")
def set_identity_hash(spark, sf):
    item = F.concat_ws("/", F.col("l_partkey").cast("string"), F.col("l_suppkey").cast("string"))
    return table(spark, sf, "lineitem").groupBy("l_orderkey").agg(I.set_hash(F.collect_list(item)).alias("identity"))


@query("SELECT event_id, substr(sha256(concat_ws(chr(1), CAST(user_id AS VARCHAR), event_type, strftime(ts, '%Y-%m-%d'))), 1, 24) AS key FROM events")
def event_key_hash(spark, sf):
    return table(spark, sf, "events").select("event_id", I.key_hash("user_id", "event_type", F.date_format("ts", "yyyy-MM-dd"), length=24).alias("key"))


@query("SELECT page_id, sha256(html) AS sha, strlen(html) AS bytes FROM pages")
def sha256_hash(spark, sf):
    return table(spark, sf, "pages").select("page_id", F.sha2("html", 256).alias("sha"), F.octet_length("html").cast("bigint").alias("bytes"))


@query("SELECT page_id, regexp_extract(url, '^([a-z]+)://', 1) AS scheme, regexp_extract(url, '^[a-z]+://([^/?#]+)', 1) AS host, regexp_extract(url, '^[a-z]+://[^/?#]+([^?#]*)', 1) AS path FROM pages")
def uri_parse(spark, sf):
    def part(name):
        return F.coalesce(F.try_parse_url("url", F.lit(name)), F.lit(""))

    return table(spark, sf, "pages").select("page_id", part("PROTOCOL").alias("scheme"), part("HOST").alias("host"), part("PATH").alias("path"))


@query("SELECT page_id, len(list_distinct(regexp_extract_all(html, 'href=\"([^\"]+)\"', 1))) AS links, regexp_extract(html, 'href=\"([^\"]+)\"', 1) AS first_link FROM pages")
def url_extract(spark, sf):
    links = F.regexp_extract_all("html", F.lit('href="([^"]+)"'), F.lit(1))
    return table(spark, sf, "pages").select("page_id", F.size(F.array_distinct(links)).alias("links"), F.regexp_extract("html", 'href="([^"]+)"', 1).alias("first_link"))


@query("SELECT page_id, nullif(regexp_extract(url, '/(?:en|de|fr|es)/(\\d+)', 1), '') AS item, 'https://example.org/item/' || regexp_extract(url, '/(?:en|de|fr|es)/(\\d+)', 1) AS canonical FROM pages")
def url_id_extract(spark, sf):
    item = F.regexp_extract("url", r"/(?:en|de|fr|es)/(\d+)", 1)
    return table(spark, sf, "pages").select("page_id", I.blank(item).alias("item"), F.format_string("https://example.org/item/%s", item).alias("canonical"))


@query("""SELECT event_id, coalesce(CASE WHEN event_id % 5 = 0 THEN 'explicit' END, nullif(regexp_extract('root/b' || CAST(user_id % 7 AS VARCHAR) || '__to__x/f', '([^/]+__to__[^/]+)/', 1), ''), 'manual') AS batch_id FROM events""")
def batch_id_coalesce(spark, sf):
    path = F.concat(F.lit("root/b"), (F.col("user_id") % 7).cast("string"), F.lit("__to__x/f"))
    return table(spark, sf, "events").select("event_id", F.coalesce(I.blank(F.when(F.col("event_id") % 5 == 0, "explicit")), I.blank(F.regexp_extract(path, "([^/]+__to__[^/]+)/", 1)), F.lit("manual")).alias("batch_id"))


@query(f"WITH {NOTES} SELECT source || ' ' || substr(report_date, 1, 7) || ' (' || CAST(count(*) AS VARCHAR) || ')' AS doc_title FROM notes GROUP BY source, substr(report_date, 1, 7)")
def doc_title_format(spark, sf):
    return notes(spark, sf).groupBy("source", F.substring("report_date", 1, 7).alias("month")).count().select(F.format_string("%s %s (%d)", "source", "month", "count").alias("doc_title"))


@query("SELECT event_id, CASE event_id % 6 WHEN 0 THEN 5 WHEN 1 THEN 5 WHEN 2 THEN 10 ELSE 20 END AS fixed, CAST(least(30 * power(2, greatest(event_id % 6, 1) - 1), 180) AS BIGINT) AS exponential FROM events")
def backoff_delay(spark, sf):
    n = F.col("event_id") % 6
    return table(spark, sf, "events").select("event_id", dates.fixed_backoff(n).alias("fixed"), dates.exponential_backoff(n).alias("exponential"))


@query("SELECT CAST(floor(epoch(ts) / 14400) AS BIGINT) AS bucket, count(*) AS events, round(sum(value), 2) AS value FROM events GROUP BY bucket")
def time_bucket(spark, sf):
    return table(spark, sf, "events").groupBy(dates.bucket("ts", 14400).alias("bucket")).agg(F.count("*").alias("events"), F.round(F.sum("value"), 2).alias("value"))


@query("SELECT event_id, user_id, CAST((row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1) // 10 + 1 AS INTEGER) AS chunk, CAST(ceil(count(*) OVER (PARTITION BY user_id) / 10.0) AS INTEGER) AS chunks FROM events")
def chunk_assign(spark, sf):
    own = Window.partitionBy("user_id")
    place = F.row_number().over(own.orderBy("ts", "event_id"))
    return table(spark, sf, "events").select("event_id", "user_id", (F.floor((place - 1) / 10) + 1).cast("int").alias("chunk"), F.ceil(F.count("*").over(own) / 10).cast("int").alias("chunks"))


@query("""WITH r AS (SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS i, count(*) OVER (PARTITION BY o_custkey) AS n FROM orders)
    SELECT o_custkey, CAST(CASE WHEN n <= 15 THEN 1 ELSE (i - 1) // 10 + 1 END AS INTEGER) AS publish_group, count(*) AS files, min(i) AS first_offset FROM r GROUP BY 1, 2""")
def publish_groups(spark, sf):
    own = Window.partitionBy("o_custkey")
    rows = table(spark, sf, "orders").select("o_custkey", F.row_number().over(own.orderBy("o_orderdate", "o_orderkey")).alias("i"), F.count("*").over(own).alias("n"))
    group = F.when(F.col("n") <= 15, 1).otherwise(F.floor((F.col("i") - 1) / 10) + 1).cast("int")
    return rows.groupBy("o_custkey", group.alias("publish_group")).agg(F.count("*").alias("files"), F.min("i").cast("bigint").alias("first_offset"))


@query()
def overlap_merge(spark, sf):
    turns = F.array_sort(F.collect_list(F.struct("turn", "text")))
    rows = table(spark, sf, "conversations").groupBy("conv_id").agg(turns.alias("t"))
    return rows.select("conv_id", F.length(arrow.overlap_merge()(F.transform("t", lambda x: x["text"]))).alias("merged_chars"))


@query("""WITH a AS (SELECT l_partkey AS k FROM lineitem WHERE l_orderkey % 2 = 0), b AS (SELECT l_partkey AS k FROM lineitem WHERE l_orderkey % 2 = 1)
    SELECT 'only_even' AS side, count(*) AS n FROM (SELECT k FROM a EXCEPT ALL SELECT k FROM b) UNION ALL SELECT 'only_odd', count(*) FROM (SELECT k FROM b EXCEPT ALL SELECT k FROM a) UNION ALL SELECT 'both', count(*) FROM (SELECT k FROM a INTERSECT ALL SELECT k FROM b)""")
def path_set_diff(spark, sf):
    rows = table(spark, sf, "lineitem").select(F.col("l_partkey").alias("k"), (F.col("l_orderkey") % 2).alias("odd"))
    each = rows.groupBy("k").agg(F.count_if(F.col("odd") == 0).alias("a"), F.count_if(F.col("odd") == 1).alias("b"))
    sums = each.agg(F.sum(F.greatest(F.col("a") - F.col("b"), F.lit(0))).alias("only_even"), F.sum(F.greatest(F.col("b") - F.col("a"), F.lit(0))).alias("only_odd"), F.sum(F.least("a", "b")).alias("both"))
    return sums.unpivot([], ["only_even", "only_odd", "both"], "side", "n")


@query(f"WITH {NOTES} SELECT sha, count(*) AS copies, min(doc_id) AS first_doc FROM notes GROUP BY sha HAVING count(*) > 1")
def duplicate_groups(spark, sf):
    return notes(spark, sf).groupBy("sha").agg(F.count("*").alias("copies"), F.min("doc_id").alias("first_doc")).where("copies > 1")


@query("SELECT p_brand, count(*) AS n, CAST(row_number() OVER (ORDER BY count(*) DESC, p_brand) AS INTEGER) AS rank FROM part GROUP BY p_brand")
def count_rank(spark, sf):
    counts = table(spark, sf, "part").groupBy("p_brand").agg(F.count("*").alias("n"))
    return counts.withColumn("rank", F.row_number().over(Window.orderBy(F.desc("n"), "p_brand")))


@query("SELECT event_id, user_id, value FROM events WHERE event_type = 'error' ORDER BY ts DESC, event_id DESC LIMIT 50")
def quarantine_sorted(spark, sf):
    return table(spark, sf, "events").where("event_type = 'error'").orderBy(F.desc("ts"), F.desc("event_id")).limit(50).select("event_id", "user_id", "value")
