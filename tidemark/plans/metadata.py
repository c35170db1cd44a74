"""Keyword rules, entities, themes, dates and statuses over documents taken as notes."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import dates, keywords as K, text as T
from ..functions.identity import blank
from ..operators import dedup, metadata as M
from ..sources import files
from .base import NOTES, inline, notes, query, sql_mentions, table, values

ENTITIES = [("Alpha Mining", ["erha", "thble"]), ("Beta Energy", ["onwh", "reou"]), ("Gamma Health", ["eauai", "auxvi"]), ("Delta Motors", ["chzu", "enge"]), ("Omega Foods", ["adoja", "esci"])]
THEMES = [("energy", ["ention", "edre"]), ("credit", ["anti", "esen"]), ("trade", ["from", "dans"]), ("labor", ["nicht", "auch"])]
SUBTHEMES = [("energy", "grid", ["ndth"]), ("energy", "storage", ["inha"]), ("credit", "rates", ["with"]), ("trade", "ports", ["para"])]
BROKERS = [("North", ["the", "of"]), ("South", ["de", "la"]), ("East", ["der", "die"]), ("West", ["el", "que"])]
LAST_YEAR = 2027


def hits(text: str, words: list[str]) -> str:
    return "(" + " + ".join(sql_mentions(text, w) for w in words) + ")"


def scored_sql(rules, keep: str = "doc_id") -> str:
    rows = [f"SELECT {keep}, '{n}' AS name, {hits('title', w)} AS title_hits, {hits('text', w)} AS body_hits FROM notes" for n, w in rules]
    return f"scored AS (SELECT *, title_hits * 4 + body_hits AS score FROM ({' UNION ALL '.join(rows)}) WHERE title_hits + body_hits > 0)"


def entities(spark, sf, rules=ENTITIES):
    return M.scored(notes(spark, sf), ["doc_id"], "title", "text", rules)


@query(f"WITH {NOTES} SELECT doc_id, {hits('text', ['the'])} > 0 AS has_the, {hits('text', ['erha'])} > 0 AS has_erha, contains(lower(text), 'ción') AS has_cion FROM notes")
def keyword_contains(spark, sf):
    return notes(spark, sf).select("doc_id", K.contains("text", "the").alias("has_the"), K.contains("text", "erha").alias("has_erha"), F.contains(F.lower("text"), F.lit("ción")).alias("has_cion"))


@query(f"WITH {NOTES} SELECT doc_id, {hits('text', ['the', 'erha', 'from'])} AS mentions FROM notes")
def keyword_mentions(spark, sf):
    return notes(spark, sf).select("doc_id", K.mentions("text", ["the", "erha", "from"]).alias("mentions"))


@query(f"WITH {NOTES} SELECT doc_id, len(regexp_extract_all(lower(text), 'é')) - len(regexp_extract_all(lower(text), 'é[nl]')) AS mentions FROM notes")
def alias_mentions_veto(spark, sf):
    return notes(spark, sf).select("doc_id", K.alias_mentions("text", ["é"], {"é": "nl"}).alias("mentions"))


@query(f"WITH {NOTES} SELECT doc_id, " + " + ".join(f"CAST({hits('text', [w])} > 0 AS INTEGER)" for w in ["the", "erha", "from", "dans", "auch"]) + " AS hits FROM notes")
def keyword_hits_distinct(spark, sf):
    return notes(spark, sf).select("doc_id", K.distinct_hits("text", ["the", "erha", "from", "dans", "auch"]).alias("hits"))


EXCLUDED, STANDALONE, REGIONS, REQUIRED = ["scum", "idiot"], ["tion", "ment"], ["the", "der"], ["in", "an"]


def _found(words):
    return f"list_filter([{', '.join(repr(w) for w in sorted(words))}], lambda w: contains(lower(title), w))"


@query(f"""WITH {NOTES}, f AS (SELECT doc_id, {_found(EXCLUDED)} AS x, {_found(STANDALONE)} AS s, {_found(REGIONS)} AS r, {_found(REQUIRED)} AS q FROM notes)
    SELECT doc_id, CASE WHEN len(x) > 0 THEN '' WHEN len(s) > 0 THEN array_to_string(s, ',') WHEN len(r) > 0 AND len(q) > 0 THEN array_to_string(list_sort(list_distinct(list_concat(r, q))), ',') ELSE '' END AS matched,
           CASE WHEN len(x) > 0 THEN NULL WHEN len(s) > 0 THEN 'standalone' WHEN len(r) > 0 AND len(q) > 0 THEN 'region_plus_topic' END AS rule FROM f""")
def title_match_rule(spark, sf):
    matched, rule = M.rule_match(F.col("title"), EXCLUDED, STANDALONE, REGIONS, REQUIRED)
    return notes(spark, sf).select("doc_id", F.array_join(matched, ",").alias("matched"), rule.alias("rule"))


@query("SELECT count(*) AS events, count(DISTINCT user_id) AS users FROM events WHERE json_contains('[\"click\", \"view\"]', '\"' || event_type || '\"')")
def json_array_contains(spark, sf):
    wanted = F.from_json(F.lit('["click", "view"]'), "array<string>")
    return table(spark, sf, "events").where(F.array_contains(wanted, F.col("event_type"))).agg(F.count("*").alias("events"), F.countDistinct("user_id").alias("users"))


@query("SELECT event_id FROM events WHERE ts BETWEEN TIMESTAMP '2024-01-05 00:00:00' AND TIMESTAMP '2024-01-06 00:00:00'")
def window_filter_closed(spark, sf):
    return table(spark, sf, "events").where("ts between timestamp_ntz'2024-01-05 00:00:00' and timestamp_ntz'2024-01-06 00:00:00'").select("event_id")


@query("SELECT o_orderkey FROM orders WHERE o_orderdate > TIMESTAMP '1997-01-01' AND o_orderdate <= TIMESTAMP '1997-02-01'")
def window_filter_half_open(spark, sf):
    return table(spark, sf, "orders").where("o_orderdate > timestamp_ntz'1997-01-01 00:00:00' and o_orderdate <= timestamp_ntz'1997-02-01 00:00:00'").select("o_orderkey")


@query(f"WITH {NOTES}, p AS (SELECT doc_id, list_filter(list_transform(regexp_split_to_array(title, '[,;、，；]'), lambda x: trim(x)), lambda x: x <> '') AS parts FROM notes) SELECT doc_id, len(parts) AS parts, coalesce(array_to_string(parts, '|'), '') AS joined FROM p")
def list_coerce(spark, sf):
    parts = F.filter(F.transform(F.split("title", "[,;、，；]"), lambda x: F.trim(x)), lambda x: x != "")
    rows = notes(spark, sf).select("doc_id", F.coalesce(F.from_json("title", "array<string>"), parts).alias("parts"))
    return rows.select("doc_id", F.size("parts").alias("parts"), F.array_join("parts", "|").alias("joined"))


@query("SELECT CASE WHEN html IS NULL OR length(html) < 1 THEN 'empty' WHEN substr(html, 1, 5) <> '<!DOC' THEN 'bad_magic' WHEN strlen(html) < 1024 THEN 'short' ELSE 'ok' END AS status, count(*) AS pages FROM pages GROUP BY status")
def binary_magic_case(spark, sf):
    b = F.col("html").cast("binary")
    status = F.when(b.isNull() | (F.length(b) < 1), "empty").when(F.substring(b, 1, 5) != F.lit(b"<!DOC"), "bad_magic").when(F.length(b) < 1024, "short").otherwise("ok")
    return table(spark, sf, "pages").groupBy(status.alias("status")).agg(F.count("*").alias("pages"))


@query("SELECT o_orderkey, o_custkey, count(*) OVER () = 1 AS exactly_one FROM orders WHERE o_orderkey = 7")
def select_exactly_one(spark, sf):
    rows = table(spark, sf, "orders").where("o_orderkey = 7").select("o_orderkey", "o_custkey")
    one = rows.agg(F.count("*").alias("n"), F.first(F.struct("o_orderkey", "o_custkey")).alias("r"))
    return one.where("n > 0").select("r.o_orderkey", "r.o_custkey", (F.col("n") == 1).alias("exactly_one"))


TERMS = [("erha", "company"), ("onwh", "company"), ("ention", "theme"), ("anti", "theme"), ("both", "company"), ("both", "theme")]


@query(f"""WITH t AS (SELECT split_part(p_name, ' ', 1) AS term, count(*) AS n FROM part GROUP BY term UNION ALL SELECT * FROM (VALUES ('erha', 1), ('anti', 1), ('both', 1)) AS v(term, n)),
    k AS (SELECT term, max(CASE WHEN kind = 'company' THEN 1 END) AS c, max(CASE WHEN kind = 'theme' THEN 1 END) AS m FROM (SELECT * FROM {values('term, kind', TERMS)}) GROUP BY term)
    SELECT t.term, n, CASE WHEN c = 1 THEN 'company' WHEN m = 1 THEN 'theme' ELSE 'other' END AS bucket FROM t LEFT JOIN k USING (term)""")
def term_bucket(spark, sf):
    own = table(spark, sf, "part").groupBy(F.substring_index("p_name", " ", 1).alias("term")).agg(F.count("*").alias("n"))
    own = own.unionByName(inline(spark, "term, n", [("erha", 1), ("anti", 1), ("both", 1)]).select("term", F.col("n").cast("bigint")))
    known = inline(spark, "term, kind", TERMS).groupBy("term").agg(F.max(F.col("kind") == "company").alias("c"), F.max(F.col("kind") == "theme").alias("m"))
    return own.join(known, "term", "left").select("term", "n", F.when(F.col("c"), "company").when(F.col("m"), "theme").otherwise("other").alias("bucket"))


@query(f"WITH {NOTES}, w AS (SELECT doc_id, list_distinct(str_split(lower(title), ' ')) AS own FROM notes) SELECT doc_id, array_to_string(list_sort(list_distinct(list_concat(list_filter(own, lambda x: x NOT IN ('the', 'de')), ['added']))), ',') AS terms FROM w")
def list_algebra(spark, sf):
    own = F.array_distinct(F.split(F.lower("title"), " "))
    return notes(spark, sf).select("doc_id", F.array_join(F.array_sort(F.array_union(F.array_except(own, F.array(F.lit("the"), F.lit("de"))), F.array(F.lit("added")))), ",").alias("terms"))


@query("""WITH s AS (SELECT page_id, lower(url) AS u, lower(html) AS h FROM pages),
    f AS (SELECT *, contains(u, 'login') AS login, contains(h, '<article') AS body, contains(u, '/en/') AS target, contains(h, 'spam') OR contains(u, 'spam-farm') AS bad FROM s)
    SELECT CASE WHEN login THEN 'login' WHEN bad AND NOT body THEN 'unavailable' WHEN body AND target THEN 'ready' ELSE 'unrecognized' END AS state,
           CASE WHEN login THEN 'login_marker' ELSE array_to_string(list_filter([CASE WHEN body THEN 'article' END, CASE WHEN target THEN 'target_url' END], lambda x: x IS NOT NULL), ',') END AS signals, count(*) AS pages FROM f GROUP BY state, signals""")
def page_state_case(spark, sf):
    u, h = F.lower("url"), F.lower("html")
    login, body, target = F.contains(u, F.lit("login")), F.contains(h, F.lit("<article")), F.contains(u, F.lit("/en/"))
    bad = F.contains(h, F.lit("spam")) | F.contains(u, F.lit("spam-farm"))
    state = F.when(login, "login").when(bad & ~body, "unavailable").when(body & target, "ready").otherwise("unrecognized")
    signals = F.array_join(F.array_compact(F.array(F.when(body, F.lit("article")), F.when(target, F.lit("target_url")))), ",")
    return table(spark, sf, "pages").groupBy(state.alias("state"), F.when(login, "login_marker").otherwise(signals).alias("signals")).agg(F.count("*").alias("pages"))


FLAT = [(n, w) for n, words in ENTITIES for w in words]


@query(f"SELECT name, string_agg(word, ',' ORDER BY word) AS aliases FROM (SELECT name, word FROM {values('name, word', FLAT)} UNION SELECT n_name, lower(n_name) FROM nation) GROUP BY name")
def rule_dictionary(spark, sf):
    rules = inline(spark, "name, word", FLAT).unionByName(table(spark, sf, "nation").select(F.col("n_name").alias("name"), F.lower("n_name").alias("word")))
    return rules.groupBy("name").agg(F.array_join(F.array_sort(F.collect_set("word")), ",").alias("aliases"))


@query(f"WITH {NOTES} SELECT doc_id, len(list_distinct(list_filter(list_transform(regexp_split_to_array(title, '[、,，/]'), lambda x: trim(x)), lambda x: x <> ''))) AS aliases FROM notes")
def alias_section(spark, sf):
    note = F.concat(F.lit("# N\n## Aliases\n"), F.col("title"), F.lit("\n## Next\n"))
    own = F.array_distinct(F.filter(F.transform(F.split(files.section(note, "Aliases"), "[、,，/]"), lambda x: F.trim(F.regexp_replace(x, "\n", " "))), lambda x: x != ""))
    return notes(spark, sf).select("doc_id", F.size(own).alias("aliases"))


@query(f"WITH {NOTES}, {scored_sql(ENTITIES)} SELECT doc_id, name, score FROM scored WHERE title_hits > 0 OR body_hits >= 2")
def entity_score(spark, sf):
    return entities(spark, sf).where("title_hits > 0 or body_hits >= 2").select("doc_id", "name", "score")


@query(f"WITH {NOTES}, {scored_sql(ENTITIES)}, k AS (SELECT *, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, name) AS INTEGER) AS rank FROM scored WHERE title_hits > 0 OR body_hits >= 2) SELECT doc_id, name, score, rank FROM k WHERE rank <= 3")
def entity_topk_per_doc(spark, sf):
    own = entities(spark, sf).where("title_hits > 0 or body_hits >= 2")
    return dedup.top_per_key(own, ["doc_id"], 3, F.desc("score"), F.col("name")).select("doc_id", "name", "score", "rank")


@query(f"""WITH {NOTES}, t AS (SELECT theme, sum(s) AS score, max(th) AS title_hits FROM (SELECT 1 AS theme, 1 AS s, 1 AS th) GROUP BY theme HAVING false),
    {scored_sql(THEMES)}, main AS (SELECT * FROM scored),
    sub AS ({' UNION ALL '.join(f"SELECT doc_id, '{t}' AS name, {hits('title', w)} * 4 + {hits('text', w)} AS score FROM notes" for t, _, w in SUBTHEMES)}),
    a AS (SELECT doc_id, name, sum(score) AS score, sum(title_hits) AS title_hits FROM (SELECT doc_id, name, score, title_hits FROM main UNION ALL SELECT doc_id, name, score, 0 FROM sub WHERE score > 0) GROUP BY doc_id, name)
    SELECT doc_id, name, CAST(score AS BIGINT) AS score FROM a WHERE score >= 2 OR title_hits > 0""")
def theme_score(spark, sf):
    docs = notes(spark, sf)
    main = M.scored(docs, ["doc_id"], "title", "text", THEMES).select("doc_id", "name", "score", "title_hits")
    parents = {s: t for t, s, _ in SUBTHEMES}
    sub = M.scored(docs, ["doc_id"], "title", "text", [(s, w) for _, s, w in SUBTHEMES])
    sub = sub.join(inline(spark, "name, theme", list(parents.items())), "name").select("doc_id", F.col("theme").alias("name"), "score", F.lit(0).alias("title_hits"))
    both = main.unionByName(sub).groupBy("doc_id", "name").agg(F.sum("score").alias("score"), F.sum("title_hits").alias("title_hits"))
    return both.where("score >= 2 or title_hits > 0").select("doc_id", "name", "score")


@query(f"""WITH {NOTES}, {scored_sql(THEMES)}, d AS (SELECT doc_id, max(title_hits) AS best FROM scored GROUP BY doc_id)
    SELECT doc_id, string_agg(name, ',' ORDER BY name) AS themes FROM scored JOIN d USING (doc_id) WHERE (best > 0 AND title_hits > 0) OR (best = 0 AND body_hits >= 2) GROUP BY doc_id""")
def classify_title_first(spark, sf):
    rows = entities(spark, sf, THEMES).groupBy("doc_id").agg(F.collect_list(F.struct("name", "title_hits", "body_hits")).alias("r"), F.max("title_hits").alias("best"))
    own = F.transform(F.filter("r", lambda x: ((F.col("best") > 0) & (x["title_hits"] > 0)) | ((F.col("best") == 0) & (x["body_hits"] >= 2))), lambda x: x["name"])
    return rows.select("doc_id", F.array_join(F.array_sort(own), ",").alias("themes")).where("themes <> ''")


def _first(rules, x):
    return "CASE " + " ".join(f"WHEN {hits(x, w)} > 0 THEN '{n}'" for n, w in rules) + " ELSE '' END"


@query(f"WITH {NOTES} SELECT doc_id, {_first(BROKERS, 'substr(text, 1, 500)')} AS broker FROM notes")
def first_rule_wins(spark, sf):
    head, out = F.substring("text", 1, 500), None
    for name, words in BROKERS:
        hit = K.mentions(head, words) > 0
        out = F.when(hit, name) if out is None else out.when(hit, name)
    return notes(spark, sf).select("doc_id", out.otherwise("").alias("broker"))


FIGURES = "title || ' rose ' || CAST(n_chars % 90 AS VARCHAR) || '% to $' || CAST(doc_id % 50 AS VARCHAR) || 'B at 3.5倍 of **' || CAST(doc_id % 7 AS VARCHAR) || ' GWh** at last'"
_PLAIN = "trim(regexp_replace(regexp_replace({}, '[#*`>]+', ' ', 'g'), '\\s+', ' ', 'g'))"


# A figure's place is the length of all before it: figures are marked, and the text is split at the marks.
@query(f"""WITH {NOTES}, t AS (SELECT doc_id, {FIGURES} AS t FROM notes), m AS (SELECT doc_id, t, str_split(regexp_replace(t, '({K.NUMBER})', chr(1) || '\\1' || chr(2), 'g'), chr(1)) AS p FROM t),
    e AS (SELECT doc_id, t, i, length(split_part(p[i], chr(2), 1)) AS n, list_sum(list_transform(p[1:i-1], lambda x: length(replace(x, chr(2), '')))) AS before FROM m, LATERAL (SELECT unnest(range(2, len(p) + 1)) AS i) u),
    s AS (SELECT doc_id, i, {_PLAIN.format("substr(t, CAST(greatest(before - 24, 0) AS BIGINT) + 1, CAST(before - greatest(before - 24, 0) + n + 24 AS BIGINT))")} AS snippet FROM e),
    f AS (SELECT doc_id, snippet, min(i) AS i FROM s WHERE snippet <> '' GROUP BY ALL), r AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY i) AS k FROM f) SELECT doc_id, snippet FROM r WHERE k <= 12""")
def key_number_snippets(spark, sf):
    text = F.expr(FIGURES.replace("AS VARCHAR", "AS STRING"))
    return notes(spark, sf).select("doc_id", F.explode(K.key_numbers(text)).alias("snippet"))


BULLET = "list_filter(str_split(text, chr(10)), lambda x: contains(x, 'idiot') OR contains(x, 'the '))"


@query(f"SELECT doc_id, len({BULLET}[1:8]) AS bullets, array_to_string(list_transform({BULLET}[1:8], lambda x: substr(trim(x), 1, 220)), '|') AS joined FROM documents")
def bullet_extract(spark, sf):
    own = F.slice(F.filter(F.split("text", "\n"), lambda x: F.contains(x, F.lit("idiot")) | F.contains(x, F.lit("the "))), 1, 8)
    rows = table(spark, sf, "documents").select("doc_id", F.transform(own, lambda x: F.substring(F.trim(x), 1, 220)).alias("b"))
    return rows.select("doc_id", F.size("b").alias("bullets"), F.array_join("b", "|").alias("joined"))


TYPES = [("company", ["erha", "onwh"]), ("macro", ["the", "with"]), ("strategy", ["der", "und"]), ("industry", ["de", "la"]), ("event", ["el", "que"])]


@query(f"WITH {NOTES} SELECT report_type, count(*) AS documents FROM (SELECT CASE {' '.join(f'WHEN {hits(chr(116) + chr(101) + chr(120) + chr(116), w)} >= 2 THEN {chr(39)}{n}{chr(39)}' for n, w in TYPES)} ELSE 'unknown' END AS report_type FROM notes) GROUP BY report_type")
def report_type_case(spark, sf):
    out = None
    for name, words in TYPES:
        hit = K.mentions("text", words) >= 2
        out = F.when(hit, name) if out is None else out.when(hit, name)
    return notes(spark, sf).groupBy(out.otherwise("unknown").alias("report_type")).agg(F.count("*").alias("documents"))


STATUS_SQL = f"""coalesce(nullif(array_to_string(list_filter([CASE WHEN contains(title, '�') THEN 'dirty_title' END, CASE WHEN NOT ({hits('text', ['erha', 'onwh'])} > 0) THEN 'unmatched_company' END,
    CASE WHEN n_chars < 500 THEN 'short_text' END], lambda x: x IS NOT NULL), ','), ''), 'ok')"""


@query(f"WITH {NOTES} SELECT doc_id, {STATUS_SQL} AS status FROM notes")
def status_array(spark, sf):
    own = M.statuses((F.contains("title", F.lit("�")), "dirty_title"), (~(K.mentions("text", ["erha", "onwh"]) > 0), "unmatched_company"), (F.col("n_chars") < 500, "short_text"), default="ok")
    return notes(spark, sf).select("doc_id", F.array_join(own, ",").alias("status"))


CONFIDENCE_SQL = f"round((CAST({_first(BROKERS, 'substr(text, 1, 500)')} <> '' AS INTEGER) + 1 + CAST({hits('text', ['ention', 'anti', 'from', 'nicht'])} > 0 AS INTEGER) + CAST({hits('text', ['erha', 'onwh'])} > 0 AS INTEGER)) / 4.0, 2)"


def _confidence():
    broker = None
    for _, words in BROKERS:
        hit = K.mentions(F.substring("text", 1, 500), words) > 0
        broker = hit if broker is None else broker | hit
    return M.confidence(broker, F.col("report_date").isNotNull(), K.mentions("text", ["ention", "anti", "from", "nicht"]) > 0, K.mentions("text", ["erha", "onwh"]) > 0)


@query(f"WITH {NOTES} SELECT doc_id, CAST({CONFIDENCE_SQL} AS DOUBLE) AS confidence FROM notes")
def metadata_confidence(spark, sf):
    return notes(spark, sf).select("doc_id", _confidence().cast("double").alias("confidence"))


@query(f"WITH {NOTES} SELECT doc_id, title, report_date, CAST({CONFIDENCE_SQL} AS DOUBLE) AS confidence, CASE WHEN {CONFIDENCE_SQL} < 0.65 THEN 'metadata_low_confidence' ELSE 'metadata_ready' END AS metadata_status, {STATUS_SQL} AS status FROM notes")
def metadata_record(spark, sf):
    rows = notes(spark, sf).select("doc_id", "title", "report_date", _confidence().cast("double").alias("confidence"), "text", "n_chars")
    own = M.statuses((F.contains("title", F.lit("�")), "dirty_title"), (~(K.mentions("text", ["erha", "onwh"]) > 0), "unmatched_company"), (F.col("n_chars") < 500, "short_text"), default="ok")
    return rows.select("doc_id", "title", "report_date", "confidence", F.when(F.col("confidence") < 0.65, "metadata_low_confidence").otherwise("metadata_ready").alias("metadata_status"), F.array_join(own, ",").alias("status"))


WORDS = "regexp_extract_all(lower(text), '[a-z]{6,}')"


@query(f"""WITH w AS (SELECT doc_id, {WORDS} AS w FROM documents), p AS (SELECT doc_id, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS i FROM w),
    f AS (SELECT doc_id, x, min(i) AS i FROM p GROUP BY doc_id, x), r AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY i) AS k FROM f)
    SELECT w.doc_id, coalesce(string_agg(x, ',' ORDER BY i), '') AS firsts FROM w LEFT JOIN r ON r.doc_id = w.doc_id AND k <= 12 GROUP BY w.doc_id""")
def first_n_distinct(spark, sf):
    return table(spark, sf, "documents").select("doc_id", F.array_join(F.slice(F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit("[a-z]{6,}"), F.lit(0))), 1, 12), ",").alias("firsts"))


@query("""WITH p AS (SELECT conv_id, role, min(turn) AS t FROM conversations GROUP BY conv_id, role) SELECT conv_id, string_agg(role, ',' ORDER BY t) AS roles FROM p GROUP BY conv_id""")
def array_distinct_order(spark, sf):
    turns = F.array_sort(F.collect_list(F.struct("turn", "role")))
    rows = table(spark, sf, "conversations").groupBy("conv_id").agg(turns.alias("t"))
    return rows.select("conv_id", F.array_join(F.array_distinct(F.transform("t", lambda x: x["role"])), ",").alias("roles"))


@query(f"WITH {NOTES}, s AS (SELECT doc_id, {STATUS_SQL} AS s FROM notes) SELECT doc_id, s AS issues FROM s WHERE s <> 'ok'")
def array_except_nonempty(spark, sf):
    rows = status_array(spark, sf).select("doc_id", F.array_except(F.split("status", ","), F.array(F.lit("ok"))).alias("i"))
    return rows.where(F.size("i") > 0).select("doc_id", F.array_join("i", ",").alias("issues"))


@query("""WITH e AS (SELECT o_orderkey, CAST(1999 + o_orderkey % 30 AS VARCHAR) AS y, lpad(CAST(o_orderkey % 14 AS VARCHAR), 2, '0') AS m, lpad(CAST(o_orderkey % 33 AS VARCHAR), 2, '0') AS d FROM orders),
    p AS (SELECT o_orderkey, TRY_CAST(y || '-' || m || '-' || d AS DATE) AS dt FROM e)
    SELECT o_orderkey, CASE WHEN year(dt) BETWEEN 2000 AND 2027 THEN strftime(dt, '%Y-%m-%d') END AS valid FROM p""")
def date_validate(spark, sf):
    k = F.col("o_orderkey")
    return table(spark, sf, "orders").select("o_orderkey", dates.valid_date((k % 30 + 1999).cast("string"), (k % 14).cast("string"), (k % 33).cast("string"), LAST_YEAR).alias("valid"))


# Dates in the forms that occur: compact, with separators, with the signs for year, month and day.
DATED = "CAST(2024 AS VARCHAR) || CASE doc_id % 4 WHEN 0 THEN '' WHEN 1 THEN '-' WHEN 2 THEN '.' ELSE '年' END || lpad(CAST(doc_id % 14 AS VARCHAR), 2, '0') || CASE doc_id % 4 WHEN 0 THEN '' WHEN 1 THEN '-' WHEN 2 THEN '.' ELSE '月' END || lpad(CAST(doc_id % 33 AS VARCHAR), 2, '0') || CASE doc_id % 4 WHEN 3 THEN '日' ELSE '' END"
HEAD = f"'note ' || {DATED} || ' ' || source"


@query(f"""WITH h AS (SELECT doc_id, {HEAD} AS head FROM documents), x AS (SELECT doc_id, regexp_extract(head, '(20\\d{{2}})[-./年]?(0[1-9]|1[0-2])[-./月]?(0[1-9]|[12]\\d|3[01])', ['y', 'm', 'd']) AS p FROM h)
    SELECT doc_id, coalesce(strftime(TRY_CAST(p.y || '-' || p.m || '-' || p.d AS DATE), '%Y-%m-%d'), 'undated') AS report_date FROM x""")
def report_date_extract(spark, sf):
    head = F.expr(HEAD.replace("AS VARCHAR", "AS STRING"))
    return table(spark, sf, "documents").select("doc_id", F.coalesce(dates.date_in(head, LAST_YEAR), F.lit("undated")).alias("report_date"))


@query("""SELECT event_id, strftime(coalesce(TRY_CAST(CASE WHEN event_id % 3 = 0 THEN 'not a date' WHEN event_id % 3 = 1 THEN '' ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S') END AS TIMESTAMP), date_trunc('day', ts)), '%Y-%m-%d %H:%M:%S') AS at FROM events""")
def note_datetime_coalesce(spark, sf):
    text = F.when(F.col("event_id") % 3 == 0, "not a date").when(F.col("event_id") % 3 == 1, "").otherwise(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"))
    return table(spark, sf, "events").select("event_id", F.date_format(F.coalesce(dates.instant(blank(text)), F.date_trunc("day", "ts")), "yyyy-MM-dd HH:mm:ss").alias("at"))


@query("SELECT doc_id, coalesce(strftime(CASE WHEN doc_id % 2 = 0 THEN DATE '2024-03-01' + CAST(doc_id % 50 AS INTEGER) END, '%Y-%m-%d'), source) AS published FROM documents")
def publish_date_coalesce(spark, sf):
    day = F.when(F.col("doc_id") % 2 == 0, F.date_format(F.date_add(F.lit("2024-03-01").cast("date"), (F.col("doc_id") % 50).cast("int")), "yyyy-MM-dd"))
    return table(spark, sf, "documents").select("doc_id", F.coalesce(blank(day), blank("source")).alias("published"))


HEADLINE = "CASE doc_id % 3 WHEN 0 THEN upper(substr(source, 1, 1)) || substr(source, 2) || ': ' || title WHEN 1 THEN 'Update Acme ' || upper(lang) || ' (' || upper(lang) || '.US) ' || title ELSE 'The Brook & Co. earnings ' || title END"


@query(f"""WITH {NOTES}, t AS (SELECT doc_id, {HEADLINE} AS t FROM notes), n AS ({' UNION ALL '.join(f"SELECT doc_id, unnest(regexp_extract_all(t, '{p}', 1)) AS x FROM t" for p in K.COMPANY)}),
    c AS (SELECT DISTINCT doc_id, trim(regexp_replace(x, '^(?i)(?:the|a|an|on|re|update|note)\\s+', ''), ' .-') AS company FROM n) SELECT doc_id, company FROM c WHERE length(company) BETWEEN 2 AND 40""")
def title_company_infer(spark, sf):
    return notes(spark, sf).select("doc_id", F.explode(K.companies_in(F.expr(HEADLINE))).alias("company"))


@query(f"WITH {NOTES} SELECT doc_id, CASE WHEN contains(title, '�') THEN 'document ' || CAST(doc_id AS VARCHAR) ELSE title END AS display_title FROM notes")
def dirty_title_case(spark, sf):
    return notes(spark, sf).select("doc_id", F.when(F.contains("title", F.lit("�")), F.concat(F.lit("document "), F.col("doc_id").cast("string"))).otherwise(F.col("title")).alias("display_title"))


@query("SELECT doc_id, lang AS lang_value, source AS source_value, length(text) AS body_chars FROM documents")
def frontmatter_map(spark, sf):
    note = F.concat(F.lit("---\nlang: "), F.col("lang"), F.lit("\nsource: \""), F.col("source"), F.lit("\"\n---\n"), F.col("text"))
    rows = table(spark, sf, "documents").select("doc_id", files.frontmatter(note).alias("f"), files.body(note).alias("body"))
    return rows.select("doc_id", F.col("f")["lang"].alias("lang_value"), F.col("f")["source"].alias("source_value"), F.length("body").alias("body_chars"))


@query(f"WITH {NOTES} SELECT doc_id, trim(title) AS section FROM notes")
def section_extract(spark, sf):
    note = F.concat(F.lit("# Top\n\n## Other\nx\n## Summary\n"), F.col("title"), F.lit("\n## Last\ny"))
    return notes(spark, sf).select("doc_id", F.trim(F.regexp_replace(files.section(note, "Summary"), r"\n$", "")).alias("section"))


@query(f"WITH {NOTES}, x AS ({' UNION ALL '.join(f'SELECT doc_id, {chr(39)}{n}{chr(39)} AS name, {hits(chr(116) + chr(101) + chr(120) + chr(116), [w])} AS hits FROM notes' for n, w in FLAT)}) SELECT doc_id, name, CAST(sum(hits) AS BIGINT) AS hits FROM x WHERE hits > 0 GROUP BY doc_id, name")
def dictionary_theta_join(spark, sf):
    rules = inline(spark, "name, word", FLAT)
    found = M.dictionary_hits(table(spark, sf, "documents"), "doc_id", "text", rules, [w for _, w in FLAT])
    return found.groupBy("doc_id", "name").agg(F.sum("hits").alias("hits"))
