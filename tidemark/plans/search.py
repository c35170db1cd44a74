"""Recall, scoring, snippets and rerank over documents."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import arrow, keywords as K
from ..operators import dedup, search as S
from .base import NOTES, inline, notes, query, sql_mentions, table, values

COLUMNS = ["title", "text"]
PRIMARY = ["thing", "ention"]
FALLBACK = ["edst", "whor", "auxvi"]
LIMIT = 300
TERMS = ["the", "erha", "dans", "und"]


def _tf(x: str, t: str) -> str:
    """Occurrences of a term that can't overlap itself."""
    return f"((length(lower({x})) - length(replace(lower({x}), '{t}', ''))) // {len(t)})"


def _bm25(terms, every, name):
    f = ", ".join(f"({_tf('title', t)} + {_tf('text', t)}) AS f{i}" for i, t in enumerate(terms))
    s = ", ".join(f"count(*) FILTER (f{i} > 0) AS d{i}" for i in range(len(terms)))
    idf = [f"CASE WHEN ln((n - d{i} + 0.5) / (d{i} + 0.5)) <= 0 THEN 1e-6 ELSE ln((n - d{i} + 0.5) / (d{i} + 0.5)) END" for i in range(len(terms))]
    score = " - ".join(["0.0"] + [f"({idf[i]}) * f{i} * 2.2 / (f{i} + 1.2 * (0.25 + 0.75 * len / a))" for i in range(len(terms))])
    found = (" AND " if every else " OR ").join(f"f{i} > 0" for i in range(len(terms)))
    return f"""{name}t AS (SELECT doc_id, greatest(length(title) - 2, 0) + greatest(length(text) - 2, 0) AS len, {f} FROM notes),
    {name}s AS (SELECT count(*) AS n, avg(len) AS a, {s} FROM {name}t),
    {name} AS (SELECT doc_id, {score} AS bm25 FROM {name}t, {name}s WHERE {found})"""


@query(f"WITH {NOTES}, {_bm25(PRIMARY, True, 'b')} SELECT doc_id, round(bm25, 6) AS bm25 FROM b ORDER BY b.bm25, doc_id LIMIT 300")
def bm25_recall(spark, sf):
    return S.bm25(notes(spark, sf), "doc_id", COLUMNS, PRIMARY).orderBy("bm25", "doc_id").limit(LIMIT).select("doc_id", F.round("bm25", 6).alias("bm25"))


@query(f"WITH {NOTES}, {_bm25(FALLBACK, False, 'b')} SELECT doc_id, round(bm25, 6) AS bm25 FROM b ORDER BY b.bm25, doc_id LIMIT 300")
def fallback_or_recall(spark, sf):
    return S.bm25(notes(spark, sf), "doc_id", COLUMNS, FALLBACK, require_all=False).orderBy("bm25", "doc_id").limit(LIMIT).select("doc_id", F.round("bm25", 6).alias("bm25"))


RECALLED = f"""{_bm25(PRIMARY, True, 'p')}, {_bm25(FALLBACK, False, 'q')},
    u AS (SELECT doc_id, 0 AS source, bm25 FROM (SELECT * FROM p ORDER BY bm25, doc_id LIMIT 300) UNION ALL SELECT doc_id, 1, bm25 FROM (SELECT * FROM q ORDER BY bm25, doc_id LIMIT 300)),
    r AS (SELECT doc_id, source, bm25 FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY source, bm25) AS k FROM u) WHERE k = 1)"""


@query(f"WITH {NOTES}, {RECALLED} SELECT doc_id, source, round(bm25, 6) AS bm25 FROM r")
def recall_union_dedup(spark, sf):
    return S.recall(notes(spark, sf), "doc_id", COLUMNS, PRIMARY, FALLBACK, LIMIT).select("doc_id", "source", F.round("bm25", 6).alias("bm25"))


def recalled(spark, sf):
    """The recalled notes in order, with their place from 0, day number, and tags; no more than two limits' rows."""
    docs = notes(spark, sf)
    own = S.recall(docs, "doc_id", COLUMNS, PRIMARY, FALLBACK, LIMIT).withColumnRenamed("source", "tier").join(docs, "doc_id")
    day = F.datediff(F.col("report_date").cast("date"), F.lit("0001-01-01").cast("date")) + 1
    # The recall is limited: this window sorts at most 2 * LIMIT rows.
    place = F.row_number().over(Window.orderBy("tier", "bm25", "doc_id")) - 1
    return own.withColumn("place", place).withColumn("day", day).withColumn("tags", F.concat_ws(" ", "lang", "source"))


def _m(x, words):
    return "(" + " + ".join(sql_mentions(x, w) for w in words) + ")"


SCORED = f"""{RECALLED}, o AS (SELECT r.doc_id, title, text, lang || ' ' || n.source AS tags, report_date, CAST(row_number() OVER (ORDER BY r.source, bm25, r.doc_id) - 1 AS INTEGER) AS place, date_diff('day', DATE '0001-01-01', CAST(report_date AS DATE)) + 1 AS day FROM r JOIN notes n ON n.doc_id = r.doc_id),
    e AS (SELECT min(day) AS lo, max(day) AS hi FROM o),
    s AS (SELECT o.*, CAST(greatest(0.0, 18.0 - place * 0.3) AS DOUBLE) AS position, CASE WHEN hi > lo THEN 18.0 * (day - lo) / (hi - lo) ELSE 9.0 END AS recent FROM o, e),
    t AS (SELECT *, position + recent + least(20.0, {_m('tags', TERMS)} * 6.0) + least(30.0, {_m('title', TERMS)} * 5.0) + least(24.0, {_m('text', TERMS)} * 1.2) + CASE WHEN {_m('title', ['the'])} > 0 THEN 14.0 ELSE 0.0 END AS score FROM s)"""


def scored(spark, sf):
    own = recalled(spark, sf)
    span = own.agg(F.min("day").alias("lo"), F.max("day").alias("hi"))
    own = own.join(F.broadcast(span))  # one row
    own = own.withColumn("recent", S.recency(F.col("day"), F.col("lo"), F.col("hi")))
    return own.withColumn("score", S.composite_score("title", "text", "tags", F.col("place"), F.col("recent"), TERMS, None, "the"))


@query(f"WITH {NOTES}, {SCORED} SELECT doc_id, round(recent, 6) AS recency FROM s")
def score_minmax_recency(spark, sf):
    return scored(spark, sf).select("doc_id", F.round("recent", 6).alias("recency"))


@query(f"WITH {NOTES}, {SCORED} SELECT doc_id, place, round(position, 4) AS position FROM s")
def rank_position_feature(spark, sf):
    return recalled(spark, sf).select("doc_id", "place", F.round(F.greatest(F.lit(0.0), F.lit(18.0) - F.col("place") * 0.3), 4).alias("position"))


@query(f"WITH {NOTES}, {SCORED} SELECT doc_id, round(score, 4) AS score FROM t")
def search_score(spark, sf):
    return scored(spark, sf).select("doc_id", F.round("score", 4).alias("score"))


@query(f"WITH {NOTES}, {SCORED} SELECT doc_id, title, round(score, 4) AS score FROM t ORDER BY t.score DESC, place LIMIT 10")
def search_topk(spark, sf):
    return scored(spark, sf).orderBy(F.desc("score"), "place").limit(10).select("doc_id", "title", F.round("score", 4).alias("score"))


def _first(x, words):
    return f"list_min(list_filter([{', '.join(f'instr(lower({x}), {chr(39)}{w}{chr(39)})' for w in words)}], lambda i: i > 0))"


@query(f"WITH {NOTES}, w AS (SELECT doc_id, title, text, {_first('title', ['erha', 'whor'])} - 1 AS a, {_first('text', ['erha', 'whor'])} - 1 AS b FROM notes) SELECT doc_id, trim(CASE WHEN a IS NOT NULL THEN substr(title, CAST(greatest(0, a - 60) AS BIGINT) + 1, 180) WHEN b IS NOT NULL THEN substr(text, CAST(greatest(0, b - 60) AS BIGINT) + 1, 180) ELSE substr(title, 1, 180) END) AS snippet FROM w")
def search_snippet(spark, sf):
    return notes(spark, sf).select("doc_id", S.snippet(["title", "text"], ["erha", "whor"]).alias("snippet"))


MARKED = ["erha", "wh"]


def _marked(x, word, n):
    places = "".join(f"(.*?)({word})" for _ in range(n))
    return f"regexp_replace({x}, '^(?is){places}', '" + "".join(f"\\{2 * i + 1}[\\{2 * i + 2}]" for i in range(n)) + "')"


def _marked_twice(x, word):
    count = f"len(regexp_extract_all({x}, '(?i){word}'))"
    return f"CASE WHEN {count} >= 2 THEN {_marked(x, word, 2)} WHEN {count} = 1 THEN {_marked(x, word, 1)} ELSE {x} END"


@query(f"WITH a AS (SELECT doc_id, {_marked_twice('text', MARKED[0])} AS t FROM documents) SELECT doc_id, {_marked_twice('t', MARKED[1])} AS marked FROM a")
def highlight_terms(spark, sf):
    return table(spark, sf, "documents").select("doc_id", K.highlight("text", MARKED).alias("marked"))


@query(f"SELECT doc_id, CAST({_first('text', ['erha', 'whor'])} AS INTEGER) AS place FROM documents")
def first_term_index(spark, sf):
    return table(spark, sf, "documents").select("doc_id", K.first_index("text", ["erha", "whor"]).alias("place"))


ASKED = "AI chips 2.5x for 半导体需求恢复 and a GPU-2"


@query(f"""WITH t AS (SELECT unnest(regexp_extract_all('{ASKED}', '{K.TOKEN}')) AS token),
    a AS (SELECT token FROM t UNION SELECT substr(token, CAST(i AS BIGINT), 3) FROM t, LATERAL (SELECT unnest(range(1, length(token) - 1)) AS i) u WHERE regexp_full_match(token, '[一-鿿]{{5,}}')) SELECT token FROM a WHERE length(token) >= 2""")
def query_tokens(spark, sf):
    return spark.createDataFrame([(t,) for t in K.query_tokens(ASKED)], "token string")


@query("""WITH w AS (SELECT doc_id, unnest(regexp_extract_all(lower(text), '[a-zà-ÿ]{2,}')) AS t FROM documents)
    SELECT doc_id, t AS token, count(*) AS n FROM (SELECT doc_id, CASE WHEN length(t) <= 4 THEN [t] ELSE list_concat(list_transform(range(1, length(t)), lambda i: substr(t, i, 2)), list_transform(range(1, length(t) - 1), lambda i: substr(t, i, 3))) END AS g FROM w) x, LATERAL (SELECT unnest(g) AS t) GROUP BY doc_id, t""")
def ngram_tokens(spark, sf):
    return _tokens(table(spark, sf, "documents"), F.col("text"))


def _tokens(docs, text):
    words = F.regexp_extract_all(F.lower(text), F.lit("[a-zà-ÿ]{2,}"), F.lit(0))

    def grams(w, n):
        return F.transform(F.sequence(F.lit(1), F.length(w) - (n - 1)), lambda i: F.substring(w, i, F.lit(n)))

    tokens = F.flatten(F.transform(words, lambda w: F.when(F.length(w) <= 4, F.array(w)).otherwise(F.concat(grams(w, 2), grams(w, 3)))))
    return docs.select("doc_id", F.explode(tokens).alias("token")).groupBy("doc_id", "token").agg(F.count("*").alias("n"))


@query()
def hash_embed_cosine(spark, sf):
    return notes(spark, sf).select("doc_id", F.round(arrow.cosine_to("the thing with whor and dans")("text"), 6).alias("cosine"))


PROBE = 7


@query(f"""WITH q AS (SELECT CAST(embedding AS DOUBLE[]) AS q FROM embeddings WHERE vec_id = {PROBE}), s AS (SELECT vec_id, list_dot_product(CAST(embedding AS DOUBLE[]), q) / sqrt(list_dot_product(CAST(embedding AS DOUBLE[]), CAST(embedding AS DOUBLE[])) * list_dot_product(q, q)) AS c FROM embeddings, q WHERE vec_id <> {PROBE})
    SELECT vec_id, round(c, 6) AS cosine FROM s ORDER BY c DESC, vec_id LIMIT 20""")
def cosine_topk(spark, sf):
    own = table(spark, sf, "embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("v"))
    probe = own.where(F.col("vec_id") == PROBE).select(F.col("v").alias("q"))

    def dot(a, b):
        return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)

    both = own.where(F.col("vec_id") != PROBE).join(F.broadcast(probe.limit(1)))  # one row
    return both.select("vec_id", (dot("v", "q") / F.sqrt(dot("v", "v") * dot("q", "q"))).alias("c")).orderBy(F.desc("c"), "vec_id").limit(20).select("vec_id", F.round("c", 6).alias("cosine"))


RERANK = ["erha", "the", "whor"]


def _has(x, t):
    return f"contains(lower({x}), '{t}')"


@query(f"WITH {NOTES}, {SCORED} SELECT doc_id, " + " + ".join(f"(CASE WHEN {_has('title', t)} THEN 6 ELSE 0 END) + (CASE WHEN {_has('text', t)} THEN 1 ELSE 0 END)" for t in RERANK)
       + " + (CASE WHEN " + " AND ".join(f"({_has('title', t)} OR {_has('text', t)})" for t in RERANK) + f" THEN 10 ELSE 0 END) + (CASE WHEN {sql_mentions('title', 'of')} > 0 THEN 18 ELSE 0 END) AS rerank FROM t")
def rerank_score(spark, sf):
    return recalled(spark, sf).select("doc_id", S.rerank_score([(6, "title"), (1, "text")], RERANK, [(18, "title")], ["of"]).alias("rerank"))


@query(f"WITH {NOTES}, {SCORED}, k AS (SELECT * FROM t ORDER BY score DESC, place LIMIT 50) SELECT doc_id, title FROM k ORDER BY length(text) DESC, doc_id LIMIT 8")
def two_stage_topk(spark, sf):
    own = scored(spark, sf).orderBy(F.desc("score"), "place").limit(50)
    return own.orderBy(F.desc(F.length("text")), "doc_id").limit(8).select("doc_id", "title")


ALIASES = [("nation_1", "alpha"), ("nation_1", "one"), ("nation_2", "two"), ("nation_9", "nine")]


@query(f"SELECT n_name AS name, n_name || coalesce(',' || string_agg(alias, ',' ORDER BY alias), '') AS terms FROM nation LEFT JOIN (SELECT * FROM {values('name, alias', ALIASES)}) a ON a.name = lower(n_name) GROUP BY n_name")
def alias_expansion(spark, sf):
    more = inline(spark, "name, alias", ALIASES).groupBy("name").agg(F.array_sort(F.collect_list("alias")).alias("more"))
    own = table(spark, sf, "nation").select("n_name", F.lower("n_name").alias("name")).join(more, "name", "left")
    return own.select(F.col("n_name").alias("name"), F.concat_ws(",", F.array("n_name"), F.coalesce("more", F.array().cast("array<string>"))).alias("terms"))
