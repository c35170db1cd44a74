"""Cleaning and quality gates over documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as T
from .base import NOTES, notes, query, sql_lines, sql_strip, table

MARKS = ["Licensed under", "All rights reserved", "Copyright"]
RATIO = 6


def _marked(x: str) -> str:
    return "(" + " OR ".join(f"contains({x}, '{m}')" for m in MARKS) + ")"


def _unmarked(x: str) -> str:
    for m in sorted(MARKS, key=len, reverse=True):
        x = f"replace({x}, '{m}', ' ')"
    return sql_strip(f"regexp_replace({x}, '[ \\t]{{2,}}', ' ', 'g')")


def _noise(x: str) -> str:
    return f"(({_marked(x)} AND (length({x}) <= 80 OR length({_unmarked(x)}) < 20)) OR regexp_full_match({x}, '[-=_*#\\s]{{3,}}'))"


def _letters(x: str) -> str:
    return f"length(regexp_replace({x}, '[^\\pL]', '', 'g'))"


def _noisy(x: str) -> str:
    tenth = f"greatest(3, CAST(floor(length({x}) * CAST(0.10 AS DOUBLE)) AS INTEGER))"
    bad = f"(length({x}) - length(replace({x}, '�', '')))"
    few = f"(length({x}) >= 20 AND length(regexp_replace({x}, '[^\\pL\\pN]', '', 'g')) < {tenth})"
    return f"(({bad} > 0 AND {bad} >= {tenth}) OR {few})"


def _label(x: str) -> str:
    return f"(length({x}) < 8 OR regexp_full_match({x}, '[-+]?\\d+(\\.\\d+)?%?') OR regexp_full_match({x}, '\\d{{1,2}}/\\d{{2}}'))"


def _meaningful(x: str) -> str:
    return f"(length({x}) >= 20 AND NOT {_noisy(x)} AND {_letters(x)} >= greatest(8, CAST(floor(length({x}) * CAST(0.20 AS DOUBLE)) AS INTEGER)))"


def _body_meaningful(x: str) -> str:
    b = _unmarked(x)
    return f"(length({x}) >= 20 AND NOT {_noise(x)} AND NOT regexp_full_match({b}, '[^\\pL\\pN]+') AND {_letters(b)} >= greatest(8, CAST(floor(length({b}) * 0.25) AS INTEGER)))"


LINES = f"l AS (SELECT doc_id, unnest({sql_lines('text')}) AS line FROM documents)"


def _repeated(where: str) -> str:
    return f"""(SELECT doc_id, sum(CASE WHEN n > 1 THEN n ELSE 0 END) / sum(n) AS ratio
        FROM (SELECT doc_id, line, count(*) AS n FROM l WHERE {where} GROUP BY doc_id, line) GROUP BY doc_id)"""


MEASURES = f"""{LINES},
    r AS {_repeated('length(line) >= 8')},
    c AS (SELECT doc_id, count(*) AS nonempty_lines,
            count(*) FILTER ({_noise('line')} AND {_marked('line')}) / count(*) AS watermark_ratio,
            count(*) FILTER ({_noisy('line')}) / count(*) AS noise_ratio,
            count(*) FILTER ({_meaningful('line')}) AS meaningful
          FROM l GROUP BY doc_id),
    m AS (SELECT d.doc_id, d.lang, length({sql_strip('text')}) AS chars, coalesce(nonempty_lines, 0) AS nonempty_lines,
            coalesce(list_max(list_transform(str_split({sql_strip('text')}, chr(10)), lambda x: length(regexp_replace(x, '\\r$', '')))), 0) AS max_line,
            coalesce(r.ratio, 1.0) AS repeated_ratio, coalesce(watermark_ratio, 1.0) AS watermark_ratio, coalesce(noise_ratio, 1.0) AS noise_ratio,
            {_letters(sql_strip('text'))} AS language_chars, coalesce(meaningful, 0) AS meaningful
          FROM documents d LEFT JOIN r USING (doc_id) LEFT JOIN c USING (doc_id)),
    g AS (SELECT *, chars >= 1800 AND max_line <= 1200 AND repeated_ratio < 0.45 AND watermark_ratio < 0.18 AND noise_ratio < 0.35
            AND language_chars >= 500 AND language_chars / greatest(chars, 1) >= 0.20
            AND (meaningful >= 10 OR (chars >= 3500 AND meaningful >= 3)) AS acceptable FROM m)"""


def gated(spark, sf):
    docs = T.quality(table(spark, sf, "documents"), "text", MARKS, ["doc_id", "lang"])
    return docs.withColumn("acceptable", T.acceptable())


@query(f"WITH {MEASURES} SELECT lang, acceptable, count(*) AS documents, sum(chars) AS chars, sum(meaningful) AS meaningful FROM g GROUP BY lang, acceptable")
def quality_gate(spark, sf):
    return gated(spark, sf).groupBy("lang", "acceptable").agg(F.count("*").alias("documents"), F.sum("chars").alias("chars"), F.sum("meaningful").alias("meaningful"))


@query(f"WITH {MEASURES} SELECT doc_id, round(watermark_ratio, 6) AS watermark_ratio, round(noise_ratio, 6) AS noise_ratio, language_chars FROM m")
def line_ratios(spark, sf):
    own = T.quality(table(spark, sf, "documents"), "text", MARKS, ["doc_id"])
    return own.select("doc_id", F.round("watermark_ratio", RATIO).alias("watermark_ratio"), F.round("noise_ratio", RATIO).alias("noise_ratio"), "language_chars")


@query(f"WITH {LINES}, a AS {_repeated('length(line) >= 8')}, b AS {_repeated('NOT ' + _label('line'))} SELECT d.doc_id, round(coalesce(a.ratio, 1.0), 6) AS repeated_ratio, round(coalesce(b.ratio, 1.0), 6) AS repeated_body_ratio FROM documents d LEFT JOIN a USING (doc_id) LEFT JOIN b USING (doc_id)")
def repeated_line_ratio(spark, sf):
    own = T.repeated_ratios(table(spark, sf, "documents"), "text", ["doc_id"])
    return own.select("doc_id", F.round("repeated_ratio", RATIO).alias("repeated_ratio"), F.round("repeated_body_ratio", RATIO).alias("repeated_body_ratio"))


@query(f"WITH {LINES} SELECT d.doc_id, count(line) FILTER ({_meaningful('line')}) AS meaningful, count(line) FILTER ({_body_meaningful('line')}) AS meaningful_body FROM documents d LEFT JOIN l USING (doc_id) GROUP BY d.doc_id")
def meaningful_lines(spark, sf):
    docs = table(spark, sf, "documents")
    own = T.quality(docs, "text", MARKS, ["doc_id"]).select("doc_id", "meaningful")
    body = table(spark, sf, "documents").select("doc_id", T.meaningful_body_lines("text", MARKS).alias("meaningful_body"))
    return own.join(body, "doc_id")


WEIRD = "len(list_distinct(list_filter(regexp_extract_all(text, '[A-Za-z0-9]{20,}'), lambda x: NOT regexp_full_match(x, '[A-Fa-f0-9]{24,}'))))"


@query(f"SELECT doc_id, {WEIRD} AS weird_tokens, CASE WHEN greatest(length(text) // 2000, 0) > CASE WHEN length(text) >= 100000 THEN 16 WHEN length(text) >= 60000 THEN 12 ELSE 8 END THEN least(length(text) // 2000, 80) ELSE CASE WHEN length(text) >= 100000 THEN 16 WHEN length(text) >= 60000 THEN 12 ELSE 8 END END AS weird_limit FROM documents")
def weird_tokens(spark, sf):
    return table(spark, sf, "documents").select("doc_id", T.weird_tokens("text").alias("weird_tokens"), T.weird_token_limit(F.length("text"), F.lit(0)).alias("weird_limit"))


EXTRACTOR = f"""{LINES}, b AS {_repeated('NOT ' + _label('line'))},
    c AS (SELECT doc_id, count(*) FILTER ({_noise('line')}) / count(*) AS wm, count(*) FILTER ({_body_meaningful('line')}) AS good FROM l GROUP BY doc_id),
    x AS (SELECT d.doc_id, length({sql_strip('text')}) AS chars, coalesce(b.ratio, 1.0) AS rep, coalesce(wm, 1.0) AS wm, coalesce(good, 0) AS good, {WEIRD} AS weird, {_letters(sql_strip('text'))} AS letters
          FROM documents d LEFT JOIN b USING (doc_id) LEFT JOIN c USING (doc_id)),
    y AS (SELECT *, CASE WHEN chars >= 100000 OR good >= 1000 THEN 16 WHEN chars >= 60000 OR good >= 500 THEN 12 ELSE 8 END AS base, greatest(chars // 2000, good // 20) AS scaled FROM x),
    z AS (SELECT *, chars >= 1800 AND rep < 0.45 AND wm < 0.18 AND (good >= 10 OR (chars >= 1800 AND letters >= 500 AND letters >= floor(chars * 0.25)))
            AND weird <= CASE WHEN scaled > base THEN least(scaled, 80) ELSE base END AS acceptable FROM y)"""


def extracted(spark, sf):
    x = T.extractor_quality(table(spark, sf, "documents"), "text", MARKS, ["doc_id"])
    return x.withColumn("acceptable", F.expr("chars >= 1800 and rep < 0.45D and wm < 0.18D and (good >= 10 or (chars >= 1800 and letters >= 500 and letters >= floor(chars * 0.25D))) and weird <= limit"))


@query(f"WITH {EXTRACTOR} SELECT acceptable, count(*) AS documents, sum(good) AS meaningful FROM z GROUP BY acceptable")
def quality_gate_extractor(spark, sf):
    return extracted(spark, sf).groupBy("acceptable").agg(F.count("*").alias("documents"), F.sum("good").alias("meaningful"))


@query(f"WITH {EXTRACTOR} SELECT CASE WHEN acceptable THEN 'accepted' WHEN chars >= 1200 AND good >= 8 AND rep < 0.50 AND wm < 0.20 THEN 'degraded' WHEN chars > 0 THEN 'rejected' ELSE 'empty' END AS tier, count(*) AS documents FROM z GROUP BY tier")
def quality_tier_case(spark, sf):
    tier = F.expr("case when acceptable then 'accepted' when chars >= 1200 and good >= 8 and rep < 0.50D and wm < 0.20D then 'degraded' when chars > 0 then 'rejected' else 'empty' end")
    return extracted(spark, sf).groupBy(tier.alias("tier")).agg(F.count("*").alias("documents"))


def _wrapped(lines):
    """CTEs from a table rows(doc_id, r: lines) to wrapped(doc_id, w: lines of at most 1200 characters)."""
    cut = "1201 - instr(reverse(substr(rest, 1, 1201)), ' ')"
    cut = f"CASE WHEN contains(substr(rest, 1, 1201), ' ') AND {cut} >= 600 THEN {cut} ELSE 1200 END"
    return f"""{lines}, l AS (SELECT doc_id, unnest(r) AS line, unnest(range(1, len(r) + 1)) AS i FROM rows),
    c(doc_id, i, k, part, rest) AS (SELECT doc_id, i, CAST(0 AS BIGINT), CAST(NULL AS VARCHAR), line FROM l WHERE length(line) > 1200
        UNION ALL SELECT doc_id, i, k + 1, CASE WHEN length(rest) <= 1200 THEN rest ELSE rtrim(substr(rest, 1, CAST({cut} AS BIGINT))) END,
            CASE WHEN length(rest) <= 1200 THEN '' ELSE regexp_replace(substr(rest, CAST({cut} AS BIGINT) + 1), '^\\s+', '') END FROM c WHERE rest <> ''),
    p AS (SELECT doc_id, i, CAST(0 AS BIGINT) AS k, line AS part FROM l WHERE length(line) <= 1200 UNION ALL SELECT doc_id, i, k, part FROM c WHERE k > 0 AND part <> ''),
    wrapped AS (SELECT doc_id, list(part ORDER BY i, k) AS w FROM p GROUP BY doc_id UNION ALL SELECT doc_id, [] FROM rows WHERE len(r) = 0)"""


CLEANED = _wrapped(f"""rows AS (SELECT doc_id, list_transform(list_filter(str_split(regexp_replace(text, '\\r\\n?', chr(10), 'g'), chr(10)), lambda x: NOT (x <> '' AND {_noise(sql_strip('x'))})), lambda x: {_unmarked('x')}) AS r FROM documents)""")


@query(f"WITH RECURSIVE {CLEANED} SELECT doc_id, sha256({sql_strip('regexp_replace(array_to_string(w, chr(10)), ' + chr(39) + chr(92) + 'n{3,}' + chr(39) + ', chr(10) || chr(10), ' + chr(39) + 'g' + chr(39) + ')')}) AS cleaned_sha FROM wrapped")
def clean_markdown(spark, sf):
    return table(spark, sf, "documents").select("doc_id", F.sha2(T.clean("text", MARKS), 256).alias("cleaned_sha"))


@query(f"""WITH {LINES}, n AS (SELECT doc_id, row_number() OVER (PARTITION BY doc_id) AS i, line FROM l),
    o AS (SELECT d.doc_id, u.i, u.line FROM documents d, LATERAL (SELECT unnest(range(1, len({sql_lines('d.text')}) + 1)) AS i, unnest({sql_lines('d.text')}) AS line) u),
    s AS (SELECT doc_id, i, length(line) AS n, sum(length(line) + 1) OVER (PARTITION BY doc_id ORDER BY i) AS used FROM o)
    SELECT d.doc_id, count(s.i) AS kept_lines, coalesce(sum(s.n), 0) + greatest(count(s.i) - 1, 0) AS kept_chars FROM documents d LEFT JOIN s ON s.doc_id = d.doc_id AND s.used <= 2000 GROUP BY d.doc_id""")
def budget_truncate(spark, sf):
    own = T.within_budget("text", 2000)
    rows = table(spark, sf, "documents").select("doc_id", own.alias("kept"))
    return rows.select("doc_id", F.when(F.col("kept") == "", 0).otherwise(F.size(F.split("kept", "\n"))).cast("bigint").alias("kept_lines"), F.length("kept").cast("bigint").alias("kept_chars"))


@query(f"WITH {LINES} SELECT doc_id, line FROM l WHERE {_noise('line')}")
def noise_line_filter(spark, sf):
    return table(spark, sf, "documents").select("doc_id", F.explode(F.filter(T.lines("text"), lambda x: T.is_noise(x, MARKS))).alias("line"))


@query(f"WITH {LINES} SELECT doc_id, {_unmarked('line')} AS stripped FROM l WHERE {_marked('line')}")
def watermark_strip(spark, sf):
    return table(spark, sf, "documents").select("doc_id", F.explode(F.filter(T.lines("text"), lambda x: T.marked(x, MARKS))).alias("line")).select("doc_id", T.without_marks("line", MARKS).alias("stripped"))


@query("SELECT doc_id, trim(regexp_replace(text, '\\s+', ' ', 'g')) AS squeezed FROM documents")
def squeeze_whitespace(spark, sf):
    return table(spark, sf, "documents").select("doc_id", T.squeeze("text").alias("squeezed"))


# Every fourth document is a single line, so that there is something to wrap.
ONE_LINE = "CASE WHEN doc_id % 4 = 0 THEN replace(text, chr(10), ' ') ELSE text END"


@query(f"WITH RECURSIVE {_wrapped(f'rows AS (SELECT doc_id, str_split({ONE_LINE}, chr(10)) AS r FROM documents)')} SELECT doc_id, list_max(list_transform(w, lambda x: length(x))) AS max_line, sha256(array_to_string(w, chr(10))) AS wrapped_sha FROM wrapped")
def hard_wrap(spark, sf):
    wrapped = T.hard_wrap(F.expr(ONE_LINE), 1200)
    return table(spark, sf, "documents").select("doc_id", wrapped.alias("w")).select("doc_id", F.array_max(F.transform("w", F.length)).alias("max_line"), F.sha2(F.array_join("w", "\n"), 256).alias("wrapped_sha"))


# The tables hold no noisy line, so every third document gets one of each kind.
NOISY_TEXT = "CASE WHEN doc_id % 3 = 0 THEN text || chr(10) || repeat('#$%&', 8) || chr(10) || 'a�b�c�' ELSE text END"


@query(f"WITH l AS (SELECT doc_id, unnest({sql_lines(NOISY_TEXT)}) AS line FROM documents) SELECT doc_id, count(*) AS noisy_lines FROM l WHERE {_noisy('line')} GROUP BY doc_id")
def noisy_line_filter(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", F.expr(NOISY_TEXT).alias("text"))
    return docs.select("doc_id", F.size(F.filter(T.lines("text"), T.is_noisy)).cast("bigint").alias("noisy_lines")).where("noisy_lines > 0")


@query(f"WITH {LINES} SELECT line, count(*) AS n FROM l WHERE {_label('line')} GROUP BY line")
def chart_label_filter(spark, sf):
    return table(spark, sf, "documents").select(F.explode(F.filter(T.lines("text"), T.is_chart_label)).alias("line")).groupBy("line").agg(F.count("*").alias("n"))


@query(f"WITH {MEASURES} SELECT doc_id, max_line, max_line > 1200 AS overlong FROM m")
def max_line_length(spark, sf):
    return table(spark, sf, "documents").select("doc_id", T.max_line_length("text").alias("max_line")).withColumn("overlong", F.col("max_line") > 1200)


@query(f"WITH x AS (SELECT doc_id, {sql_lines('text')} AS own FROM documents) SELECT doc_id, substr(array_to_string(own[greatest(len(own) - 5, 1):len(own)], ' | '), 1, 320) AS tail FROM x")
def safe_tail(spark, sf):
    return table(spark, sf, "documents").select("doc_id", T.tail("text").alias("tail"))


# Substrings that tell a failure's class, the first rule that holds counts.
FAILURES = [
    (["error 0", "error 1"], "env_failure:missing_dependency"),
    (["error 2"], "content_failure:page_geometry"),
    (["error 3", "error 4"], "env_failure:permission"),
    (["error 5"], "content_failure:parse_failure"),
    (["error"], "transient_failure:interrupted"),
]


def _case(rules, x):
    return "CASE " + " ".join(f"WHEN {' OR '.join(f'contains({x}, {chr(39)}{w}{chr(39)})' for w in words)} THEN '{v}'" for words, v in rules)


MESSAGE = "event_type || ' ' || CAST(CAST(floor(value) AS BIGINT) AS VARCHAR)"


@query(f"SELECT {_case(FAILURES, MESSAGE)} ELSE 'none' END AS failure, count(*) AS events FROM events GROUP BY failure")
def failure_class_case(spark, sf):
    message = F.concat_ws(" ", "event_type", F.floor("value").cast("string"))
    return table(spark, sf, "events").groupBy(T.ordered_case(message, FAILURES, "none").alias("failure")).agg(F.count("*").alias("events"))


VETOED = [(["signup"], "permanent"), (["error 1"], "permanent"), (["error", "click 2"], "transient")]


@query(f"SELECT {_case(VETOED, MESSAGE)} ELSE 'unknown' END AS kind, count(*) AS events, count(DISTINCT user_id) AS users FROM events GROUP BY kind")
def transient_veto_case(spark, sf):
    message = F.concat_ws(" ", "event_type", F.floor("value").cast("string"))
    return table(spark, sf, "events").groupBy(T.ordered_case(message, VETOED, "unknown").alias("kind")).agg(F.count("*").alias("events"), F.countDistinct("user_id").alias("users"))


ANCHORS = "list_filter(list_transform(str_split(text, '.'), lambda x: regexp_replace(lower(x), '[^a-z]', '', 'g')), lambda x: length(x) >= 12)[1:8]"


@query(f"WITH a AS (SELECT doc_id, {ANCHORS} AS anchors, regexp_replace(lower(text), '[^a-z]', '', 'g') AS body FROM documents), b AS (SELECT doc_id, len(anchors) AS anchors, len(list_filter(anchors, lambda x: contains(body, x))) AS hits FROM a) SELECT doc_id, anchors, hits, anchors > 0 AND hits >= CASE WHEN anchors <= 2 THEN 1 ELSE 2 END AS verified FROM b")
def anchor_verify(spark, sf):
    """The first eight sentences of 12 letters or more, looked for in the whole body."""
    anchors = F.slice(F.filter(F.transform(F.split("text", r"\."), _compact), lambda x: F.length(x) >= 12), 1, 8)
    rows = table(spark, sf, "documents").select("doc_id", anchors.alias("a"), _compact(F.col("text")).alias("body"))
    rows = rows.select("doc_id", F.size("a").alias("anchors"), F.size(F.filter("a", lambda x: F.contains(F.col("body"), x))).alias("hits"))
    return rows.withColumn("verified", F.expr("anchors > 0 and hits >= if(anchors <= 2, 1, 2)"))


def _compact(c):
    return F.regexp_replace(F.lower(c), "[^a-z]", "")


@query("SELECT doc_id, right(regexp_replace(regexp_replace(text, '(?i)(password|token)(\\s*=\\s*)\\S+', '\\1\\2***', 'g'), 'AKIA[A-Z0-9]{16}', 'AKIA***', 'g'), 1200) AS redacted FROM documents")
def redact_text(spark, sf):
    c = F.regexp_replace("text", r"(?i)(password|token)(\s*=\s*)\S+", "$1$2***")
    return table(spark, sf, "documents").select("doc_id", F.right(F.regexp_replace(c, "AKIA[A-Z0-9]{16}", "AKIA***"), F.lit(1200)).alias("redacted"))


# Forms of credentials and addresses.
SECRETS = {
    "email": "[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\\.[A-Za-z]{2,}",
    "access_key": "AKIA[0-9A-Z]{16}",
    "api_key": "sk-[A-Za-z0-9]{20,}",
    "private_key": "-----BEGIN [A-Z ]*PRIVATE KEY-----",
    "assignment": "(?i)(password|secret|token)\\s*[:=]\\s*[^\\s]{6,}",
}


@query(" UNION ALL ".join(f"SELECT doc_id, '{k}' AS label FROM documents WHERE regexp_matches(text, '{v}')" for k, v in SECRETS.items()))
def secret_pattern_scan(spark, sf):
    labels = F.array_compact(F.array(*(F.when(F.col("text").rlike(v), F.lit(k)) for k, v in SECRETS.items())))
    return table(spark, sf, "documents").select("doc_id", F.explode(labels).alias("label"))


@query(f"WITH {NOTES} SELECT doc_id, trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(title, '\\[\\[([^\\]|]+)\\|([^\\]]+)\\]\\]', '\\2', 'g'), '\\[\\[([^\\]]+)\\]\\]', '\\1', 'g'), '[#*`>]+', ' ', 'g'), '\\s+', ' ', 'g')) AS cleaned FROM notes")
def clean_search_text(spark, sf):
    return notes(spark, sf).select("doc_id", T.search_text("title").alias("cleaned"))
