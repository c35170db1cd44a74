"""Notes edited, paths listed, relative dates, geometry errors, the search index and queries as they are typed."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import search as S
from ..sources import files
from .base import NOTES, notes, query, table
from .files import NAME
from .results import both

NL = "chr(10)"
HEAD = f"'---' || {NL} || 'lang: ' || lang || {NL} || 'source: ' || source || {NL} || '---' || {NL} || 'body ' || CAST(doc_id AS VARCHAR)"
TAIL = f"{NL} || '## End' || {NL} || 'last' || {NL}"


@query(f"SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN '---' || {NL} || 'lang: xx' || {NL} || '---' || {NL} || {NL} || 'plain' ELSE replace({HEAD}, 'lang: ' || lang, 'lang: xx') END AS field_set, "
       f"CASE WHEN doc_id % 3 = 0 THEN '---' || {NL} || 'rating: 5' || {NL} || '---' || {NL} || {NL} || 'plain' ELSE replace({HEAD}, 'source: ' || source, 'source: ' || source || {NL} || 'rating: 5') END AS field_added FROM documents")  # fmt: skip
def frontmatter_edit(spark, sf):
    rows = table(spark, sf, "documents").select("doc_id", F.when(F.col("doc_id") % 3 == 0, "plain").otherwise(F.expr(HEAD.replace("AS VARCHAR", "AS STRING"))).alias("n"))
    return rows.select("doc_id", files.with_field("n", "lang", F.lit("xx")).alias("field_set"), files.with_field("n", "rating", F.lit(5)).alias("field_added"))


LINKS = f"'# ' || source || {NL} || {NL} || '## Links' || {NL} || '- [[' || lang || ']]' || {NL}"


@query(f"""SELECT doc_id, CASE doc_id % 3 WHEN 0 THEN 'x' || {NL} || {NL} || '## Links' || {NL} || 'new' || {NL} WHEN 1 THEN '# ' || source || {NL} || {NL} || '## Links' || {NL} || 'new' || {NL} || {NL} || '## End' || {NL} || 'last' || {NL} ELSE '# ' || source || {NL} || {NL} || '## Links' || {NL} || 'new' || {NL} END AS replaced,
    CASE doc_id % 3 WHEN 0 THEN 'x' WHEN 1 THEN CASE WHEN lang = 'de' THEN {LINKS} || {TAIL} ELSE {LINKS} || {NL} || '- [[de|shown]]' || {NL} || {NL} || '## End' || {NL} || 'last' || {NL} END ELSE CASE WHEN lang = 'de' THEN {LINKS} ELSE {LINKS} || '- [[de|shown]]' || {NL} END END AS linked FROM documents""")
def section_edit(spark, sf):
    text = F.when(F.col("doc_id") % 3 == 0, "x").when(F.col("doc_id") % 3 == 1, F.expr(f"{LINKS} || {TAIL}")).otherwise(F.expr(LINKS))
    rows = table(spark, sf, "documents").select("doc_id", text.alias("n"))
    return rows.select("doc_id", files.with_section("n", "Links", F.lit("new")).alias("replaced"), files.with_link("n", "Links", F.lit("de"), F.lit("[[de|shown]]")).alias("linked"))


LISTS = """CASE event_id % 6 WHEN 0 THEN '["n/b.md", "n/' || event_type || '.md", " n/b.md "]' WHEN 1 THEN '{"notes": ["n/' || event_type || '.md", ""]}' WHEN 2 THEN '{"files": [{"obsidian_note_path": "n/x.md"}, {"path": "y"}, {"obsidian_note_path": "n/' || event_type || '.md"}]}'
    WHEN 3 THEN ' n/a.md' || chr(10) || chr(10) || 'n/' || event_type || '.md' || chr(10) || 'n/a.md' WHEN 4 THEN '{"note_paths": ["n/z.md"]}' ELSE '' END"""


@query("""SELECT event_id, CASE event_id % 6 WHEN 0 THEN 'n/b.md,n/' || event_type || '.md' WHEN 1 THEN 'n/' || event_type || '.md' WHEN 2 THEN 'n/x.md,n/' || event_type || '.md' WHEN 3 THEN 'n/a.md,n/' || event_type || '.md' WHEN 4 THEN 'n/z.md' ELSE '' END AS paths FROM events""")
def note_path_lists(spark, sf):
    return table(spark, sf, "events").select("event_id", F.array_join(files.listed_paths(F.expr(LISTS)), ",").alias("paths"))


@query(f"WITH n AS (SELECT DISTINCT regexp_replace({NAME}, '/{{2,}}', '/', 'g') AS path FROM events) SELECT path, regexp_extract(path, '[^/]*$') AS filename FROM n WHERE NOT regexp_matches(path, '/[.~][^/]*$') AND lower(path) LIKE '%.pdf'")
def manual_batch_rows(spark, sf):
    path = F.expr(NAME)
    twice = table(spark, sf, "events").select(F.explode(F.array(path, F.replace(path, F.lit("/"), F.lit("//")))).alias("path"))
    return files.manual_batch(twice)


@query(f"WITH n AS (SELECT {NAME} AS path FROM events) SELECT lower(regexp_extract(path, '\\.([^./]*)$', 1)) AS extension, count(*) AS files FROM n WHERE NOT regexp_matches(path, '/\\.[^/]*$') GROUP BY 1")
def file_count_sources(spark, sf):
    return files.file_counts(table(spark, sf, "events").select(F.expr(NAME).alias("path")))


@query("SELECT event_id, CASE event_id % 3 WHEN 0 THEN strftime(DATE '2024-03-01' - CAST(user_id % 400 AS INTEGER), '%Y-%m-%d') WHEN 1 THEN '2024-01-05' ELSE '' END AS since FROM events")
def since_grammar(spark, sf):
    text = F.when(F.col("event_id") % 3 == 0, F.concat((F.col("user_id") % 400).cast("string"), F.lit("d"))).when(F.col("event_id") % 3 == 1, "2024-01-05").otherwise(" ")
    return table(spark, sf, "events").select("event_id", files.since(text, F.lit("2024-03-01").cast("date")).alias("since"))


MESSAGE = "CASE event_id % 9 WHEN 0 THEN 'Image too large' WHEN 1 THEN 'image dimensions are too large: 9' WHEN 2 THEN 'Image size exceeds' WHEN 3 THEN 'the maximum image dimension' WHEN 4 THEN 'UNSUPPORTED_PAGE_GEOMETRY' WHEN 5 THEN 'in _encode_tile' WHEN 6 THEN 'pix too large' WHEN 7 THEN NULL ELSE 'large image' END"


@query("SELECT event_type, count(*) FILTER (event_id % 9 < 7) AS geometry, count(*) AS n FROM events GROUP BY event_type")
def geometry_error(spark, sf):
    return table(spark, sf, "events").groupBy("event_type").agg(F.count_if(T.is_geometry_error(F.expr(MESSAGE))).alias("geometry"), F.count("*").alias("n"))


@query("""SELECT event_id, CASE WHEN event_id % 2 = 0 THEN '{"k":1}' ELSE '{"k": 2, "scan_snapshot": null}' END AS plan FROM events""")
def plan_unwrap(spark, sf):
    plan = F.when(F.col("event_id") % 2 == 0, '{"scan_snapshot": {"k": 1}, "other": 3}').otherwise('{"k": 2, "scan_snapshot": null}')
    return table(spark, sf, "events").select("event_id", files.unwrapped(plan).alias("plan"))


def _cleaned(x):
    return f"trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace({x}, '\\[\\[([^\\]|]+)\\|([^\\]]+)\\]\\]', '\\2', 'g'), '\\[\\[([^\\]]+)\\]\\]', '\\1', 'g'), '[#*`>]+', ' ', 'g'), '\\s+', ' ', 'g'))"


@query(f"""WITH {NOTES}, i AS (SELECT doc_id, {_cleaned('title')} AS title, lang || ' ' || source AS themes, {_cleaned("'## ' || text")} AS summary_text FROM notes)
    SELECT doc_id, sha256(title || '|' || themes || '|' || summary_text) AS indexed, greatest(length(title) - 2, 0) + greatest(length(themes) - 2, 0) + greatest(length(summary_text) - 2, 0) AS doc_len FROM i""")
def search_index_build(spark, sf):
    reports = notes(spark, sf).select("doc_id", "title", F.array("lang", "source").alias("themes"), F.concat(F.lit("## "), "text").alias("summary_text"))
    rows = S.index_rows(reports, "doc_id")
    return rows.select("doc_id", F.sha2(F.concat_ws("|", "title", "themes", "summary_text"), 256).alias("indexed"), "doc_len")


TYPED = ['thing AND "und "', 'whor OR "edst"', '"open', "thing AND", "OR", "a:b", "", "NOT thing"]


@query("""WITH t AS (SELECT lower(text) AS t FROM documents) SELECT * FROM (SELECT 0 AS query, count(*) AS found FROM t WHERE contains(t, 'thing') AND contains(t, 'und ')
    UNION ALL SELECT 1, count(*) FROM t WHERE contains(t, 'whor') OR contains(t, 'edst')) UNION ALL SELECT i, 0 FROM (SELECT unnest(range(2, 8)) AS i)""")
def malformed_query_empty(spark, sf):
    docs, out = table(spark, sf, "documents").select("doc_id", "text"), None
    for i, q in enumerate(TYPED):
        one = S.matched(docs, "doc_id", ["text"], q).agg(F.count("*").alias("found")).select(F.lit(i).alias("query"), "found")
        out = one if out is None else out.unionByName(one)
    return out
