"""Sources: paths, notes, logs, payloads and transcripts."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import arrow
from ..sources import files
from .base import inline, query, table

NAME = "CASE event_id % 5 WHEN 0 THEN 'a/.' || event_type || '.pdf' WHEN 1 THEN 'a/~$' || event_type || '.pdf' WHEN 2 THEN 'b/' || event_type || '.PDF' WHEN 3 THEN 'b/' || event_type || '.pdf.part' ELSE 'c/' || event_type || '.txt' END"


@query(f"WITH n AS (SELECT event_id, {NAME} AS path FROM events) SELECT event_id, path FROM n WHERE NOT regexp_matches(path, '/[.~][^/]*$') AND lower(path) LIKE '%.pdf'")
def file_ignore_filter(spark, sf):
    own = table(spark, sf, "events").select("event_id", F.expr(NAME).alias("path"))
    return own.where(files.accepted("path"))


@query("SELECT doc_id, lang, split_part(text, chr(10), 1) AS title, length(text) AS body_chars FROM documents")
def note_scan(spark, sf):
    note = F.concat(F.lit("---\nlang: "), F.col("lang"), F.lit("\n---\n"), F.col("text"))
    rows = table(spark, sf, "documents").select("doc_id", note.alias("note"))
    return rows.select("doc_id", files.frontmatter("note")["lang"].alias("lang"), F.substring_index(files.body("note"), "\n", 1).alias("title"), F.length(files.body("note")).alias("body_chars"))


@query("SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events WHERE event_id % 7 <> 0")
def jsonl_permissive(spark, sf):
    line = F.when(F.col("event_id") % 7 == 0, F.concat(F.lit("broken "), "props")).otherwise(F.col("props"))
    own = table(spark, sf, "events").select("event_id", F.from_json(line, "k bigint").alias("j"))
    return own.where("j.k is not null").select("event_id", "j.k")


@query("SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events")
def json_shape_coalesce(spark, sf):
    nested = F.when(F.col("event_id") % 2 == 0, F.concat(F.lit('{"result": '), F.col("props"), F.lit("}"))).otherwise(F.col("props"))
    return table(spark, sf, "events").select("event_id", F.coalesce(F.get_json_object(nested, "$.k"), F.get_json_object(nested, "$.result.k")).cast("bigint").alias("k"))


@query("""WITH l AS (SELECT conv_id, turn, unnest(str_split(text, chr(10))) AS line, unnest(range(0, len(str_split(text, chr(10))))) AS pos FROM conversations),
    n AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn, pos) AS i FROM l WHERE trim(line) <> ''),
    c AS (SELECT *, lag(line, 1, '') OVER w || '|' || lag(line, 2, '') OVER w || '|' || lag(line, 3, '') OVER w AS before FROM n WINDOW w AS (PARTITION BY conv_id ORDER BY i)),
    m AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY i DESC) AS k FROM c WHERE length(line) % 2 = 0 AND NOT contains(before, 'idiot'))
    SELECT conv_id, i, line FROM m WHERE k = 1""")
def transcript_marker_last(spark, sf):
    rows = table(spark, sf, "conversations").select("conv_id", "turn", F.posexplode(F.split("text", "\n")).alias("pos", "line")).where("trim(line) <> ''")
    by = Window.partitionBy("conv_id").orderBy("turn", "pos")
    rows = rows.withColumn("i", F.row_number().over(by).cast("bigint")).withColumn("before", F.concat_ws("|", F.collect_list("line").over(by.rowsBetween(-3, -1))))
    marked = rows.where((F.length("line") % 2 == 0) & ~F.contains("before", F.lit("idiot")))
    return marked.groupBy("conv_id").agg(F.max_by(F.struct("i", "line"), "i").alias("m")).select("conv_id", "m.i", "m.line")


@query("""WITH s AS (SELECT conv_id, turn, role, last_value(CASE WHEN role <> 'user' THEN role END IGNORE NULLS) OVER (PARTITION BY conv_id ORDER BY turn) AS section FROM conversations)
    SELECT conv_id, turn, section FROM s WHERE section = 'assistant'""")
def transcript_sections(spark, sf):
    by = Window.partitionBy("conv_id").orderBy("turn")
    mark = F.when(F.col("role") != "user", F.col("role"))
    return table(spark, sf, "conversations").withColumn("section", F.last(mark, ignorenulls=True).over(by)).where("section = 'assistant'").select("conv_id", "turn", "section")


ALLOWED = [("error",), ("purchase",)]


@query("WITH r AS (SELECT user_id, event_type AS reason, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS k FROM events WHERE event_type IN ('error', 'purchase')) SELECT user_id, reason FROM r WHERE k = 1")
def last_reason_line(spark, sf):
    line = F.concat(F.lit("launcher: reason="), F.col("event_type"))
    own = table(spark, sf, "events").select("user_id", "ts", "event_id", F.regexp_extract(line, "reason=([a-z_]+)", 1).alias("reason"))
    allowed = own.join(inline(spark, "reason", ALLOWED), "reason", "left_semi")
    return allowed.groupBy("user_id").agg(F.max_by("reason", F.struct("ts", "event_id")).alias("reason"))


@query("SELECT event_id, replace(props, ' ', '') AS payload FROM events")
def last_json_object(spark, sf):
    text = F.concat(F.lit('log {"old": 1} then '), "props", F.lit(" and {broken"))
    return table(spark, sf, "events").select("event_id", arrow.last_json_object()(text).alias("payload"))


@query("SELECT event_id, unnest([json_extract_string(props, '$.k'), 'x']) AS value FROM events")
def json_values_at_depth(spark, sf):
    text = F.concat(F.lit('{"a": [1, '), "props", F.lit(', {"b": {"k": "x"}}]}'))
    return table(spark, sf, "events").select("event_id", F.explode(arrow.json_values("k")(text)).alias("value"))
