"""Files as rows: scans with content hashes, notes with frontmatter, line logs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.identity import blank, first_of
from ..functions.keywords import escaped
from ..functions.text import WHITE, col, is_json


def accepted(path: Column | str, extension: str = ".pdf") -> Column:
    """Not hidden, temporary or of another extension."""
    name = F.regexp_extract(col(path), r"[^/]*$", 0)
    low = F.lower(name)
    return ~name.startswith(".") & ~name.startswith("~$") & low.endswith(extension) & ~low.rlike(r"\.(tmp|part|crdownload|download)(\.|$)")


def scan(spark: SparkSession, roots: list[str], pattern: str = "*.pdf") -> DataFrame:
    """(path, size_bytes, modified_at, sha, valid) of all files below the roots."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(roots)
    rows = files.where(accepted("path", pattern.lstrip("*").lower()))
    return rows.select("path", F.col("length").alias("size_bytes"), F.col("modificationTime").alias("modified_at"), F.sha2("content", 256).alias("sha"), pdf_status(F.col("content")).alias("valid"))


def pdf_status(content: Column, least: int = 1) -> Column:
    """ok, or why the bytes can't be a PDF file."""
    return F.when(content.isNull() | (F.length(content) < least), "empty").when(F.substring(content, 1, 5) != F.lit(b"%PDF-"), "bad_magic").otherwise("ok")


FRONT = r"(?s)\A---\r?\n(.*?)\r?\n---[ \t]*(?:\r?\n|\z)"


def frontmatter(text: Column | str) -> Column:
    """The lines 'key: value' of the head as a map; of a key that repeats the last value counts."""
    head = F.regexp_extract(col(text), FRONT, 1)
    rows = F.filter(F.split(head, r"\r?\n"), lambda x: x.rlike(r"^[A-Za-z_][\w-]*:"))
    pairs = F.transform(rows, lambda x: F.struct(F.regexp_extract(x, r"^([\w-]+):", 1).alias("key"), F.regexp_replace(F.regexp_replace(x, r"^[\w-]+:\s*", ""), r"^[\"']|[\"']?\s*$", "").alias("value")))
    lasts = F.filter(pairs, lambda p, i: F.size(F.filter(F.slice(pairs, i + 2, F.greatest(F.size(pairs), F.lit(1))), lambda q: q["key"] == p["key"])) == 0)
    return F.map_from_entries(lasts)


def body(text: Column | str) -> Column:
    return F.regexp_replace(col(text), FRONT, "")


def first_heading(text: Column | str) -> Column:
    found = F.regexp_extract(col(text), r"(?m)^#\s+(.+?)\s*$", 1)
    return F.when(found != "", found)


def notes(spark: SparkSession, root: str) -> DataFrame:
    """(path, frontmatter, title, body) of the Markdown notes below the root."""
    rows = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.md").text(root, wholetext=True)
    rows = rows.select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("text"))
    stem = F.regexp_replace(F.regexp_extract("path", r"[^/]*$", 0), r"\.md$", "")
    return rows.select("path", frontmatter("text").alias("frontmatter"), F.coalesce(first_heading("text"), stem).alias("title"), body("text").alias("body"))


def linked_targets(text: Column | str) -> Column:
    """Distinct targets of double-bracket links."""
    return F.array_distinct(F.transform(F.regexp_extract_all(col(text), F.lit(r"\[\[([^\]|#]+)"), F.lit(1)), lambda x: F.trim(x)))


def section(text: Column | str, heading: str) -> Column:
    """The body under a second-level heading, up to the next one; empty without it."""
    return F.trim(F.regexp_extract(col(text), rf"(?ms)^##[ \t]*{heading}[ \t]*$\n(.*?)(?=^## |\z)", 1))


def json_lines(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Rows of a JSON-lines log; lines that aren't a JSON object of the schema are skipped."""
    return spark.read.schema(schema).option("mode", "DROPMALFORMED").json(path)


def append(df: DataFrame, path: str, partition: str | None = None) -> None:
    writer = df.write.mode("append")
    (writer.partitionBy(partition) if partition else writer).parquet(path)


def render_notes(df: DataFrame, keys: list[str], body: str) -> DataFrame:
    """(value): each row as a note, its keys as frontmatter."""
    head = F.concat_ws("\n", F.lit("---"), *(F.concat(F.lit(f"{k}: "), F.coalesce(F.col(k).cast("string"), F.lit(""))) for k in keys), F.lit("---"))
    return df.select(F.concat_ws("\n\n", head, F.col(body)).alias("value"))


def payload_reason(ok: Column | str, status: Column | str, text: Column | str) -> Column:
    """Why an API's answer can't be used, null if it can: its status, no JSON object, an error code, or topics of another shape."""
    text = F.coalesce(blank(text), F.lit("{}"))
    data = F.when(is_json(text) & F.startswith(F.btrim(text), F.lit("{")), text)
    code = F.btrim(F.get_json_object(data, "$.code"))
    code = F.when(code.isin("", "0", "None", "null"), None).otherwise(code)
    failed = F.coalesce(F.get_json_object(data, "$.succeeded") == "false", F.lit(False)) | code.isNotNull()
    topics = F.get_json_object(data, "$.resp_data.topics")
    shaped = topics.isNull() | topics.isin("", "0", "false", "{}") | F.startswith(topics, F.lit("["))
    return (
        F.when(~F.coalesce(col(ok), F.lit(False)), F.concat(F.lit("api_status_"), F.coalesce(col(status).cast("string"), F.lit("None"))))
        .when(data.isNull(), "api_invalid_json")
        .when(failed, F.concat(F.lit("api_error_"), F.coalesce(code, F.lit("unknown"))))
        .when(~shaped, "api_invalid_topics")
    )


def payload_topics(ok: Column | str, status: Column | str, text: Column | str) -> Column:
    """The topics (JSON objects as texts) of a usable answer; none of any other."""
    topics = F.from_json(F.get_json_object(F.coalesce(blank(text), F.lit("{}")), "$.resp_data.topics"), "array<string>")
    none = F.array().cast("array<string>")
    return F.when(payload_reason(ok, status, text).isNull(), F.filter(F.coalesce(topics, none), lambda x: F.startswith(x, F.lit("{")))).otherwise(none)


def unwrapped(plan: Column | str) -> Column:
    """A plan's snapshot if it holds one as an object, else the plan."""
    inner = F.get_json_object(col(plan), "$.scan_snapshot")
    return F.when(F.startswith(inner, F.lit("{")), inner).otherwise(col(plan))


def listed_paths(text: Column | str) -> Column:
    """The paths that a list names, in order, each once: a JSON list, an object with notes, note_paths or a batch's files, or plain lines."""
    text = F.btrim(F.coalesce(col(text), F.lit("")), F.lit(WHITE))
    good = is_json(text)
    data = F.from_json(text, "notes array<string>, note_paths array<string>, files array<struct<obsidian_note_path: string>>")
    none = F.array().cast("array<string>")
    some = F.when(F.size(data["notes"]) > 0, data["notes"]).when(F.size(data["note_paths"]) > 0, data["note_paths"]).otherwise(F.transform(data["files"], lambda x: x["obsidian_note_path"]))
    items = F.when(good & F.startswith(text, F.lit("[")), F.from_json(text, "array<string>")).when(good & F.startswith(text, F.lit("{")), some).when(good & text.rlike(r"^[\d\"]"), none).otherwise(F.split(text, "\\r?\\n"))
    return F.array_distinct(F.filter(F.transform(F.coalesce(items, none), lambda x: F.btrim(x)), lambda x: x.isNotNull() & (x != "")))


def manual_batch(paths: DataFrame, path: str = "path") -> DataFrame:
    """(path, filename): accepted paths of an explicit list, each once, whatever slashes and spaces it is written with, in order."""
    from ..functions.identity import path_key

    rows = paths.where(accepted(path)).select(path_key(path).alias("path")).distinct()
    return rows.select("path", F.regexp_extract("path", "[^/]*$", 0).alias("filename")).orderBy("path")


def file_counts(paths: DataFrame, path: str = "path") -> DataFrame:
    """(extension, files): how many files there are by extension in lower case; hidden ones don't count."""
    name = F.regexp_extract(F.col(path), "[^/]*$", 0)
    rows = paths.where(~F.startswith(name, F.lit(".")))
    return rows.groupBy(F.lower(F.regexp_extract(name, r"\.([^.]*)$", 1)).alias("extension")).agg(F.count("*").alias("files"))


def batch_dir(start: Column | str, end: Column | str) -> Column:
    """The name of the folder of a window's files."""
    form = "yyyy-MM-dd'_'HH-mm-ss"
    return F.concat(F.date_format(col(start), form), F.lit("__to__"), F.date_format(col(end), form))


def display_time(value: Column | str) -> Column:
    """Month, day and minute of an ISO time; a text that is none as it stands, and a sign for a blank one."""
    at = F.try_to_timestamp(F.replace(F.btrim(col(value)), F.lit("T"), F.lit(" ")))
    return F.coalesce(F.date_format(at, "MM-dd HH:mm"), blank(F.btrim(col(value))), F.lit("未知"))


def since(value: Column | str, today: Column | None = None) -> Column:
    """The first day that counts: days back from today, written 30d, as an ISO date; any other text as it stands."""
    value = F.btrim(F.coalesce(col(value), F.lit("")))
    days = F.try_element_at(F.regexp_extract_all(value, F.lit(r"^(\d{1,6})d$"), F.lit(1)), F.lit(1)).cast("int")
    return F.coalesce(F.date_format(F.date_sub(today if today is not None else F.current_date(), days), "yyyy-MM-dd"), value)


def has_link(text: Column | str, target: Column | str) -> Column:
    return F.array_contains(linked_targets(text), col(target))


def with_field(text: Column | str, key: str, value: Column | str) -> Column:
    """The note with a field of its frontmatter set: in place, behind the others, or with a frontmatter of its own; a head without an end stays."""
    text, line = col(text), F.concat(F.lit(f"{key}: "), col(value).cast("string"))
    end = F.locate("\n---", text, 5)
    raw = F.substring(text, F.lit(5), F.greatest(end - 5, F.lit(0)))
    rows = F.filter(F.split(raw, "\n"), lambda x: (x != "") | (raw != ""))
    at = F.array_position(F.transform(rows, lambda x: F.trim(F.substring_index(x, ":", 1)) == key), True)
    new = F.when(at > 0, F.transform(rows, lambda x, i: F.when(i == at - 1, line).otherwise(x))).otherwise(F.concat(rows, F.array(line)))
    whole = F.concat(F.lit("---\n"), F.array_join(new, "\n"), F.substring(text, end, F.length(text)))
    return F.when(~F.startswith(text, F.lit("---\n")), F.concat(F.lit("---\n"), line, F.lit("\n---\n\n"), text)).when(end == 0, text).otherwise(whole)


def _around(text: Column, heading: str) -> tuple[Column, Column, Column]:
    """(before the heading, heading and body, from the next second-level heading on); the second is empty without the heading."""
    parts = rf"(?ms)\A(.*?)(^##[ \t]+{escaped(heading)}[ \t]*$.*?)(^##\s.*)?\z"
    return tuple(F.regexp_extract(text, parts, i) for i in (1, 2, 3))


def with_section(text: Column | str, heading: str, body: Column | str) -> Column:
    """The note with the section's body replaced, or with the section behind it."""
    text, body = col(text), F.coalesce(blank(body), F.lit(""))
    before, own, after = _around(text, heading)
    section = F.concat(F.lit(f"## {heading}\n"), F.when(body != "", F.concat(body, F.lit("\n"))).otherwise(""))
    added = F.concat(text, F.when(F.endswith(text, F.lit("\n")), "").otherwise("\n"), F.lit("\n"), section)
    rest = F.regexp_replace(after, r"^\n+", "")
    replaced = F.concat(F.rtrim(before, F.lit(WHITE)), F.lit("\n\n"), section, F.when(rest != "", F.concat(F.lit("\n"), rest)).otherwise(""))
    return F.when(own == "", added).otherwise(replaced)


def with_link(text: Column | str, heading: str, target: Column | str, shown: Column | str) -> Column:
    """The note with a line for the link at the end of the section; as it is if it has the link already or no such section."""
    text = col(text)
    before, own, after = _around(text, heading)
    head = F.concat(before, own)
    line = F.concat(F.when(F.endswith(head, F.lit("\n")), "").otherwise("\n"), F.lit("- "), col(shown), F.lit("\n"), F.when((after == "") | F.startswith(after, F.lit("\n")), "").otherwise("\n"))
    return F.when(has_link(text, target) | (own == ""), text).otherwise(F.concat(head, line, after))
