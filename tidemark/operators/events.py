"""Report events: stages and artifacts of a status, events of a batch's items, event and payload rows, batches from chunks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.identity import blank, first_of
from ..functions.text import col

# Status prefixes, the stage of each, and the columns that may hold its artifact, in order.
FAMILIES = [
    ("raw_md_", "raw_md", ["raw_md_path", "path", "pdf_path"]),
    ("clean_md_", "clean_md", ["clean_md_path", "raw_md_path"]),
    ("text_extract_", "text_extract", ["extracted_text_path", "path", "pdf_path"]),
    ("summary_", "summary", ["summary_md_path"]),
    ("feishu_", "feishu", ["doc_url", "feishu_doc_url", "summary_md_path"]),
    ("obsidian_", "obsidian", ["obsidian_note_path", "summary_md_path"]),
]
OTHER_ARTIFACT = ["path", "pdf_path", "archive_path"]
# The columns of an event.
EVENT_FIELDS = ["report_id", "pdf_sha256", "batch_id", "stage", "status", "artifact_path", "feishu_doc_url", "error_message", "run_id", "batch_file", "chunk_file"]
# Fixed value: the source of a text that needs no other.
PREPARED = "markitdown_clean"


def _or_empty(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


def _text(c: Column | str) -> Column:
    """The value as text without white space at its ends; null is empty."""
    return F.btrim(_or_empty(col(c).cast("string")))


def stage_of(status: Column | str) -> Column:
    """The stage that a status belongs to; a status that no rule knows is its own stage."""
    status = _text(status)
    out = None
    for prefix, stage, _ in FAMILIES:
        hit = F.startswith(status, F.lit(prefix))
        out = F.when(hit, stage) if out is None else out.when(hit, stage)
    out = out.when(F.startswith(status, F.lit("pdf_")) | (status == "downloaded"), "pdf").when(status == "needs_review", "review")
    return out.otherwise(status)


def artifact_of(status: Column | str, columns: list[str]) -> Column:
    """The path of what a status is about: the first of its family's columns, of those that there are, that isn't blank."""
    status, out = _text(status), None

    def first(names: list[str]) -> Column:
        there = [n for n in names if n in columns]
        return F.btrim(_or_empty(first_of(*there))) if there else F.lit("")

    for prefix, _, names in FAMILIES:
        hit = F.startswith(status, F.lit(prefix))
        out = F.when(hit, first(names)) if out is None else out.when(hit, first(names))
    return out.otherwise(first(OTHER_ARTIFACT))


def normalized(events: DataFrame) -> DataFrame:
    """events with exactly the columns of an event, as trimmed texts: status from index_status where it is blank, stage from the status."""
    there = set(events.columns)
    status = _or_empty(first_of(*(c for c in ("status", "index_status") if c in there))) if there & {"status", "index_status"} else F.lit("")
    status = F.btrim(status)
    out = []
    for c in EVENT_FIELDS:
        if c == "status":
            value = status
        elif c == "stage":
            own = blank(_text(c)) if c in there else F.lit(None).cast("string")
            value = F.coalesce(own, stage_of(status))
        else:
            value = _text(c) if c in there else F.lit("")
        out.append(value.alias(c))
    return events.select(*out)


def needs_fallback(exists: Column | str) -> Column:
    """Whether an item's text must be extracted anew: unless it was prepared well and its file exists."""
    good = (_text("text_extract_status") == "success") & (_text("text_source") == PREPARED)
    return ~(good & F.coalesce(col(exists), F.lit(False)))


def extraction_events(items: DataFrame) -> DataFrame:
    """The events (status, artifact_path, error_message, report_id, pdf_sha256, ...) of items whose text came from a fallback or failed; items without an identity have none."""
    state, source = _text("text_extract_status"), _text("text_source")
    status = F.when((state == "success") & (source != "") & (source != PREPARED), "text_extract_fallback_success").when(state == "failed", "text_extract_failed")
    rows = items.withColumn("status", status).where(F.col("status").isNotNull())
    rows = rows.where((_text("report_id") != "") | (_text("pdf_sha256") != ""))
    return rows.withColumn("artifact_path", artifact_of("status", items.columns)).withColumn("error_message", _text("text_extract_error"))


def started_events(items: DataFrame, exists: str) -> DataFrame:
    """The events of items whose text extraction starts anew."""
    rows = items.where(needs_fallback(exists) & ((_text("report_id") != "") | (_text("pdf_sha256") != "")))
    rows = rows.withColumn("status", F.lit("text_extract_fallback_started"))
    return rows.withColumn("artifact_path", artifact_of("status", items.columns))


def as_payload(records: DataFrame, lists: list[str], texts: list[str]) -> DataFrame:
    """records for a table of texts: lists as JSON columns <name>_json (null: an empty list), texts without nulls."""
    out = [F.to_json(F.coalesce(col(c), F.array().cast("array<string>"))).alias(f"{c}_json") if c in lists else _or_empty(col(c).cast("string")).alias(c) if c in texts else col(c) for c in records.columns]
    return records.select(*out)


def citation(report_id: str, note_path: str, summary_path: str, pdf_path: str, heading: str) -> Column:
    """Where a statement about a report comes from, as a struct; its snippet is filled in by a search."""
    parts = {"report_id": report_id, "note_path": note_path, "summary_path": summary_path, "pdf_path": pdf_path}
    return F.struct(*(_or_empty(col(c).cast("string")).alias(n) for n, c in parts.items()), F.lit(heading).alias("heading"), F.lit("").alias("snippet"))


def acknowledged_batch(chunks: DataFrame, chunk: str, files: str) -> DataFrame:
    """One row per batch: the first chunk's columns, the files of all its chunks in order, and their count.

    chunks: a row each, with its number in the column chunk and an array in files. A
    batch's files come together, as they are one row of the result.
    """
    rows = F.array_sort(F.collect_list(F.struct(F.col(chunk).alias("at"), F.col(files).alias("f"))))
    first = F.min_by(F.struct(*(c for c in chunks.columns if c not in (chunk, files, "batch"))), F.col(chunk))
    out = chunks.groupBy("batch").agg(first.alias("base"), F.flatten(F.transform(rows, lambda x: F.coalesce(x["f"], F.array().cast(chunks.schema[files].dataType)))).alias(files))
    return out.select("batch", "base.*", files, F.size(files).alias("file_count"))


def in_order_of(left: DataFrame, right: DataFrame, key: str, position: str) -> DataFrame:
    """left's rows in the order of their position, each with the first of right's rows of its key (by position too); right's columns as struct found, null where it has none."""
    rows = F.struct(*(right[c] for c in right.columns))
    best = right.groupBy(F.col(key).alias("__key")).agg(F.min_by(rows, F.col(position)).alias("found"))
    return left.join(best, F.col(key) == F.col("__key"), "left").drop("__key").orderBy(position)
