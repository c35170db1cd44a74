"""Answers and pages: evidence, claims, rendered sections; result texts, outcomes, backfills; scans that stop at a window, endpoints, memberships."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.identity import blank, file_key
from ..functions.text import col, is_json, search_text
from ..sources.files import linked_targets, payload_reason, payload_topics

NOTHING = "- 暂无"


def evidence_line(place: Column, title: str, date: str, broker: str, snippet: str, width: int = 220) -> Column:
    """A source as a line: its number, title, date and broker in brackets, and the start of its snippet."""
    meta = F.concat_ws(" / ", blank(date), blank(broker))
    shown = F.substring(search_text(F.coalesce(col(snippet), F.lit(""))), 1, width)
    return F.concat(F.lit("- [S"), place.cast("string"), F.lit("] "), F.coalesce(col(title), F.lit("")), F.when(meta != "", F.concat(F.lit("（"), meta, F.lit("）"))).otherwise(""), F.when(shown != "", F.concat(F.lit("："), shown)).otherwise(""))


def references(ranked: DataFrame, rules: list[tuple[list[str], str]], place: str = "place", text: str = "text", most: int = 4) -> DataFrame:
    """(rule, claim, refs): for each rule that any ranked source holds a word of, the first sources that do, as S1、S2."""
    low = F.lower(F.coalesce(F.col(text), F.lit("")))
    held = []
    for i, (words, claim) in enumerate(rules):
        hit = F.lit(False)
        for w in words:
            hit = hit | F.contains(low, F.lit(w.lower()))
        held.append(F.when(hit, F.struct(F.lit(i).alias("rule"), F.lit(claim).alias("claim"))))
    rows = ranked.select(F.col(place).alias("place"), F.explode(F.array_compact(F.array(*held))).alias("r")).select("place", "r.*")
    firsts = rows.withColumn("k", F.row_number().over(Window.partitionBy("rule").orderBy("place"))).where(F.col("k") <= most)
    names = F.transform(F.array_sort(F.collect_list("place")), lambda p: F.concat(F.lit("S"), p.cast("string")))
    return firsts.groupBy("rule", "claim").agg(F.array_join(names, "、").alias("refs"))


def claims(ranked: DataFrame, query: str, triggers: list[str], rules: list[tuple[list[str], str]], most: int = 8, width: int = 220) -> DataFrame:
    """(place, claim): what the ranked sources (place, text, snippet) say about a query.

    If the query holds a trigger, each rule's claim that sources support, with its
    references; without any such claim the snippets of the first four sources. Equal claims come once.
    """
    asked = any(t.lower() in query.lower() for t in triggers)
    told = references(ranked, rules if asked else [([], "")]).select(F.col("rule").alias("at"), F.concat(F.lit("- ["), "refs", F.lit("] "), "claim").alias("claim"), F.lit(0).alias("kind"))
    shown = F.substring(search_text(F.coalesce(F.col("snippet"), F.lit(""))), 1, width)
    own = ranked.where(F.col("place") <= 4).select(F.col("place").alias("at"), F.when(shown != "", F.concat(F.lit("- [S"), F.col("place").cast("string"), F.lit("] "), shown)).alias("claim"), F.lit(1).alias("kind")).where("claim is not null")
    both = told.unionByName(own)
    # Snippets count only without a claim: the least kind is the one that is shown.
    kept = both.withColumn("least", F.min("kind").over(Window.partitionBy(F.lit(0)))).where("kind = least")
    once = kept.groupBy("claim").agg(F.min("at").alias("at"))
    return once.withColumn("place", F.row_number().over(Window.orderBy("at", "claim"))).where(F.col("place") <= most).select("place", "claim")


def rendered(lines: DataFrame, headings: list[str]) -> DataFrame:
    """(page, text): each page's lines (page, section, place, line) under the headings, in order; a section without lines says so.

    A page's lines come together, so they must be few: cut lists to what a page shows first.
    """
    rows = lines.groupBy("page").agg(F.array_sort(F.collect_list(F.struct("section", "place", "line"))).alias("l"))
    parts = []
    for h in headings:
        own = F.transform(F.filter("l", lambda x: x["section"] == h), lambda x: x["line"])
        parts += [F.lit(f"## {h}"), F.when(F.size(own) > 0, F.array_join(own, "\n")).otherwise(NOTHING), F.lit("")]
    return rows.select("page", F.concat_ws("\n", *parts).alias("text"))


def counted_line(name: str, count: str) -> Column:
    return F.concat(F.lit("- "), F.col(name), F.lit(": "), F.col(count).cast("string"))


# States of a run, their outcome and what they say of the pipeline.
FAILED, BLOCKING, IDLE = ["failed", "env_failed"], ["env_failed", "ack_failed", "preflight_failed"], ["idle_no_new_pdf", "preflight_only", "dry_run"]


def run_outcome(status: str, state: str, ready: str, published: str, quarantined: str) -> tuple[Column, Column, Column]:
    """(status, outcome, health) of a run; a partial success that did nothing is a failure."""
    none = (F.col(ready) == 0) & (F.col(published) == 0) & (F.col(quarantined) == 0)
    own, state = F.when((F.col(status) == "partial_success") & none, "failed").otherwise(F.col(status)), F.col(state)
    quarantine = state == "completed_with_quarantine"
    outcome = F.when(own.isin(FAILED), "failed").when(own == "partial_success", "partial_success").when(quarantine, "completed_with_quarantine").when(own.isin("waiting", "paused"), "waiting").when(state.isin(IDLE), "noop").otherwise("success")
    health = F.when(own.isin(FAILED), "blocked").when(own == "partial_success", F.when(state.isin(BLOCKING), "blocked").otherwise("degraded")).when(quarantine, "degraded").when(own == "paused", "degraded").otherwise("healthy")
    return own, outcome, health


def error_summary(text: Column | str, most: int = 200) -> Column:
    """What a result's text says of an error: the summary or status of the last JSON object that ends it, else the first payload's first line, else the first line that is no plugin's."""
    text = F.coalesce(col(text), F.lit(""))
    rows = F.split(text, "\n")
    starts = F.filter(F.sequence(F.lit(1), F.size(rows)), lambda i: F.startswith(F.ltrim(F.element_at(rows, i)), F.lit("{")))
    rests = F.transform(F.reverse(starts), lambda i: F.btrim(F.array_join(F.slice(rows, i, F.size(rows)), "\n"), F.lit(" \t\r\n")))
    objects = F.filter(rests, is_json)

    def told(x: Column) -> Column:
        summary = F.coalesce(blank(F.get_json_object(x, "$.summary")), blank(F.get_json_object(x, "$.status")))
        texts = F.from_json(F.get_json_object(x, "$.result.payloads"), "array<struct<text: string>>")
        first = F.try_element_at(F.filter(F.transform(texts, lambda p: blank(p["text"])), lambda p: p.isNotNull()), F.lit(1))
        return F.coalesce(F.btrim(summary), F.substring_index(F.btrim(first), "\n", 1))

    found = F.try_element_at(F.filter(F.transform(objects, told), lambda x: x.isNotNull()), F.lit(1))
    plain = F.try_element_at(F.filter(F.transform(rows, lambda x: F.btrim(x, F.lit(" \t\r"))), lambda x: (x != "") & ~F.startswith(x, F.lit("[plugins]"))), F.lit(1))
    return F.substring(F.coalesce(found, plain), 1, most)


def retry_version(manifest: Column | str) -> Column:
    """A hash of a manifest's records (label, exists, sha256), whatever their order and whatever else it says; of the text itself if it is no JSON."""
    text = F.btrim(F.coalesce(col(manifest), F.lit("")))
    records = F.from_json(text, "records array<struct<label: string, exists: boolean, sha256: string>>")["records"]
    stable = F.transform(F.filter(F.coalesce(records, F.array().cast("array<struct<label: string, exists: boolean, sha256: string>>")), lambda r: blank(r["label"]).isNotNull()), lambda r: F.struct(r["label"].alias("at"), F.coalesce(r["exists"], F.lit(False)).alias("exists"), r["label"].alias("label"), F.coalesce(r["sha256"], F.lit("")).alias("sha256")))
    canonical = F.to_json(F.transform(F.array_sort(stable), lambda r: F.struct(r["exists"].alias("exists"), r["label"].alias("label"), r["sha256"].alias("sha256"))))
    return F.sha2(F.when(~is_json(text), text).otherwise(canonical), 256)


def summary_path(batch: Column | str, filename: Column | str, root: str = "summaries") -> Column:
    """Where a file's summary is kept for good."""
    stem = F.regexp_replace(F.regexp_extract(col(filename), "[^/]*$", 0), r"(?<=.)\.[^.]*$", "")
    return F.concat_ws("/", F.lit(root), col(batch), F.concat(stem, F.lit(".summary.md")))


def backfilled(notes: DataFrame, reports: DataFrame, extracted: DataFrame, key: str, paths: list[str], fields: list[str], force: bool = False) -> DataFrame:
    """notes with blank paths filled from reports and blank fields (with force: all) from what was extracted, and changed_fields: the names of those that are other than before."""
    r = reports.select(F.col(key), *(F.col(c).alias(f"__r_{c}") for c in paths))
    e = extracted.select(F.col(key), *(F.col(c).alias(f"__e_{c}") for c in fields))
    rows = notes.join(r, key, "left").join(e, key, "left")
    new = {c: F.coalesce(blank(c), F.col(f"__r_{c}")) for c in paths}
    new |= {c: F.coalesce(blank(f"__e_{c}"), blank(c)) if force else F.coalesce(blank(c), F.col(f"__e_{c}")) for c in fields}
    changed = F.array_compact(F.array(*(F.when(~F.coalesce(blank(c), F.lit("")).eqNullSafe(F.coalesce(blank(v), F.lit(""))), F.lit(c)) for c, v in new.items())))
    return rows.select(*(new[c].alias(c) if c in new else F.col(c) for c in notes.columns), changed.alias("changed_fields"))


def scanned(pages: DataFrame, start: str, created: str = "create_time") -> DataFrame:
    """(page, reason, topic): the topics of an API's pages (page, ok, status, text), newest first, up to the page that reaches back beyond the start.

    A page without topics, or whose last topic has no time or one before the start, is the last. An error
    before it ends the scan: its reason is the only row.
    """
    rows = pages.select("page", payload_reason("ok", "status", "text").alias("reason"), payload_topics("ok", "status", "text").alias("topics"))
    last = F.get_json_object(F.try_element_at("topics", F.lit(-1)), f"$.{created}")
    rows = rows.withColumn("ends", F.col("reason").isNotNull() | (F.size("topics") == 0) | blank(last).isNull() | (last < start))
    # One row: the page that ends the scan, and the error that it is, if it is one.
    stop = rows.where("ends").agg(F.min("page").alias("stop"), F.min_by("reason", "page").alias("why"))
    met = rows.join(F.broadcast(stop), F.col("stop").isNull() | (F.col("page") <= F.col("stop")))
    good = met.where("why is null").select("page", F.lit(None).cast("string").alias("reason"), F.explode("topics").alias("topic"))
    return good.unionByName(met.where("why is not null and page = stop").select("page", F.col("why").alias("reason"), F.lit(None).cast("string").alias("topic")))


def endpoints(traffic: DataFrame, pattern: str) -> DataFrame:
    """(url, first_at, validated_at, supports_end_time): the URLs of a browser's answers (at, url, content_type, body) that match, and where one first had the topics' shape."""
    first = F.get_json_object(F.col("body"), "$.resp_data.topics[0]")
    topics = F.get_json_object(F.col("body"), "$.resp_data.topics")
    shaped = F.startswith(topics, F.lit("[")) & ((topics == "[]") | (F.get_json_object(first, "$.topic_id").isNotNull() & F.get_json_object(first, "$.create_time").isNotNull()))
    good = F.contains(F.lower(F.coalesce(F.col("content_type"), F.lit(""))), F.lit("json")) & F.coalesce(shaped, F.lit(False))
    rows = traffic.where(F.col("url").rlike(pattern)).groupBy("url").agg(F.min("at").alias("first_at"), F.min(F.when(good, F.col("at"))).alias("validated_at"))
    return rows.withColumn("supports_end_time", F.col("url").rlike(r"[?&]end_time="))


def listed_pages(pages: DataFrame, name: str, index: DataFrame, text: str, folder: str) -> DataFrame:
    """The pages that the index (rows of a text) links to in the folder; all of them if it links to none."""
    links = index.select(F.explode(linked_targets(text)).alias("target")).where(F.startswith("target", F.lit(f"{folder}/")))
    names = links.select(F.regexp_extract("target", "[^/]*$", 0).alias("__name")).where("__name <> ''").distinct()
    some = names.agg((F.count("*") > 0).alias("__some"))
    listed = pages.join(names, F.col(name) == F.col("__name"), "left").join(F.broadcast(some))
    return listed.where(F.col("__name").isNotNull() | ~F.col("__some")).select(*pages.columns)


def archived_names(files: DataFrame, path: str = "path") -> DataFrame:
    """(name): the distinct names of archived files, in the form that names are compared in."""
    return files.select(file_key(F.regexp_extract(F.col(path), "[^/]*$", 0)).alias("name")).distinct()


def parents(path: Column | str) -> Column:
    """A path's folders, the nearest first."""
    parts = F.split(col(path), "/")
    up = F.when(F.size(parts) > 1, F.sequence(F.size(parts) - 1, F.lit(1))).otherwise(F.array().cast("array<int>"))
    return F.filter(F.transform(up, lambda n: F.array_join(F.slice(parts, F.lit(1), n), "/")), lambda x: x != "")
