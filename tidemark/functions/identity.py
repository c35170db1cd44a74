"""Keys, hashes and ids."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .arrow import composed
from .text import col, squeeze

SEPARATOR = "\u0001"


def blank(c: Column | str) -> Column:
    """Null if the value is null or only white space: a blank string is a missing value."""
    c = col(c).cast("string")
    return F.when(F.trim(c) == "", None).otherwise(c)


def first_of(*columns: Column | str) -> Column:
    """The first value that isn't blank."""
    return F.coalesce(*(blank(c) for c in columns))


def key_hash(*parts: Column | str, length: int = 64) -> Column:
    """Hash of the parts' texts; null and empty parts are alike, their places count."""
    text = F.concat_ws(SEPARATOR, *(F.coalesce(col(p).cast("string"), F.lit("")) for p in parts))
    return F.substring(F.sha2(text, 256), 1, length)


def set_hash(items: Column) -> Column:
    """Hash of an array that doesn't depend on the order of its items."""
    return F.sha2(F.array_join(F.array_sort(items), SEPARATOR), 256)


def report_id(sha: Column | str, fallback: Column | str) -> Column:
    """An id from a content hash of 16 characters or more, else from a path."""
    sha = F.lower(F.coalesce(blank(sha), F.lit("")))
    return F.when(F.length(sha) >= 16, F.concat(F.lit("doc_"), F.substring(sha, 1, 16))).otherwise(F.concat(F.lit("local_"), F.substring(F.sha2(col(fallback).cast("string"), 256), 1, 16)))


def file_key(name: Column | str) -> Column:
    """A file name's letters and digits in lower case, without its extension; the name itself if none are left.

    For ASCII and composed letters; arrow.filename_key also folds compatibility forms.
    """
    stem = F.regexp_replace(F.lower(col(name)), r"\.[a-z0-9]{1,5}$", "")
    key = F.regexp_replace(stem, r"[^\p{L}\p{N}]", "")
    return F.when(key == "", F.trim(stem)).otherwise(key)


def path_key(path: Column | str) -> Column:
    """A path to compare by: composed letters, one kind of slash, single spaces and slashes."""
    key = F.replace(squeeze(composed()(col(path).cast("string"))), F.lit("\\"), F.lit("/"))
    return F.regexp_replace(key, "/{2,}", "/")


def compact_title(c: Column | str) -> Column:
    """Lower case, no extension, no punctuation."""
    c = F.regexp_replace(F.lower(F.trim(col(c))), r"\.(pdf|md)$", "")
    return F.regexp_replace(c, r"[^\p{L}\p{N}_]+", "")


def candidate_identity(file_id: Column | str, name: Column | str) -> Column:
    return F.coalesce(F.concat(F.lit("file_id:"), blank(file_id)), F.concat(F.lit("filename:"), col(name)))


def grams(c: Column | str, n: int) -> Column:
    """The distinct n-grams of a text: a lookahead finds those that overlap, without a lambda that would read the text anew."""
    return F.array_distinct(F.regexp_extract_all(col(c), F.lit(f"(?s)(?=(.{{{n}}}))"), F.lit(1)))


def similarity_of_grams(t: Column, t1: Column, t3: Column, c: Column, c1: Column, c3: Column) -> Column:
    """Of compact titles: 1 if either holds the other, else 0.35 of the target's characters and 0.65 of its 3-grams that the candidate has.

    t1, t3, c1, c3 are the titles' grams(_, 1) and grams(_, 3), made once a title and not once a pair.
    """

    def part(own: Column, other: Column) -> Column:
        return F.size(F.array_intersect(own, other)) / F.greatest(F.size(own), F.lit(1))

    # The weights of characters and of 3-grams.
    return (
        F.when((t == "") | (c == ""), 0.0)
        .when(F.contains(c, t) | F.contains(t, c), 1.0)
        .otherwise(part(t1, c1) * 0.35 + part(t3, c3) * 0.65)
    )


def title_similarity(target: Column | str, candidate: Column | str) -> Column:
    """similarity_of_grams of two columns."""
    t, c = col(target), col(candidate)
    return similarity_of_grams(t, grams(t, 1), grams(t, 3), c, grams(c, 1), grams(c, 3))
