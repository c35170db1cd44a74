"""Cleaning and quality of texts, as column expressions over arrays of lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_LINE = 1200


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


# Unicode's white space.
WHITE = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"


def strip(c: Column | str) -> Column:
    """Without white space at either end, whatever its kind."""
    return F.btrim(col(c), F.lit(WHITE))


def squeeze(c: Column | str) -> Column:
    """Runs of white space as one space, none at the ends."""
    return F.trim(F.regexp_replace(col(c), r"(?U)\s+", " "))


def lines(text: Column | str) -> Column:
    """The text's stripped lines that aren't empty."""
    return F.filter(F.transform(F.split(strip(text), "\n"), strip), lambda x: x != "")


def letters(c: Column | str) -> Column:
    return F.length(F.regexp_replace(col(c), r"[^\p{L}]+", ""))


def alphanumerics(c: Column | str) -> Column:
    return F.length(F.regexp_replace(col(c), r"[^\p{L}\p{N}]+", ""))


def marked(line: Column, marks: list[str]) -> Column:
    """Whether the line holds one of the watermarks."""
    out = F.lit(False)
    for m in marks:
        out = out | F.contains(line, F.lit(m))
    return out


def without_marks(c: Column | str, marks: list[str]) -> Column:
    """The text with watermarks replaced by a space, blanks squeezed."""
    c = col(c)
    for m in sorted(marks, key=len, reverse=True):
        c = F.replace(c, F.lit(m), F.lit(" "))
    wide = F.contains(c, F.lit("  ")) | F.contains(c, F.lit("\t"))
    return strip(F.when(wide, F.regexp_replace(c, r"[ \t]{2,}", " ")).otherwise(c))


def is_noise(line: Column, marks: list[str]) -> Column:
    """A watermark line (short, or with little beside the mark) or a rule of dashes and the like."""
    line = strip(line)
    watermark = marked(line, marks) & ((F.length(line) <= 80) | (F.length(without_marks(line, marks)) < 20))
    return (line != "") & (watermark | line.rlike(r"^[-=_*#\s]{3,}$"))


def _tenth(line: Column) -> Column:
    return F.greatest(F.lit(3), F.floor(F.length(line) * F.lit(0.10)).cast("int"))


def is_noisy(line: Column) -> Column:
    """Many replacement characters, or hardly a letter or digit in 20 characters or more."""
    line = strip(line)
    replaced = F.length(line) - F.length(F.replace(line, F.lit("�"), F.lit("")))
    few = (F.length(line) >= 20) & (alphanumerics(line) < _tenth(line))
    return (line != "") & (((replaced > 0) & (replaced >= _tenth(line))) | few)


def is_chart_label(line: Column) -> Column:
    line = strip(line)
    return (F.length(line) < 8) | line.rlike(r"^[-+]?\d+(\.\d+)?%?$") | line.rlike(r"^\d{1,2}/\d{2}$")


def repeats(items: Column) -> Column:
    """How many of an array's items occur more than once: a pass over the sorted array."""
    start = F.struct(F.lit(None).cast("string").alias("was"), F.lit(0).alias("run"), F.lit(0).alias("n"))

    def step(a: Column, x: Column) -> Column:
        same = a["was"].eqNullSafe(x)
        return F.struct(
            x.alias("was"),
            F.when(same, a["run"] + 1).otherwise(F.lit(1)).alias("run"),
            (a["n"] + F.when(same & (a["run"] == 1), 2).when(same, 1).otherwise(0)).alias("n"),
        )

    return F.aggregate(F.array_sort(items), start, step, lambda a: a["n"])


def share(part: Column, items: Column) -> Column:
    """part / size(items); 1.0 for no items, as an empty text is all noise."""
    return F.when(F.size(items) == 0, F.lit(1.0)).otherwise(part / F.size(items))


def repeated_line_ratio(text: Column | str, least: int = 8) -> Column:
    own = F.filter(lines(text), lambda x: F.length(x) >= least)
    return share(repeats(own), own)


def repeated_body_ratio(text: Column | str) -> Column:
    """The extractor's variant: lines that aren't chart labels."""
    own = F.filter(lines(text), lambda x: ~is_chart_label(x))
    return share(repeats(own), own)


def watermark_ratio(text: Column | str, marks: list[str]) -> Column:
    own = lines(text)
    return share(F.size(F.filter(own, lambda x: is_noise(x, marks) & marked(x, marks))), own)


def noise_ratio(text: Column | str) -> Column:
    own = lines(text)
    return share(F.size(F.filter(own, is_noisy)), own)


def meaningful_lines(text: Column | str) -> Column:
    """Lines of 20 characters or more, not noisy, a fifth letters (8 at least)."""

    def good(x: Column) -> Column:
        return (F.length(x) >= 20) & ~is_noisy(x) & (letters(x) >= F.greatest(F.lit(8), F.floor(F.length(x) * F.lit(0.20)).cast("int")))

    return F.size(F.filter(lines(text), good))


def meaningful_body_lines(text: Column | str, marks: list[str]) -> Column:
    """The extractor's variant: watermarks off first, a quarter letters."""

    def good(x: Column) -> Column:
        body = without_marks(x, marks)
        rule = is_noise(x, marks)
        return (F.length(x) >= 20) & ~rule & ~body.rlike(r"^[^\p{L}\p{N}]+$") & (letters(body) >= F.greatest(F.lit(8), F.floor(F.length(body) * F.lit(0.25)).cast("int")))

    return F.size(F.filter(lines(text), good))


def weird_tokens(text: Column | str) -> Column:
    """Distinct runs of 20 ASCII letters and digits or more that aren't hexadecimal."""
    found = F.regexp_extract_all(col(text), F.lit("[A-Za-z0-9]{20,}"), F.lit(0))
    return F.size(F.array_distinct(F.filter(found, lambda x: ~x.rlike("^[A-Fa-f0-9]{24,}$"))))


def weird_token_limit(chars: Column, meaningful: Column) -> Column:
    """8, more for long texts, and in proportion to length up to 80."""
    base = F.when((chars >= 100000) | (meaningful >= 1000), 16).when((chars >= 60000) | (meaningful >= 500), 12).otherwise(8)
    scaled = F.greatest(F.floor(chars / 2000).cast("int"), F.floor(meaningful / 20).cast("int"))
    return F.when(scaled > base, F.least(scaled, F.lit(80))).otherwise(base)


def max_line_length(text: Column | str) -> Column:
    return F.coalesce(F.array_max(F.transform(F.split(strip(text), "\n"), lambda x: F.length(F.regexp_replace(x, "\r$", "")))), F.lit(0))


def lined(df: DataFrame, text: str, marks: list[str], names: list[str]) -> DataFrame:
    """df with __t, the stripped text, and __lines, what is asked for by name of each line.

    Each step is a projection of its own: an array that several measures read
    is made once, and each line is searched once.
    """
    df = df.withColumn("__t", strip(text)).withColumn("__l", lines("__t"))

    def known(x: Column) -> Column:
        has = marked(x, marks)
        body = without_marks(x, marks)
        noise = (has & ((F.length(x) <= 80) | (F.length(body) < 20))) | x.rlike(r"^[-=_*#\s]{3,}$")
        facts = {
            "line": x, "n": F.length(x), "alnum": alphanumerics(x), "letters": letters(x), "tenth": _tenth(x),
            "replaced": F.length(x) - F.length(F.replace(x, F.lit("�"), F.lit(""))), "marked": has, "noise": noise, "label": is_chart_label(x),
            "body_n": F.length(body), "body_letters": F.when(has, letters(body)).otherwise(letters(x)), "body_words": body.rlike(r"[\p{L}\p{N}]"),
        }
        return F.struct(*(facts[n].alias(n) for n in names))

    return df.withColumn("__lines", F.transform("__l", known))


def _noisy(x: Column) -> Column:
    return ((x["replaced"] > 0) & (x["replaced"] >= x["tenth"])) | ((x["n"] >= 20) & (x["alnum"] < x["tenth"]))


def _part(n: Column, share_: float) -> Column:
    return F.greatest(F.lit(8), F.floor(n * F.lit(share_)).cast("int"))


def _share_of(test) -> Column:
    own = F.col("__lines")
    return share(F.size(F.filter(own, test)), own)


def _repeated(test) -> Column:
    own = F.transform(F.filter("__lines", test), lambda x: x["line"])
    return share(repeats(own), own)


def quality(df: DataFrame, text: str, marks: list[str], keep: list[str]) -> DataFrame:
    """(keep, the clean-text gate's measures)."""
    rows = lined(df, text, marks, ["line", "n", "alnum", "letters", "tenth", "replaced", "marked", "noise"])
    good = F.filter("__lines", lambda x: (x["n"] >= 20) & ~_noisy(x) & (x["letters"] >= _part(x["n"], 0.20)))
    return rows.select(
        *keep, F.length("__t").alias("chars"), F.size("__lines").alias("nonempty_lines"), max_line_length("__t").alias("max_line"),
        _repeated(lambda x: x["n"] >= 8).alias("repeated_ratio"), _share_of(lambda x: x["noise"] & x["marked"]).alias("watermark_ratio"),
        _share_of(_noisy).alias("noise_ratio"), letters("__t").alias("language_chars"), F.size(good).alias("meaningful"),
    )


def extractor_quality(df: DataFrame, text: str, marks: list[str], keep: list[str]) -> DataFrame:
    """(keep, the extractor gate's measures)."""
    rows = lined(df, text, marks, ["line", "n", "noise", "label", "body_n", "body_letters", "body_words"])
    good = F.filter("__lines", lambda x: (x["n"] >= 20) & ~x["noise"] & (x["body_words"] | (x["body_n"] == 0)) & (x["body_letters"] >= _part(x["body_n"], 0.25)))
    rows = rows.select(
        *keep, F.length("__t").alias("chars"), _repeated(lambda x: ~x["label"]).alias("rep"), _share_of(lambda x: x["noise"]).alias("wm"),
        F.size(good).alias("good"), weird_tokens("__t").alias("weird"), letters("__t").alias("letters"),
    )
    return rows.withColumn("limit", weird_token_limit(F.col("chars"), F.col("good")))


def repeated_ratios(df: DataFrame, text: str, keep: list[str]) -> DataFrame:
    """(keep, repeated_ratio, repeated_body_ratio): both variants, from one array of lines."""
    rows = df.withColumn("__l", lines(text))
    long, body = F.filter("__l", lambda x: F.length(x) >= 8), F.filter("__l", lambda x: ~is_chart_label(x))
    rows = rows.withColumn("__long", long).withColumn("__body", body)
    return rows.select(*keep, share(repeats(F.col("__long")), F.col("__long")).alias("repeated_ratio"), share(repeats(F.col("__body")), F.col("__body")).alias("repeated_body_ratio"))


# The thresholds of the gate.
def acceptable() -> Column:
    """The clean-text gate, on the columns of quality()."""
    return F.expr(
        f"""chars >= 1800 and max_line <= {MAX_LINE} and repeated_ratio < 0.45D and watermark_ratio < 0.18D and noise_ratio < 0.35D
        and language_chars >= 500 and language_chars / greatest(chars, 1) >= 0.20D
        and (meaningful >= 10 or (chars >= 3500 and meaningful >= 3))"""
    )


def tail(text: Column | str, count: int = 6, chars: int = 320) -> Column:
    """The last lines that aren't empty, joined by ' | ', and of that the first characters."""
    own = lines(text)
    return F.substring(F.array_join(F.slice(own, F.greatest(F.size(own) - (count - 1), F.lit(1)), F.lit(count)), " | "), 1, chars)


def within_budget(text: Column | str, chars: int) -> Column:
    """Lines from the start whose lengths, a break each, stay within the budget; the first that doesn't ends it."""
    start = F.struct(F.array().cast("array<string>").alias("kept"), F.lit(0).alias("used"), F.lit(False).alias("full"))

    def step(a: Column, x: Column) -> Column:
        over = a["full"] | (a["used"] + F.length(x) + 1 > chars)
        return F.struct(
            F.when(over, a["kept"]).otherwise(F.concat(a["kept"], F.array(x))).alias("kept"),
            F.when(over, a["used"]).otherwise(a["used"] + F.length(x) + 1).alias("used"),
            over.alias("full"),
        )

    return F.aggregate(lines(text), start, step, lambda a: F.array_join(a["kept"], "\n"))


def wrapped(line: Column, width: int = MAX_LINE) -> Column:
    """The line's parts of at most width characters, cut at the last space past the middle if there is one, else at the width.

    One regular expression: what is left if it fits, else as much as ends before
    a space, else the width; white space at a cut goes.
    """
    white = "[" + WHITE.replace("\t\n\x0b\x0c\r", r"\t-\r") + "]"
    part = rf"(?s)(.{{1,{width}}}\z|.{{{width // 2},{width}}}(?= )|.{{{width}}}){white}*+"
    cut = F.filter(F.transform(F.regexp_extract_all(line, F.lit(part), F.lit(1)), lambda x: F.rtrim(x, F.lit(WHITE))), lambda x: x != "")
    return F.when(F.length(line) <= width, F.array(line)).otherwise(cut)


def hard_wrap(text: Column | str, width: int = MAX_LINE) -> Column:
    """The text's lines, none longer than the width."""
    return F.flatten(F.transform(F.split(col(text), "\n"), lambda x: wrapped(x, width)))


def clean(text: Column | str, marks: list[str], width: int = MAX_LINE) -> Column:
    """Normalised breaks, noise lines out, blank lines single, marks off, long lines wrapped."""
    rows = F.split(F.regexp_replace(col(text), "\r\n?", "\n"), "\n")
    rows = F.filter(rows, lambda x: ~is_noise(x, marks))
    out = F.array_join(F.flatten(F.transform(F.transform(rows, lambda x: without_marks(x, marks)), lambda x: wrapped(x, width))), "\n")
    return strip(F.regexp_replace(out, "\n{3,}", "\n\n"))


def search_text(c: Column | str) -> Column:
    """Markdown marks, links and white space reduced to plain words."""
    c = F.regexp_replace(col(c), r"\[\[([^\]|]+)\|([^\]]+)\]\]", "$2")
    c = F.regexp_replace(c, r"\[\[([^\]]+)\]\]", "$1")
    c = F.regexp_replace(c, r"[#*`>]+", " ")
    return squeeze(c)


def ordered_case(text: Column, rules: list[tuple[list[str], str]], default: str | None) -> Column:
    """The value of the first rule one of whose words the text holds."""
    out = None
    for words, value in rules:
        hit = F.lit(False)
        for w in words:
            hit = hit | F.contains(text, F.lit(w))
        out = F.when(hit, value) if out is None else out.when(hit, value)
    return out.otherwise(F.lit(default))


# What an error of a page's size says.
GEOMETRY_ERRORS = ["image too large", "image dimensions are too large", "image size exceeds", "maximum image dimension", "unsupported_page_geometry", "_encode_tile", "pix too large"]


def is_geometry_error(message: Column | str) -> Column:
    low, hit = F.lower(F.coalesce(col(message), F.lit(""))), F.lit(False)
    for token in GEOMETRY_ERRORS:
        hit = hit | F.contains(low, F.lit(token))
    return hit


def is_json(text: Column | str) -> Column:
    """Whether the whole text is one JSON value; the parser alone ignores what follows a value, so the text must also fit into a list and into an object."""
    text = col(text)
    return F.try_parse_json(F.concat(F.lit("["), text, F.lit("]"))).isNotNull() & F.try_parse_json(F.concat(F.lit('{"v":'), text, F.lit("}"))).isNotNull() & (F.btrim(text, F.lit(WHITE)) != "")
