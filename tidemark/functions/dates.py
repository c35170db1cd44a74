"""Dates as ISO strings, windows and delays."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import col


def valid_date(year: Column, month: Column, day: Column, last_year: int) -> Column:
    """The ISO date if it exists and lies between 2000 and the last year, else null."""
    text = F.concat_ws("-", F.lpad(year, 4, "0"), F.lpad(month, 2, "0"), F.lpad(day, 2, "0"))
    date = F.try_to_date(text)
    return F.when(F.year(date).between(2000, last_year), F.date_format(date, "yyyy-MM-dd"))


# What may stand behind a year and behind a month.
AFTER_YEAR, AFTER_MONTH = "-./年", "-./月"


def _either(first: int, last: int) -> str:
    """A group of the two-digit numbers from first to last."""
    return "(" + "|".join(f"{n:02d}" for n in range(first, last + 1)) + ")"


def date_in(text: Column | str, last_year: int) -> Column:
    """The first date written 20YYMMDD with or without separators, else the first YYMMDD."""
    month, day = _either(1, 12), _either(1, 31)
    long = rf"(?<!\d)(20\d\d)[{AFTER_YEAR}]?{month}[{AFTER_MONTH}]?{day}"
    short = rf"(?<!\d){_either(20, 29)}{month}{day}(?!\d)"

    def found(pattern: str, century: str) -> Column:
        year, month, day = (F.regexp_extract(col(text), pattern, i) for i in (1, 2, 3))
        return valid_date(F.concat(F.lit(century), year), month, day, last_year)

    return F.coalesce(found(long, ""), found(short, "20"))


def instant(text: Column | str) -> Column:
    """A timestamp from ISO text, null where it isn't one."""
    return F.try_to_timestamp(F.replace(col(text), F.lit("T"), F.lit(" ")))


def bucket(ts: Column | str, seconds: int) -> Column:
    return F.floor(F.unix_timestamp(col(ts).cast("timestamp")) / seconds)


def fixed_backoff(attempt: Column | str, delays: tuple[int, ...] = (5, 10, 20)) -> Column:
    """Minutes until the next attempt: the delay of this one, the last for all later."""
    return F.element_at(F.array(*map(F.lit, delays)), F.greatest(F.least(col(attempt).cast("int"), F.lit(len(delays))), F.lit(1)))


def exponential_backoff(attempt: Column | str, base: int = 30, cap: int = 180) -> Column:
    return F.least(F.lit(base) * F.pow(F.lit(2), F.greatest(col(attempt), F.lit(1)) - 1), F.lit(cap)).cast("bigint")
