"""Lenient dates, freshness and waiting times. ``now`` is always a parameter."""

from __future__ import annotations

import warnings
from datetime import datetime, timedelta, timezone

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Seconds of each unit of a relative date.
UNIT_SECONDS = {"second": 1, "minute": 60, "min": 60, "hour": 3600, "hr": 3600, "day": 86400, "week": 604800, "month": 2592000, "year": 31536000}
RELATIVE = r"(?i)(\d+)\s*(second|minute|min|hour|hr|day|week|month|year)s?\s*ago"
#: Shapes of dates that the JVM reads, each with its one format, which asks for no guess: a date, a time of day, a zone.
_DATE, _TIME, _ZONE = r"\d{4}-\d\d-\d\d", r"\d\d:\d\d:\d\d(?:\.(?:\d{3}|\d{6}))?", r"(?:Z|[+-]\d\d:\d\d)"
_FRACTION = "[.SSSSSS][.SSS]"
SHAPES = [
    (f"{_DATE}T{_TIME}{_ZONE}", f"yyyy-MM-dd'T'HH:mm:ss{_FRACTION}XXX"), (f"{_DATE}T{_TIME}", f"yyyy-MM-dd'T'HH:mm:ss{_FRACTION}"), (f"{_DATE} {_TIME}", f"yyyy-MM-dd HH:mm:ss{_FRACTION}"), (_DATE, "yyyy-MM-dd"),
    (r"\d{1,2} [A-Z][a-z]{2} \d{4} \d\d:\d\d:\d\d [+-]\d{4}", "d MMM yyyy HH:mm:ss Z"), (r"\d{1,2} [A-Z][a-z]{2} \d{4} \d\d:\d\d:\d\d (?:GMT|UTC)", "d MMM yyyy HH:mm:ss z"),
]
#: Seconds from year 1 to 1970, and from there to the end of year 9999.
FIRST, LAST = 62_135_596_800, 253_402_300_800


@F.pandas_udf(T.LongType())
def _guessed(s: pd.Series, now: pd.Series) -> pd.Series:
    """Microseconds since 1970 of dates of any shape; what a date leaves out is of now's day at midnight. Zones that are only a name count as UTC."""
    from dateutil import parser

    epoch = datetime(1970, 1, 1, tzinfo=timezone.utc)

    def one(x, at):
        if x is None:
            return None
        try:
            t = parser.parse(x, default=datetime(at.year, at.month, at.day))
            return (t.replace(tzinfo=timezone.utc) if t.tzinfo is None else t) - epoch
        except Exception:  # whatever the parser makes of a text, that is no date
            return None

    with warnings.catch_warnings():
        warnings.simplefilter("ignore")
        return pd.Series([t if t is None else t // timedelta(microseconds=1) for t in map(one, s, now)], dtype="Int64")


def parse_datetime(c: Column, now: Column, lenient: bool = True) -> Column:
    """A UTC timestamp from words, relative dates, epochs and dates; null where nothing reads it, or the time is before year 1 or after year 9999.

    A date of a common shape is read by the one format of its shape. lenient: others go
    to a general parser, in Python.
    """
    v = F.nullif(F.regexp_replace(c, r"(?U)^\s+|\s+$", ""), F.lit(""))
    low = F.lower(v)
    seconds = F.coalesce(*[F.when(F.lower(F.regexp_extract(v, RELATIVE, 2)) == k, F.lit(n)) for k, n in UNIT_SECONDS.items()])
    ago = F.regexp_extract(v, RELATIVE, 1)
    back = F.try_multiply(ago.try_cast("long"), seconds.cast("long"))
    at_most = F.unix_seconds(now) + FIRST
    digits = F.when(v.rlike(r"^\d+$"), v.try_cast("long"))
    unnamed = F.regexp_replace(v, r"^[A-Z][a-z]{2}, ", "")
    shape = F.coalesce(*[F.when(unnamed.rlike(f"^{r}$"), F.lit(f)) for r, f in SHAPES])
    read = F.try_to_timestamp(unnamed, shape)
    word = low.isin("just now", "moments ago", "now", "today", "yesterday")
    if lenient:  # only what nothing else reads is sent to Python
        read = F.coalesce(read, F.timestamp_micros(_guessed(F.when(read.isNull() & ~word & (ago == "") & ~v.rlike(r"^\d+$"), v), now)))
    return (
        F.when(low.isin("just now", "moments ago", "now"), now)
        .when(low == "today", F.date_trunc("day", now))
        .when(low == "yesterday", F.date_trunc("day", now) - F.expr("interval 1 day"))
        .when(ago != "", F.timestamp_micros(F.unix_micros(now) - F.when(back <= at_most, back) * 1_000_000))
        .when(digits.isNotNull() & (digits > 10_000_000_000), F.timestamp_millis(F.when(digits < LAST * 1000, digits)))
        .when(digits.isNotNull(), F.timestamp_seconds(digits))
        .otherwise(read)
    )


def is_fresh(at: Column, now: Column, hours: int = 24) -> Column:
    """Within the window, both ends included, or less than five minutes ahead; null is not fresh."""
    return F.coalesce(
        ((at >= now - F.expr(f"interval {hours} hours")) & (at <= now)) | ((at > now) & (at < now + F.expr("interval 5 minutes"))), F.lit(False)
    )


def backoff_seconds(attempt: Column, base: float, most: float, retry_after: Column | None = None) -> Column:
    """The waiting time before jitter: doubled at each attempt, or what the server asks for, never above most."""
    grown = F.least(F.lit(base) * F.pow(F.lit(2.0), attempt), F.lit(float(most)))
    # least passes over nulls, so what was not asked for is told apart first
    return grown if retry_after is None else F.when(retry_after.isNull(), grown).otherwise(F.least(retry_after, F.lit(float(most))))
