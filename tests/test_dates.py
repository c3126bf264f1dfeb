"""Dates of many written forms against the general parser that the described source uses."""

import random
from datetime import datetime, timedelta, timezone

from dateutil import parser
from pyspark.sql import functions as F

from sluice.functions import dates

NOW = datetime(2026, 9, 4, 12, tzinfo=timezone.utc)
FORMS = [
    "%Y-%m-%d", "%Y/%m/%d", "%Y-%m-%dT%H:%M:%S", "%Y-%m-%dT%H:%M:%SZ", "%Y-%m-%dT%H:%M:%S+02:00", "%Y-%m-%dT%H:%M:%S.%f", "%Y-%m-%dT%H:%M:%S.%fZ", "%Y-%m-%dT%H:%M", "%Y-%m-%d %H:%M:%S", "%Y-%m-%d %H:%M", "%Y-%m-%d %H:%M:%S+0530",
    "%a, %d %b %Y %H:%M:%S GMT", "%a, %d %b %Y %H:%M:%S +0100", "%A, %d %B %Y %H:%M", "%d %b %Y", "%d %B %Y", "%b %d, %Y", "%B %d, %Y", "%B %d, %Y %I:%M %p", "%m/%d/%Y", "%d.%m.%Y %H:%M", "%b %d %Y", "%Y%m%dT%H%M%S", "%H:%M", "%d %b", "%B %Y",
    "%a %b %d %H:%M:%S %Y", "%a, %d %b %Y %H:%M:%S EST", "%Y-%m-%dT%H:%M:%S-08:00", "%d-%b-%Y", " %Y-%m-%d ", "%A", "%Y-%m-%dt%H:%M:%Sz", "%a, %d %b %Y %H:%M:%S UTC", "at %H:%M on %d %b %Y", "%d %b %Y %H:%M:%S -0700",
]


def described(value):
    try:
        t = parser.parse(value.strip(), default=datetime(NOW.year, NOW.month, NOW.day))
        t = t.replace(tzinfo=timezone.utc) if t.tzinfo is None else t.astimezone(timezone.utc)
        return t.replace(tzinfo=None)
    except (ValueError, OverflowError):
        return None


def test_generated_forms(spark):
    rng = random.Random(2)
    values = []
    for _ in range(20):
        t = datetime(1990, 1, 1) + timedelta(seconds=rng.randrange(40 * 365 * 86400), microseconds=rng.randrange(10**6))
        values += [t.strftime(f) for f in FORMS]
    values += ["not a date", "2026-13-01", "2026-02-30", "31/12/2025", "99:99", "x" * 5000, "Sept 5 2025", "0001-01-01", "9999-12-31T23:59:59"]
    df = spark.createDataFrame(list(enumerate(values)), "k int, s string").repartition(3)
    got = df.select("k", F.unix_micros(dates.parse_datetime(F.col("s"), F.lit(NOW.isoformat()).cast("timestamp"))).alias("t")).collect()
    for r in got:
        want = described(values[r.k])
        assert r.t == (None if want is None else (want - datetime(1970, 1, 1)) // timedelta(microseconds=1)), values[r.k]
    assert len(values) > 500 and sum(r.t is not None for r in got) > 500


def test_forms_of_the_jvm(spark):
    """The strict parser reads common shapes alone, by the plan without Python."""
    df = spark.createDataFrame([("2026-09-04",), ("2026/09/04",), ("Fri, 04 Sep 2026 10:00:00 GMT",)], "s string")
    out = df.select(dates.parse_datetime(F.col("s"), F.lit(NOW.isoformat()).cast("timestamp"), lenient=False).alias("t"))
    assert "Python" not in out._jdf.queryExecution().toString()
    assert [r.t is None for r in out.collect()] == [False, True, False]
