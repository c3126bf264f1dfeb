"""Fetched pages, with headers, retries and a limit for each host.

``fetch(urls)`` gives (url, status, headers, body, error) for a column of addresses
that may be as long as the table it comes from: addresses are dealt by host into
``per_host`` tasks each, so that a host never has more requests at a time and a host
of many addresses is not one task. ``spark.read.format("sluice_http")`` does the same
for a short list given as an option. Nothing raises: failures are rows with the
status of a time-out (598) or a broken connection (599).
"""

from __future__ import annotations

import json
import os
import random
import signal
import time
import urllib.error
import urllib.request
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from urllib.parse import urlsplit

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

SCHEMA = "url string, status int, headers map<string,string>, body string, error string"


@dataclass
class Answer:
    status: int
    body: str | None = None
    headers: dict[str, str] = field(default_factory=dict)

    @property
    def asked(self) -> float | None:
        """The seconds that the server asks to wait."""
        try:
            return float(next((v for k, v in self.headers.items() if k.lower() == "retry-after"), ""))
        except ValueError:
            return None


def wait_seconds(attempt: int, base: float = 1.0, most: float = 30.0, jitter: float = 0.0, asked: float | None = None) -> float:
    """Doubling with jitter; what the server asks for holds instead, both up to most."""
    if asked is not None:
        return min(asked, most)
    return min(base * 2**attempt, most) + random.uniform(0, jitter)


def retry(call: Callable[[], Answer], retries: int = 4, base: float = 1.0, most: float = 30.0, sleep: Callable[[float], None] = time.sleep) -> Answer:
    """The first answer that is not 429 or 5xx, or the last of retries + 1."""
    for attempt in range(retries + 1):
        got = call()
        if got.status != 429 and got.status < 500 or attempt == retries:
            return got
        sleep(wait_seconds(attempt, base, most, 0.0, got.asked))
    raise AssertionError("unreachable")


def send(url: str, data: bytes | None = None, headers: dict[str, str] | None = None, timeout: float = 20.0) -> Answer:
    """One request: a POST where there are data."""
    try:
        with urllib.request.urlopen(urllib.request.Request(url, data, {"User-Agent": "sluice"} | (headers or {})), timeout=timeout) as r:
            return Answer(r.status, r.read().decode(r.headers.get_content_charset() or "utf-8", "replace"), dict(r.headers.items()))
    except urllib.error.HTTPError as e:
        return Answer(e.code, e.read().decode("utf-8", "replace") if e.code != 429 and e.code < 500 else None, dict(e.headers.items()))
    except TimeoutError:
        return Answer(598)
    except (urllib.error.URLError, OSError, ValueError, LookupError) as e:
        return Answer(598 if isinstance(getattr(e, "reason", None), TimeoutError) else 599)


def _row(url: str, ask: Callable[[str], Answer], retries: int) -> tuple:
    try:
        got = retry(lambda: ask(url), retries)
        return url, got.status, got.headers, got.body, None
    except Exception as e:  # one page must not end the others
        return url, 599, {}, None, str(e)[:500]


def fetch(
    df: DataFrame, url: str | Column = "url", ask: Callable[[str], Answer] = send, retries: int = 4, per_host: int = 5, delay: float = 0.0,
) -> DataFrame:
    """(url, status, headers, body, error) of the distinct addresses of a column. ask: what one request does, sent to the tasks."""
    address = F.col(url) if isinstance(url, str) else url
    host = F.regexp_extract("url", r"^[A-Za-z][\w+.-]*://([^/?#]*)", 1)
    dealt = df.select(address.alias("url")).where("url is not null").distinct().withColumn("lane", F.pmod(F.xxhash64("url"), F.lit(per_host))).withColumn("host", host)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        k = 0
        for frame in frames:
            for i in range(0, len(frame), 16):  # pages are long, so few are held
                out = []
                for u in frame["url"][i : i + 16]:
                    if k and delay:
                        time.sleep(delay)
                    out.append(_row(u, ask, retries))
                    k += 1
                yield pd.DataFrame(out, columns=["url", "status", "headers", "body", "error"])

    return dealt.repartition("host", "lane").select("url").mapInPandas(run, SCHEMA)


def with_plain_http(df: DataFrame, url: str, get: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """(url, fetched_url, body) of the addresses that gave a page: as they are, else over plain HTTP where a secure connection broke or timed out (598, 599)."""
    first = get(df.select(F.col(url).alias("url")).distinct()).select("url", "status", "body")
    broken = first.where(F.col("status").isin(598, 599) & F.col("url").startswith("https://")).select(F.col("url").alias("secure"), F.concat(F.lit("http://"), F.substring(F.col("url"), 9, F.length("url"))).alias("url"))
    second = broken.join(get(broken.select("url").distinct()).select("url", "status", "body"), "url").where("status = 200 and body is not null")
    good = first.where("status = 200 and body is not null").select("url", F.col("url").alias("fetched_url"), "body")
    return good.unionByName(second.select(F.col("secure").alias("url"), F.col("url").alias("fetched_url"), "body"))


class HttpSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "sluice_http"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return HttpReader(self.options)


class _Lane(InputPartition):
    def __init__(self, urls: list[str]):
        self.urls = urls


class HttpReader(DataSourceReader):
    def __init__(self, options: dict):
        self.urls = json.loads(options.get("urls", "[]"))
        self.retries, self.timeout, self.delay, self.per_host = int(options.get("retries", 4)), float(options.get("timeout", 20)), float(options.get("delay", 0)), int(options.get("per_host", 5))

    def partitions(self) -> list[InputPartition]:
        by: dict[tuple, list[str]] = {}
        for u in self.urls:
            by.setdefault((urlsplit(u).netloc, zlib.crc32(u.encode()) % self.per_host), []).append(u)
        return [_Lane(x) for x in by.values()] or [_Lane([])]

    def read(self, partition: _Lane) -> Iterator[tuple]:
        for k, url in enumerate(partition.urls):
            if k and self.delay:
                time.sleep(self.delay)
            yield _row(url, lambda u: send(u, timeout=self.timeout), self.retries)


class Stop:
    """A wish to stop that pagers and isolated calls ask for between items.

    With a marker, a file that driver and executors share, tasks see it too.
    """

    def __init__(self, marker: str | None = None):
        self.marker, self._set = marker, False

    def trigger(self, *_) -> None:
        self._set = True
        if self.marker:
            with open(self.marker, "w"):
                pass

    def is_set(self) -> bool:
        return self._set or bool(self.marker and os.path.exists(self.marker))

    def install(self) -> Stop:
        """Interrupts and requests to end ask for a stop from now on."""
        for name in (signal.SIGINT, signal.SIGTERM):
            signal.signal(name, self.trigger)
        return self


def pages(fetch_page: Callable[[str | None], tuple[list, str | None]], start: str | None = None, most: int | None = None, stop: Stop | None = None) -> Iterator[list]:
    """Pages by cursor, until one is empty, the cursor is missing or stays, most pages came, or a stop is asked for."""
    cursor, n = start, 0
    while (most is None or n < most) and not (stop and stop.is_set()):
        rows, after = fetch_page(cursor)
        if not rows:
            return
        yield rows
        n += 1
        if not after or after == cursor:
            return
        cursor = after


def offset_pages(
    fetch_page: Callable[[int, int], list], size: int, most: int, delay: float = 3.0, stop: Stop | None = None, sleep: Callable[[float], None] = time.sleep,
) -> Iterator[list]:
    """Pages of at most size items by (offset, number), with a pause between, until one is empty or most items came."""
    at = 0
    while at < most and not (stop and stop.is_set()):
        if at:
            sleep(delay)
        rows = fetch_page(at, min(size, most - at))[: most - at]
        if not rows:
            return
        yield rows
        at += len(rows)
