"""Star counts of repositories: a durable cache, a quota and the meaning of each status.

A count that was found, and that a repository is missing (404), are cached for good;
when the quota is used up (no remaining requests, or 403) nothing more is asked in the
run; any other failure is asked again by a later run. The cache is a Parquet folder
that runs append to.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.functions.text import repo_slug
from sluice.operators.candidates import cached_lookup, misses
from sluice.sources.http import Answer, retry, send

CACHE = "slug string, github_stars int"
API = "https://api.github.com/repos/"


def look_up(slugs: Iterator[str], ask: Callable[[str], Answer]) -> Iterator[tuple[str, int | None]]:
    """(slug, count or null) of what may be cached, until the quota is used up."""
    for slug in slugs:
        got = ask(slug)
        left = next((v for k, v in got.headers.items() if k.lower() == "x-ratelimit-remaining"), None)
        if got.status == 200:
            try:
                value = json.loads(got.body or "")
            except ValueError:
                value = None
            if isinstance(value, dict):
                count = value.get("stargazers_count")
                yield slug, count if isinstance(count, int) else None
        elif got.status == 404:
            yield slug, None
        if got.status == 403 or (left is not None and left.strip().lstrip("-").isdigit() and int(left) <= 0):
            return


def asker(token: str = "") -> Callable[[str], Answer]:
    headers = {"Accept": "application/vnd.github+json"} | ({"Authorization": f"Bearer {token}"} if token else {})
    return lambda slug: retry(lambda: send(API + slug, headers=headers), 1)


def read_cache(spark: SparkSession, path: str) -> DataFrame:
    """The cache; empty where there is none yet. A slug that two runs found has the later count."""
    from sluice.operators.manifest import read_if_there

    found = read_if_there(spark, path)
    if found is None:
        return spark.createDataFrame([], CACHE)
    return found.groupBy("slug").agg(F.max_by(F.struct("github_stars"), "run").alias("x")).select("slug", "x.github_stars")


def with_stars(df: DataFrame, url: str, order: str, path: str, ask: Callable[[str], Answer], quota: int, run: int) -> DataFrame:
    """df with slug and github_stars, the cache filled for at most quota slugs it lacks, the first by order.

    The quota bounds the requests of a run, and stopping needs their order, so they are
    one task.
    """
    spark = df.sparkSession
    rows = df.withColumn("slug", repo_slug(F.col(url)))
    wanted = misses(cached_lookup(rows.where("slug is not null"), read_cache(spark, path), "slug", "github_stars"), "slug", order, quota)

    def work(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for slug, count in look_up((s for f in frames for s in f["slug"]), ask):
            yield pd.DataFrame({"slug": [slug], "github_stars": pd.array([count], "Int32")})

    found = wanted.coalesce(1).sortWithinPartitions(order).select("slug").mapInPandas(work, CACHE).withColumn("run", F.lit(run))
    found.write.mode("append").parquet(path)
    return cached_lookup(rows, read_cache(spark, path), "slug", "github_stars").drop("is_cached")
