"""Incremental ingestion by Structured Streaming: rows first, then state, in each micro-batch."""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from sluice.plans.verticals import Outcome, RunContext, learned_names, store


def run_stream(
    source: DataFrame, plan: Callable[[RunContext, DataFrame], Outcome], ctx: RunContext, name: str, checkpoint: str, seen_key=None,
) -> StreamingQuery:
    """Runs plan over what is new and stops.

    A batch is one commit, named by the stream's own id, which its checkpoint keeps, and
    the batch's number: repeated after a failure, it adds nothing twice. Each batch knows
    the names that those before it learned.
    """

    def one(batch: DataFrame, number: int) -> None:
        own = json.loads(ctx.spark.read.text(f"{checkpoint}/metadata").first()[0])["id"]
        known = replace(ctx, learned=learned_names(ctx))
        store(known, name, plan(known, batch), seen_key, f"{name}/{own}/{number}")

    return source.writeStream.foreachBatch(one).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def read_files(spark: SparkSession, path: str, schema: str, kind: str = "json", per_batch: int = 1000) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", per_batch).format(kind).load(path)


def bounded_dedup(stream: DataFrame, key: list[str], event_time: str, delay: str = "25 hours") -> DataFrame:
    """The first row of each key; state is dropped once the watermark passes. Freshness itself goes by the run's now, not by the watermark."""
    return stream.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(key)


def windowed_counts(stream: DataFrame, event_time: str, by: str, window: str = "1 hour", delay: str = "10 minutes") -> DataFrame:
    w = F.window(event_time, window)
    return stream.withWatermark(event_time, delay).groupBy(w.alias("w"), by).agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), by, "n")
