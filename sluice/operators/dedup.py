"""Deduplication, gates against state, and upserts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sluice.functions.text import content_hash


def first_wins(df: DataFrame, key: str | Column, order: list[str | Column]) -> DataFrame:
    """The first row of each key in order.

    A partial aggregate keeps one row of a key in each task before the shuffle, so a
    key of a third of all rows costs no more than any other.
    """
    names = df.columns
    k = F.col(key) if isinstance(key, str) else key
    rank = F.struct(*[(F.col(o) if isinstance(o, str) else o).alias(f"o{i}") for i, o in enumerate(order)])
    first = df.select(k.alias("_key"), F.struct(*[F.col(f"`{n}`") for n in names]).alias("_row"), rank.alias("_rank"))
    first = first.groupBy("_key").agg(F.min_by("_row", "_rank").alias("_row"))
    return first.select(*[F.col("_row")[n].alias(n) for n in names])


def content_dedup(df: DataFrame, parts: list[str], order: list[str]) -> DataFrame:
    """First row of each content, of the named parts."""
    return first_wins(df, content_hash(*[F.col(p) for p in parts]), order)


def not_seen(df: DataFrame, state: DataFrame, on: list[str]) -> DataFrame:
    """Rows whose key is not in state; state is reduced to its distinct keys."""
    return df.join(state.select(*on).distinct(), on, "left_anti")


def upsert_new(df: DataFrame, stored: DataFrame, key: str, order: list[str]) -> DataFrame:
    """Rows to append: keys that are not stored, the first of each."""
    return first_wins(not_seen(df, stored, [key]), key, order)


def mark_seen(state: DataFrame, rows: DataFrame, on: list[str]) -> DataFrame:
    """State with the keys of rows; a key marked before keeps its mark."""
    new = rows.select(*on).distinct().join(state.select(*on), on, "left_anti")
    return state.unionByName(new, allowMissingColumns=True)


def latest(df: DataFrame, key: list[str], order: list[str | Column]) -> DataFrame:
    """The last row of each key: a cursor table after its updates."""
    names = [c for c in df.columns if c not in key]
    rank = F.struct(*[(F.col(o) if isinstance(o, str) else o).alias(f"o{i}") for i, o in enumerate(order)])
    out = df.groupBy(*key).agg(F.max_by(F.struct(*names), rank).alias("_row"))
    return out.select(*key, *[F.col("_row")[n].alias(n) for n in names])


def per_group_top(df: DataFrame, group: str, order: list[Column], quota: int) -> DataFrame:
    """The first quota rows of each group; Spark cuts each task's rows to quota before the shuffle."""
    w = Window.partitionBy(group).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= quota).drop("_rn")


def supplement(first: DataFrame, second: DataFrame, target: int) -> DataFrame:
    """first, with second behind it when first has fewer rows than target."""
    return first if first.limit(target).count() >= target else first.unionByName(second)
