"""Validation of records: what breaks, accepted and rejected rows, counters."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from sluice.functions.rules import valid_url
from sluice.functions.text import truncate

# The pricing models and the record types.
PRICING_MODELS = ["FREE", "FREEMIUM", "PAID", "ENTERPRISE"]
RECORD_TYPES = ["STARTUP", "PRODUCT", "RESEARCH_PAPER", "JOB", "NEWS"]


def required(name: str) -> tuple[Column, str]:
    return F.col(name).isNull(), f"{name}: field required"


def not_blank(name: str) -> tuple[Column, str]:
    return F.col(name).isNull() | (F.trim(F.col(name)) == ""), f"{name}: blank"


def one_of(name: str, values: list[str]) -> tuple[Column, str]:
    return ~F.coalesce(F.col(name).isin(values), F.lit(False)), f"{name}: not a known value"


def is_url(name: str, optional: bool = False) -> tuple[Column, str]:
    bad = ~valid_url(F.col(name))
    return (F.col(name).isNotNull() & bad) if optional else bad, f"{name}: not a valid address"


def pinned(name: str, value: str) -> tuple[Column, str]:
    return ~F.coalesce(F.col(name) == value, F.lit(False)), f"{name}: not {value}"


def with_errors(df: DataFrame, checks: list[tuple[Column, str]]) -> DataFrame:
    found = F.array(*[F.when(bad, F.lit(said)) for bad, said in checks]) if checks else F.array().cast("array<string>")
    return df.withColumn("errors", F.filter(found, lambda e: e.isNotNull()))


def split(df: DataFrame, checks: list[tuple[Column, str]]) -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected): rejected rows say why, three reasons at most, and show the row, in 500 characters at most."""
    checked = with_errors(df, checks)
    good = checked.where(F.size("errors") == 0).drop("errors")
    return good, rejections(checked.where(F.size("errors") > 0), df.columns)


def rejections(bad: DataFrame, shown: list[str], record_type: str = "RECORD") -> DataFrame:
    return bad.select(
        F.lit(record_type).alias("record_type"), F.array_join(F.slice("errors", 1, 3), "; ").alias("reason"),
        truncate(F.to_json(F.struct(*[F.col(f"`{c}`") for c in shown])), 500).alias("raw_preview"), *shown,
    )


def observed(df: DataFrame, counters: dict[str, Column], name: str = "quality") -> tuple[DataFrame, Observation]:
    """df with counters that Spark sums as it passes by; no further job."""
    seen = Observation(name)
    return df.observe(seen, *[F.count_if(c).alias(k) for k, c in counters.items()]), seen


def counted(df: DataFrame, counters: dict[str, Column]) -> DataFrame:
    """A row of counters, in one pass."""
    return df.agg(*[F.count_if(c).alias(k) for k, c in counters.items()])


def coerce(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Columns cast where their text allows it, else null."""
    return df.withColumns({c: F.trim(F.col(c).cast("string")).try_cast(t) for c, t in types.items()})


def all_of(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions, F.lit(True))
