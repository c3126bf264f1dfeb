"""Ordered cascades: the first candidate that answers, cached lookups, providers in turn."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema


def first_success(df: DataFrame, key: list[str], order: str, good: Column) -> DataFrame:
    """For each key, its first row by order for which good holds; keys without one are left out. A partial aggregate."""
    rest = [c for c in df.columns if c not in key]
    first = df.where(good).groupBy(*key).agg(F.min_by(F.struct(*rest), order).alias("_r"))
    return first.select(*key, *[F.col("_r")[c].alias(c) for c in rest])


# Paths where prices usually stand.
PRICE_PATHS = ["/pricing", "/plans", "/price", "/pricing/"]


def address_candidates(df: DataFrame, url: str, link: Column, paths: list[str] = PRICE_PATHS) -> DataFrame:
    """(all columns, ordinal, candidate): the page's own link where it has one, else each path behind the address; never the address itself."""
    base = F.regexp_replace(F.col(url), "/+$", "")
    found = F.when(link.isNotNull(), F.array(link)).otherwise(F.array(*[F.concat(base, F.lit(p)) for p in paths]))
    return df.select("*", F.posexplode(found).alias("ordinal", "candidate")).where(F.col("candidate") != F.col(url))


def probe_pricing(sites: DataFrame, get: Callable[[DataFrame], DataFrame], key: str = "site", url: str = "website") -> DataFrame:
    """(key, pricing_model, evidence, fetched_url): by the home page's text, else by the first candidate page that tells.

    get: (url, status, body) of a column url. All candidates of a site are fetched at
    once; the first in order counts. A site that tells nowhere has no row.
    """
    from sluice.functions.html import find_link, visible_text
    from sluice.functions.rules import pricing_model
    from sluice.sources.http import with_plain_http

    def told(pages: DataFrame) -> DataFrame:
        return pages.withColumn("t", visible_text(F.col("body"))).withColumn("pricing_model", pricing_model(F.col("t"))).withColumn("evidence", F.substring("t", 1, 300)).drop("t")

    home = told(sites.select(key, F.col(url).alias("url")).join(with_plain_http(sites, url, get), "url"))
    open_ = home.where("pricing_model is null").select(key, "fetched_url", find_link(F.col("body"), F.col("fetched_url")).alias("link"))
    asked = address_candidates(open_, "fetched_url", F.col("link")).select(key, "ordinal", F.col("candidate").alias("url"))
    more = told(asked.join(with_plain_http(asked, "url", get), "url"))
    first = first_success(more.select(key, "ordinal", "pricing_model", "evidence", "fetched_url"), [key], "ordinal", F.col("pricing_model").isNotNull())
    columns = [key, "pricing_model", "evidence", "fetched_url"]
    return home.where("pricing_model is not null").select(*columns).unionByName(first.select(*columns))


def isolate(df: DataFrame, work: Callable[[dict], dict], schema: str, stop: Callable[[], bool] | None = None) -> DataFrame:
    """Each row with the columns that work makes of it (as a dict), and error: a row whose call fails keeps its place, with nulls and the
    error's text; rows after a wish to stop are left with the error "stopped"."""
    from pyspark.sql import types as T

    made = T._parse_datatype_string(schema)
    fields = [f for f in df.schema.fields if f.name not in {*made.names, "error"}]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = to_arrow_schema(T.StructType([*made.fields, T.StructField("error", T.StringType())]))
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                try:
                    out.append({"error": "stopped"} if stop and stop() else work(row) | {"error": None})
                except Exception as e:
                    out.append({"error": f"{type(e).__name__}: {e}"[:500]})
            new = pa.RecordBatch.from_pylist([{n: r.get(n) for n in kind.names} for r in out], kind)
            yield pa.RecordBatch.from_arrays([*[batch.column(batch.schema.get_field_index(f.name)) for f in fields], *new.columns], names=[*[f.name for f in fields], *kind.names])

    return df.mapInArrow(run, T.StructType([*fields, *made.fields, T.StructField("error", T.StringType())]))


def cached_lookup(df: DataFrame, cache: DataFrame, on: str, value: str) -> DataFrame:
    """df with the cached value and is_cached; a cached null is known to be missing and is no miss."""
    hit = cache.select(on, F.col(value), F.lit(True).alias("is_cached"))
    return df.join(hit, on, "left").withColumn("is_cached", F.coalesce("is_cached", F.lit(False)))


def misses(df: DataFrame, on: str, order: str, quota: int) -> DataFrame:
    """The first quota distinct keys without a cached value, by order; keys that tie there go by themselves."""
    return df.where(~F.col("is_cached")).groupBy(on).agg(F.min(order).alias(order)).orderBy(order, on).limit(quota)


def provider_fallback(outcomes: DataFrame, row: str = "row_id", chunk: str = "chunk", tier: str = "tier", keys: list[str] | None = None) -> DataFrame:
    """(row, chunk, tier, data): the answer that holds for each row.

    outcomes: (row, chunk, tier, status, data), data a map. Chunks go in order, and
    providers in order within a chunk; an answer counts when its status is 200 and it
    is not empty, and then the chunk's other providers are not asked. The first answer
    with all keys filled ends the search; else what the last chunk gave holds, which
    may be nothing (null).
    """
    usable = F.col("status").eqNullSafe(200) & F.coalesce(F.size("data") > 0, F.lit(False))
    full = usable
    for k in keys or []:
        full = full & F.coalesce(F.trim(F.try_element_at("data", F.lit(k))) != "", F.lit(False))
    asked = outcomes.groupBy(row, chunk).agg(F.min_by(F.struct(chunk, tier, "data", full.alias("full")), F.when(usable, F.col(tier))).alias("a"))
    best = asked.groupBy(row).agg(F.min_by("a", F.when(F.col("a.full"), F.col(chunk))).alias("whole"), F.max_by("a", chunk).alias("last"))
    return best.select(row, F.coalesce("whole", "last").alias("a")).select(row, f"a.{chunk}", f"a.{tier}", "a.data")


def isolated(values: Column, default: Column) -> Column:
    """A value, or default where computing it gave null: a failing item leaves an empty slot."""
    return F.coalesce(values, default)
