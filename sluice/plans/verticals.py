"""Plans of the five verticals: gate, resolve, validate, store; each a logical plan with three outputs."""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sluice.functions.dates import is_fresh
from sluice.functions.rules import normal_url, pricing_model, role_family
from sluice.functions.text import content_hash
from sluice.operators import dedup, validate
from sluice.operators.candidates import isolated, probe_pricing
from sluice.operators.manifest import Tables
from sluice.operators.resolve import mapping_log, resolve_and_learn
from sluice.operators.scratch import Scratch


@dataclass
class RunContext:
    """What a run depends on; now is fixed, so a run can be repeated."""

    spark: SparkSession
    now: Column
    root: str
    seed: dict[str, list[str]] | None = None
    fuzzy_threshold: float = 97.0
    review_threshold: float = 80.0
    fresh_hours: int = 24
    keywords: list[str] = field(default_factory=list)
    #: Names that runs before this one learned (norm, raw, first); their places come before this run's.
    learned: DataFrame | None = None
    #: Whether names with other numbers in them are other names, however similar.
    numbers: bool = False


@dataclass
class Outcome:
    """Accepted rows with their dedup_key, rejected rows with reasons, entries of the mapping log, and the names learned."""

    accepted: DataFrame
    rejected: DataFrame
    mapping: DataFrame | None = None
    learned: DataFrame | None = None


def candidate_limit(target: int) -> int:
    return int(target * 1.2) + 50


def supplement_limit(target: int, have: int) -> int:
    return max((target - have) * 4, 500)


def category_quota(target: int, categories: int) -> int:
    return max(1, math.ceil(target * 1.15 / categories))


def _resolved(ctx: RunContext, rows: DataFrame, name: str, source_url: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(resolved rows, mapping entries, names learned); names that ctx knows from runs before count as learned.

    The resolved rows are a table, so that what is accepted, rejected, logged and counted comes of one resolution.
    """
    out, taught = resolve_and_learn(rows, name, "seq", ctx.seed, ctx.fuzzy_threshold, [c for c in rows.columns if c != "seq"], ctx.learned, ctx.numbers)
    out = Scratch(ctx.spark).put(out)
    log = out.select("seq", "raw_name", "canonical_name", "method", "confidence", F.coalesce(F.col(source_url), F.lit("")).alias("source_url"), ctx.now.alias("timestamp"))
    return out, log, taught


# Fixed value: the version that every record is pinned to.
SCHEMA_VERSION = "1.0"


def _pin(rows: DataFrame, record_type: str) -> tuple[DataFrame, list]:
    """rows with their version and record type where they come without, and the checks that pin both."""
    for name, value in (("schema_version", SCHEMA_VERSION), ("record_type", record_type)):
        if name not in rows.columns:
            rows = rows.withColumn(name, F.lit(value))
    return rows, [validate.pinned("schema_version", SCHEMA_VERSION), validate.pinned("record_type", record_type)]


def _checked(rows: DataFrame, checks: list, record_type: str) -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected) by the checks and the pins; the pins' columns are not part of what is accepted."""
    pinned, pins = _pin(rows, record_type)
    checked = validate.with_errors(pinned, [*checks, *pins])
    good = checked.where(F.size("errors") == 0).select(*rows.columns)
    shown = [c for c in rows.columns if c not in ("schema_version", "record_type")]
    return good, validate.rejections(checked.where(F.size("errors") > 0), shown, record_type)


def counters(ctx: RunContext, discovered: DataFrame, outcome: Outcome) -> dict[str, int]:
    """What a run saw: records discovered, accepted, rejected, and of these by freshness; the rest are duplicates."""
    n = discovered.count()
    good = outcome.accepted.count()
    bad = validate.counted(outcome.rejected, {"rejected": F.lit(True), "freshness_failures": F.col("reason").startswith("stale")}).first()
    return {"records_discovered": n, "accepted": good, "validation_failures": bad["rejected"] - bad["freshness_failures"], "freshness_failures": bad["freshness_failures"], "duplicates_removed": n - good - bad["rejected"]}


def _answered(rows: DataFrame, answers: DataFrame | None, key: Column, rule: str, allowed: list[str] | None) -> DataFrame:
    """rows with the provider's answer (answer_key, answer) in place of the rule's where there is a known one."""
    if answers is None:
        return rows
    said = answers.groupBy("answer_key").agg(F.min("answer").alias("_answer"))
    out = rows.withColumn("_key", key).join(said, F.col("_key") == F.col("answer_key"), "left")
    answer = F.upper(F.trim("_answer")) if allowed else F.nullif(F.trim("_answer"), F.lit(""))
    known = F.when(answer.isin(allowed), answer) if allowed else answer
    return out.withColumn(rule, isolated(known, F.col(rule))).drop("_key", "answer_key", "_answer")


def startups(ctx: RunContext, rows: DataFrame, seen: DataFrame | None = None, target: int | None = None) -> Outcome:
    """rows: seq, name, page_url, team_size. A name seen before is passed over; a rejected one leaves its mapping entry.

    With a target, as many candidates are looked at as candidate_limit allows, the first in order.
    """
    rows = dedup.first_wins(rows, F.lower(F.trim("name")), ["seq"])
    if target is not None:
        rows = rows.orderBy("seq").limit(candidate_limit(target))
    if seen is not None:
        rows = dedup.not_seen(rows.withColumn("item_id", F.lower(F.trim("name"))), seen, ["item_id"]).drop("item_id")
    found, log, taught = _resolved(ctx, rows, "name", "page_url")
    found = found.withColumn("source_url", normal_url(F.col("page_url")))
    good, bad = _checked(found, [validate.not_blank("canonical_name"), validate.is_url("page_url")], "STARTUP")
    good = good.select(
        "seq", F.col("raw_name").alias("entity_name"), "canonical_name", F.col("team_size").alias("employee_count"), "source_url",
        content_hash(F.col("canonical_name"), F.col("source_url")).alias("dedup_key"),
    )
    return Outcome(good, bad, log, taught)


def products(ctx: RunContext, rows: DataFrame, text: str = "page_text", answers: DataFrame | None = None, told: str | None = None) -> Outcome:
    """rows: seq, name, website, page_text. The pricing model comes from the page's text, or from a provider's answer (answer_key, the
    lower-case name, and answer) where the text tells anything; without one a row is rejected. told: a column that has the text's model already."""
    rows = dedup.first_wins(rows.where(F.coalesce(F.trim("website"), F.lit("")) != ""), F.lower(F.trim("name")), ["seq"])
    rows = rows.withColumn("pricing_model", F.col(told) if told else pricing_model(F.col(text)))
    rows = _answered(rows, answers, F.when(F.col("pricing_model").isNotNull(), F.lower(F.trim("name"))), "pricing_model", validate.PRICING_MODELS)
    found, log, taught = _resolved(ctx, rows, "name", "website")
    found = found.withColumn("source_url", normal_url(F.col("website")))
    good, bad = _checked(found, [validate.is_url("website"), validate.one_of("pricing_model", validate.PRICING_MODELS)], "PRODUCT")
    good = good.select(
        "seq", F.col("raw_name").alias("startup_name"), "canonical_name", "pricing_model", "source_url",
        content_hash(F.col("canonical_name"), F.col("source_url"), F.col("pricing_model")).alias("dedup_key"),
    )
    return Outcome(good, bad, log, taught)


def probed_products(
    ctx: RunContext, companies: DataFrame, get: Callable[[DataFrame], DataFrame], target: int, others: DataFrame | None = None, answers: DataFrame | None = None,
) -> Outcome:
    """companies: seq, name, website, probed by get (url, status, body). Where they yield fewer than target, as many of others as
    supplement_limit allows are probed too, the first in order, without names that were tried."""

    def of(pool: DataFrame) -> Outcome:
        told = probe_pricing(pool.where(F.coalesce(F.trim("website"), F.lit("")) != "").select("seq", "website"), get, "seq")
        rows = pool.drop("website").join(told.select("seq", F.col("fetched_url").alias("website"), F.col("evidence").alias("page_text"), F.col("pricing_model").alias("_told")), "seq")
        return products(ctx, rows, answers=answers, told="_told")

    first = of(companies)
    have = first.accepted.count() if others is not None else target
    if have >= target:
        return first
    tried = companies.select(F.lower(F.trim("name")).alias("_n")).distinct()
    pool = others.join(tried, F.lower(F.trim("name")) == F.col("_n"), "left_anti").orderBy("seq").limit(supplement_limit(target, have))
    second = of(pool)
    union = lambda a, b: a.unionByName(b, allowMissingColumns=True)
    return Outcome(*[union(a, b) for a, b in ((first.accepted, second.accepted), (first.rejected, second.rejected), (first.mapping, second.mapping), (first.learned, second.learned))])


def papers(ctx: RunContext, rows: DataFrame, stars: DataFrame | None = None) -> Outcome:
    """rows: seq, paper_id, title, authors, paper_url, github_url, summary, published_date. An address counts only where the text has it."""
    from sluice.functions.rules import is_evidence
    from sluice.functions.text import repo_slug
    from sluice.operators.candidates import cached_lookup

    rows = dedup.first_wins(rows, "paper_id", ["seq"])
    rows = rows.withColumn("github_url", F.when(is_evidence(F.col("github_url"), F.col("summary")), F.col("github_url")))
    rows = rows.withColumn("slug", repo_slug(F.col("github_url")))
    rows = cached_lookup(rows, stars, "slug", "github_stars") if stars is not None else rows.withColumn("github_stars", F.lit(None).cast("int"))
    good, bad = _checked(rows, [validate.not_blank("title"), validate.is_url("paper_url"), validate.is_url("github_url", optional=True), validate.required("published_date")], "RESEARCH_PAPER")
    good = good.withColumn("dedup_key", content_hash(F.col("title"), normal_url(F.col("paper_url"))))
    return Outcome(good.drop("is_cached", "slug"), bad)


def papers_by_category(
    ctx: RunContext, rows: DataFrame, others: DataFrame, target: int, categories: list[str], page_size: int = 100, stars: DataFrame | None = None,
) -> Outcome:
    """Papers of some categories, each up to its quota of candidates, and of a second pool where they are too few.

    rows: as of papers, with category. Categories go in the order given, their papers by
    seq in pages; a page is looked at while fewer than target papers were accepted before
    it, so the last page may lead beyond the target. Of others, papers that were not
    accepted yet are added by seq up to the target. One plan: quotas are ranks, pages are
    counted and summed, and how many are lacking is a row that is joined.
    """
    quota = category_quota(target, len(categories))
    at = F.array_position(F.array(*[F.lit(c) for c in categories]), F.col("category"))
    place = Window.partitionBy("category").orderBy("seq")
    first = rows.where(F.col("category").isin(categories)).withColumn("_rank", F.row_number().over(place)).where(F.col("_rank") <= quota)
    # papers() takes the first of each id by seq, which is the order of asking here
    first = first.select(F.col("seq").alias("_seq"), (at * (1 << 32) + F.col("_rank")).alias("seq"), *[c for c in rows.columns if c != "seq"], at.alias("_at"), F.floor((F.col("_rank") - 1) / page_size).alias("_page"))
    found = papers(ctx, first, stars)
    accepted = Scratch(ctx.spark).put(found.accepted)
    before = Window.orderBy("_at", "_page").rowsBetween(Window.unboundedPreceding, -1)  # a row a page
    pages = accepted.groupBy("_at", "_page").agg(F.count("*").alias("n")).select("_at", "_page", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    pages = pages.where(F.col("before") < target).select("_at", "_page")
    whole = lambda df: df.withColumn("seq", F.col("_seq")).drop("_seq", "_at", "_page")
    accepted = Scratch(ctx.spark).put(accepted.join(pages, ["_at", "_page"], "left_semi"))
    last = pages.agg(F.max(F.struct("_at", "_page")).alias("last"))
    rejected = found.rejected.join(F.broadcast(last), F.col("last").isNull() | (F.struct("_at", "_page") <= F.col("last"))).drop("last")

    more = papers(ctx, others.join(accepted.select("paper_id"), "paper_id", "left_anti"), stars)
    lacking = accepted.agg((F.lit(target) - F.count("*")).alias("_lacking"))  # one row
    added = more.accepted.orderBy("seq").limit(target).withColumn("_n", F.row_number().over(Window.orderBy("seq")))
    added = added.join(F.broadcast(lacking), F.col("_n") <= F.col("_lacking")).drop("_n", "_lacking")
    union = lambda a, b: a.unionByName(b, allowMissingColumns=True)
    return Outcome(union(whole(accepted), added), union(whole(rejected), more.rejected.join(F.broadcast(lacking), F.col("_lacking") > 0).drop("_lacking")))


def news(ctx: RunContext, rows: DataFrame, seen: DataFrame | None = None, hashes: DataFrame | None = None) -> Outcome:
    """rows: seq, source_name, headline, url, date, summary. Stale rows are rejected with the date as read."""
    fresh = is_fresh(F.col("date"), ctx.now, ctx.fresh_hours)
    stale = rows.where(~fresh).withColumn("errors", F.array(F.concat(F.lit("stale: "), F.coalesce(F.col("date").cast("string"), F.lit("no date")))))
    live = rows.where(fresh)
    if seen is not None:
        live = live.join(seen.select(F.col("item_id").alias("url")).distinct(), "url", "left_anti")
    live = dedup.first_wins(live, "url", ["seq"]).withColumn("content_hash", content_hash(F.col("headline"), F.col("source_name")))
    if hashes is not None:
        live = dedup.not_seen(live, hashes, ["content_hash"])
    live = dedup.first_wins(live, "content_hash", ["seq"])
    good, bad = _checked(live, [validate.not_blank("headline"), validate.is_url("url")], "NEWS")
    bad = bad.unionByName(validate.rejections(stale, [c for c in rows.columns if c != "record_type"], "NEWS"), allowMissingColumns=True)
    return Outcome(good.withColumn("dedup_key", content_hash(F.col("headline"), normal_url(F.col("url")))), bad)


def jobs(ctx: RunContext, rows: DataFrame, seen: DataFrame | None = None, answers: DataFrame | None = None) -> Outcome:
    """rows: seq, company, title, date, is_remote, url, description. A provider's answer (answer_key, the row's address or
    company:title, and answer) holds in place of the role family by rules."""
    fresh = is_fresh(F.col("date"), ctx.now, ctx.fresh_hours)
    stale = rows.where(~fresh).withColumn("errors", F.array(F.concat(F.lit("stale: "), F.coalesce(F.col("date").cast("string"), F.lit("no date")))))
    item = F.coalesce(F.nullif(F.col("url"), F.lit("")), F.concat_ws(":", "company", "title"))
    live = dedup.first_wins(rows.where(fresh).withColumn("item_id", item), "item_id", ["seq"])
    if seen is not None:
        live = dedup.not_seen(live, seen, ["item_id"])
    live = live.withColumn("role_family", role_family(F.col("title"), F.col("description")))
    live = _answered(live, answers, F.col("item_id"), "role_family", None)
    found, log, taught = _resolved(ctx, live, "company", "url")
    good, bad = _checked(found, [validate.not_blank("canonical_name"), validate.required("date"), validate.required("is_remote"), validate.is_url("url", optional=True)], "JOB")
    good = good.withColumn("dedup_key", content_hash(
        F.col("canonical_name"), F.col("role_family"), F.coalesce(normal_url(F.col("url")), F.lit("")), F.date_format("date", "yyyy-MM-dd'T'HH:mm:ss")
    ))
    bad = bad.unionByName(validate.rejections(stale, rows.columns, "JOB"), allowMissingColumns=True)
    return Outcome(good, bad, log, taught)


def store(ctx: RunContext, name: str, outcome: Outcome, seen_key: Column | None = None, commit: str | None = None) -> int:
    """Commits new rows, rejections, mapping entries, names learned and marks of what was stored together; returns the rows stored.

    All are one commit of ``manifest.Tables``: a run that dies at any point leaves nothing
    that is read, and one that is repeated under the same commit adds nothing. Without a
    commit's name each call is one of its own, and rows stored before are duplicates.
    """
    tables = Tables(ctx.spark, ctx.root)
    if commit is not None and (done := tables.committed(commit)) is not None:
        return done[name]
    stored = tables.read(name)
    new = dedup.first_wins(outcome.accepted, "dedup_key", ["seq"])
    if stored is not None:
        new = dedup.not_seen(new, stored, ["dedup_key"])
    new = Scratch(ctx.spark).put(new)  # read by several writes
    frames = {name: new, f"rejected/{name}": outcome.rejected}
    if outcome.mapping is not None:
        frames["mapping"] = mapping_log(outcome.mapping, "seq", tables.read("mapping")).drop("seq")
    if outcome.learned is not None:
        frames["learned"] = outcome.learned
    if seen_key is not None:
        frames["seen"] = new.select(F.lit(name).alias("namespace"), seen_key.alias("item_id"), ctx.now.alias("seen_at"))
    return tables.commit(frames, commit)[name]


def seen_items(ctx: RunContext, namespace: str) -> DataFrame | None:
    state = Tables(ctx.spark, ctx.root).read("seen")
    return None if state is None else state.where(F.col("namespace") == namespace)


def learned_names(ctx: RunContext) -> DataFrame | None:
    """(norm, raw, first) of the names that all runs stored under this root have learned, whatever the vertical; the first of each counts."""
    state = Tables(ctx.spark, ctx.root).read("learned")
    return None if state is None else dedup.first_wins(state, "norm", ["first"])
