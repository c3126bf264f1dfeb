"""Entity resolution: exact, alias, learned and fuzzy, in the order of a sequence column.

The order matters: a name that matches nothing becomes known from then on. Distinct
normal names are few beside the rows, so they are settled first. A name is a leader
when no seed name and no leader before it is similar enough; that is decided in
rounds, each settling the names whose earlier neighbours are settled, over the edges
of a similarity join. Rows then join their names.

What a run learned can be given to the next (``learned``): names known before lead, in
the order in which they were first seen, so that runs over the parts of an input one
after the other give the names of one run over all of it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.functions.text import normalize_name
from sluice.operators.scratch import Scratch
from sluice.operators.seed import COMPANIES
from sluice.operators.similarity import similar_pairs

#: Seed names beyond which the seed table is joined, not broadcast.
SMALL_SEED = 50_000


def _cut(df: DataFrame) -> DataFrame:
    """df as a table of the shared folder."""
    return Scratch(df.sparkSession).put(df)


def seed_table(spark: SparkSession, seed: dict[str, list[str]]) -> DataFrame:
    """(norm, canonical, kind, display, ord): kind exact or alias; display is what a fuzzy match of the name shows."""
    rows, at = [], 0
    for canonical, aliases in seed.items():
        for kind, name in [("exact", canonical), *(("alias", a) for a in aliases)]:
            rows.append((at, kind, canonical, name))
            at += 1
    table = spark.createDataFrame(rows, "ord int, kind string, canonical string, name string").withColumn("norm", normalize_name(F.col("name")))
    # a canonical name goes before an alias; of two aliases the later holds; the first display holds
    return table.groupBy("norm").agg(
        F.coalesce(F.max_by("canonical", F.when(F.col("kind") == "exact", F.col("ord"))), F.max_by("canonical", "ord")).alias("canonical"),
        F.when(F.bool_or(F.col("kind") == "exact"), "exact").otherwise("alias").alias("kind"),
        F.min_by("canonical", "ord").alias("display"), F.min("ord").alias("ord"),
    )


def _edges(names: DataFrame, table: DataFrame, percent: float, learned: DataFrame | None = None, numbers: bool = False) -> DataFrame:
    """(norm, other, other_at, score): for each name, seed names, learned names and names before it with percent or more."""
    seeds = table.select("norm", F.col("ord").cast("long").alias("place"), F.lit(0).alias("group"))
    both = seeds.unionByName(names.select("norm", F.col("first").alias("place"), F.lit(1).alias("group")))
    if learned is not None:
        both = both.unionByName(learned.select("norm", F.col("first").alias("place"), F.lit(1).alias("group")))
    pairs = similar_pairs(both.select("norm", F.col("norm").alias("key")), percent, "norm", numbers=numbers)
    info = lambda c: both.select(F.col("norm").alias(c), F.struct("group", "place").alias(f"{c}_at"))
    met = pairs.join(info("a"), "a").join(info("b"), "b").where("a_at.group = 1 or b_at.group = 1")
    if learned is not None:  # what is known before stays as it is
        fresh = lambda c: names.select(F.col("norm").alias(c), F.lit(True).alias(f"{c}_new"))
        met = met.join(fresh("a"), "a", "left").join(fresh("b"), "b", "left").where("a_new or b_new")
    a_first = F.col("a_at") < F.col("b_at")
    return met.select(
        F.when(a_first, F.col("b")).otherwise(F.col("a")).alias("norm"), F.when(a_first, F.col("a")).otherwise(F.col("b")).alias("other"),
        F.when(a_first, F.col("a_at")).otherwise(F.col("b_at")).alias("other_at"), "score",
    )


def _leaders(names: DataFrame, edges: DataFrame, learned: DataFrame | None = None) -> DataFrame:
    """(norm) of the names that no seed name, no learned name and no earlier leader is similar to."""
    merged = edges.where("other_at.group = 0").select("norm").distinct()
    if learned is not None:
        merged = merged.unionByName(edges.join(learned.select(F.col("norm").alias("other")), "other", "left_semi").select("norm")).distinct()
    edges = _cut(edges.where("other_at.group = 1").select("norm", "other"))
    if edges.isEmpty():
        return names.select("norm").join(merged, "norm", "left_anti")
    merged = _cut(merged)
    open_ = _cut(edges.select("norm").distinct().join(merged, "norm", "left_anti"))
    settled = names.select("norm").join(merged, "norm", "left_anti").join(open_, "norm", "left_anti")
    leaders = fresh = _cut(settled)
    while not open_.isEmpty():
        # a leader's later neighbours merge; an open name all of whose earlier neighbours merged leads
        lost = open_.join(edges.join(fresh.withColumnRenamed("norm", "other"), "other").select("norm").distinct(), "norm")
        merged = _cut(merged.unionByName(lost))
        open_ = open_.join(lost, "norm", "left_anti")
        live = edges.join(merged.withColumnRenamed("norm", "other"), "other", "left_anti").select("norm").distinct()
        fresh = _cut(open_.join(live, "norm", "left_anti"))
        leaders = leaders.unionByName(fresh)
        open_ = _cut(open_.join(fresh, "norm", "left_anti"))
    return _cut(leaders)


def resolve(
    df: DataFrame, raw: str, seq: str, seed: dict[str, list[str]] | None = None, threshold: float = 97.0, carry: list[str] | None = None, learned: DataFrame | None = None,
    numbers: bool = False,
) -> DataFrame:
    """(seq, raw_name, canonical_name, method, confidence[, carried]): method exact, alias, fuzzy or unmatched-new.

    learned: (norm, raw, first) of names that earlier runs learned, as learned_names gives them; their places come before those of df.
    numbers: a name is no fuzzy match of one with other numbers in it.
    """
    return resolve_and_learn(df, raw, seq, seed, threshold, carry, learned, numbers)[0]


def resolve_and_learn(
    df: DataFrame, raw: str, seq: str, seed: dict[str, list[str]] | None = None, threshold: float = 97.0, carry: list[str] | None = None, learned: DataFrame | None = None,
    numbers: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """(rows as resolve gives them, (norm, raw, first) of the names that this run learned)."""
    rows, table, names, edges, leaders = _settled(df, raw, seq, seed, threshold, carry or [], learned, numbers)
    taught = names.join(leaders, "norm").select("norm", "raw", "first")
    shown = taught if learned is None else taught.unionByName(learned.select("norm", "raw", "first"))
    shown = shown.select(F.col("norm").alias("l_norm"), F.col("raw").alias("l_raw"), F.col("first").alias("l_first"))
    leaders = shown.select(F.col("l_norm").alias("norm"))
    # a name that is no leader is compared at each occurrence with all that are known by then, those first seen after it too
    at = names.select(F.col("norm"), F.struct(F.lit(1).alias("group"), F.col("first").alias("place")).alias("own_at"))
    back = edges.where("other_at.group = 1").join(at, "norm").select(F.col("other").alias("norm"), F.col("norm").alias("other"), F.col("own_at").alias("other_at"), "score")
    edges = edges.unionByName(back)
    kept = edges.join(leaders.select(F.col("norm").alias("other"), F.lit(True).alias("leads")), "other", "left").where("other_at.group = 0 or leads")
    displays = table.select(F.col("norm").alias("other"), "display").unionByName(shown.select(F.col("l_norm").alias("other"), F.col("l_raw").alias("display")))
    # only names that are not leaders have fuzzy matches, the same at each occurrence but for leaders learned meanwhile
    kept = kept.join(leaders, "norm", "left_anti").join(displays, "other")
    small = table.count() <= SMALL_SEED
    known = table.select("norm", F.col("canonical").alias("s_canonical"), F.col("kind").alias("s_kind"))
    out = rows.join(F.broadcast(known) if small else known, "norm", "left")
    out = out.join(shown, out["norm"] == shown["l_norm"], "left").drop("l_norm")
    best = out.where("s_kind is null and l_first is null and norm <> ''").select("norm", "_seq").join(kept, "norm")
    best = best.where("other_at.group = 0 or other_at.place < _seq").groupBy("_seq").agg(
        F.max_by(F.struct("display", "score"), F.struct("score", (-F.col("other_at.group")).alias("g"), (-F.col("other_at.place")).alias("p"))).alias("f")
    )
    out = out.join(best, "_seq", "left")
    own = F.trim("raw")
    canonical = F.when(F.col("norm") == "", own).otherwise(F.coalesce("s_canonical", "l_raw", "f.display", own))
    first = F.col("l_first") == F.col("_seq")
    method = (
        F.when(F.col("norm") == "", "unmatched-new").when(F.col("s_kind").isNotNull(), F.col("s_kind")).when(first, "unmatched-new")
        .when(F.col("l_first").isNotNull(), "exact").when(F.col("f").isNotNull(), "fuzzy").otherwise("unmatched-new")
    )
    confidence = F.when(method == "unmatched-new", 0.0).when(method == "fuzzy", F.round("f.score", 6)).otherwise(100.0)
    return out.select(F.col("_seq").alias(seq), F.col("raw").alias("raw_name"), canonical.alias("canonical_name"), method.alias("method"), confidence.alias("confidence"), *(carry or [])), taught


def _settled(df, raw, seq, seed, threshold, carry, learned=None, numbers=False):
    seed = COMPANIES if seed is None else seed
    rows = df.select(F.col(seq).cast("long").alias("_seq"), F.coalesce(F.col(raw).cast("string"), F.lit("")).alias("raw"), *carry).withColumn("norm", normalize_name(F.col("raw")))
    table = seed_table(df.sparkSession, seed).where("norm <> ''") if seed else df.sparkSession.createDataFrame([], "norm string, canonical string, kind string, display string, ord int")
    table = _cut(table)
    names = rows.where("norm <> ''").groupBy("norm").agg(F.min("_seq").alias("first"), F.trim(F.min_by("raw", "_seq")).alias("raw"))
    names = names.join(table.select("norm"), "norm", "left_anti")
    if learned is not None:
        learned = learned.join(table.select("norm"), "norm", "left_anti")
        names = names.join(learned.select("norm"), "norm", "left_anti")
    names = _cut(names)
    edges = _cut(_edges(names, table, threshold, learned, numbers))
    return rows, table, names, edges, _leaders(names, edges, learned)


def review_candidates(df: DataFrame, raw: str, seq: str, seed: dict[str, list[str]] | None = None, threshold: float = 97.0, review: float = 80.0) -> DataFrame:
    """(raw_name, candidate, confidence): leaders whose best earlier match lies in [review, threshold), for a person to look at."""
    _, table, names, _, leaders = _settled(df, raw, seq, seed, threshold, [])
    near = _edges(names, table, review).join(leaders, "norm")
    near = near.join(leaders.select(F.col("norm").alias("other"), F.lit(True).alias("leads")), "other", "left").where("other_at.group = 0 or leads")
    displays = table.select(F.col("norm").alias("other"), "display").unionByName(names.select(F.col("norm").alias("other"), F.col("raw").alias("display")))
    best = near.join(displays, "other").groupBy("norm").agg(
        F.max_by(F.struct("display", "score"), F.struct("score", (-F.col("other_at.group")).alias("g"), (-F.col("other_at.place")).alias("p"))).alias("f")
    )
    return best.join(names, "norm").where((F.col("f.score") < threshold)).select(
        F.col("raw").alias("raw_name"), F.col("f.display").alias("candidate"), F.round("f.score", 6).alias("confidence")
    )


def mapping_log(entries: DataFrame, order: str, stored: DataFrame | None = None) -> DataFrame:
    """The first entry of each (raw_name, canonical_name, method), none of those stored before."""
    key = ["raw_name", "canonical_name", "method"]
    if stored is not None:
        entries = entries.join(stored.select(*key).distinct(), key, "left_anti")
    rest = [c for c in entries.columns if c not in key]
    first = entries.groupBy(*key).agg(F.min_by(F.struct(*rest), order).alias("_r"))
    return first.select(*key, *[F.col("_r")[c].alias(c) for c in rest])
