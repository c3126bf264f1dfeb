"""Similarity joins of names by token-sorted insert-and-delete similarity.

Two strings of lengths a and b with similarity t per hundred differ by at most
(1 - t) * (a + b) insertions and deletions. A deletion takes two of a string's pairs of
neighbouring letters (its ends count as letters), an insertion one, so of a + 1 pairs at
most so many are lost. If the pairs of both strings are put in one order, a pair they
share stands among the first of each, one more than can be lost: only these are indexed,
under both lengths, and the order is the rarest first, so that keys stay small.

Where the longer of two similar strings can lose one character at the most and the
shorter one or none, as short names do at high limits, they are equal once what is lost
is left out. There the key is the whole string, or the string without one of its
characters, so that candidates are few however many letters all names share.

A key that more than ``CROWD`` entries hold is split by a second pair of letters, which
two similar strings share too, among one more of their first; what is still larger is
joined by tiles of bounded size. Candidates are met once, at the first pairs they share,
and scored by a longest common subsequence in machine words. Never all pairs of names.
"""

from __future__ import annotations

from collections import Counter

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.functions.text import lcs_length, token_sort
from sluice.operators.scratch import Scratch

#: Entries of a key beyond which it is split.
CROWD = 500
#: Stands for a pair of letters where two similar strings may share none.
ANY = "*"


@F.pandas_udf(T.ArrayType(T.StringType()))
def letter_pairs(names: pd.Series) -> pd.Series:
    """The pairs of neighbouring letters, ends among them, each with the number of its like before it."""

    def one(s: str) -> list[str]:
        seen: Counter[str] = Counter()
        out = []
        for p in map("".join, zip("\0" + s, s + "\0")):
            out.append(f"{p}{seen[p]}")
            seen[p] += 1
        return out

    return names.map(one)


def _by_rarity(rows: DataFrame) -> DataFrame:
    """rows (k, s, len) with pairs, the rarest of all names first."""
    pairs = rows.select("k", F.explode(letter_pairs("s")).alias("pair"))
    often = pairs.groupBy("pair").agg(F.count("*").alias("n"))
    ordered = pairs.join(often, "pair").groupBy("k").agg(F.sort_array(F.collect_list(F.struct("n", "pair"))).alias("p"))
    return rows.join(ordered.select("k", F.col("p.pair").alias("pairs")), "k")


def _lengths(n: Column, t: float) -> Column:
    """The lengths that a partner of a name of length n can have."""
    return F.sequence(F.greatest(F.lit(1), F.ceil(n * (t / (2 - t)) - 1e-9)).cast("int"), F.floor(n * ((2 - t) / t) + 1e-9).cast("int"))


def _changes(n: Column, m: Column, t: float) -> Column:
    """The most insertions and deletions between similar strings of lengths n and m."""
    most = F.floor((n + m) * (1 - t) + 1e-9).cast("int")
    return most - F.pmod(most - F.abs(n - m), F.lit(2))  # as many more insertions as the lengths differ


def _far(n: Column, m: Column, t: float) -> Column:
    """Whether the longer of similar strings of lengths n and m can lose more than one character."""
    return _changes(n, m, t) + F.abs(n - m) > 2


def _apart(rows: DataFrame) -> list[str]:
    """The column in which partners are equal, where there is one."""
    return [c for c in rows.columns if c == "w"]


def _near_entries(rows: DataFrame, lengths: DataFrame, t: float) -> DataFrame:
    """(lo, hi, pair, k, s, len, d) for each length at which the longer one loses one character at the most: pair is the string as it is,
    or without each of its characters, as a number."""
    n, m = F.col("len"), F.col("m")
    out = rows.select("*", F.explode(_lengths(n, t)).alias("m")).join(F.broadcast(lengths), "m").withColumn("d", _changes(n, m, t))
    out = out.where("d >= abs(len - m)").where(~_far(n, m, t))
    shorter = F.array_distinct(F.transform(F.sequence(F.lit(1), n), lambda i: F.concat(F.left("s", i - 1), F.substring("s", i + 1, n))))
    left = F.when(F.col("d") + n - m == 0, F.array("s")).otherwise(shorter)
    out = out.select(F.least(n, m).alias("lo"), F.greatest(n, m).alias("hi"), "k", "s", "len", "d", *_apart(rows), F.explode(left).alias("left"))
    return out.withColumn("pair", F.xxhash64("left", *_apart(rows))).drop("left", *_apart(rows))


def _near(rows: DataFrame, lengths: DataFrame, t: float, crowd: int) -> DataFrame:
    """Candidates (a, b, sa, sb) of such lengths. Nearly all are similar, so a crowded key is one of similar names, and is joined by tiles."""
    on = ["lo", "hi", "pair"]
    scratch = Scratch(rows.sparkSession)
    entries = scratch.put(_near_entries(rows, lengths, t))

    def met(shorter: DataFrame, longer: DataFrame, keys: list[str]) -> DataFrame:
        side = lambda df, c: df.select(*keys, *[F.col(x).alias(f"{c}_{x}") for x in ("k", "s", "d")])
        return side(shorter.where("len = lo"), "x").join(side(longer.where("len = hi"), "y"), keys).where("lo < hi or x_k < y_k")

    large = scratch.put(_crowded(entries, on, crowd))
    if large.isEmpty():
        both = met(entries, entries, on)
    else:
        calm = entries.join(large, on, "left_anti")
        both = met(calm, calm, on).unionByName(met(*_tiles(entries, large, on, crowd), [*on, "i", "j"]).drop("i", "j"))
    both = both.select((F.col("x_d") == 2).alias("again"), *_sides())
    # two strings that lose one character each may be left equal in several ways
    return both.where("not again").drop("again").unionByName(both.where("again").drop("again").dropDuplicates(["a", "b"]))


def _entries(rows: DataFrame, t: float) -> DataFrame:
    """(lo, hi, pair, k, s, len, first, more) for each length that a partner of a name can have, and each of its first pairs; first and
    more are the pairs among which one and two are shared."""
    n, m = F.col("len"), F.col("m")
    out = rows.select("*", F.explode(_lengths(n, t)).alias("m")).select("*", F.least(n, m).alias("lo"), F.greatest(n, m).alias("hi"))
    out = out.withColumn("d", _changes(n, m, t)).where("d >= hi - lo")
    lost = ((3 * F.col("d") + n - m) / 2).cast("int")
    # shared of both sides at the least: pairs less what is lost
    shared = F.least(n + 1 - lost, m + 1 - ((3 * F.col("d") + m - n) / 2).cast("int"))

    def among(k: int) -> Column:
        return F.when(shared >= k, F.slice("pairs", F.lit(1), lost + k)).otherwise(F.array(F.lit(ANY)))

    out = out.select("lo", "hi", "k", "s", "len", *_apart(rows), among(1).alias("first"), among(2).alias("more"))
    return out.select("*", F.explode("first").alias("pair"))


def _sides() -> list[Column]:
    a = F.col("x_k") < F.col("y_k")
    return [F.least("x_k", "y_k").alias("a"), F.greatest("x_k", "y_k").alias("b"), F.when(a, F.col("x_s")).otherwise(F.col("y_s")).alias("sa"), F.when(a, F.col("y_s")).otherwise(F.col("x_s")).alias("sb")]


def _once(both: DataFrame) -> DataFrame:
    """Candidates (x, y) of one key, where the key is what they share first."""
    both = both.where("lo < hi or x_k < y_k").where(F.get(F.array_intersect("x_first", "y_first"), F.lit(0)) == F.col("pair"))
    if "pair2" in both.columns:
        second = F.get(F.array_except(F.array_intersect("x_more", "y_more"), F.array("pair")), F.lit(0))
        both = both.where(F.coalesce(second, F.lit(ANY)) == F.col("pair2"))
    return both.select(*_sides())


def _met(shorter: DataFrame, longer: DataFrame, on: list[str]) -> DataFrame:
    side = lambda df, c: df.select(*on, *[F.col(x).alias(f"{c}_{x}") for x in ("k", "s", "first", "more")])
    return _once(side(shorter.where("len = lo"), "x").join(side(longer.where("len = hi"), "y"), on))


def _crowded(entries: DataFrame, on: list[str], crowd: int) -> DataFrame:
    """Keys of more than crowd entries, where there are shorter and longer names among them."""
    sizes = entries.groupBy(*on).agg(F.count("*").alias("entries"), F.count_if(F.col("len") == F.col("lo")).alias("lows"), F.count_if(F.col("len") == F.col("hi")).alias("highs"))
    return sizes.where(F.col("entries") > crowd).where("lows > 0 and highs > 0").drop("lows", "highs")


def _tiles(entries: DataFrame, sizes: DataFrame, on: list[str], crowd: int) -> tuple[DataFrame, DataFrame]:
    """Entries of large keys as those of tiles (i, j), shorter names by rows and longer by columns: about crowd of each in a tile, and two
    names meet in one tile alone."""
    dealt = entries.join(sizes, on).withColumn("parts", F.ceil(F.col("entries") / crowd).cast("int")).withColumn("part", F.pmod(F.xxhash64("k"), F.col("parts")).cast("int"))
    others = F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
    return dealt.select(*entries.columns, F.col("part").alias("i"), others.alias("j")), dealt.select(*entries.columns, others.alias("i"), F.col("part").alias("j"))


def candidates(rows: DataFrame, percent: float, crowd: int = CROWD) -> DataFrame:
    """(a, b, sa, sb) of rows (k, s, len): every two names that can have percent or more, and some others, once each.

    Where rows have a column w, only names that are equal in it are met.
    """
    t = percent / 100
    scratch = Scratch(rows.sparkSession)
    rows = scratch.put(rows)
    lengths = scratch.put(rows.select(F.col("len").alias("m")).distinct())
    near = _near(rows, lengths, t, crowd)
    far = rows.where(F.exists(_lengths(F.col("len"), t), lambda m: _far(F.col("len"), m, t)))
    return near if far.isEmpty() else near.unionByName(_far_candidates(far, lengths, t, crowd))


def _far_candidates(rows: DataFrame, lengths: DataFrame, t: float, crowd: int) -> DataFrame:
    """Candidates of lengths at which the longer one can lose more than one character, by pairs of letters."""
    one, two = ["lo", "hi", "pair", *_apart(rows)], ["lo", "hi", "pair", *_apart(rows), "pair2"]
    scratch = Scratch(rows.sparkSession)  # entries are read once for each way and side
    entries = _entries(_by_rarity(rows), t).where(_far(F.col("lo"), F.col("hi"), t))
    entries = scratch.put(entries.join(F.broadcast(lengths), F.col("lo") + F.col("hi") - F.col("len") == F.col("m"), "left_semi"))
    large = scratch.put(_crowded(entries, one, crowd).select(*one))
    if large.isEmpty():
        return _met(entries, entries, one)
    calm, split = entries.join(large, one, "left_anti"), entries.join(large, one, "left_semi")
    seconds = F.array_except("more", F.array("pair"))
    split = scratch.put(split.select("*", F.explode(F.when(F.size(seconds) > 0, seconds).otherwise(F.array(F.lit(ANY)))).alias("pair2")))
    larger = scratch.put(_crowded(split, two, crowd))
    calmer = split.join(larger.select(*two), two, "left_anti")
    rows_, columns = _tiles(split, larger, two, crowd)
    return _met(calm, calm, one).unionByName(_met(calmer, calmer, two)).unionByName(_met(rows_, columns, [*two, "i", "j"]))


def similar_pairs(names: DataFrame, percent: float, name: str = "name", key: str = "key", crowd: int = CROWD, numbers: bool = False) -> DataFrame:
    """(a, b, score): keys a < b of names with a score of percent or more. Names are normal already; keys are distinct.

    A name without words is similar to none. percent is above 0. numbers: names with other numbers in them are not similar.
    """
    rows = names.select(F.col(key).alias("k"), token_sort(F.col(name)).alias("s")).where("s <> ''").withColumn("len", F.length("s"))
    if numbers:
        rows = rows.withColumn("w", F.array_join(F.array_sort(F.regexp_extract_all("s", F.lit(r"(\d+)"))), " "))
    met = candidates(rows, percent, crowd)
    total = F.length("sa") + F.length("sb")
    score = F.when(F.col("sa") == F.col("sb"), F.lit(100.0)).otherwise(200.0 * lcs_length(F.col("sa"), F.col("sb")) / total)
    return met.withColumn("score", score).where(F.col("score") >= percent - 1e-9).select("a", "b", "score")
