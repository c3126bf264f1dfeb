"""The similarity core against brute force."""

import random
import time

import pytest
from pyspark.sql import functions as F

from sluice.functions.text import lcs_length
from sluice.operators import similarity


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b, 1):
            new.append(row[j - 1] + 1 if x == y else max(row[j], new[-1]))
        row = new
    return row[-1]


def ratio(a, b):
    a, b = (" ".join(sorted(x.split())) for x in (a, b))
    return 100.0 if a == b else 200 * lcs(a, b) / (len(a) + len(b))


def typos(rng, base, count, letters="abcde0123 é"):
    names = set()
    while len(names) < count:
        w = list(rng.choice(base))
        for _ in range(rng.randint(0, 3)):
            k = rng.randrange(len(w) + 1)
            w[k : k + rng.randint(0, 1)] = rng.choice([[], [rng.choice(letters)]])
        if s := " ".join("".join(w).split()):
            names.add(s)
    return sorted(names)


@pytest.fixture(scope="module")
def names(spark, sf):
    """Names of customers, which share most of their letters, and made typos."""
    known = [r[0].lower().replace("#", " ") for r in spark.read.parquet(f"{sf}/customer.parquet").orderBy("c_custkey").limit(60).select("c_name").collect()]
    rng = random.Random(3)
    return known + typos(rng, [*known, "acme robotics", "x", "ab", "é à"], 120) + ["same name", "name same"]


@pytest.mark.parametrize("percent, crowd", [(97, 500), (85, 500), (85, 5), (45, 20)])
def test_pairs(spark, names, percent, crowd):
    df = spark.createDataFrame(list(enumerate(names)), "key int, name string")
    rows = similarity.similar_pairs(df, percent, crowd=crowd).collect()
    want = {(i, j): round(r, 6) for i in range(len(names)) for j in range(i + 1, len(names)) if (r := ratio(names[i], names[j])) >= percent}
    assert {(r.a, r.b): round(r.score, 6) for r in rows} == want and len(rows) == len(want)


def test_names_of_one_length_are_not_met(spark):
    """Numbered names of one length differ by two letters at the least, so at 97 none is a candidate, as many as share their letters."""
    names = [f"{k:09d} customer" for k in range(3000)]
    rows = spark.createDataFrame([(k, s, len(s)) for k, s in enumerate(names)], "k int, s string, len int")
    assert similarity.candidates(rows, 97).count() == 0


@pytest.mark.parametrize("crowd", [500, 3])
def test_pairs_of_longer_names(spark, crowd):
    """Names of 30 to 40 letters: one letter lost, two exchanged, one replaced; none of them needs pairs of letters."""
    rng = random.Random(5)
    base = ["aaaaaaaaaaaaaaaaabbbbbbbbbbbbbbbbbcc", "a rather long name of some company x", "0000000000000000000000000012345 name"]
    names = sorted({*base, *typos(rng, base, 60), base[1].replace("ny", "yn"), base[0][1:] + "a", base[2].replace("5", "4")})
    df = spark.createDataFrame(list(enumerate(names)), "key int, name string")
    rows = similarity.similar_pairs(df, 97, crowd=crowd).collect()
    want = {(i, j): round(r, 6) for i in range(len(names)) for j in range(i + 1, len(names)) if (r := ratio(names[i], names[j])) >= 97}
    assert {(r.a, r.b): round(r.score, 6) for r in rows} == want and len(rows) == len(want)


@pytest.mark.parametrize("percent", [97, 85])
def test_numbers_tell_names_apart(spark, percent):
    names = ["small widget 10305", "small widget 1005", "smal widget 10305", "smal widget 1005", "widgets 10305 small", "small 7 widget 10305", "small widget"]
    df = spark.createDataFrame(list(enumerate(names)), "key int, name string")
    rows = similarity.similar_pairs(df, percent, numbers=True).collect()
    number = lambda s: sorted(w for w in s.split() if w.isdigit())
    want = {(i, j) for i in range(7) for j in range(i + 1, 7) if ratio(names[i], names[j]) >= percent and number(names[i]) == number(names[j])}
    assert {(r.a, r.b) for r in rows} == want and len(want) >= 2
    assert (0, 1) in {(r.a, r.b) for r in similarity.similar_pairs(df, percent).collect()}


def test_no_key_is_larger_than_a_tile(spark, names):
    """Customers' names share nearly all pairs of letters; what meets under one key stays bounded."""
    crowd = 8
    rows = spark.createDataFrame([(k, s, len(s)) for k, s in enumerate(names)], "k int, s string, len int")
    entries = similarity._entries(similarity._by_rarity(rows), 0.85)
    two = ["lo", "hi", "pair", "pair2"]
    split = entries.withColumn("pair2", F.explode(F.array_except("more", F.array("pair"))))
    sizes = similarity._crowded(split, two, crowd)
    assert sizes.count()
    for side in similarity._tiles(split, sizes, two, crowd):
        assert side.groupBy(*two, "i", "j").count().agg(F.max("count")).first()[0] <= 4 * crowd


def test_lcs_of_every_pair(spark, sf):
    """Of 2,000 names of parts with typos, drawn pairs; and long strings in time that grows with their length alone."""
    rng = random.Random(1)
    part = sorted({r[0] for r in spark.read.parquet(f"{sf}/part.parquet").select("p_name").collect()})
    made = typos(rng, part, 2000)
    pairs = [(rng.choice(made), rng.choice(made)) for _ in range(20_000)] + [("", ""), ("", "a"), (None, "a"), ("a" * 70 + "b", "b" + "a" * 70), ("é日" * 50, "日é" * 50)]
    df = spark.createDataFrame(pairs, "a string, b string")
    for r in df.select("a", "b", lcs_length(F.col("a"), F.col("b")).alias("n")).collect():
        assert r.n == (None if r.a is None else lcs(r.a, r.b))
    start = time.time()
    long = spark.createDataFrame([("ab" * 20_000, "ba" * 20_000)], "a string, b string").select(lcs_length(F.col("a"), F.col("b"))).first()[0]
    assert long == 39_999 and time.time() - start < 10


def resolver(rows, seed, threshold):
    """One name after the other, as the described resolver does."""
    known, learned, out = {}, {}, []
    corpus = []
    for c in seed:
        known[c.lower()] = c
        corpus.append((c.lower(), c))
    for seq, raw in rows:
        norm = " ".join(raw.lower().split())
        if not norm:
            out.append((seq, raw, raw.strip(), "unmatched-new", 0.0))
        elif norm in known:
            out.append((seq, raw, known[norm], "exact", 100.0))
        elif norm in learned:
            out.append((seq, raw, learned[norm], "exact", 100.0))
        else:
            best = max(corpus, key=lambda x: round(ratio(norm, x[0]), 9), default=None)
            if best and ratio(norm, best[0]) >= threshold:
                out.append((seq, raw, best[1], "fuzzy", round(ratio(norm, best[0]), 6)))
            else:
                learned[norm] = raw.strip()
                corpus.append((norm, raw.strip()))
                out.append((seq, raw, raw.strip(), "unmatched-new", 0.0))
    return out


@pytest.mark.parametrize("threshold", [92, 85])
def test_names_learned_across_runs(spark, threshold):
    """Two and three runs over parts of the rows give what one run gives, and what the described resolver gives."""
    from sluice.operators.resolve import resolve, resolve_and_learn

    rng = random.Random(6)
    pool = typos(rng, ["acme robotic", "beta systems", "gamma", "delta lake"], 60, "abcde")
    rows = [(k, rng.choice(pool)) for k in range(220)] + [(220, " "), (221, "")]
    seed = {"Acme Robotics": [], "Beta System": []}
    want = sorted(resolver(rows, seed, threshold))
    assert {r[3] for r in want} >= {"fuzzy", "exact", "unmatched-new"}
    frame = lambda part: spark.createDataFrame(part, "seq long, name string")
    assert sorted(map(tuple, resolve(frame(rows), "name", "seq", seed, threshold).collect())) == want
    for cuts in ([0, 90, 222], [0, 10, 11, 222]):
        got, learned = [], None
        for a, b in zip(cuts, cuts[1:]):
            out, own = resolve_and_learn(frame(rows[a:b]), "name", "seq", seed, threshold, learned=learned)
            got += map(tuple, out.collect())
            own = spark.createDataFrame(own.collect(), own.schema)
            learned = own if learned is None else learned.unionByName(own)
        assert sorted(got) == want
