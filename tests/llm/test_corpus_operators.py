"""Quality, near duplicates and the pipeline against brute force."""

import random
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from sluice.llm import langid, minhash, quality, queries, secrets
from sluice.llm.common import cut

EDGES = [(0, None), (1, ""), (2, " \t\n"), (3, "a"), (3, "a"), (None, "a b c d e f"), (None, None), (5, "word " * 60_000), (6, "z" * 50_000), (7, "A b C d E f"), (8, "a b c d e f")]


@pytest.fixture(scope="module")
def edges(spark):
    rows = [(i, t, "en", None, 1, True, 3, "x", "y") for i, t in EDGES]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, kept boolean, node long, line string, removed string")


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_sql(name, spark, sf):
    con = duckdb.connect()
    for t in ("documents", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    result = con.execute(queries.SQL[name])
    columns = [c[0] for c in result.description]
    df = queries.QUERIES[name](spark, sf)
    assert sorted(df.columns) == sorted(columns)
    assert Counter(tuple(r[c] for c in columns) for r in df.collect()) == Counter(result.fetchall())


def components(rows, percent):
    sets = {}
    for d, t in rows:
        w = (t or "").encode().lower().split()
        sets[d] = frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])
    parent = {d: d for d in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            x, y = sets[a], sets[b]
            if x and y and 100 * len(x & y) >= percent * len(x | y):
                p, q = root(a), root(b)
                parent[max(p, q)] = min(p, q)
    return {d: (len(sets[d]), root(d)) for d in ids}


def near_copies(seed=5):
    """Groups of copies with one to nine words changed, copies of copies, and texts that share a passage."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 9)))
    passage, rows = [word() for _ in range(60)], []
    for g in range(12):
        base = [word() for _ in range(rng.randint(40, 220))]
        for k in range(rng.choice([1, 2, 5, 40])):
            text = list(base)
            for _ in range(rng.randint(0, 9) if k else 0):
                text[rng.randrange(len(text))] = word()
            rows.append(" ".join(text))
            if k % 4 == 3:
                base = text
    rows += [" ".join([*passage, *[word() for _ in range(rng.randint(30, 200))]]) for _ in range(25)]
    rng.shuffle(rows)
    return [(i * 3, t) for i, t in enumerate(rows)]


@pytest.mark.parametrize("percent", [80, 85])
def test_near_duplicates(spark, percent):
    rows = near_copies()
    want = components(rows, percent)
    got = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), percent=percent).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == want
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got)


def test_near_duplicates_edges(edges, empty):
    got = Counter((r["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in minhash.near_duplicates(edges).collect())
    assert got == Counter([
        (0, 0, 0, True), (1, 0, 1, True), (2, 0, 2, True), (3, 1, 3, True), (3, 1, 3, True), (None, 2, None, True), (None, 0, None, True), (5, 1, 5, True), (6, 1, 6, True), (7, 2, 7, True), (8, 2, 7, False),
    ])
    assert minhash.near_duplicates(empty).count() == 0


def test_near_duplicates_ids(spark):
    """Ids of any type; rows that share an id are judged each by its own text, whatever their order."""
    rows = near_copies()
    want = components([(f"k{i:06d}", t) for i, t in rows], 85)
    got = minhash.near_duplicates(spark.createDataFrame([(f"k{i:06d}", t) for i, t in rows], "name string, body string"), "name", "body", 85).collect()
    assert {r["name"]: (r["n_shingles"], r["component_id"]) for r in got} == want
    words = [f"w{k}" for k in range(60)]
    one, two = " ".join(words), " ".join(words[::-1])
    mixed = [(5, one), (5, two), (7, one + " more"), (9, two), (3, two + " x")]
    for order in (mixed, mixed[::-1]):
        got = Counter((r["doc_id"], r["component_id"], r["kept"]) for r in minhash.near_duplicates(spark.createDataFrame(order, "doc_id long, text string"), percent=85).collect())
        assert got == Counter([(5, 5, True), (5, 3, False), (7, 5, False), (9, 3, False), (3, 3, True)])


def test_sides_and_recall():
    """Pairs at the limit share a table with the probability stated, by drawn sets."""
    rng = np.random.default_rng(5)
    for percent, n in ((85, 10), (80, 13), (100, 1)):
        assert minhash.sides(percent) == n
    same, other = 170, 15  # 170 / 200 = 0.85
    met = 0
    for _ in range(1500):
        x = rng.integers(0, 1 << 64, same + 2 * other, np.uint64)
        sets = np.concatenate([x[: same + other], x[:same], x[same + other :]])
        keys = minhash.sub_keys(sets, np.array([0, same + other]), 10)
        eq = keys[:, 0] == keys[:, 1]
        met += eq[:10].any() and eq[10:].any()
    assert met >= 1496


def test_components(spark):
    rng = random.Random(3)
    links = [(i, i + 1) for i in range(60)] + [(100 + i, 100) for i in range(1, 40)] + [(rng.randrange(200, 300), rng.randrange(200, 300)) for _ in range(70)]
    parent = {}

    def root(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        p, q = root(a), root(b)
        if a != b:
            parent[max(p, q)] = min(p, q)
    named = {x for a, b in links if a != b for x in (a, b)}
    frame = lambda x: spark.createDataFrame(x, "a long, b long")
    rng.shuffle(links)
    labels = None
    for k in range(0, len(links), 40):  # a part of the links after the other
        labels = minhash.merged(labels, frame(links[k : k + 40]), 2)
    assert {r["node"]: r["component"] for r in labels.collect()} == {x: root(x) for x in named}
    got = {r["node"]: r["component"] for r in minhash.components(spark.createDataFrame(links, "a long, b long"), 2).collect()}
    assert got == {x: root(x) for x in named}


def test_quality_edges(edges, empty, spark):
    rows = quality.quality_rules(edges).collect()
    assert len(rows) == len(EDGES)
    by = {r["doc_id"]: r for r in rows}
    assert (by[1]["n_words"], by[1]["kept"]) == (0, False) and by[5]["n_words"] == 60_000 and by[5]["n_repeat_words"] == 60_000 and by[6]["word_chars"] == 50_000
    assert quality.quality_rules(empty).count() == 0


def test_boilerplate(spark):
    """A line of many different documents of a host goes, and with it documents of little else; a text's copies count once."""
    rng = random.Random(1)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(6))
    prose = lambda n: "\n".join(" ".join(word() for _ in range(10)) for _ in range(n))
    banner = "Subscribe to our daily letter and follow us everywhere you go " * 4
    rows = [(i, prose(8) + "\n" + banner, "a") for i in range(40)] + [(100 + i, prose(1) + ("\n" + banner) * 3, "a") for i in range(5)]
    copy = prose(9)
    rows += [(200 + i, copy, "a") for i in range(300)] + [(600 + i, prose(8) + "\n" + banner, "b") for i in range(5)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = {r["doc_id"]: r for r in quality.quality_rules(df, carry=["doc_id"]).collect()}
    assert all(got[i]["removed_lines"] == 1 and got[i]["kept"] and banner.strip() not in got[i]["clean_text"] for i in range(40))
    assert not any(got[100 + i]["kept"] for i in range(5))
    assert all(got[200 + i]["kept"] and got[200 + i]["removed_lines"] == 0 and got[200 + i]["clean_text"] == copy for i in range(300))
    assert all(got[600 + i]["removed_lines"] == 0 for i in range(5))
    native = quality.quality_rules(df)._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas", native)


def test_pipeline(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns = docs.columns
    stages = dict(corpus_pipeline.STAGES)
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality rules", "language ID", "MinHash near-dedup", "secret scans", "best-fit packing"]
    read = lambda df: {r["doc_id"]: r for r in df.collect()}

    one = cut(stages["quality rules"](spark, docs, sf))
    verdict = {r["doc_id"]: r for r in quality.quality_rules(docs, carry=["doc_id"]).collect()}
    assert one.columns == columns and {i: r["text"] for i, r in read(one).items()} == {i: r["clean_text"] for i, r in verdict.items() if r["kept"]}
    assert all(r["n_chars"] == len(r["text"]) for r in read(one).values())

    two = cut(stages["language ID"](spark, one, sf))
    before, after = read(one), read(two)
    classify = langid.Classifier(langid.train_dictionaries(langid.training_rows(one)))
    for i, r in before.items():
        lang, score, margin = classify(r["text"].lower().encode()) if re.search(r"[^\W\d_]", r["text"]) else ("und", 0.0, 0.0)
        assert (i in after) == (lang != "und" and score >= 0.05 and margin >= 0.02)
        if i in after:
            assert after[i]["text"] == r["text"] and after[i]["lang"] == lang
    assert two.columns == columns and len(after) >= 0.95 * len(before)

    three = cut(stages["MinHash near-dedup"](spark, two, sf))
    want = components([(i, r["text"]) for i, r in after.items()], 80)
    assert three.columns == columns and set(read(three)) == {i for i, (_, c) in want.items() if i == c}

    four = cut(stages["secret scans"](spark, three, sf))
    masked = read(four)
    assert four.columns == columns and set(masked) == set(read(three)) and all(r["n_chars"] == len(r["text"]) for r in masked.values())
    left = secrets.scan_secrets(four).where("size(_secrets.base) > 0").count()
    assert left == 0 and (not any("token =" in r["text"] for r in read(three).values()) or any("[SECRET]" in r["text"] for r in masked.values()))

    five = stages["best-fit packing"](spark, four, sf)
    assert {r["doc_id"] for r in five.collect()} == set(masked)
    whole = corpus_pipeline.run(spark, sf)
    key = lambda df: Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in df.collect())
    assert key(whole) == key(five)


def test_pipeline_edges(spark, edges, empty, sf):
    base = edges.select("doc_id", "text", "lang", "source", "n_chars")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, base, sf).count() >= 0
        assert stage(spark, empty, sf).count() == 0
    counts = defaultdict(int)
    for r in corpus_pipeline.secret_stage(spark, base, sf).collect():
        counts[r["doc_id"]] += 1
    assert counts[3] == 2 and sum(counts.values()) == len(EDGES)
    assert base.where(F.col("doc_id").isNull()).count() == corpus_pipeline.duplicate_stage(spark, base, sf).where(F.col("doc_id").isNull()).count()
