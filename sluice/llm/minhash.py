"""MinHash near-duplicates with tensored banding, verified on full shingle sets.

Two collections of sub-keys stand for a document, each sub-key of ``WIDE`` minhashes. A
table key is a pair of one sub-key from each collection, so n * n tables of 2 * WIDE
minhashes cost only 2 * n * WIDE hash functions. A pair with similarity s meets in some
table with probability (1 - (1 - s^WIDE)^n)^2; n follows from the percentage asked for
(``sides``) so that this is ``RECALL`` at the limit and higher above: 10 at 0.85, 13 at
0.80.

1. Documents with equal shingle sets are one class, by two 64-bit sums over the set;
   a hash of the id and text of one of them names it as a node, so copies cost nothing
   further, and ids may be of any type.
2. Sub-keys that only one class has are dropped before the pairs are formed, so a
   class without any relative has no table key at all.
3. In each table a bucket links its members to one of them, the centre, never all
   pairs; links are verified on whole texts. Rounds follow on buckets whose members
   still belong to different components, with other centres, while one in
   ``WORTH`` pairs is a link. They settle most of a large group in linear work and
   decide nothing.
4. The end is exact: every two nodes of different components that share a table are
   compared in tiles of ``BLOCK`` x ``BLOCK`` nodes, first by bounds that no link can
   fail, then on whole texts. The pairs within the largest component of a group are
   no longer asked for, so this is quadratic only in what the rounds left apart.
5. Components are found by minimum labels and pointer jumping over a round's links
   between the components so far, whose labels are one table.

Skew: counts are partial aggregates; joins on class, sub-key and bucket are plain
equi-joins of rows that Spark may split where a key is hot.

Defined results: null text, and text without words, has an empty set and is linked
with nothing; a row without an id cannot be named, so it has no component and is
kept; rows that share an id are judged each by its own text; an empty table gives an
empty result; other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.llm.common import cut, slices, sweep
from sluice.operators.scratch import Scratch

SHINGLE, WIDE = 5, 3
#: Probability that two texts at the limit share a table.
RECALL = 0.9998
#: Rounds go on while at least one of so many pairs compared is a link; beyond that tiles cost less.
WORTH = 10
#: Centres of a node in a round, and parts of a bucket; what they leave out is compared at the end.
TRIES = 12
LOOKS = 4
#: Nodes on each side of a tile at the end, and bins into which a node's shingles are counted.
BLOCK = 1024
BINS = 256
#: Rows of table keys to a task and file in the rounds.
PART = 20_000
_MIX = np.uint64(0x9E3779B97F4A7C15)
_rng = np.random.default_rng(20240917)
_BYTES = _rng.integers(0, 1 << 64, 256, np.uint64)
#: Odd numbers that multiply the hashes of a window's words, a byte by its place, and a shingle for each hash function.
_PLACES = _rng.integers(0, 1 << 63, SHINGLE, np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = np.uint64(int(_rng.integers(0, 1 << 63)) * 2 + 1)
_SPACES = np.zeros(256, bool)
_SPACES[[32, 9, 10, 11, 12, 13]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads each bit over all."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(n: int) -> np.ndarray:
    out = np.full(n, _BASE, np.uint64)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


def word_hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place of each word's first byte, its hash) in UTF-8 bytes; A-Z as a-z."""
    space = _SPACES[data]
    edge = np.diff(np.concatenate([[True], space, [True]]).astype(np.int8))
    starts, ends = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    if not len(starts):
        return starts, np.zeros(0, np.uint64)
    # a byte's factor goes by its place in the word
    place = np.zeros(len(data), np.int64)
    word = ~space
    place[word] = np.flatnonzero(word) - np.repeat(starts, ends - starts)
    powers = _powers(int((ends - starts).max()))
    terms = np.where(word, _BYTES[_LOWER[data]] * powers[place], np.uint64(0))
    sums = np.add.reduceat(terms, starts)  # spaces add nothing
    return starts, mix(sums + (ends - starts).astype(np.uint64) * _MIX)


def shingles(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, offsets): the distinct shingles of each text, ascending within it. Texts lie in data, each from its offset on.

    A text ends a word: a blank must stand between the texts.
    """
    starts, words = word_hashes(data)
    first = np.searchsorted(starts, offsets)  # words before each text
    counts = np.diff(first)
    n = np.where(counts >= SHINGLE, counts - SHINGLE + 1, np.minimum(counts, 1))
    doc = np.repeat(np.arange(len(counts)), n)
    begin = np.cumsum(n) - n
    at = np.arange(int(n.sum())) - begin[doc] + first[:-1][doc]
    got = np.zeros(len(at), np.uint64)
    for k in range(SHINGLE):
        here = k < counts[doc]
        got += np.where(here, words[np.minimum(at + k, max(len(words) - 1, 0))] * _PLACES[k], np.uint64(0)) if len(words) else np.uint64(0)
    got = mix(got + np.minimum(counts, SHINGLE)[doc].astype(np.uint64))
    order = np.lexsort((got, doc))
    got, doc = got[order], doc[order]
    new = np.ones(len(got), bool)
    new[1:] = (got[1:] != got[:-1]) | (doc[1:] != doc[:-1])
    got, doc = got[new], doc[new]
    return got, np.searchsorted(doc, np.arange(len(counts) + 1))


def texts_in_one(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All texts of a string column as bytes with a blank after each, and where each begins (and the end)."""
    parts = column.cast(pa.binary()).to_pylist()
    data = b" ".join([*(p or b"" for p in parts), b""])
    lengths = np.array([len(p or b"") + 1 for p in parts], np.int64)
    return np.frombuffer(data, np.uint8), np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)


def sides(percent: int) -> int:
    """Sub-keys of each collection for links of percent or more."""
    alone = 1 - (percent / 100) ** WIDE
    return max(1, math.ceil(math.log(1 - math.sqrt(RECALL)) / math.log(alone)) if alone > 0 else 1)


def side_names(n: int) -> list[str]:
    return [f"u{i}" for i in range(n)] + [f"v{i}" for i in range(n)]


def sub_keys(hashes: np.ndarray, begin: np.ndarray, n: int) -> np.ndarray:
    """The sub-keys of sets of shingles, a row for each of side_names(n); a set lies in hashes from its begin on and is not empty."""
    rng = np.random.default_rng(20240918)
    odd, offsets = rng.integers(0, 1 << 63, (2, 2 * n * WIDE), np.uint64)
    factors = odd * np.uint64(2) + np.uint64(1)
    keys = np.zeros((2 * n, len(begin)), np.uint64)
    for k in range(2 * n):
        key = np.full(len(begin), np.uint64((k + 1) * int(_MIX) % (1 << 64)))
        for j in range(k * WIDE, (k + 1) * WIDE):
            key = mix(key + np.minimum.reduceat((hashes ^ offsets[j]) * factors[j], begin))
        keys[k] = key
    return keys


def sketch(docs: DataFrame, n: int, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc, own, n_shingles, s1, s2, u0.., v0..): a hash of the row, set size, two sums that stand for the set, and n sub-keys a side."""
    names = ["doc", "own", "n_shingles", "s1", "s2", *side_names(n)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 2):
            hashes, at = shingles(*texts_in_one(batch.column(2)))
            size = np.diff(at)
            full = size > 0
            sums, keys = np.zeros((2, len(size)), np.uint64), np.zeros((2 * n, len(size)), np.uint64)
            if full.any():
                begin = at[:-1][full]
                for k, salt in enumerate((np.uint64(0x5851F42D4C957F2D), np.uint64(0x14057B7EF767814F))):
                    sums[k, full] = np.add.reduceat(mix(hashes ^ salt), begin)
                keys[:, full] = sub_keys(hashes, begin, n)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(size), *[pa.array(x.view(np.int64)) for x in (*sums, *keys)]], names=names
            )

    schema = T.StructType([T.StructField("doc", docs.schema[doc_id].dataType), *[T.StructField(x, T.LongType()) for x in names[1:]]])
    return docs.select(F.col(doc_id).alias("doc"), F.xxhash64(doc_id, text).alias("own"), F.col(text).alias("t")).mapInArrow(run, schema)


def table_keys(classes: DataFrame, n: int) -> DataFrame:
    """(bucket, node) for the table keys of classes: pairs of a u and a v sub-key, each shared by classes."""
    names = side_names(n)
    subs = classes.select("node", F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.col(s).alias("sub")) for i, s in enumerate(names)])).alias("x")).select("node", "x.i", "x.sub")
    shared = subs.groupBy("i", "sub").count().where("count > 1").select("i", "sub")
    both = subs.join(shared, ["i", "sub"]).groupBy("node").agg(
        *[F.max(F.when(F.col("i") == i, F.col("sub"))).alias(s) for i, s in enumerate(names)]
    )
    u, v = (F.filter(F.array(*side), lambda x: x.isNotNull()) for side in (names[:n], names[n:]))
    pairs = both.select("node", F.explode(u).alias("u"), v.alias("vs")).select("node", "u", F.explode("vs").alias("v"))
    return pairs.select(F.xxhash64("u", "v").alias("bucket"), "node")


def verified(pairs: DataFrame, texts: DataFrame, percent: int, parts: int) -> DataFrame:
    """Of pairs (a, b), those with 100 * intersection >= percent * union. texts: (node, t), one row a node."""
    full = pairs.join(texts.select(F.col("node").alias("b"), F.col("t").alias("tb")), "b").coalesce(parts).join(texts.select(F.col("node").alias("a"), F.col("t").alias("ta")), "a")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in (batch.slice(i, 64) for i in range(0, batch.num_rows, 64)):
                x, at_x = shingles(*texts_in_one(part.column(2)))
                y, at_y = shingles(*texts_in_one(part.column(3)))
                good = []
                for k in range(part.num_rows):
                    one, two = x[at_x[k] : at_x[k + 1]], y[at_y[k] : at_y[k + 1]]
                    same = len(one) + len(two) - len(np.union1d(one, two))
                    good.append(100 * same >= percent * (len(one) + len(two) - same))
                keep = pa.array(good, pa.bool_())
                yield pa.RecordBatch.from_arrays([part.column(0).filter(keep), part.column(1).filter(keep)], names=["a", "b"])

    return full.select("a", "b", "ta", "tb").coalesce(parts).mapInArrow(run, "a long, b long")


def components(links: DataFrame, parts: int = 1 << 20) -> DataFrame:
    """(node, component) of the nodes that links (a, b) name; the component is its least node.

    parts: files of each step's table at most; links are few, and a file is not free.

    Every round takes each node's least neighbour as its parent, jumps to the root of
    the parents, and draws the links together; rounds are about the logarithm of the
    longest path.
    """
    tables = Scratch(links.sparkSession)
    few = lambda df: tables.put(df.coalesce(parts))
    edges = few(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    names = few(edges.select(F.explode(F.array("a", "b")).alias("node")).distinct().withColumn("component", F.col("node")))
    while not edges.isEmpty():
        parents = few(edges.groupBy("a").agg(F.min("b").alias("p")))
        while True:  # parents are less than their nodes, so this ends
            far = few(parents.join(parents.select(F.col("a").alias("p"), F.col("p").alias("q")), "p", "left"))
            tables.drop(parents)
            done = far.where("q is not null").isEmpty()
            parents = few(far.select("a", F.coalesce("q", "p").alias("p"))) if not done else far.select("a", "p")
            if done:
                break
            tables.drop(far)
        before, old = names, edges
        names = few(names.join(parents.select(F.col("a").alias("component"), "p"), "component", "left").select("node", F.coalesce("p", "component").alias("component")))
        to = lambda c: parents.select(F.col("a").alias(c), F.col("p").alias(f"{c}_to"))  # noqa: B023, E731
        edges = edges.join(to("a"), "a", "left").coalesce(parts).join(to("b"), "b", "left").select(F.coalesce("a_to", "a").alias("a"), F.coalesce("b_to", "b").alias("b"))
        edges = few(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
        tables.drop(before, old, far)
    tables.drop(edges)
    return names


def merged(labels: DataFrame | None, found: DataFrame, parts: int) -> DataFrame:
    """labels (node, component) after the links found (a, b): only links between components so far are looked at."""
    if labels is None:
        return components(found, parts)
    to = lambda c: labels.select(F.col("node").alias(c), F.col("component").alias(f"{c}_to"))
    between = found.join(to("a"), "a", "left").join(to("b"), "b", "left").select(F.coalesce("a_to", "a").alias("a"), F.coalesce("b_to", "b").alias("b"))
    new = components(between, parts)
    # a component's name is a node; one that was alone so far has no label yet
    alone = new.select("node", F.col("node").alias("component")).join(labels.select("node"), "node", "left_anti")
    now = new.select(F.col("node").alias("component"), F.col("component").alias("now"))
    both = labels.unionByName(alone).join(now, "component", "left").select("node", F.coalesce("now", "component").alias("component"))
    return Scratch(found.sparkSession).put(both.coalesce(parts))


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", percent: int = 80) -> DataFrame:
    """Per row: the id, n_shingles, component_id (the least id reachable by links of percent or more) and kept."""
    n = sides(percent)
    sketches = cut(sketch(docs, n, doc_id, text))
    named = sketches.where("doc is not null and n_shingles > 0")
    classes = named.groupBy("s1", "s2").agg(F.min("doc").alias("least"), F.min("own").alias("node"), F.count("*").alias("rows"), *[F.first(s).alias(s) for s in side_names(n)])
    tables = table_keys(classes, n)
    # buckets of one class are of no use; the rest is small and is read in every round
    counts = tables.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1").select("bucket")
    tables = cut(tables.join(counts, "bucket"))
    nodes = tables.select("node").distinct()
    texts = docs.where(F.col(doc_id).isNotNull()).select(F.xxhash64(doc_id, text).alias("node"), F.col(text).alias("t")).join(nodes, "node", "left_semi")
    texts = cut(texts.dropDuplicates(["node"]))  # rows of one node have one id and one text
    # what follows has at most the rows of tables, in files of about PART rows
    parts = max(1, -(-tables.count() // PART))
    tables, texts = tables.coalesce(parts), texts.coalesce(parts)
    labels, tried, round_, scratch = None, None, 0, Scratch(docs.sparkSession)
    while True:
        pairs = scratch.put(_candidates(tables, labels, tried, round_, parts))
        found = scratch.put(verified(pairs, texts, percent, parts))
        new, asked = found.count(), pairs.count()
        tried = pairs if tried is None else tried.unionByName(pairs)
        if new:
            labels = merged(labels, found, parts)
        scratch.drop(found)
        round_ += 1
        sweep(docs.sparkSession)
        if new == 0 or WORTH * new < asked:
            break
    found = scratch.put(verified(_rest(tables, labels, tried, texts, percent, n, parts), texts, percent, parts))
    if not found.isEmpty():
        labels = merged(labels, found, parts)
    scratch.drop(found, *[f for f, _ in scratch.held])
    rep = classes.where("rows > 1").select("s1", "s2", "least", "node")
    out = sketches.select("doc", "own", "n_shingles", "s1", "s2").join(rep, ["s1", "s2"], "left")
    full = F.col("doc").isNotNull() & (F.col("n_shingles") > 0)
    out = out.select("doc", "n_shingles", F.when(full, F.coalesce("least", "doc")).otherwise(F.col("doc")).alias("least"), F.when(full, F.coalesce("node", "own")).alias("node"))
    if labels is not None:
        linked = labels.join(classes.select("node", "least"), "node")
        first = linked.groupBy("component").agg(F.min("least").alias("first"))
        moved = linked.join(first, "component").where("least <> first").select("node", "first")
        out = out.join(moved, "node", "left").withColumn("least", F.coalesce("first", "least"))
    return out.select(
        F.col("doc").alias(doc_id), "n_shingles", F.col("least").alias("component_id"),
        (F.col("doc").isNull() | (F.col("doc") == F.col("least"))).alias("kept"),
    )


def _candidates(tables: DataFrame, labels: DataFrame | None, tried: DataFrame | None, round_: int, parts: int) -> DataFrame:
    """(a, b), a > b: members of a bucket with its centre, where they are not of one component yet and were not tried.

    The first centre is the least node, the same in most of a group's buckets, so that
    its links coincide. A later round deals each bucket into ``LOOKS`` parts, others at
    each round, and draws a centre in each part, first a component and then a node of
    it, so that a document still alone is often compared with all of its part. Of its
    centres a node tries ``TRIES``, those it meets most often first, since these are the
    most similar; the next round has other parts and centres.
    """
    rows = tables
    if labels is None:
        rows = rows.withColumn("component", F.col("node"))
        centre = F.min("node")
    else:
        part = F.pmod(F.xxhash64("bucket", "node", F.lit(round_)), F.lit(LOOKS))
        rows = rows.withColumn("bucket", F.xxhash64("bucket", part)).join(labels, "node", "left").coalesce(parts)
        rows = rows.withColumn("component", F.coalesce("component", "node"))
        centre = F.min(F.struct(
            F.xxhash64("component", "bucket", F.lit(round_)).alias("h"), F.xxhash64("node", "bucket", F.lit(round_)).alias("g"), "node", "component"
        ))
    at = rows.groupBy("bucket").agg(centre.alias("c"), F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo < hi")
    if labels is None:
        at = at.select("bucket", F.col("c").alias("b"), F.col("c").alias("b_component"))
    else:
        at = at.select("bucket", F.col("c.node").alias("b"), F.col("c.component").alias("b_component"))
    met = rows.join(at, "bucket").coalesce(parts).where("component <> b_component").groupBy(F.col("node").alias("a"), "b").agg(F.count("*").alias("n")).coalesce(parts)
    if labels is None:
        return met.select("a", "b")
    tries = F.slice(F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("n"), F.xxhash64("b", F.lit(round_)).alias("h"), "b"))), 1, TRIES)
    pairs = met.groupBy("a").agg(tries.alias("x")).select("a", F.explode("x.b").alias("b"))
    pairs = pairs.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct().coalesce(parts)
    return pairs.join(tried, ["a", "b"], "left_anti").coalesce(parts)


def _marks(texts: DataFrame, n_sides: int) -> DataFrame:
    """(node, component, n, u, subs, bins) of texts (node, component, t): set size, u sub-keys, all sub-keys, and counts of shingles by bin."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 2):
            hashes, at = shingles(*texts_in_one(batch.column(2)))
            n = np.diff(at)
            subs = sub_keys(hashes, at[:-1], n_sides).T.copy()  # nodes have no empty sets
            spot = np.repeat(np.arange(len(n)), n) * BINS + (hashes >> np.uint64(56)).astype(np.int64)
            bins = np.minimum(np.bincount(spot, minlength=len(n) * BINS), 65_535).astype("<u2").reshape(-1, BINS)
            u = pa.array(list(subs.view(np.int64)[:, :n_sides]), pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(n), u, pa.array([x.tobytes() for x in subs], pa.binary()), pa.array([x.tobytes() for x in bins], pa.binary())],
                names=["node", "component", "n", "u", "subs", "bins"],
            )

    return texts.select("node", "component", "t").mapInArrow(run, "node long, component long, n long, u array<long>, subs binary, bins binary")


def _rest(tables: DataFrame, labels: DataFrame | None, tried: DataFrame, texts: DataFrame, percent: int, n_sides: int, parts: int) -> DataFrame:
    """(a, b), a > b: every two nodes that share a table and are of different components, but for tried ones and ones that bounds exclude.

    Nodes meet by their u sub-keys. Of the nodes of a u sub-key those that are not of its
    largest component stand on the left of a tile, and all stand on the right, each side
    dealt into blocks. A pair counts where its first equal u sub-key is, if a v sub-key
    is equal too. The bounds are the sizes of both sets, and the sum over the bins of
    the lesser count, which no intersection exceeds.
    """
    rows = tables.withColumn("component", F.col("node")) if labels is None else tables.join(labels, "node", "left").withColumn("component", F.coalesce("component", "node"))
    spans = rows.groupBy("bucket").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo < hi").select("bucket")
    apart = rows.join(spans, "bucket").select("node", "component").distinct()
    marks = cut(_marks(texts.join(apart.coalesce(parts), "node").coalesce(parts), n_sides))
    keyed = marks.select("*", F.posexplode("u").alias("i", "key")).drop("u")
    counts = keyed.groupBy("key", "component").count().groupBy("key").agg(F.max(F.struct("count", "component")).alias("m"), F.sum("count").alias("all"))
    blocks = lambda n: F.ceil(n / BLOCK)
    groups = counts.where(F.col("all") > F.col("m.count")).select("key", F.col("m.component").alias("most"), blocks(F.col("all") - F.col("m.count")).alias("x"), blocks(F.col("all")).alias("y"))
    both = keyed.join(groups, "key")
    less, place = F.col("component") != F.col("most"), lambda k, n: F.pmod(F.xxhash64("node", F.lit(k)), F.col(n))
    tile = lambda x, y, left: F.struct(F.xxhash64("key", x, y).alias("tile"), F.lit(left).alias("left"))
    right = F.transform(F.sequence(F.lit(0).cast("long"), F.col("x") - 1), lambda k: tile(k, place(1, "y"), False))
    left = F.transform(F.sequence(F.lit(0).cast("long"), F.col("y") - 1), lambda k: tile(place(0, "x"), k, True))
    dealt = both.select("node", "component", "n", "subs", "bins", "i", less.alias("less"), F.explode(F.when(less, F.concat(right, left)).otherwise(right)).alias("to"))
    dealt = dealt.select("to.tile", "to.left", "less", "i", "node", "component", "n", "subs", "bins").repartition("tile").sortWithinPartitions("tile")

    def compare(rows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        _, is_left, is_less, at, node, component, n, subs, bins = rows
        one, two = np.flatnonzero(is_left), np.flatnonzero(~is_left)
        out = [np.zeros((2, 0), np.int64)]
        step = max(1, (1 << 16) // max(1, len(two)))
        for k in range(0, len(one), step):
            a, b = np.repeat(one[k : k + step], len(two)), np.tile(two, len(one[k : k + step]))
            low, high = np.minimum(n[a], n[b]), np.maximum(n[a], n[b])
            # two of the left meet twice, once with the greater on the left
            good = (component[a] != component[b]) & (~is_less[b] | (node[a] > node[b])) & (100 * low >= percent * high)
            a, b = a[good], b[good]
            same = subs[a] == subs[b]
            good = (np.argmax(same[:, :n_sides], 1) == at[a]) & same[:, :n_sides].any(1) & same[:, n_sides:].any(1)
            a, b = a[good], b[good]
            for i in range(0, len(a), 4096):
                x, y = a[i : i + 4096], b[i : i + 4096]
                most = np.minimum(bins[x], bins[y]).sum(1, dtype=np.int64)
                # a count may have reached its end where a set is that large
                good = (100 * most >= percent * (n[x] + n[y] - most)) | (np.minimum(n[x], n[y]) >= 65_535)
                x, y = node[x[good]], node[y[good]]
                out.append(np.stack([np.maximum(x, y), np.minimum(x, y)]))
        a, b = np.concatenate(out, 1)
        return a, b

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A tile's rows may stand in several batches."""
        held = None

        def pairs(rows):
            edge = np.flatnonzero(np.concatenate([[True], rows[0][1:] != rows[0][:-1], [True]]))
            got = [compare([x[s:e] for x in rows]) for s, e in zip(edge[:-1], edge[1:])]
            return pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*got)], names=["a", "b"])

        for batch in batches:
            if not batch.num_rows:
                continue
            c = batch.columns
            new = [x.to_numpy(zero_copy_only=False) for x in c[:7]]
            new += [np.frombuffer(b"".join(c[7].to_pylist()), np.int64).reshape(-1, 2 * n_sides), np.frombuffer(b"".join(c[8].to_pylist()), "<u2").reshape(-1, BINS)]
            held = new if held is None else [np.concatenate(x) for x in zip(held, new)]
            last = int(np.argmax(held[0] == held[0][-1]))
            if last:
                yield pairs([x[:last] for x in held])
                held = [x[last:] for x in held]
        if held is not None:
            yield pairs(held)

    return dealt.mapInArrow(run, "a long, b long").join(tried, ["a", "b"], "left_anti")
