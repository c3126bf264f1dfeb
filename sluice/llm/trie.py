"""A trie of the prefixes of rebuilt conversations, merged family by family.

A family is the conversations of one base id, ``c - c % 100``: they begin with turns of
the base conversation, so most of what conversations share is shared within a family.
Conversations come together by base id, are rebuilt there, and each family's nodes are
found; the global trie then merges the families' nodes, never their turns.

A turn is known by 16 bytes of a SHA-256 of role and text, and a prefix by its depth and
two 64-bit sums (exclusive or) of hashes of its turns and their depths. Such sums add up
from block to block, so a conversation of any length is cut into blocks of ``BLOCK``
turns, and a family's turns at the depths of one block are one group of at most 100
conversations by ``BLOCK`` turns. Texts themselves are not moved.

A node's owner is its smallest member. Below the deepest node that a conversation does
not own it owns all nodes of its path, so what a subtree sums up is a sum over members,
of what each has above that depth: two joins and aggregates, no rounds over levels.

The hash of a node's ends needs its ids in order. They are joined in parts of at most
4,096; of the few nodes with several parts, one task streams the parts of a node.

Defined results: a null role or text is empty; turns that tie are in the order of their
digests, so repeated rows are repeated turns; rows without a conversation id, or with
one that is no whole number, are of no conversation; a remainder has the sign of its id,
as in SQL; very long texts count and are hashed whole; an empty table has no root; other
columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.operators.scratch import Scratch

#: Conversations of a family, by their ids; the most turns taken from its base; turns of a block; bits of an id within a part of a node's ends.
FAMILY, HEAD, BLOCK, PART_BITS = 100, 5, 1024, 12
#: The chunk of turns without a place, before all others.
FIRST = -(1 << 62)
KEY = ["depth", "k1", "k2"]


def turns(rows: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv, pos, digest, chars): the turns of each conversation by place, from 1.

    Places are counted in chunks of turn numbers and added up over the chunks.
    """
    said = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    whole = F.concat(F.length(said(role)).cast("string"), F.lit(":"), said(role), said(text))
    t = rows.select(
        F.expr(f"try_cast(`{conv_id}` AS bigint)").alias("conv"), F.col(turn).alias("turn"), F.substring(F.unhex(F.sha2(whole, 256)), 1, 16).alias("digest"),
        F.length(said(text)).cast("long").alias("chars"), F.coalesce(F.floor(F.col(turn) / BLOCK).cast("long"), F.lit(FIRST)).alias("chunk"),
    ).where("conv is not null")
    t = t.withColumn("local", F.row_number().over(Window.partitionBy("conv", "chunk").orderBy(F.col("turn").asc_nulls_first(), "digest")).cast("long"))
    before = Window.partitionBy("conv").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = t.groupBy("conv", "chunk").agg(F.max("local").alias("n")).select("conv", "chunk", F.sum("n").over(before).alias("offset")).where("offset > 0")
    return t.join(offsets, ["conv", "chunk"], "left").select("conv", (F.col("local") + F.coalesce("offset", F.lit(0))).alias("pos"), "digest", "chars")


def rebuilt(placed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conversations, turns): (base, conv, length), and (base, conv, length, depth, digest, chars) of the rebuilt conversations.

    A conversation has the first h turns of its base and its own behind its first h;
    h is the checksum of its id modulo 6. Bases and conversations meet by base id.
    """
    heads = placed.where((F.col("pos") <= HEAD) & (F.col("conv") % FAMILY == 0)).groupBy(F.col("conv").alias("base")).agg(F.sort_array(F.collect_list(F.struct("pos", "digest", "chars"))).alias("head"))
    convs = placed.groupBy("conv").agg(F.max("pos").alias("n")).withColumn("base", F.col("conv") - F.col("conv") % FAMILY)
    convs = convs.withColumn("h", F.crc32(F.col("conv").cast("string").cast("binary")) % (HEAD + 1)).join(heads, "base", "left")
    taken = F.least(F.col("h"), F.coalesce(F.size("head"), F.lit(0))).cast("long")
    convs = convs.withColumn("taken", taken).withColumn("length", F.col("taken") + F.greatest(F.col("n") - F.col("h"), F.lit(0)))
    own = placed.join(convs.select("base", "conv", "h", "taken", "length"), "conv").where("pos > h")
    own = own.select("base", "conv", "length", (F.col("pos") - F.col("h") + F.col("taken")).alias("depth"), "digest", "chars")
    lent = convs.where("taken > 0").select("base", "conv", "length", F.explode(F.slice("head", F.lit(1), F.col("taken").cast("int"))).alias("t"))
    return convs.select("base", "conv", "length"), own.unionByName(lent.select("base", "conv", "length", F.col("t.pos").alias("depth"), "t.digest", "t.chars"))


def families(rows: DataFrame, scratch: Scratch) -> DataFrame:
    """(conv, length, depth, k1, k2, p1, p2, chars, upto, first, many) of rebuilt turns: keys of the prefix and of its parent, the code points
    up to there, and, within the family, the node's smallest member and whether it has others."""
    rows = scratch.put(rows.select("*", F.floor((F.col("depth") - 1) / BLOCK).alias("block"), F.xxhash64("depth", "digest").alias("x1"), F.xxhash64("digest", "depth", F.lit(1)).alias("x2")).drop("digest"))
    spans = rows.where(F.col("length") > BLOCK).groupBy("base", "block", "conv").agg(F.bit_xor("x1").alias("o1"), F.bit_xor("x2").alias("o2"), F.sum("chars").alias("oc"))
    before = Window.partitionBy("base", "conv").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = spans.select("base", "block", "conv", F.bit_xor("o1").over(before).alias("o1"), F.bit_xor("o2").over(before).alias("o2"), F.sum("oc").over(before).alias("oc")).where("block > 0")
    path = Window.partitionBy("base", "block", "conv").orderBy("depth").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # a family's turns of a block meet in one task, and all that follows here stays there
    there = rows.repartition("base", "block").select("*", F.bit_xor("x1").over(path).alias("k1"), F.bit_xor("x2").over(path).alias("k2"), F.sum("chars").over(path).alias("upto"))
    there = there.join(offsets, ["base", "block", "conv"], "left")
    added = lambda c, o: F.col(c).bitwiseXOR(F.coalesce(o, F.lit(0)))
    there = there.select("base", "block", "conv", "length", "depth", "chars", "x1", "x2", added("k1", "o1").alias("k1"), added("k2", "o2").alias("k2"), (F.col("upto") + F.coalesce("oc", F.lit(0))).alias("upto"))
    node = Window.partitionBy("base", "block", *KEY)
    return scratch.put(there.select(
        "conv", "length", *KEY, F.col("k1").bitwiseXOR(F.col("x1")).alias("p1"), F.col("k2").bitwiseXOR(F.col("x2")).alias("p2"), "chars", "upto",
        F.min("conv").over(node).alias("first"), (F.count("*").over(node) > 1).alias("many"),
    ))


def ends_hashes(ends: DataFrame) -> DataFrame:
    """(key, ends_sha256) of rows (key, conv): the hash of a node's ids in decimal, ascending, with commas between."""
    ids = F.array_join(F.transform(F.sort_array(F.collect_list("conv")), lambda c: c.cast("string")), ",")
    parts = ends.groupBy(*KEY, F.shiftright("conv", PART_BITS).alias("part")).agg(ids.alias("ids"))
    one = parts.groupBy(*KEY).agg(F.count("*").alias("parts"), F.min("ids").alias("ids"))
    several = parts.join(one.where("parts > 1").select(*KEY), KEY, "left_semi").repartition(*KEY).sortWithinPartitions(*KEY, "part")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, held, state = [*KEY, "ends_sha256"], None, None
        made = lambda: pa.RecordBatch.from_pylist([dict(zip(names, (*held, state.hexdigest())))], kind)
        kind = pa.schema([*[(c, pa.int64()) for c in KEY], ("ends_sha256", pa.string())])
        for batch in batches:
            for *key, text in zip(*[batch.column(i).to_pylist() for i in (0, 1, 2, 4)]):
                if key != held:
                    if held is not None:
                        yield made()
                    held, state = key, hashlib.sha256()
                else:
                    state.update(b",")
                state.update(text.encode())
        if held is not None:
            yield made()

    schema = T.StructType([*[T.StructField(c, T.LongType()) for c in KEY], T.StructField("ends_sha256", T.StringType())])
    return one.where("parts = 1").select(*KEY, F.sha2("ids", 256).alias("ends_sha256")).unionByName(several.select(*KEY, "part", "ids").mapInArrow(run, schema))


def prefix_trie(rows: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256) of each node of the trie."""
    scratch = Scratch(rows.sparkSession)
    convs, told = rebuilt(scratch.put(turns(rows, conv_id, turn, role, text)))
    convs = scratch.put(convs)
    paths = families(told, scratch)
    last = F.col("depth") == F.col("length")

    # a task holds whole families, so what it sends of a node is one row a family at most
    nodes = scratch.put(paths.groupBy(*KEY).agg(
        F.min("conv").alias("owner"), F.count("*").alias("n_convs"), F.sum(last.cast("long")).alias("n_ends"), F.max("chars").alias("chars"), F.max("upto").alias("upto"),
        F.max("p1").alias("p1"), F.max("p2").alias("p2"),
    ))

    # of each conversation: the deepest node it does not own, the code points up to there, the deepest node it shares, and whether it owns a leaf
    deep = lambda held: F.max(F.when(held, F.struct("depth", "upto")))
    inside = paths.groupBy("conv").agg(deep(F.col("conv") != F.col("first")).alias("s"), F.max(F.when(F.col("many"), F.col("depth"))).alias("shared"))
    firsts = paths.where("conv = first").select("conv", "length", *KEY, "upto").join(nodes.select(*KEY, "owner", "n_convs", "n_ends"), KEY)
    foreign, leaf = F.col("owner") != F.col("conv"), F.max(((F.col("owner") == F.col("conv")) & last & (F.col("n_convs") == F.col("n_ends"))).cast("long"))
    across = firsts.groupBy("conv").agg(deep(foreign).alias("s2"), F.max(F.when(F.col("n_convs") > 1, F.col("depth"))).alias("shared2"), leaf.alias("leaf"))
    known = convs.join(inside, "conv", "left").join(across, "conv", "left").select(
        "conv", "length", F.greatest("s", "s2").alias("s"), F.coalesce(F.greatest("shared", "shared2"), F.lit(0)).alias("shared"), F.coalesce("leaf", F.lit(0)).alias("leaf"))
    known = scratch.put(known.select("conv", "length", F.coalesce("s.depth", F.lit(0)).alias("s"), F.coalesce("s.upto", F.lit(0)).alias("s_upto"), "shared", "leaf"))

    # a node of one conversation has one leaf and saves nothing; the others sum over their members
    members = paths.join(known.where("shared > 0").select("conv", "s", "s_upto", "shared", "leaf"), "conv").where("depth <= shared")
    saves: Column = F.col("s") >= F.col("depth")
    sums = members.groupBy(*KEY).agg(
        F.sum("leaf").alias("n_leaves"), F.sum(F.when(saves, F.col("s_upto") - F.col("upto") + F.col("chars")).otherwise(0)).alias("saved_tokens"))

    parent = [(F.col("depth") - 1).alias("depth"), F.col("p1").alias("k1"), F.col("p2").alias("k2")]
    children = nodes.where("depth > 1").select(*parent).groupBy(*KEY).agg(F.count("*").alias("n_children"))
    owners = nodes.select((F.col("depth") + 1).alias("depth"), F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("owner").alias("above"))
    ends = paths.where(last).select(*KEY, "conv").unionByName(convs.where("length = 0").select(F.lit(0).cast("long").alias("depth"), F.lit(0).cast("long").alias("k1"), F.lit(0).cast("long").alias("k2"), "conv"))
    hashes = scratch.put(ends_hashes(ends))
    none = hashlib.sha256(b"").hexdigest()

    top = known.agg(F.min("conv").alias("owner"), F.count("*").alias("n_convs"), F.sum("leaf").alias("leaves"), F.sum("s_upto").alias("saved_tokens")).where("n_convs > 0")
    firsts_of_root = nodes.where("depth = 1").agg(F.count("*").alias("n_children"))
    root_hash = hashes.where("depth = 0").agg(F.max("ends_sha256").alias("ends_sha256"))
    root = top.join(firsts_of_root).join(root_hash).select(  # three single rows
        F.col("owner").alias("conv_id"), F.lit(0).cast("long").alias("depth"), F.lit(None).cast("long").alias("parent_conv_id"), "n_convs", "n_children",
        F.greatest("leaves", F.lit(1)).alias("n_leaves"), "saved_tokens", F.coalesce("ends_sha256", F.lit(none)).alias("ends_sha256"))

    out = nodes.join(sums, KEY, "left").join(children, KEY, "left").join(hashes, KEY, "left").join(owners, ["depth", "p1", "p2"], "left")
    out = out.join(F.broadcast(top.select(F.col("owner").alias("least"))))  # one row
    return out.select(
        F.col("owner").alias("conv_id"), "depth", F.when(F.col("depth") == 1, F.col("least")).otherwise(F.col("above")).alias("parent_conv_id"), "n_convs",
        F.coalesce("n_children", F.lit(0)).alias("n_children"), F.coalesce("n_leaves", F.lit(1)).alias("n_leaves"), F.coalesce("saved_tokens", F.lit(0)).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(none)).alias("ends_sha256"),
    ).unionByName(root)
