"""The trie of conversations against brute force."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from sluice.llm import trie


def digest(role, text):
    return hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()


def brute(rows):
    turns = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            turns[conv].append((turn is not None, turn or 0, digest(role or "", text or ""), (role or "", text or "")))
    own = {c: [x[-1] for x in sorted(xs, key=lambda x: x[:3])] for c, xs in turns.items()}
    made = {}
    for c, xs in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = c - (abs(c) % 100 if c >= 0 else -(abs(c) % 100))
        made[c] = tuple(own.get(base, [])[:h] + xs[h:])
    members = defaultdict(list)
    for c, xs in made.items():
        for d in range(len(xs) + 1):
            members[xs[:d]].append(c)
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        mine = (len(members[node]) - 1) * (len(node[-1][1]) if node else 0)
        leaves[node] = sum(leaves[x] for x in children[node]) or 1
        saved[node] = mine + sum(saved[x] for x in children[node])
    return sorted(
        (min(m), len(node), min(members[node[:-1]]) if node else None, len(m), len(children[node]), leaves[node], saved[node],
         hashlib.sha256(",".join(map(str, sorted(c for c in m if made[c] == node))).encode()).hexdigest())
        for node, m in members.items()
    )


def result(spark, rows):
    frame = spark.createDataFrame([(*r, 1, "x") for r in rows], "conv_id long, turn long, role string, text string, depth int, k1 string").repartition(4)
    return sorted(map(tuple, trie.prefix_trie(frame).collect()))


def made_rows(rng, families=4, members=12, longest=9, words=3):
    rows = []
    for f in range(families):
        for m in range(members):
            c = rng.choice([0, 1, 5]) * 100 + f * 1000 + (m if rng.random() < 0.7 else rng.randint(0, 99))
            if f == 1 and c % 100 == 0:
                continue  # a family without its base
            for t in range(rng.randint(0, longest)):
                rows.append((c, rng.choice([t, t, None, 3]), rng.choice(["user", "assistant", None]), rng.choice([None, "", "é" * words] + ["w" * k for k in range(words)])))
    return rows


@pytest.mark.parametrize("block, bits", [(1024, 12), (3, 1)])
def test_against_brute_force(spark, monkeypatch, block, bits):
    monkeypatch.setattr(trie, "BLOCK", block)
    monkeypatch.setattr(trie, "PART_BITS", bits)
    for seed in (1, 2):
        rows = made_rows(random.Random(seed))
        rows += [(7000 + k, t, "user", "same") for k in range(40) for t in range(8)]  # copies, many ends of one node
        rows += [(9100, t, "user", str(t)) for t in range(60)] + [(9101, t, "user", str(t)) for t in range(60)]  # long ones
        rows += [(-5, 0, "a", "b"), (-105, 1, "a", "b"), (None, 0, "a", "b"), rows[3], rows[3]]
        got = result(spark, rows)
        assert got == brute(rows)


def test_edges(spark):
    assert result(spark, []) == [] and result(spark, [(None, 1, "a", "b")]) == []
    one = [(1, None, None, None)]
    assert result(spark, one) == brute(one)
    long = [(100, 1, "u", "x" * 300_000), (101, 1, "u", "x" * 300_000), (101, 2, "u", "y"), (101, 2, "u", "y"), (102, 9, None, "z")]
    assert result(spark, long) == brute(long)


def test_ids_of_other_types(spark):
    frame = spark.createDataFrame([("7", 1, "u", "x"), ("seven", 1, "u", "x"), (None, 1, "u", "y")], "conv_id string, turn int, role string, text string")
    assert {r.conv_id for r in trie.prefix_trie(frame).collect()} == {7}
