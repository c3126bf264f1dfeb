"""Spelling variants against brute force."""

import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from sluice.llm import variants
from sluice.operators.scratch import Scratch


def near(a: str, b: str) -> bool:
    """Exactly one code point inserted, deleted or replaced."""
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def lower(s: str) -> str:
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in s)


def brute(rows):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = lower(run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}
    close = {w: [x for x in words if near(w, x)] for w in words}
    form = {}
    for w, xs in close.items():
        best = min(xs, key=lambda x: (-words[x], x), default=None)
        form[w] = best if best is not None and words[best] >= 5 * words[w] else None
    out = []
    for w, n in words.items():
        end = w
        while form[end]:
            end = form[end]
        out.append((w, form[w], end, n, len(close[w]), words[form[w]] if form[w] else None))
    return sorted(out)


def result(spark, rows, **more):
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"word": F.lit(1), "n": F.lit("x"), "key": F.lit(None)})
    return sorted(map(tuple, variants.spelling_variants(docs, **more).collect()))


def made_words(rng, count, alphabet="abcdeé÷ÿ"):
    """Words with many neighbours: edits of a few stems, long common segments among them."""
    out = set()
    for _ in range(count):
        w = list(rng.choice(["stemword", "preamble" + "x" * rng.randint(0, 2), "überlänge", "aaaaaa", "abcabcabcabc"]))
        for _ in range(rng.randint(0, 3)):
            k = rng.randrange(len(w))
            w[k : k + rng.randint(0, 1)] = rng.choice([[], [rng.choice(alphabet)], [rng.choice(alphabet)]])
        out.add("".join(w))
    return sorted(out)


def test_against_brute_force(spark):
    rng = random.Random(1)
    words = made_words(rng, 900)
    rows = []
    for i in range(120):
        text = []
        for _ in range(150):
            w = words[min(int(rng.expovariate(0.02)), len(words) - 1)]
            text.append(w.upper() if rng.random() < 0.05 and w.isascii() else w)
        rows.append((i if i else None, rng.choice([" ", ", ", "-", "1"]).join(text)))
    rows += [(500, None), (501, ""), (502, " \t"), (503, "short"), rows[5], rows[5]]
    want = brute(rows)
    assert any(r[1] for r in want) and max(r[4] for r in want) > 10
    assert result(spark, rows) == want


@pytest.mark.parametrize("crowd", [1, 3, 1_000_000])
def test_crowded_segments_lose_no_pair(spark, crowd):
    rng = random.Random(2)
    words = {w for w in made_words(rng, 400) if len(w) >= 2} | {"common" + "".join(rng.choice("ab") for _ in range(6)) for _ in range(60)} | {"ab", "abc", "b", "bc", "a", "ac"}
    frame = spark.createDataFrame([(w, 1) for w in sorted(words)], "word string, n long")
    got = sorted((r.a, r.b) for r in variants.near_pairs(frame, Scratch(spark), crowd).collect())
    want = sorted((a, b) if len(a) == len(b) else (min(a, b, key=len), max(a, b, key=len)) for a in words for b in words if a < b and near(a, b))
    assert got == want


def test_ties_and_chains(spark):
    counts = {"aaaaaab": 5, "aaaaaac": 25, "aaaaaad": 25, "aaaaaadd": 125, "zzzzzz": 5, "zzzzzzé": 24}
    rows = [(10**6 + k, w) for k, (w, n) in enumerate(counts.items()) for _ in range(n)]
    got = {r[0]: r[1:] for r in result(spark, rows)}
    assert brute(rows) == result(spark, rows)
    assert got["aaaaaab"] == ("aaaaaac", "aaaaaac", 5, 2, 25)
    assert got["aaaaaad"] == ("aaaaaadd", "aaaaaadd", 25, 3, 125)
    assert got["zzzzzz"] == (None, "zzzzzz", 5, 1, None)


def test_long_texts_and_empty_tables(spark):
    rows = [(1, "word " * 100_000 + "lengthy " * 50_000 + "x" * 200_000), (2, None)]
    assert result(spark, rows) == [("lengthy", None, "lengthy", 50_000, 0, None)]
    assert result(spark, []) == [] and result(spark, [(1, None)]) == []


def test_other_measures(spark):
    rows = [(1, "cat cat cat cut"), (2, "cart")]
    assert result(spark, rows, length=3, occurrences=1, factor=2, spare=None) == [("cart", "cat", "cat", 1, 1, 3), ("cat", None, "cat", 3, 2, None), ("cut", "cat", "cat", 1, 1, 3)]
    with pytest.raises(ValueError):
        result(spark, rows, factor=1)
