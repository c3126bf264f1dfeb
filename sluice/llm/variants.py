"""Spelling variants: words one edit apart, and the frequent form that each rare word stands for.

Words of length l are indexed by two segments, their first l // 2 code points and the
rest. One edit leaves one of two segments whole, so a word one edit away has it at one
known place: where it stands, if the words are of equal length, and at the start or the
end, if the other word is one longer. Each word therefore probes with its own two
segments and, as the longer one, with the two substrings that the segments of words one
shorter would be. What shares a segment is a candidate, and one edit is verified.

A segment that more than ``CROWD`` entries share is not joined as a whole: its entries
are split by the rest of their words, cut in two in the same way, as often as it takes.
What still shares all but one code point is near by itself, and its number is bounded
by the alphabet. So no key holds many words but those that are near each other.

Counting is a partial aggregate of words, forms are followed by doubling: a form is at
least ``FACTOR`` times as frequent as its word, so paths are short.

Defined results: null and empty texts have no words, as has an empty table; a null id
counts as an empty text before the colon; repeated rows count as often as they stand
there; of near words that tie in number, the first in code-point order is the form; a
very long text is read whole by one pattern; columns other than id and text are not read.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.operators.scratch import Scratch

#: Code points of a word and occurrences of it, at least; how much more frequent a form is; of which share of runs a code point is taken.
LENGTH, OCCURRENCES, FACTOR, SPARE = 6, 5, 5, 199
#: Letters of a run: Latin letters of the first 256 code points and what stands among them.
LETTERS = "A-Za-zÀ-ÿ"
#: Entries of one segment that are joined as they are.
CROWD = 24


def words_of(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", length: int = LENGTH, occurrences: int = OCCURRENCES, spare: int | None = SPARE) -> DataFrame:
    """(word, n): words of at least length code points with at least occurrences.

    A run loses one code point where spare divides the checksum of its id and itself
    (None: never), so a run shorter than length is never a word and is not looked at.
    """
    # runs of at least length: the pattern is greedy, so a match is a maximal run
    found = F.regexp_extract_all(F.col(text), F.lit(f"[{LETTERS}]{{{length},}}"), F.lit(0))
    runs = docs.select(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).alias("id"), F.explode(found).alias("run"))
    low = F.when(F.col("run").rlike("[A-Z]"), F.translate("run", string.ascii_uppercase, string.ascii_lowercase)).otherwise(F.col("run"))
    runs = runs.select("id", low.alias("run"))
    word = F.col("run")
    if spare:
        runs = runs.withColumn("h", F.crc32(F.concat("id", F.lit(":"), "run").cast("binary")))
        at = (F.col("h") % F.length("run")).cast("int")
        word = F.when(F.col("h") % spare == 0, F.concat(F.substring("run", 1, at), F.expr("substring(run, cast(h % length(run) as int) + 2)"))).otherwise(word)
    return runs.select(word.alias("word")).where(F.length("word") >= length).groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= occurrences)


def _start(words: DataFrame) -> DataFrame:
    """(key, size, longer, word, n, rest): each word among those of its length, and as the longer one among those one shorter."""
    roles = F.array(*[F.struct(F.lit(longer).alias("longer"), (F.length("word") - int(longer)).alias("size")) for longer in (False, True)])
    return words.select("word", "n", F.explode(roles).alias("r")).select(F.col("r.size").cast("long").alias("key"), "r.size", "r.longer", "word", "n", F.col("word").alias("rest"))


def _split(entries: DataFrame) -> DataFrame:
    """Each entry under both segments of its rest. size is the length of the shorter words' rests; the longer ones' have one more."""
    half, more = F.col("size").cast("int") / 2, F.col("longer").cast("int")
    half = F.floor(half).cast("int")

    def part(place: int, whole: Column, size: Column, rest: Column) -> Column:
        return F.struct(F.xxhash64("key", "size", F.lit(place), whole).alias("key"), size.cast("int").alias("size"), rest.alias("rest"))

    first, last = F.substring("rest", F.lit(1), half), F.substring("rest", half + more + 1, F.length("rest"))
    parts = F.array(
        part(1, first, F.col("size") - half, F.substring("rest", half + 1, F.length("rest"))),
        part(2, last, half, F.substring("rest", F.lit(1), half + more)),
    )
    return entries.select("longer", "word", "n", F.explode(parts).alias("p")).select("p.key", "p.size", "longer", "word", "n", "p.rest")


def _verified(entries: DataFrame) -> DataFrame:
    """(a, b, na, nb) of entries under one key whose words are one edit apart; b is the longer word, or the later of two of one length."""
    one = entries.where("not longer").select("key", F.col("word").alias("a"), F.col("n").alias("na"))
    two = entries.select("key", "longer", F.col("word").alias("b"), F.col("n").alias("nb"))
    return one.join(two, "key").where((F.col("longer") | (F.col("a") < F.col("b"))) & (F.levenshtein("a", "b", 1) == 1)).select("a", "b", "na", "nb")


def near_pairs(words: DataFrame, scratch: Scratch, crowd: int = CROWD) -> DataFrame:
    """(a, b, na, nb): every two words exactly one edit apart, once."""
    found, entries = None, _start(words)
    while True:
        entries = scratch.put(_split(entries))
        # what has no more than one code point left can't be split further
        crowded = scratch.put(entries.where("size > 1").groupBy("key").agg(F.count("*").alias("entries")).where(F.col("entries") > crowd).select("key"))
        calm = entries.join(crowded, "key", "left_anti")
        pairs = _verified(calm)
        found = pairs if found is None else found.unionByName(pairs)
        if crowded.isEmpty():
            return found.distinct()  # two words can share both segments
        entries = entries.join(crowded, "key", "left_semi")


def roots(forms: DataFrame, scratch: Scratch) -> DataFrame:
    """(word, root) of rows (word, form): the end of each word's path of forms, found in rounds that double their reach."""
    at = scratch.put(forms.select("word", F.col("form").alias("root")))
    while True:
        on = at.select(F.col("word").alias("root"), F.col("root").alias("next"))
        ahead = scratch.put(at.join(on, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")))
        scratch.drop(at)
        at = ahead.select("word", "root")
        if ahead.where("moved").isEmpty():
            return at


def spelling_variants(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", factor: int = FACTOR, **choice) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of each word; choice: as in words_of.

    form is the most frequent word one edit away, if it is at least factor times as
    frequent, and root the end of the path of forms, the word itself if it has none.
    """
    if factor <= 1:
        raise ValueError("a form must be more frequent than its word, or paths of forms would not end")
    scratch = Scratch(docs.sparkSession)
    words = scratch.put(words_of(docs, doc_id, text, **choice))
    sides = F.array(F.struct(F.col("a").alias("word"), F.col("b").alias("near"), F.col("nb").alias("n")), F.struct(F.col("b").alias("word"), F.col("a").alias("near"), F.col("na").alias("n")))
    near = near_pairs(words, scratch).select(F.explode(sides).alias("s")).select("s.*")
    best = near.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("n")).alias("less"), "near")).alias("best"))
    known = words.join(best, "word", "left").select("word", "n", "n_near", F.when(-F.col("best.less") >= factor * F.col("n"), F.struct(F.col("best.near").alias("form"), (-F.col("best.less")).alias("n"))).alias("f"))
    known = scratch.put(known.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.col("f.form").alias("form"), F.col("f.n").alias("form_n")))
    ends = roots(known.where("form is not null").select("word", "form"), scratch)
    return known.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
