"""Quality rules by cross-document line frequency, in DataFrame functions only.

Lines are normalised (white space collapsed and trimmed, lower case) and hashed.
A line is boilerplate of a host when it stands in more than ``min_docs`` distinct
documents of that host, and in more than ``max_share`` of them or in more than
``max_docs``. Distinct documents are distinct texts: with ``copies`` each id counts,
and then a group of copies turns its own prose into boilerplate and goes as a whole.
Boilerplate lines are removed, and a document of which less than ``min_left`` of the
characters remains is rejected as depleted.

Texts are split into lines once: a narrow table with a row for each line of each
distinct (host, text) is written to the shared folder, and counts, hosts and verdicts
are read from it.

Skew: every count is a partial aggregate on keys of (host, line, text), none of which
is hot, or has a row for each key and task at most. Verdicts go back to the documents
by (host, text) in a plain left join, whose hot keys Spark splits; a verdict is one
row. Boilerplate lines meet the lines by (host, line) and a salt: as many salts as the
line has documents, over ``PER_SALT``.

Defined results: null or empty text has no words, no lines and fails the base
rule; a null host is a host of its own; equal rows get equal results; an empty
table gives an empty result; input columns of any name are left as they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import SPACE_CLASS, WORD_CLASS, cut, let

#: Documents of a boilerplate line for each part into which its join is dealt.
PER_SALT = 20_000


def _repeated_words(words: Column) -> Column:
    """Words that lie in a 3-word window found twice or more among words."""

    def covered(places: Column) -> Column:
        gaps = F.transform(
            places,
            lambda p, k: F.when(k == 0, F.lit(3)).otherwise(F.least(F.lit(3), p - F.get(places, k - 1))),
        )
        return F.aggregate(gaps, F.lit(0), lambda a, g: a + g)

    def from_sorted(found: Column) -> Column:
        again = F.filter(
            found,
            lambda x, k: F.coalesce(F.get(found, k - 1)["h"] == x["h"], F.lit(False))
            | F.coalesce(F.get(found, k + 1)["h"] == x["h"], F.lit(False)),
        )
        return let(F.sort_array(F.transform(again, lambda x: x["i"])), covered)

    def from_hashes(hashes: Column) -> Column:
        by_hash = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0)).otherwise(let(by_hash, from_sorted))

    def of(w: Column) -> Column:
        windows = F.transform(
            F.sequence(F.lit(0), F.size(w) - 3),
            lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)),
        )
        return F.when(F.size(w) < 3, F.lit(0)).otherwise(let(windows, from_hashes))

    return let(words, of)


def text_stats(text: Column) -> Column:
    """A struct of w (n words, r words in repeated windows), word_chars, n_symbols and n_dup_lines, all long."""
    t = F.coalesce(text, F.lit(""))
    words = F.array_remove(F.split(t, SPACE_CLASS + "+", -1), "")
    lines = F.filter(F.split(t, "\n", -1), lambda x: x.rlike(WORD_CLASS))
    return F.struct(
        let(words, lambda w: F.struct(F.size(w).cast("long").alias("n"), _repeated_words(w).cast("long").alias("r"))).alias("w"),
        (F.length(t) - F.regexp_count(t, F.lit(SPACE_CLASS))).cast("long").alias("word_chars"),
        F.regexp_count(t, F.lit("[#*$%&|<>]")).cast("long").alias("n_symbols"),
        let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
    )


def normal_line(line: Column) -> Column:
    return F.lower(F.trim(F.regexp_replace(line, SPACE_CLASS + "+", " ")))


def _keys(doc_id: str, text: str, host: str, copies: bool) -> list[Column]:
    """Hashes of the host and of the document: its text, with its id where copies count."""
    t = F.coalesce(F.col(text), F.lit(""))
    name = F.coalesce(F.concat(F.lit("h"), F.col(host).cast("string")), F.lit("n"))
    own = F.coalesce(F.concat(F.lit("i"), F.col(doc_id).cast("string")), F.lit("n"))
    return [F.xxhash64(name).alias("_host"), (F.xxhash64(own, t) if copies else F.xxhash64(t)).alias("_doc_hash")]


def _lines(docs: DataFrame, doc_id: str, text: str, host: str, copies: bool) -> DataFrame:
    """A row for each line with a word of each distinct (host, document): _host, _doc_hash, place, line (hash), n_chars (not white space)."""
    line = F.posexplode(F.split(F.coalesce(F.col(text), F.lit("")), "\n", -1)).alias("place", "_l")
    rows = docs.select(*_keys(doc_id, text, host, copies), line)
    rows = rows.withColumn("_l", normal_line(F.col("_l"))).where("_l <> ''")
    chars = F.length(F.replace(F.col("_l"), F.lit(" "), F.lit("")))
    return rows.select("_host", "_doc_hash", "place", F.xxhash64("_l").alias("line"), chars.alias("n_chars")).distinct()


def boilerplate_lines(lines: DataFrame, min_docs: int, max_share: float, max_docs: int) -> DataFrame:
    """(_host, line, n_docs) of the lines above the limits."""
    counted = lines.groupBy("_host", "line").agg(F.count_distinct("_doc_hash").alias("n_docs")).where(F.col("n_docs") > min_docs)
    hosts = lines.select("_host", "_doc_hash").distinct().groupBy("_host").agg(F.count("*").alias("host_docs"))
    # hosts are dealt by a part of the line's hash, so that the lines of a hot host are not one task's
    parts = 32
    hosts = hosts.select("_host", "host_docs", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("_part"))
    counted = counted.withColumn("_part", F.pmod("line", F.lit(parts)).cast("int"))
    over = (F.col("n_docs") > F.col("host_docs") * max_share) | (F.col("n_docs") > max_docs)
    return counted.join(hosts, ["_host", "_part"]).where(over).select("_host", "line", "n_docs")


def line_verdicts(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", host: str = "source",
    min_docs: int = 10, max_share: float = 0.01, max_docs: int = 1000, copies: bool = False,
) -> DataFrame:
    """For documents with boilerplate lines: _host, _doc_hash, removed_chars, removed_lines and removed (distinct line hashes)."""
    lines = cut(_lines(docs, doc_id, text, host, copies))
    frequent = cut(boilerplate_lines(lines, min_docs, max_share, max_docs).withColumn("_salts", F.ceil(F.col("n_docs") / PER_SALT).cast("int")))
    most = frequent.agg(F.max("_salts")).first()[0] or 1
    # a line does not know its own salts, so all are dealt over the greatest number
    dealt = frequent.select("_host", "line", F.explode(F.sequence(F.lit(0), F.lit(most - 1))).alias("_salt"))
    hit = lines.withColumn("_salt", F.pmod("_doc_hash", F.lit(most)).cast("int")).join(dealt, ["_host", "line", "_salt"])
    return hit.groupBy("_host", "_doc_hash").agg(
        F.sum("n_chars").alias("removed_chars"), F.count("*").alias("removed_lines"), F.collect_set("line").alias("removed")
    )


def quality_rules(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", host: str = "source",
    min_docs: int = 10, max_share: float = 0.01, min_left: float = 0.3, carry: list[str] | None = None,
    max_docs: int = 1000, copies: bool = False,
) -> DataFrame:
    """One row per document: the id, counts, removed_lines, base_failed and kept.

    With ``carry`` those input columns come along in the struct ``_carried``, and
    ``clean_text`` has the text without its boilerplate lines. The base rule fails
    documents of fewer than 50 words or with more than half of the words in repeated
    3-word windows.
    """
    verdicts = line_verdicts(docs, doc_id, text, host, min_docs, max_share, max_docs, copies)
    own = [F.struct(*[F.col(f"`{c}`") for c in carry]).alias("_carried"), F.col(text).alias("_text")] if carry is not None else []
    rows = docs.select(F.col(doc_id).alias("_doc"), *_keys(doc_id, text, host, copies), text_stats(F.col(text)).alias("_stats"), *own)
    joined = rows.join(verdicts, ["_host", "_doc_hash"], "left")
    s, w = F.col("_stats"), F.col("_stats.w")
    base_failed = (w["n"] < 50) | (100 * w["r"] > 50 * w["n"])
    left = s["word_chars"] - F.coalesce(F.col("removed_chars"), F.lit(0))
    kept = ~base_failed & (left >= s["word_chars"] * F.lit(min_left))
    out = [
        F.col("_doc").alias(doc_id), w["n"].alias("n_words"), s["word_chars"].alias("word_chars"),
        s["n_symbols"].alias("n_symbols"), s["n_dup_lines"].alias("n_dup_lines"), w["r"].alias("n_repeat_words"),
        F.coalesce(F.col("removed_lines"), F.lit(0)).cast("long").alias("removed_lines"),
        base_failed.alias("base_failed"), kept.alias("kept"),
    ]
    if carry is not None:
        without = F.array_join(
            F.filter(
                F.split("_text", "\n", -1),
                lambda x: ~F.array_contains(F.col("removed"), F.xxhash64(normal_line(x))),
            ),
            "\n",
        )
        out += [F.when(F.col("removed").isNull(), F.col("_text")).otherwise(without).alias("clean_text"), F.col("_carried")]
    return joined.select(*out)
