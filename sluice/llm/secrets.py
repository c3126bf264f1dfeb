"""Secret scans: fixed patterns and a Markov log-likelihood ratio, in DataFrame functions only.

Two first-order character models, one of random strings and one of ordinary
identifiers, are counted from labelled samples. A run of 20 or more key
characters is a secret of kind ``random`` when the log-likelihood ratio of the
two models over the transitions of some segment of it reaches ``min_llr``, so
ordinary characters beside a secret do not outvote it. Fixed patterns give the
kinds ``assign``, ``access`` and ``hex``; the model only adds spans.

The model is a table of 128 x 128 numbers whatever the corpus, so it travels in
the plan. Scanning is row-local: no shuffle, no join, and no hot key.

Defined results: null or empty text has no spans; equal rows get equal results;
an empty table gives an empty result and a model of sampled strings alone.
"""

from __future__ import annotations

import json
import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import WORD_CLASS, free, let

ASSIGN = (
    "([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])"
    "[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)
ACCESS = "AKIA[A-Z0-9]+"
HEX = "[0-9a-f]{32,}"
#: A maximal run of key characters; the look-behind keeps the search linear.
RUN = "(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}"
SPAN = "struct<s:bigint,e:bigint,kind:string>"
ASCII = 128


def _spans(text: Column, pattern: str, kind: str, good: Column | None, keep) -> Column:
    """Spans of the leftmost matches that do not overlap; good: an array beside the matches that keep() looks at.

    An append copies its array, so matches are taken in blocks of about the root of
    their number: n matches cost n times that root at most.
    """
    found = F.struct(
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("m"),
        F.split(text, pattern, -1).alias("gap"),
        (good if good is not None else F.array().cast("array<string>")).alias("g"),
    )

    none = F.array().cast(f"array<{SPAN}>")

    def placed(f: Column) -> Column:
        n = F.size(f["m"])
        wide = F.ceil(F.sqrt(n)).cast("int")

        def block(b: Column) -> Column:
            """The length of a block of matches with the gaps before them, and its spans, counted from its start."""

            def step(acc: Column, i: Column) -> Column:
                start = acc["at"] + F.length(F.get(f["gap"], i))
                end = start + F.length(F.get(f["m"], i))
                span = F.struct(start.alias("s"), end.alias("e"), F.lit(kind).alias("kind"))
                return F.struct(end.alias("at"), F.when(keep(f, i), F.array_append(acc["out"], span)).otherwise(acc["out"]).alias("out"))

            zero = F.struct(F.lit(0).cast("long").alias("at"), none.alias("out"))
            return F.aggregate(F.sequence(b * wide, F.least(n, (b + 1) * wide) - 1), zero, step)

        def from_blocks(blocks: Column) -> Column:
            zero = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<bigint>").alias("starts"))
            starts = F.aggregate(blocks, zero, lambda a, x: F.struct((a["at"] + x["at"]).alias("at"), F.array_append(a["starts"], a["at"]).alias("starts")), lambda a: a["starts"])
            return let(starts, lambda at: F.flatten(F.transform(blocks, lambda x, k: F.transform(x["out"], lambda y: F.struct(
                (y["s"] + F.get(at, k)).alias("s"), (y["e"] + F.get(at, k)).alias("e"), y["kind"].alias("kind")
            )))))

        return let(F.transform(F.sequence(F.lit(0), F.ceil(n / wide).cast("int") - 1), block), from_blocks)

    return F.when(text.rlike(pattern), let(found, placed)).otherwise(none)


def base_spans(text: Column) -> list[Column]:
    """The spans of assign, access and hex, each an array in the order of the text."""
    group = F.regexp_extract_all(text, F.lit(ASSIGN), F.lit(2))
    yes = lambda f, i: F.lit(True)
    return [
        _spans(text, ASSIGN, "assign", group, lambda f, i: F.length(F.get(f["g"], i)) >= 8),
        _spans(text, ACCESS, "access", None, lambda f, i: F.length(F.get(f["m"], i)) >= 16),
        _spans(text, HEX, "hex", None, yes),
    ]


def labelled_samples(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", sample_docs: int = 2000, sample_strings: int = 4096) -> DataFrame:
    """(sample, random) labelled strings: words of at most ``sample_docs`` documents, and drawn strings.

    The documents are those with the least hash of the id, so the sample is the same
    at every run; its bound makes the broadcast of the ids bounded too. Words are
    taken as written, in upper case and joined in pairs by an underscore.
    """
    ids = docs.select(F.col(doc_id).alias("_id")).where("_id is not null").orderBy(F.xxhash64("_id"), "_id").limit(sample_docs).distinct()
    some = docs.select(F.col(doc_id).alias("_id"), F.col(text).alias("_t")).join(F.broadcast(ids), "_id", "left_semi")
    words = F.filter(
        F.array_distinct(F.regexp_extract_all("_t", F.lit(WORD_CLASS + "+"), F.lit(0))),
        lambda w: w.rlike("^[A-Za-z]{3,}[A-Za-z.,;:!?]*$"),
    )
    ordinary = some.select(words.alias("w")).select(
        F.explode(F.concat("w", F.transform("w", F.upper), F.transform("w", lambda w, i: F.concat_ws("_", w, F.get("w", i + 1))))).alias("sample")
    )
    digest = F.sha2(F.col("id").cast("string"), 256)
    raw = F.unhex(digest)
    drawn = docs.sparkSession.range(sample_strings).select(F.explode(F.array(
        digest, F.regexp_replace(F.base64(raw), "=+$", ""), F.translate(F.base64(raw), "abcdefghijklmnopqrstuvwxyz+/=", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"),
    )).alias("sample"))
    return ordinary.distinct().select("sample", F.lit(False).alias("random")).unionByName(drawn.select("sample", F.lit(True).alias("random")))


def train_markov(samples: DataFrame) -> list[float]:
    """The log ratio of both models for each pair of ASCII characters, at 128 * first + second.

    samples: (sample, random). Characters beyond ASCII end a run and are not counted.
    The counts are summed on the executors; at most 2 x 128 x 128 sums come back.
    """
    pair = F.explode(F.transform(
        F.sequence(F.lit(1), F.length("sample") - 1),
        lambda i: F.ascii(F.substring("sample", i, F.lit(1))) * ASCII + F.ascii(F.substring("sample", i + 1, F.lit(1))),
    )).alias("pair")
    counted = samples.where(F.length("sample") > 1).where(~F.col("sample").rlike("[^\\x00-\\x7F]")).select("random", pair).groupBy("random", "pair").count().collect()
    n = {(r["random"], r["pair"]): r["count"] for r in counted}
    out = []
    for first in range(ASCII):
        total = {k: sum(n.get((k, first * ASCII + x), 0) for x in range(ASCII)) for k in (True, False)}
        for second in range(ASCII):
            p = [(n.get((k, first * ASCII + second), 0) + 0.5) / (total[k] + 0.5 * 65) for k in (True, False)]
            out.append(round(math.log(p[0] / p[1]), 6))
    return out


def random_spans(text: Column, ratios: list[float], min_llr: float) -> Column:
    table = F.from_json(F.lit(json.dumps(ratios)), "array<double>")

    zero = F.struct(F.lit(0.0).alias("now"), F.lit(0.0).alias("most"), F.lit("").alias("last"))

    def block(before: Column, piece: Column) -> Column:
        """The state behind a piece of a run: the sum that starts anew where it falls below zero, its maximum, the last character."""
        joined = F.concat(before["last"], piece)

        def step(a: Column, i: Column) -> Column:
            own = F.get(table, F.ascii(F.substring(joined, i, F.lit(1))) * ASCII + F.ascii(F.substring(joined, i + 1, F.lit(1))))
            now = F.greatest(a["now"] + own, F.lit(0.0))
            return F.struct(now.alias("now"), F.greatest(a["most"], now).alias("most"))

        start = F.struct(before["now"].alias("now"), before["most"].alias("most"))
        return F.aggregate(F.sequence(F.lit(1), F.length(joined) - 1), start, step, lambda a: F.struct(a["now"].alias("now"), a["most"].alias("most"), F.substring(piece, -1, 1).alias("last")))

    def ratio(run: Column) -> Column:
        """The greatest ratio of a segment. A place is found by counting from the start, so a run is read in short pieces."""
        return F.aggregate(F.regexp_extract_all(run, F.lit(".{1,256}"), F.lit(0)), zero, block, lambda a: a["most"])

    return _spans(text, RUN, "random", None, lambda f, i: ratio(F.get(f["m"], i)) >= min_llr)


def scan_secrets(
    docs: DataFrame, ratios: list[float] | None = None, doc_id: str = "doc_id", text: str = "text", min_llr: float = 12.0,
    sample_docs: int = 2000, out: str = "_secrets",
) -> DataFrame:
    """docs with ``out`` (underscores behind it where docs has that name): base (array of spans by start) and all (with those of kind random), each (s, e, kind).

    Starts and ends are code points, the end exclusive. min_llr is the natural
    logarithm of the odds a run must overcome to count as random.
    """
    if ratios is None:
        ratios = train_markov(labelled_samples(docs, doc_id, text, sample_docs))
    t = F.coalesce(F.col(text), F.lit(""))
    kinds = F.struct(*[x.alias(k) for x, k in zip([*base_spans(t), random_spans(t, ratios, min_llr)], ("a", "c", "h", "r"))])
    found = let(kinds, lambda k: F.struct(
        F.concat(k["a"], k["c"], k["h"]).alias("base"), F.concat(k["a"], k["c"], k["h"], k["r"]).alias("all"),
        F.size(k["a"]).cast("long").alias("n_assign"), F.size(k["c"]).cast("long").alias("n_access"), F.size(k["h"]).cast("long").alias("n_hex"),
    ))
    return docs.select("*", found.alias(free(docs.columns, out)))


def in_order(spans: Column) -> Column:
    """Spans by start, then assign, access, hex, random, as kind:start:end, comma-joined."""
    rank = {"assign": 0, "access": 1, "hex": 2, "random": 3}
    keyed = F.transform(spans, lambda x: F.struct(
        x["s"].alias("s"), F.coalesce(*[F.when(x["kind"] == k, F.lit(i)) for k, i in rank.items()]).alias("r"), x["e"].alias("e"), x["kind"].alias("kind")
    ))
    return F.array_join(F.transform(F.sort_array(keyed), lambda x: F.concat_ws(":", x["kind"], x["s"].cast("string"), x["e"].cast("string"))), ",")


def redacted(text: Column, spans: Column, mask: str = "[SECRET]") -> Column:
    """text with each maximal run of overlapping spans replaced by mask.

    Spark finds a place in a text by counting from its start, so spans are taken in
    blocks of about the root of their number, each with its own piece of the text.
    """
    long = lambda x: F.lit(x).cast("long")

    def merged(x: Column) -> Column:
        """The runs of sorted spans (s, e): a run begins where no earlier span reaches."""
        wide = F.ceil(F.sqrt(F.size(x))).cast("int")

        def step(acc: Column, y: Column) -> Column:
            run = F.struct(y["s"].alias("s"), y["e"].alias("e"))
            last = F.struct(acc["last"]["s"].alias("s"), F.greatest(acc["last"]["e"], y["e"]).alias("e"))
            begun = F.when(F.size(acc["block"]) >= wide, F.struct(F.array_append(acc["blocks"], acc["block"]).alias("blocks"), F.array(acc["last"]).alias("block"), run.alias("last")))
            begun = begun.otherwise(F.struct(acc["blocks"].alias("blocks"), F.array_append(acc["block"], acc["last"]).alias("block"), run.alias("last")))
            return F.when(y["s"] < acc["last"]["e"], F.struct(acc["blocks"].alias("blocks"), acc["block"].alias("block"), last.alias("last"))).otherwise(begun)

        none = F.array().cast("array<struct<s:bigint,e:bigint>>")
        zero = F.struct(F.array().cast("array<array<struct<s:bigint,e:bigint>>>").alias("blocks"), none.alias("block"), F.struct(F.get(x, 0)["s"].alias("s"), F.get(x, 0)["e"].alias("e")).alias("last"))
        return F.aggregate(F.slice(x, 2, F.greatest(F.size(x) - 1, F.lit(0))), zero, step, lambda a: F.array_append(a["blocks"], F.array_append(a["block"], a["last"])))

    def cut_out(blocks: Column) -> Column:
        def block(b: Column, k: Column) -> Column:
            start = F.when(k == 0, long(0)).otherwise(F.element_at(F.get(blocks, k - 1), -1)["e"])
            piece = F.substring(text, (start + 1).cast("int"), (F.element_at(b, -1)["e"] - start).cast("int"))
            return let(F.struct(start.alias("s"), piece.alias("t")), lambda p: F.array_join(F.transform(b, lambda y, i: F.concat(
                F.substring(p["t"], (F.when(i == 0, p["s"]).otherwise(F.get(b, i - 1)["e"]) - p["s"] + 1).cast("int"), (y["s"] - F.when(i == 0, p["s"]).otherwise(F.get(b, i - 1)["e"])).cast("int")), F.lit(mask)
            )), ""))

        end = F.element_at(F.element_at(blocks, -1), -1)["e"]
        return F.concat(F.array_join(F.transform(blocks, block), ""), F.substring(text, (end + 1).cast("int"), F.length(text)))

    return F.when(F.size(spans) > 0, let(let(F.sort_array(spans), merged), cut_out)).otherwise(text)
