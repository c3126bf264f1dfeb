"""Language identification by compression with per-language zstandard dictionaries.

Each language gets a raw-content dictionary: passages of labelled training documents,
laid end to end. A text is compressed whole, in blocks of
``BLOCK`` bytes that each start from the dictionary alone (else the start of a long
text would serve its end better than any dictionary), and the language whose
dictionary leaves the fewest bytes is chosen. The margin is the gap to the second
best in bits per byte; narrow margins are rejected. Compression in two levels gives
finer sizes, so ties are rare; those left go to the language first in order.

Training texts are checked against each other first: dictionaries of one half
classify the other half, and texts whose label is contradicted are left out.

Dictionaries are fitted on a bounded sample of labelled passages: whole training texts
are cut into passages of at most ``passage`` characters, and at most ``sample``
different passages a language are drawn by their hash, so that every part of every
text has the same chance and copies count once. Prediction is row-local, without
shuffle.

Defined results: null text, and text without a letter, is ``und`` with score 0 and
rejected; without any labelled training text everything is ``und``; equal texts
get equal results; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.llm.common import crc_mod, slices, texts_of

LEVELS = (1, 6)
BLOCK = 4096
#: Parts of a language that are ranked by themselves.
PARTS = 16


def train_dictionaries(docs: DataFrame, text: str = "text", lang: str = "lang", sample: int = 160, passage: int = 1024) -> dict[str, bytes]:
    """A raw-content dictionary for each language of docs (rows without text or language are left out).

    Hashes of equal passages are made one by a partial aggregate; the rank is over
    hashes only and is cut to sample in each partition before its shuffle, so no task
    holds a language. Passages are taken out of the texts for the chosen hashes alone.
    """
    rows = docs.where(F.col(lang).isNotNull() & F.col(text).isNotNull()).select(
        F.col(lang).cast("string").alias("l"), F.explode(F.regexp_extract_all(text, F.lit("(?s).{1,%d}" % passage), F.lit(0))).alias("t")
    ).where(F.col("t").rlike(r"\p{L}")).withColumn("h", F.xxhash64("t"))
    # first within parts of a language, so that a language of most texts is not one task's
    parts = rows.select("l", "h").distinct().withColumn("p", F.pmod("h", F.lit(PARTS)))
    parts = parts.withColumn("k", F.row_number().over(Window.partitionBy("l", "p").orderBy("h"))).where(F.col("k") <= sample)
    chosen = parts.select("l", "h", F.row_number().over(Window.partitionBy("l").orderBy("h")).alias("k")).where(F.col("k") <= sample)
    got = rows.join(F.broadcast(chosen), ["l", "h"]).groupBy("l", "k").agg(F.min("t").alias("t")).orderBy("l", "k").collect()  # at most sample rows a language
    samples = [(r["l"], r["t"].lower().encode(), r["k"] % 2) for r in got]
    halves = [Classifier(_joined([x for x in samples if x[2] == k])) for k in (0, 1)]
    agreed = [x for x in samples if x[0] not in (c := halves[1 - x[2]]).langs or c(x[1])[0] == x[0]]
    named = {x[0] for x in agreed}
    return _joined(agreed + [x for x in samples if x[0] not in named])


def _joined(samples: list[tuple[str, bytes, int]]) -> dict[str, bytes]:
    """Passages of each language end to end."""
    out: dict[str, list[bytes]] = {}
    for name, data, _ in samples:
        out.setdefault(name, []).append(data + b"\n")
    return {k: b"".join(v) for k, v in out.items()}


class Classifier:
    """Compressors of each language; made once per task."""

    def __init__(self, dictionaries: dict[str, bytes]):
        self.langs = sorted(dictionaries)
        self.by_lang = []
        for name in self.langs:
            own = []
            for level in LEVELS:
                held = zstandard.ZstdCompressionDict(dictionaries[name], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
                held.precompute_compress(level=level)
                own.append(zstandard.ZstdCompressor(dict_data=held, write_content_size=False, write_checksum=False, write_dict_id=False))
            self.by_lang.append(own)

    def sizes(self, data: bytes) -> list[int]:
        parts = [data[i : i + BLOCK] for i in range(0, len(data), BLOCK)]
        return [sum(len(c.compress(p)) for c in own for p in parts) for own in self.by_lang]

    def __call__(self, data: bytes) -> tuple[str, float, float]:
        """(language, score, margin in bits a byte)."""
        sizes = self.sizes(data)
        order = sorted(range(len(sizes)), key=lambda k: (sizes[k], k))
        if len(order) == 1:
            return self.langs[0], 1.0, 8.0
        first, second = sizes[order[0]], sizes[order[1]]
        gap = (second - first) / len(LEVELS)
        return self.langs[order[0]], gap / (gap + 8.0), 8.0 * gap / max(len(data), 1)


def identify(
    docs: DataFrame, dictionaries: dict[str, bytes], text: str = "text", min_margin: float = 0.02, min_gap: float = 0.05,
    prefix: str = "",
) -> DataFrame:
    """docs with lang_pred, score (0 to 1), margin and accepted; a column of docs with such a name gives way.

    score is g / (g + 8) for the gap g in bytes between the two best languages. A
    prediction is accepted when its score reaches min_gap and its margin, in bits
    a byte, reaches min_margin.
    """
    names = [prefix + x for x in ("lang_pred", "score", "margin", "accepted")]
    docs = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c.lower() not in {n.lower() for n in names} or c == text])
    at = docs.columns.index(text)
    schema = T.StructType(list(docs.schema.fields) + [T.StructField(n, t) for n, t in zip(names, (T.StringType(), T.DoubleType(), T.DoubleType(), T.BooleanType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classify = Classifier(dictionaries) if dictionaries else None
        for batch in slices(batches, at):
            column = batch.column(at)
            letters = pc.fill_null(pc.match_substring_regex(column, r"\p{L}"), False).to_pylist()
            lowered = pc.utf8_lower(column)
            got = [classify(t) if has and classify else ("und", 0.0, 0.0) for t, has in zip(texts_of(lowered), letters)]
            lang, score, margin = (list(x) for x in zip(*got)) if got else ([], [], [])
            accepted = [name != "und" and s >= min_gap and m >= min_margin for name, s, m in got]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(margin, pa.float64()), pa.array(accepted, pa.bool_())],
                names=[*batch.schema.names, *names],
            )

    return docs.mapInArrow(run, schema)


def training_rows(docs: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """Documents to learn from: crc32 of the id as text, modulo 3, is not 1. A row without an id is never learned from."""
    return docs.where(crc_mod(F.col(doc_id), 3) != 1)
