"""A corpus from raw documents to packed sequences: quality, language, near duplicates, secrets, packing."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.llm import langid, minhash, packing, quality, secrets
from sluice.llm.common import cut, free, read_table

#: Ids, of eight bytes each, up to which a table of them is broadcast.
SMALL = 500_000


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules keep, without their boilerplate lines; n_chars follows the text."""
    out = quality.quality_rules(docs, carry=docs.columns).where("kept")
    text = F.col("clean_text")
    return out.select(*[
        {"text": text.alias("text"), "n_chars": F.length(text).cast(docs.schema["n_chars"].dataType).alias("n_chars")}.get(c, F.col("_carried")[c].alias(c))
        for c in docs.columns
    ])


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is certain, lang being the language found."""
    dictionaries = langid.train_dictionaries(langid.training_rows(docs))
    prefix = free(docs.columns, "_lang")  # no column begins with it
    out = langid.identify(docs, dictionaries, prefix=prefix).where(F.col(f"{prefix}accepted"))
    return out.select(*[F.col(f"{prefix}lang_pred").alias(c) if c == "lang" else F.col(f"`{c}`") for c in docs.columns])


def duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of least id of each group, and documents without relatives or id."""
    verdicts = minhash.near_duplicates(docs, percent=80)
    gone = cut(verdicts.where("not kept").select("doc_id").distinct())
    if gone.count() <= SMALL:
        gone = F.broadcast(gone)  # so that no text is moved
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)


def secret_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets in their texts masked; n_chars follows the text."""
    name = free(docs.columns, "_secrets")
    out, found = secrets.scan_secrets(docs, out=name), F.col(name)["all"]
    masked = F.when(F.size(found) > 0, secrets.redacted(F.col("text"), found))
    return out.select("*", masked.alias(free(out.columns, "_masked"))).select(*[
        F.coalesce(F.col(free(out.columns, "_masked")), F.col("text")).alias(c) if c == "text"
        else F.coalesce(F.length(free(out.columns, "_masked")), F.col("n_chars")).cast(docs.schema["n_chars"].dataType).alias(c) if c == "n_chars"
        else F.col(f"`{c}`") for c in docs.columns
    ])


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The packed pieces of every document left."""
    return packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality rules", quality_stage), ("language ID", language_stage), ("MinHash near-dedup", duplicate_stage),
    ("secret scans", secret_stage), ("best-fit packing", packing_stage),
]

#: Compression, token ids and packing have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each written to the shared folder before the next."""
    docs = read_table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
