"""Helpers that the corpus operators share.

Every operator takes a DataFrame with an id column and a text column, named by
parameters, and reads only those columns (and the host or language column it is
told of); any other column, whatever its name, is ignored or carried unchanged.
"""

from __future__ import annotations

import gc
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.operators.scratch import shared_dir

#: Rows that Python code takes from an Arrow batch at a time.
SLICE_ROWS = 512
#: Bytes of text after which a slice ends, whatever its rows.
SLICE_BYTES = 4 << 20
#: White space of a word: space and the five controls from tab to carriage return.
SPACE_CLASS = r"[\x20\x09-\x0D]"
WORD_CLASS = r"[^\x20\x09-\x0D]"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def free(columns: list[str], name: str) -> str:
    """name, with as many underscores behind it as it takes that no column begins with it; Spark takes no note of case."""
    while any(c.lower().startswith(name.lower()) for c in columns):
        name += "_"
    return name


def cut(df: DataFrame) -> DataFrame:
    """df written to the shared checkpoint folder and read from it, so that a lost executor costs no recomputation."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def sweep(spark: SparkSession) -> None:
    """Lets Spark drop the shuffle files, checkpoints and broadcasts that nothing refers to any more.

    Spark learns of them by the driver's garbage collection, which it forces itself only
    every half hour; an operator of many rounds would hold all of its rounds' files.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def crc_mod(column: Column, modulus: int) -> Column:
    """crc32 of the value as text, modulo modulus; a null value gives null."""
    return F.crc32(column.cast("string").cast("binary")) % F.lit(modulus)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with value computed once per row, though body names it often or inside lambdas."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def slices(batches: Iterator[pa.RecordBatch], text: int = 1) -> Iterator[pa.RecordBatch]:
    """The batches in pieces of bounded rows and bytes; a single longer text is a piece of its own."""
    for batch in batches:
        lengths = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_pylist()
        start = held = 0
        for i, n in enumerate(lengths):
            if i > start and (i - start >= SLICE_ROWS or held + n > SLICE_BYTES):
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += n
        if start < len(lengths):
            yield batch.slice(start)


def texts_of(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of each text; null is empty."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]
