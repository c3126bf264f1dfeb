"""Token-id files with Elias-Fano document boundaries.

A shard file holds the ids of some documents, one after another, as unsigned 16- or
32-bit integers, and where each document ends as an Elias-Fano sequence: the low
bits of each end packed side by side, the high bits in unary in a bit vector, with
the place of every ``EVERY``-th set bit for select. That takes about 2 + log2(mean
length) bits a document in place of 64. Document ids stand as 64-bit integers.

Writing: rows are dealt by Spark's range partitioner over (id, hash of the text, input
partition) into tasks of about ``range_bytes`` of text, the mean of all, and sorted
there (Spark spills what does not fit). A task encodes its rows as they come and streams
them into files of at most ``FILE_IDS`` ids and one document; the number of the range is
that of the shard. The hash splits an id with a third of the rows, and the partition
number splits copies of one row. Texts are moved once, nothing comes to the driver but
their length. Files go to the shared folder under a temporary name and are renamed, so
that an attempt that dies leaves nothing that is read; a lost executor's files are
written again with the same content. The starts of files are a prefix sum in two levels.

Reading opens a file and finds the documents' ends by select, a block of documents at
a time, without a table of all of them.

Defined results: null text has the end token alone; rows without an id come first; ids of
whole numbers are longs, those of another type keep it and its order, and a type without
an order is refused by Spark; rows that share an id are in the order of their texts'
hashes, however the input is cut, and repeated rows are kept next to each other; a very
long text is one document of one file; an empty table gives no file and an empty result;
other columns are not read.
"""

from __future__ import annotations

import json
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from sluice.llm.common import cut, shared_dir, slices, texts_of

MAGIC = b"SLUICEF1"
EVERY = 256
#: Ids of a file, about.
FILE_IDS = 1 << 22
#: Bytes of text of a range.
RANGE_BYTES = 32 << 20
#: Documents whose ends are read at a time.
BLOCK = 4096


class EliasFano:
    """A non-decreasing sequence of whole numbers from 0 on."""

    def __init__(self, n: int, low_bits: int, low: np.ndarray, high: np.ndarray, samples: np.ndarray):
        self.n, self.low_bits, self.low, self.high, self.samples = n, low_bits, low, high, samples

    @classmethod
    def of(cls, values: np.ndarray) -> EliasFano:
        values = np.asarray(values, np.uint64)
        n, top = len(values), int(values[-1]) if len(values) else 0
        low_bits = max(0, (top // max(n, 1)).bit_length() - 1)
        shift = np.uint64(low_bits)
        lows = values & np.uint64((1 << low_bits) - 1)
        bits = ((lows[:, None] >> np.arange(low_bits, dtype=np.uint64)) & np.uint64(1)).astype(np.uint8)
        low = np.packbits(bits.ravel(), bitorder="little")
        places = (values >> shift).astype(np.int64) + np.arange(n)
        marks = np.zeros(int(places[-1]) + 1 if n else 0, np.uint8)
        marks[places] = 1
        return cls(n, low_bits, low, np.packbits(marks, bitorder="little"), places[::EVERY].astype(np.uint64))

    def select(self, k: int) -> int:
        """The place of the k-th set bit of the high part: from the sample before it, byte by byte."""
        place = int(self.samples[k // EVERY])
        left = k % EVERY
        byte = place // 8
        window = self.high[byte : byte + 1] >> (place % 8) << (place % 8)
        while True:
            count = int(window[0]).bit_count()
            if left < count:
                bits = np.flatnonzero(np.unpackbits(window[:1], bitorder="little"))
                return byte * 8 + int(bits[left])
            left -= count
            byte += 1
            window = self.high[byte : byte + 1]

    def __getitem__(self, k: int) -> int:
        if not 0 <= k < self.n:
            raise IndexError(k)
        low = 0
        if self.low_bits:
            first, bit = divmod(k * self.low_bits, 8)
            chunk = int.from_bytes(self.low[first : first + (bit + self.low_bits + 7) // 8].tobytes(), "little")
            low = (chunk >> bit) & ((1 << self.low_bits) - 1)
        return ((self.select(k) - k) << self.low_bits) | low

    def between(self, i: int, j: int) -> np.ndarray:
        """The numbers i to j - 1, by select: only the high bits between two samples are read."""
        if i >= j:
            return np.zeros(0, np.int64)
        first, after = int(self.samples[i // EVERY]), (j - 1) // EVERY + 1
        stop = int(self.samples[after]) if after < len(self.samples) else 8 * len(self.high)
        byte = first // 8
        places = byte * 8 + np.flatnonzero(np.unpackbits(self.high[byte : -(-stop // 8)], bitorder="little"))
        k = np.searchsorted(places, first) + i % EVERY
        high = places[k : k + j - i].astype(np.int64) - np.arange(i, j)
        if not self.low_bits:
            return high
        bit = i * self.low_bits
        bits = np.unpackbits(self.low[bit // 8 : -(-j * self.low_bits // 8)], bitorder="little")[bit % 8 :][: (j - i) * self.low_bits].reshape(j - i, self.low_bits)
        return (high << self.low_bits) | (bits.astype(np.int64) << np.arange(self.low_bits)).sum(1)


def to_bytes(doc_ids: list | pa.Array, ids: list[np.ndarray]) -> bytes:
    """A shard file of the ids of each document; ids of documents may be null. Those that are no longs stand as an Arrow stream."""
    column = doc_ids if isinstance(doc_ids, pa.Array) else pa.array(doc_ids, pa.int64())
    if longs := pa.types.is_int64(column.type):
        stored = column.fill_null(0).to_numpy().astype("<i8").tobytes()
    else:
        batch, out = pa.RecordBatch.from_arrays([column], names=["id"]), pa.BufferOutputStream()
        with pa.ipc.new_stream(out, batch.schema) as stream:
            stream.write_batch(batch)
        stored = out.getvalue().to_pybytes()
    lengths = np.array([len(x) for x in ids], np.int64)
    data = np.concatenate([*ids, np.zeros(0, "<u2")])
    wide = bool(len(data)) and int(data.max()) >= 1 << 16
    ends = EliasFano.of(np.cumsum(lengths))
    blocks = [
        stored, np.packbits(np.array(column.is_null().to_pylist(), bool)).tobytes(),
        ends.low.tobytes(), ends.high.tobytes(), ends.samples.astype("<u8").tobytes(), data.astype("<u4" if wide else "<u2").tobytes(),
    ]
    head = json.dumps({"n": len(ids), "longs": longs, "low_bits": ends.low_bits, "width": 4 if wide else 2, "blocks": [len(b) for b in blocks], "crc": zlib.crc32(b"".join(blocks[:-1]))}).encode()
    return b"".join([MAGIC, len(head).to_bytes(4, "little"), head, *blocks])


class Shard:
    """An opened shard file."""

    def __init__(self, data: bytes):
        if data[:8] != MAGIC:
            raise ValueError("not a shard file")
        size = int.from_bytes(data[8:12], "little")
        head = json.loads(data[12 : 12 + size])
        at, blocks = 12 + size, []
        for n in head["blocks"]:
            blocks.append(memoryview(data)[at : at + n])
            at += n
        if at != len(data) or zlib.crc32(b"".join(blocks[:-1])) != head["crc"]:
            raise ValueError("a damaged shard file")
        self.n = head["n"]
        self._null = np.frombuffer(blocks[1], np.uint8)
        self._doc_ids = np.frombuffer(blocks[0], "<i8") if head["longs"] else pa.ipc.open_stream(blocks[0]).read_next_batch().column(0)
        self.ends = EliasFano(self.n, head["low_bits"], np.frombuffer(blocks[2], np.uint8), np.frombuffer(blocks[3], np.uint8), np.frombuffer(blocks[4], "<u8"))
        self.ids = np.frombuffer(blocks[5], f"<u{head['width']}")

    def doc_ids(self, i: int, j: int) -> list:
        """The ids of the documents i to j - 1, i a multiple of 8."""
        if isinstance(self._doc_ids, pa.Array):
            return self._doc_ids.slice(i, j - i).to_pylist()
        null = np.unpackbits(self._null[i // 8 : -(-j // 8)]).astype(bool)
        return [None if x else d for d, x in zip(self._doc_ids[i:j].tolist(), null)]

    def document(self, k: int) -> np.ndarray:
        """The ids of the k-th document, found by select."""
        return self.ids[self.ends[k - 1] if k else 0 : self.ends[k]]


def _put(uri: str, data: bytes) -> None:
    from pyarrow import fs

    system, path = fs.FileSystem.from_uri(uri)
    system.create_dir(path.rpartition("/")[0], recursive=True)
    temporary = f"{path}.{uuid.uuid4().hex}.tmp"
    with system.open_output_stream(temporary) as f:
        f.write(data)
    system.move(temporary, path)


def _get(uri: str) -> bytes:
    from pyarrow import fs

    system, path = fs.FileSystem.from_uri(uri)
    with system.open_input_stream(path) as f:
        return f.read()


def _as_uri(folder: str) -> str:
    return folder if "://" in folder else "file://" + folder.removeprefix("file:")


def id_type(docs: DataFrame, doc_id: str) -> T.DataType:
    """The type that ids have in files: long for whole numbers, else their own."""
    kind = docs.schema[doc_id].dataType
    return T.LongType() if isinstance(kind, T.IntegralType) else kind


def write_shards(
    docs: DataFrame, path: str, folder: str, doc_id: str = "doc_id", text: str = "text", end_id: int = 2, range_bytes: int = RANGE_BYTES, file_ids: int = FILE_IDS,
) -> DataFrame:
    """Writes every document's ids and returns (shard, file, uri, n_docs, n_ids), checkpointed, a row per file, in the order of (shard, file)."""
    kind = id_type(docs, doc_id)
    rows = docs.select(F.col(doc_id).cast(kind).alias("_id"), F.coalesce(F.col(text), F.lit("")).alias("_t"))
    rows = rows.select("_id", F.xxhash64("_t").alias("_hash"), F.spark_partition_id().alias("_part"), "_t")
    size = rows.agg(F.sum(F.octet_length("_t").cast("long") + 8)).first()[0] or 0
    order = [F.col("_id").asc_nulls_first(), F.col("_hash"), F.col("_part")]
    dealt = rows.repartitionByRange(max(1, -(-size // range_bytes)), *order).sortWithinPartitions(*order)
    target, own = _as_uri(folder), to_arrow_type(kind)

    def store(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from sluice.llm.tokens import encoder

        encode, end, shard = encoder(path, spaced=False), np.array([end_id], "<u4").tobytes(), TaskContext.get().partitionId()
        file, held, doc_ids, ids = 0, 0, [], []

        def flush():
            uri = f"{target}/shard-{shard:09d}-{file:06d}.ids"
            _put(uri, to_bytes(pa.array(doc_ids, own), ids))
            return pa.RecordBatch.from_arrays([pa.array([shard]), pa.array([file]), pa.array([uri]), pa.array([len(ids)]), pa.array([held])], names=["shard", "file", "uri", "n_docs", "n_ids"])

        for batch in slices(batches):
            for i, x in zip(batch.column(0).to_pylist(), encode(texts_of(batch.column(1)))):
                if held >= file_ids:
                    yield flush()
                    file, held, doc_ids, ids = file + 1, 0, [], []
                doc_ids.append(i)
                ids.append(np.frombuffer(x + end, "<u4"))
                held += len(ids[-1])
        if doc_ids:
            yield flush()

    return cut(dealt.select("_id", "_t").mapInArrow(store, "shard long, file long, uri string, n_docs long, n_ids long"))


def with_starts(shards: DataFrame, block: int = 256) -> DataFrame:
    """(uri, base): the ids before each file. Files are summed within blocks of shards, and the blocks, which are few, among themselves."""
    rows = shards.select("shard", "file", "uri", "n_ids", F.floor(F.col("shard") / block).alias("block"))
    blocks = rows.groupBy("block").agg(F.sum("n_ids").alias("all"))
    before = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select("block", F.coalesce(F.sum("all").over(before), F.lit(0)).alias("over"))
    own = Window.partitionBy("block").orderBy("shard", "file").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("within", F.coalesce(F.sum("n_ids").over(own), F.lit(0)))
    return rows.join(blocks, "block").select("uri", (F.col("over") + F.col("within")).alias("base"))


def read_shards(spark: SparkSession, shards: DataFrame, doc_id: str = "doc_id", with_ids: bool = False, kind: T.DataType = T.LongType()) -> DataFrame:
    """Per document from the files: the id, start, n_tokens, ids_crc32 and, with_ids, the ids. shards: what write_shards returned; kind: the ids' type."""
    fields = [T.StructField(doc_id, kind), *[T.StructField(n, T.LongType()) for n in ("start", "n_tokens", "ids_crc32")]] + [T.StructField("ids", T.BinaryType())] * with_ids
    schema, own = T.StructType(fields), to_arrow_type(kind)
    names = schema.names

    def load(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uri, base in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                shard, begin = Shard(_get(uri)), 0
                for i in range(0, shard.n, BLOCK):
                    ends = shard.ends.between(i, min(i + BLOCK, shard.n))
                    begins = np.concatenate([[begin], ends[:-1]]).astype(np.int64)
                    begin = int(ends[-1])
                    data = [shard.ids[a:b].astype("<u4").tobytes() for a, b in zip(begins.tolist(), ends.tolist())]
                    columns = [
                        pa.array(shard.doc_ids(i, i + BLOCK), own), pa.array(begins + base), pa.array(ends - begins),
                        pa.array([zlib.crc32(x) for x in data], pa.int64()),
                    ]
                    yield pa.RecordBatch.from_arrays(columns + [pa.array(data, pa.binary())] * with_ids, names=names)

    files = cut(with_starts(shards))
    return files.repartition(max(1, files.count())).mapInArrow(load, schema)


def write_and_read(docs: DataFrame, path: str, folder: str | None = None, doc_id: str = "doc_id", text: str = "text", end_id: int = 2) -> DataFrame:
    spark = docs.sparkSession
    folder = folder or f"{shared_dir(spark).rstrip('/')}/ids-{uuid.uuid4().hex}"
    return read_shards(spark, write_shards(docs, path, folder, doc_id, text, end_id), doc_id, kind=id_type(docs, doc_id))
