"""Paged sources as Spark data sources.

``sluice_pages`` follows cursors as a stream: the offset of a batch is the cursor that
comes after it, so what a checkpoint has seen is not asked for again, and a batch that
failed is asked for again from its own cursor. A cursor is known only from the page
before it, so pages are asked for one after the other; a batch has few of them.

``sluice_offset_pages`` reads pages by place as a table: places are known beforehand, so
they are dealt over lanes, each a task that pauses between its pages.

What asks for a page is a Python function that is sent along: of a cursor (None at
first), giving items as texts and the next cursor or None; or of a place and a number,
giving items.
"""

from __future__ import annotations

import base64
import time
from collections.abc import Callable, Iterator

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition, SimpleDataSourceStreamReader
from pyspark.sql.streaming import StreamingQuery

SCHEMA = "page long, place int, item string"


def _sent(function: Callable) -> str:
    return base64.b64encode(cloudpickle.dumps(function)).decode()


def _received(text: str) -> Callable:
    return cloudpickle.loads(base64.b64decode(text))


class CursorPages(DataSource):
    @classmethod
    def name(cls) -> str:
        return "sluice_pages"

    def schema(self) -> str:
        return SCHEMA

    def simpleStreamReader(self, schema) -> CursorReader:
        return CursorReader(self.options)


class CursorReader(SimpleDataSourceStreamReader):
    """Offsets are (cursor, page, done); a source that gave no next cursor, or the same again, or an empty page, is done."""

    def __init__(self, options: dict):
        self.ask, self.start, self.most = _received(options["ask"]), options.get("start"), int(options.get("pages_per_batch", 10))

    def initialOffset(self) -> dict:
        return {"cursor": self.start, "page": 0, "done": False}

    def _walk(self, start: dict, pages: int) -> tuple[list[tuple], dict]:
        at, rows = dict(start), []
        while not at["done"] and at["page"] < start["page"] + pages:
            items, after = self.ask(at["cursor"])
            rows += [(at["page"], k, x) for k, x in enumerate(items)]
            over = not items or not after or after == at["cursor"]
            at = {"cursor": at["cursor"] if over else after, "page": at["page"] + bool(items), "done": over}
        return rows, at

    def read(self, start: dict) -> tuple[Iterator[tuple], dict]:
        rows, end = self._walk(start, self.most)
        return iter(rows), end

    def readBetweenOffsets(self, start: dict, end: dict) -> Iterator[tuple]:
        return iter(self._walk(start, end["page"] - start["page"])[0])


def cursor_stream(spark: SparkSession, ask: Callable[[str | None], tuple[list[str], str | None]], start: str | None = None, pages_per_batch: int = 10) -> DataFrame:
    """A stream of (page, place, item) of the pages by cursor."""
    spark.dataSource.register(CursorPages)
    reader = spark.readStream.format("sluice_pages").option("ask", _sent(ask)).option("pages_per_batch", pages_per_batch)
    return (reader.option("start", start) if start is not None else reader).load()


def drain(query: StreamingQuery) -> None:
    """Waits until a stream has nothing new, and stops it; what made it fail is raised."""
    try:
        query.processAllAvailable()
    finally:
        query.stop()


class OffsetPages(DataSource):
    @classmethod
    def name(cls) -> str:
        return "sluice_offset_pages"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return OffsetReader(self.options)


class _Places(InputPartition):
    def __init__(self, places: range):
        self.places = places


class OffsetReader(DataSourceReader):
    def __init__(self, options: dict):
        self.ask, self.size, self.most = _received(options["ask"]), int(options["size"]), int(options["most"])
        self.lanes, self.delay = int(options.get("lanes", 1)), float(options.get("delay", 3.0))

    def partitions(self) -> list[InputPartition]:
        return [_Places(range(lane * self.size, self.most, self.lanes * self.size)) for lane in range(self.lanes)]

    def read(self, partition: _Places) -> Iterator[tuple]:
        for k, at in enumerate(partition.places):
            if k:
                time.sleep(self.delay)
            items = self.ask(at, min(self.size, self.most - at))[: self.most - at]
            if not items:  # nothing lies behind an empty page
                return
            yield from ((at // self.size, i, x) for i, x in enumerate(items))


def offset_scan(spark: SparkSession, ask: Callable[[int, int], list[str]], size: int, most: int, lanes: int = 1, delay: float = 3.0) -> DataFrame:
    """(page, place, item) of at most most items, in pages of size, by lanes tasks that pause for delay seconds between their pages."""
    spark.dataSource.register(OffsetPages)
    return spark.read.format("sluice_offset_pages").options(ask=_sent(ask), size=str(size), most=str(most), lanes=str(lanes), delay=str(delay)).load()


class FilePages:
    """Pages that Spark wrote to a shared folder, served by cursor or by place; items are lines of text."""

    def __init__(self, root: str):
        self.root = root if "://" in root else "file://" + root.removeprefix("file:")

    @classmethod
    def write(cls, rows: DataFrame, page: str, place: str, item: str, root: str) -> FilePages:
        dealt = rows.select(page, place, item).repartition(page).sortWithinPartitions(page, place)
        dealt.select(page, item).withColumnRenamed(page, "page").write.partitionBy("page").text(root)
        return cls(root)

    def page(self, number: int) -> list[str]:
        from pyarrow import fs

        system, where = fs.FileSystem.from_uri(f"{self.root}/page={number}")
        files = system.get_file_info(fs.FileSelector(where, allow_not_found=True))
        lines: list[str] = []
        for f in sorted((f for f in files if f.base_name.startswith("part-")), key=lambda f: f.path):
            with system.open_input_stream(f.path) as stream:
                lines += stream.read().decode().splitlines()
        return lines

    def by_cursor(self, cursor: str | None) -> tuple[list[str], str | None]:
        number = int(cursor or 0)
        return self.page(number), str(number + 1)

    def by_place(self, at: int, size: int) -> list[str]:
        return self.page(at // size)
