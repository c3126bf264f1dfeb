"""Pagers as data sources: a stream that dies resumes at its cursor, pages by place by lanes."""

import json

import pytest
from pyspark.sql import functions as F

from sluice.operators.manifest import Tables
from sluice.sources import paging


def pager(log, pages=11, size=3):
    """Scripted pages by cursor; what is asked for is written to a file, for the source runs in a process of its own."""

    def ask(cursor):
        with open(log, "a") as f:
            f.write(json.dumps(cursor) + "\n")
        n = int((cursor or "c0")[1:])
        return [f"item {n}.{k}" for k in range(size)], f"c{n + 1}" if n + 1 < pages else None

    return ask


def run(spark, tmp_path, ask, die_at=None):
    tables = Tables(spark, str(tmp_path / "out"))

    def one(batch, number):
        if die_at == (number, "before"):
            raise RuntimeError("killed")
        tables.commit({"items": batch}, f"batch {number}")
        if die_at == (number, "after"):
            raise RuntimeError("killed")

    stream = paging.cursor_stream(spark, ask, pages_per_batch=2)
    paging.drain(stream.writeStream.foreachBatch(one).option("checkpointLocation", str(tmp_path / "checkpoint")).start())
    return sorted(r.item for r in tables.read("items").collect())


@pytest.mark.parametrize("die_at", [(2, "before"), (2, "after")])
def test_a_stream_that_dies_resumes(spark, tmp_path, die_at):
    log = tmp_path / "asked"
    with pytest.raises(Exception, match="killed"):
        run(spark, tmp_path, pager(log), die_at)
    before = len(log.read_text().splitlines())
    got = run(spark, tmp_path, pager(log))
    assert got == sorted(f"item {n}.{k}" for n in range(11) for k in range(3))  # none lost, none twice
    again = [json.loads(x) for x in log.read_text().splitlines()[before:]]
    assert min(int((c or "c0")[1:]) for c in again) >= 4  # the first two batches are not asked for again
    asked = len(log.read_text().splitlines())
    assert run(spark, tmp_path, pager(log)) == got and len(log.read_text().splitlines()) == asked  # it is done


def test_ends(spark, tmp_path):
    for ask, want in ((lambda c: ([], "x"), 0), (lambda c: (["a"], "same"), 2), (lambda c: (["a", "b"], None), 2)):
        reader = paging.CursorReader({"ask": paging._sent(ask), "pages_per_batch": "5"})
        rows, end = reader.read(reader.initialOffset())
        rows = list(rows)
        assert len(rows) == want and end["done"] and list(reader.read(end)[0]) == []
        assert list(reader.readBetweenOffsets(reader.initialOffset(), end)) == rows


def test_pages_by_place(spark):
    def ask(at, n):
        return [str(k) for k in range(at, min(at + n, 23))]

    for lanes in (1, 3):
        got = paging.offset_scan(spark, ask, 5, 100, lanes, 0.0)
        assert sorted((r.page, r.place, r.item) for r in got.collect()) == sorted((k // 5, k % 5, str(k)) for k in range(23))
    assert paging.offset_scan(spark, ask, 5, 12, 2, 0.0).agg(F.count("*"), F.max(F.col("item").cast("int"))).first() == (12, 11)
    assert paging.offset_scan(spark, ask, 5, 0, 2, 0.0).count() == 0
