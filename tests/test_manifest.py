"""Commits of several tables at once: what a run leaves that dies anywhere, and names learned across batches."""

import pytest
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from sluice.operators.manifest import Tables
from sluice.plans import verticals
from sluice.streaming import incremental

ROWS = [(k, n, f"https://d.com/{k}" if k != 3 else "bad", 5) for k, n in enumerate(["OpenAI, Inc.", "Nova Labs", "nova labs llc", "Bad", "Nova Lab", "Zeta"])]
SCHEMA = "seq bigint, name string, page_url string, team_size int"
NAMES = ["startups", "rejected/startups", "mapping", "learned", "seen"]


class Killed(Exception):
    pass


def context(spark, root):
    return verticals.RunContext(spark, F.lit("2026-09-04").cast("timestamp"), str(root))


def content(spark, root):
    tables = Tables(spark, str(root))
    return {n: sorted(map(str, (tables.read(n) or spark.range(0)).collect())) for n in NAMES}


def run(spark, root, commit="c"):
    """An outcome of plain rows, two of which share a key."""
    made = lambda rows, schema: spark.createDataFrame(rows, schema).coalesce(1)
    log = "seq long, raw_name string, canonical_name string, method string, confidence double"
    out = verticals.Outcome(
        made([(1, "a", "k1"), (2, "b", "k2"), (3, "c", "k2"), (4, "d", "k4")], "seq long, entity_name string, dedup_key string"), made([("R", "bad")], "record_type string, reason string"),
        made([(1, "a", "A", "exact", 100.0), (2, "a", "A", "exact", 100.0)], log), made([("a", "A", 1)], "norm string, raw string, first long"))
    return verticals.store(context(spark, root), "startups", out, F.lower(F.trim("entity_name")), commit)


def test_killed_between_any_two_writes(spark, tmp_path, monkeypatch):
    assert run(spark, tmp_path / "whole") == 3
    want = content(spark, tmp_path / "whole")
    assert all(want[n] for n in NAMES)
    for stop in range(6):  # five tables and the manifest
        root, left = tmp_path / f"stop{stop}", [stop]
        for kind in ("parquet", "json"):
            def write(self, path, *a, real=getattr(DataFrameWriter, kind), **b):
                if str(root) in path:
                    if not left[0]:
                        raise Killed
                    left[0] -= 1
                return real(self, path, *a, **b)

            monkeypatch.setattr(DataFrameWriter, kind, write)
        with pytest.raises(Killed):
            run(spark, root)
        monkeypatch.undo()
        assert not any(content(spark, root).values())  # nothing of it is read
        assert run(spark, root) == 3 and run(spark, root) == 3
        assert content(spark, root) == want
        assert run(spark, root, "another") == 0  # another commit finds its rows stored


def test_batches_of_a_stream(spark, tmp_path, monkeypatch):
    """Two batches, the first of which dies after its commit: each row is stored once and names are those of one run."""
    (tmp_path / "in").mkdir()
    one = context(spark, tmp_path / "one")
    verticals.store(one, "startups", verticals.startups(one, spark.createDataFrame(ROWS, SCHEMA)))
    want = sorted((r.seq, r.canonical_name) for r in Tables(spark, one.root).read("startups").collect())
    ctx = context(spark, tmp_path / "two")
    for k, part in enumerate((ROWS[:3], ROWS[3:])):
        spark.createDataFrame(part, SCHEMA).coalesce(1).write.mode("append").json(str(tmp_path / "in" / str(k)))

        def stream():
            return incremental.run_stream(incremental.read_files(spark, str(tmp_path / "in" / "*"), SCHEMA), verticals.startups, ctx, "startups", str(tmp_path / "cp")).awaitTermination(120)

        if k == 0:
            real = verticals.Tables.commit

            def die(self, frames, commit=None):
                real(self, frames, commit)
                raise Killed

            monkeypatch.setattr(verticals.Tables, "commit", die)
            with pytest.raises(Exception, match="Killed"):
                stream()
            monkeypatch.undo()
        stream()
    assert sorted((r.seq, r.canonical_name) for r in Tables(spark, ctx.root).read("startups").collect()) == want
    assert {r.norm for r in verticals.learned_names(ctx).collect()} == {r.norm for r in verticals.learned_names(one).collect()}
