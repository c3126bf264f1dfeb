"""Tables that are committed together.

A commit writes its rows of each table to folders of its own and then one manifest that
names them; readers follow manifests alone. So what a run left that died between two
writes is never read, a commit that is repeated overwrites its own folders, and one that
is in the manifest already is not made again. A manifest is one small row a table and
commit, written by Spark, so that any store that Spark writes will do.
"""

from __future__ import annotations

import hashlib
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

SCHEMA = "commit string, name string, path string, n long"


def read_if_there(spark: SparkSession, path: str) -> DataFrame | None:
    """A Parquet table, or None where nothing was written yet."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return None


class Tables:
    """The committed tables under a root folder."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def entries(self) -> list[tuple[str, str, str, int]]:
        """(commit, table, path, rows) of what is committed: as many as commits times tables."""
        try:
            found = self.spark.read.schema(SCHEMA).option("recursiveFileLookup", True).json(f"{self.root}/_manifest").collect()
        except AnalysisException as e:
            if "PATH_NOT_FOUND" not in str(e):
                raise
            return []
        return sorted(tuple(r) for r in found)

    def committed(self, commit: str) -> dict[str, int] | None:
        """Rows of each table of a commit; None if it is not committed."""
        own = {name: n for c, name, _, n in self.entries() if c == commit}
        return own or None

    def read(self, name: str) -> DataFrame | None:
        """All committed rows of a table; None if there are none."""
        paths = [path for _, table, path, n in self.entries() if table == name and n]
        return self.spark.read.option("mergeSchema", True).parquet(*paths) if paths else None

    def commit(self, frames: dict[str, DataFrame], commit: str | None = None) -> dict[str, int]:
        """Writes the frames as one commit and returns their rows; what is committed already is left as it is."""
        commit = commit or uuid.uuid4().hex
        if (done := self.committed(commit)) is not None:
            return done
        folder = hashlib.sha256(commit.encode()).hexdigest()[:32]
        rows = []
        for name, df in frames.items():
            path = f"{self.root}/{name}/{folder}"
            df.write.mode("overwrite").parquet(path)
            rows.append((commit, name, path, self.spark.read.schema(df.schema).parquet(path).count()))
        self.spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("overwrite").json(f"{self.root}/_manifest/{folder}")
        return {name: n for _, name, _, n in rows}

