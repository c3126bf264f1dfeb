"""Tables of an operator's rounds, as Parquet in the folder that driver and executors share.

A checkpoint carries its plan's size estimate on, and a join's estimate is a product, so
in a loop of joins the numbers themselves grow without bound. A table that is read
again has the size of its files. It survives a lost executor like a checkpoint.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or a folder of the warehouse where that is unset."""
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(named or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/checkpoints")
    return named or sc.getCheckpointDir()


class Scratch:
    """Tables by one folder; those that no later step reads can be dropped, the others stay as checkpoints do."""

    def __init__(self, spark: SparkSession):
        self.spark, self.root, self.held = spark, f"{shared_dir(spark).rstrip('/')}/tables-{uuid.uuid4().hex}", []

    def put(self, df: DataFrame) -> DataFrame:
        path = f"{self.root}/{len(self.held)}"
        df.write.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        self.held.append((out, path))
        return out

    def drop(self, *frames: DataFrame | None) -> None:
        """Deletes tables. A folder that this process can't reach stays."""
        from pyarrow import fs

        gone = {id(f) for f in frames if f is not None}
        for k, (frame, path) in enumerate(self.held):
            if id(frame) in gone:
                self.held[k] = (None, path)
                try:
                    system, where = fs.FileSystem.from_uri(path if "://" in path else "file://" + path.removeprefix("file:"))
                    system.delete_dir(where)
                except (OSError, ValueError):
                    pass
