"""Queries of the record operators and their SQL, by name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}
#: Examples over literal rows, for tests: name to (function of spark, SQL). They are no queries, for their work never grows.
EXAMPLES: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str]] = {}


def query(sql: str | None = None, name: str | None = None):
    """Registers a function (spark, sf_dir) as a query, with its SQL."""

    def put(f):
        key = name or f.__name__
        QUERIES[key] = f
        if sql is not None:
            SQL[key] = sql
        return f

    return put


def example(sql: str, name: str | None = None):
    """Registers a function (spark, sf_dir) over literal rows as an example, with its SQL."""

    def put(f):
        EXAMPLES[name or f.__name__] = (f, sql)
        return f

    return put


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def inline(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    return spark.createDataFrame(rows, schema)


def _literal(v) -> str:
    if v is None:
        return "NULL"
    if isinstance(v, bool):
        return "TRUE" if v else "FALSE"
    if isinstance(v, (list, tuple)):
        return "[" + ", ".join(map(_literal, v)) + "]"
    if isinstance(v, float):
        return f"CAST({v!r} AS DOUBLE)"
    return repr(v) if isinstance(v, int) else "'" + str(v).replace("'", "''") + "'"


def values(rows: list[tuple], names: str) -> str:
    """The same rows as a table expression of standard SQL."""
    return "(VALUES " + ", ".join("(" + ", ".join(map(_literal, r)) + ")" for r in rows) + ") AS t(" + ", ".join('"' + n.strip().strip('"') + '"' for n in names.split(",")) + ")"


from sluice.plans import queries_records, queries_shaped, queries_tables, queries_values  # noqa: E402, F401
