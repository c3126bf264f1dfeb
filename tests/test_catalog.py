"""Every query with SQL gives the SQL's rows, at the smallest size."""

import datetime
import math

import duckdb
import pytest

from sluice import catalog

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def db(sf):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return con


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else float(f"{v:.9g}")
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None).isoformat()
    return tuple(map(plain, v)) if isinstance(v, (list, tuple)) else v


CASES = {n: (catalog.QUERIES[n], q) for n, q in catalog.SQL.items()} | {f"example of {n}": x for n, x in catalog.EXAMPLES.items()}


@pytest.mark.parametrize("name", sorted(CASES))
def test_query(name, spark, sf, db):
    run, sql = CASES[name]
    df = run(spark, sf)
    result = db.execute(sql)
    columns = [c[0] for c in result.description]
    assert sorted(df.columns) == sorted(columns)
    mine = sorted((tuple(plain(r[c]) for c in columns) for r in df.collect()), key=repr)
    assert mine == sorted((tuple(map(plain, r)) for r in result.fetchall()), key=repr)


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - set(catalog.SQL)))
def test_rows_only(name, spark, sf):
    assert catalog.QUERIES[name](spark, sf).count() > 0


def test_every_query_reads_a_table(spark, tmp_path):
    """On a folder without tables none runs."""
    from pyspark.errors import AnalysisException

    for name, run in catalog.QUERIES.items():
        with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
            run(spark, str(tmp_path / "none"))
            pytest.fail(name)


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
