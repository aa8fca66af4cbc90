"""One session for all tests, and the driver's tables in DuckDB."""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
os.environ.setdefault("OMP_NUM_THREADS", "1")

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession

    session = (
        SparkSession.builder.master("local[4]")
        .appName("tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.checkpoint.dir", f"file://{tmp_path_factory.mktemp('shared')}")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


@pytest.fixture(scope="session")
def sf():
    return SF


def plain(value):
    """Values in one form, whichever engine they come from."""
    if value is None or value != value:
        return None
    if isinstance(value, bool) or type(value).__name__ == "bool_":
        return bool(value)
    if isinstance(value, (int, float)) or hasattr(value, "item"):
        return float(value)
    return str(value)


def same_rows(df, con, sql):
    """Assert that a DataFrame and a DuckDB query give the same rows under the same names."""
    a, b = df.toPandas(), con.execute(sql).df()
    assert sorted(a.columns) == sorted(b.columns)
    names = sorted(a.columns)
    rows = lambda d: sorted((tuple(None if str(v) in ("<NA>", "NaT") else plain(v) for v in r) for r in d[names].values.tolist()), key=repr)
    x, y = rows(a), rows(b)
    assert len(x) == len(y)
    assert x == y
