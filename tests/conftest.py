import os
import sys

import numpy as np
import pandas as pd
import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
os.environ["PYTHONPATH"] = os.pathsep.join(filter(None, [ROOT, os.environ.get("PYTHONPATH", "")]))


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    session = (
        SparkSession.builder.master("local[4]").appName("tests")
        .config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false").config("spark.driver.memory", "4g")
        .config("spark.sql.session.timeZone", "UTC").config("spark.ui.showConsoleProgress", "false").getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def duck():
    """DuckDB with the smallest tables as views."""
    import duckdb

    folder = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for name in os.listdir(folder):
        con.execute(f"CREATE VIEW {name.removesuffix('.parquet')} AS SELECT * FROM '{folder}/{name}'")
    return con


def _cell(v):
    """A value as text: whole numbers alike whatever their type, doubles to six digits."""
    if np.ndim(v) == 0 and pd.isna(v):
        return None
    if isinstance(v, (float, np.floating)):
        return str(int(v)) if float(v).is_integer() else repr(round(float(v), 6))
    return str(v)


def rows_of(frame):
    """Rows of a pandas frame as sorted tuples of texts."""
    frame = frame[sorted(frame.columns)]
    return sorted((tuple(map(_cell, row)) for row in frame.astype(object).itertuples(index=False, name=None)), key=str)


@pytest.fixture(scope="session")
def same_as_sql(spark, duck):
    """Check a registered query on the smallest tables against its SQL."""

    def check(name):
        import __spark_entry__ as entry

        got = entry.queries()[name](spark, "/root/testdata/sf0.001").toPandas()
        want = duck.execute(entry.oracle_sql()[name]).fetchdf()
        assert sorted(got.columns) == sorted(want.columns)
        assert rows_of(got) == rows_of(want)

    return check
