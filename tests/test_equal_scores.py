"""Chains of equal score and target are numbered as their SQL does: by query before start."""

from __future__ import annotations

import os

import duckdb
import pytest

from tests.conftest import rows_of

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["swap_chain", "read_chain", "reciprocal_best"])
def test_same_as_sql_with_few_prices(spark, tmp_path, name):
    import __spark_entry__ as entry

    con = duckdb.connect()
    for table in ("lineitem", "part"):
        few = "* REPLACE (1000 * (l_orderkey % 3 + 1) AS l_extendedprice, l_partkey % 20 AS l_partkey)" if table == "lineitem" else "*"
        con.execute(f"COPY (SELECT {few} FROM '{FOLDER}/{table}.parquet') TO '{tmp_path}/{table}.parquet'")
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{tmp_path}/{table}.parquet'")
    got = entry.queries()[name](spark, os.fspath(tmp_path)).toPandas()
    assert rows_of(got) == rows_of(con.execute(entry.oracle_sql()[name]).fetchdf())
