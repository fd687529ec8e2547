"""Numbered fixtures sort and write what their columns follow from; unnumbered ones sort nothing."""

from __future__ import annotations

import pytest

from markerloom.operators.numbering import with_row_number
from markerloom.plans import fixtures

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["map_markers", "chain"])
def test_same_rows_from_narrow_ones(spark, name):
    number, order, extra = fixtures.NUMBERED[name]
    got = fixtures.fixture(spark, FOLDER, name)
    sql = fixtures._TABLES.sub(lambda m: f"{m[1]} parquet.`{FOLDER}/{m[2]}.parquet`", fixtures.SQL[name])
    want = with_row_number(spark.sql(sql), order, number).drop(*extra)
    assert got.dtypes == want.dtypes and got.exceptAll(want).isEmpty() and got.count() == want.count()


def test_counting_groups_sorts_nothing(spark):
    import __spark_entry__ as entry

    plan = entry.queries()["lg_counts"](spark, FOLDER)._jdf.queryExecution().optimizedPlan().toString()
    assert "l_tax" in plan and "_place" not in plan and "marker_id" not in plan
