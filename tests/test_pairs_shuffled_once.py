"""Pairs of one read's alignments come from one shuffle of plain columns."""

from __future__ import annotations

import pytest

from markerloom.operators import joins as j


@pytest.mark.parametrize("tile_rows", [1000, 3])
def test_pairs_are_those_of_a_walk_from_one_shuffle(spark, tile_rows):
    data = [(f"r{k % 17}" if k % 23 else None, k, k * 7 % 11) for k in range(150)]
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = j.pairs_within(spark.createDataFrame(data, "read string, n int, v int"), "read", ["v", "n"], tile_rows).select("a.n", "b.n")
        found = sorted(map(tuple, got.collect()))
        plan = got._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    want = sorted((x[1], y[1]) for x in data for y in data if x[0] is not None and x[0] == y[0] and (x[2], x[1]) < (y[2], y[1]))
    assert found == want
    if tile_rows == 1000:
        final = plan.split("Initial Plan")[0]
        assert final.count("Exchange hashpartitioning") - final.count("ReusedExchange") <= 1 and "ReusedExchange" in final
