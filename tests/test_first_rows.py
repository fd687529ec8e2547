"""A round of greedy picks writes the rows it takes and those left, not every row judged."""

from __future__ import annotations

import random

from markerloom.operators import iterative as it
from markerloom.plans import registry
from markerloom.plans.staging import Staging

ROWS = "turn bigint, a string, b string, take string"


def test_a_round_writes_no_row_twice(spark, monkeypatch):
    written, put = [], Staging.put

    def counted(self, df, *args, **kwargs):
        back = put(self, df, *args, **kwargs)
        written.append(back.count())
        return back

    rows = spark.createDataFrame([(k, f"a{k}", f"b{k}", f"a{k}") for k in range(300)], ROWS)
    monkeypatch.setattr(Staging, "put", counted)
    got = it._accepted(rows, 500_000)
    monkeypatch.undo()
    assert got.count() == 300 and sum(written) <= 600


def test_rows_whose_ends_are_one(spark):
    rng = random.Random(5)
    data = [(k, *(ends := (f"c{rng.randint(0, 30)}", f"c{rng.randint(0, 30)}")), rng.choice(ends)) for k in range(200)]
    data += [(200 + k, f"s{k}", f"s{k}", f"s{k}") for k in range(5)]
    taken, want = set(), []
    for turn, a, b, take in data:
        if a not in taken and b not in taken:
            taken.add(take)
            want.append(turn)
    for component_rows in (500_000, 0):
        assert sorted(r.turn for r in it._accepted(spark.createDataFrame(data, ROWS), component_rows).collect()) == want


def test_records_are_the_chains(spark):
    folder = "/root/testdata/sf0.001"
    chain = registry.fx(spark, folder, "chain", numbered=False).selectExpr("CAST(score / 1000 AS BIGINT) AS score", "tname AS contig", "CAST(1 AS BIGINT) AS start", "tsize AS end", "qname AS partner")
    got = registry._records(spark, folder)
    assert got.dtypes == chain.dtypes and sorted(map(tuple, got.collect())) == sorted(map(tuple, chain.collect()))
    joined = got._jdf.queryExecution().optimizedPlan().toString()
    assert joined.index("Join Inner") < joined.index("Join LeftSemi")  # the outer join is that with the contig
