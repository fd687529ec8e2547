"""A component too large for a task is placed in phases of many steps, not in a round for every step."""

from __future__ import annotations

from markerloom.operators import iterative as it
from markerloom.plans.staging import Staging
from tests.test_link_propagation import plain, run


def test_a_long_order_takes_few_phases(spark, monkeypatch):
    names, put = [], Staging.put
    monkeypatch.setattr(Staging, "put", lambda self, df, name, **more: names.append(name) or put(self, df, name, **more))
    placements = [("s0", 1, 9, 0, 0), ("t", 2, 3, 0, 0)]
    links = [(1, f"s{k}", "+", f"s{k + 1}", "+", int(10**9 * 0.9**k)) for k in range(30)] + [(1, "t", "-", "s15", "-", 10**7)]
    assert run(spark, placements, links, component_rows=40) == plain(placements, links)
    assert names.count("now") < 10


def test_ends_of_links_are_shuffled_once(spark):
    links = spark.createDataFrame([(1, "a", "+", "b", "-", 5), (1, "a", "+", "b", "-", 2), (2, "b", "+", "a", "-", 4), (1, "a", "+", "a", "+", 9), (1, "b", "-", "c", "+", 0)], "file_no int, contig1 string, o1 string, contig2 string, o2 string, score long")
    ends = it._link_ends(links)
    assert sorted(map(tuple, ends.collect())) == [("a", "b", 2, 7.0), ("b", "a", 2, 7.0)]
    assert ends._jdf.queryExecution().executedPlan().toString().split("+- == Initial Plan ==")[0].count("Exchange") == 1
