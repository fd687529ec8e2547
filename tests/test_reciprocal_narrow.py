"""Reciprocal best chains come from aggregates over names, scores and ids, not from sorted whole rows."""

from __future__ import annotations

import random

from markerloom.operators.joins import reciprocal_best


def test_equals_a_walk_and_sorts_no_whole_rows(spark):
    rng = random.Random(4)
    rows = [(k, rng.choice([9999, 10000, 10001, 20000]), f"a{rng.randint(0, 9)}", f"a{rng.randint(0, 9)}", "x" * k) for k in range(150)]
    got = reciprocal_best(spark.createDataFrame(rows, "id bigint, score bigint, tname string, qname string, note string"))
    kept = sorted((r for r in rows if r[1] >= 10000 and r[2] != r[3]), key=lambda r: (-r[1], r[0]))
    first = lambda c: {r[c]: r[0] for r in reversed(kept)}
    t, q = first(2), first(3)
    assert sorted(map(tuple, got.collect())) == sorted(r for r in kept if t[r[2]] == r[0] == q[r[3]])
    assert "Window" not in got._jdf.queryExecution().optimizedPlan().toString()
