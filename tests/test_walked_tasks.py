"""Components that are walked in order are spread over tasks, also where their rows are few bytes."""

from __future__ import annotations

from markerloom.operators import iterative as it


def test_components_are_walked_in_several_tasks(spark):
    rows = [(c * 30 + i, f"{c}-{i}", f"{c}-{i + 1}", f"{c}-{i + 1}") for c in range(40) for i in range(30)]
    got = it._accepted(spark.createDataFrame(rows, "turn bigint, a string, b string, take string"), 500_000)
    assert sorted(r.turn for r in got.collect()) == [c * 30 + i for c in range(40) for i in range(0, 30, 2)]
    assert len([f for f in got.inputFiles() if "walked" in f]) > 1
