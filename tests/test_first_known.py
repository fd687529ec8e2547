"""The first known row of every group, without dealing out the rows behind it."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from markerloom.operators import iterative as it
from markerloom.operators import joins as j
from markerloom.plans import registry

FOLDER = "/root/testdata/sf0.001"


def test_first_known_equals_a_plain_loop(spark):
    rng = random.Random(11)
    data = [(rng.randint(0, 40), rng.randint(0, 5), f"k{rng.randint(0, 30)}", n) for n in range(600)]
    data += [(50, 9, "k1", 600), (50, 8, "x", 601), (51, 9, "x", 602), (None, 9, "k1", 603), (52, 9, None, 604), (52, 1, "k2", 605)]
    rows = spark.createDataFrame(data, "g int, score int, k string, n int").repartition(5)
    for known in ({f"k{i}" for i in range(31)}, {f"k{i}" for i in range(0, 31, 3)}, {"k2"}, set()):
        listed = spark.createDataFrame([(k,) for k in known for _ in range(2)] + [(None,)], "k string")  # repeated, one null
        want: dict[int, tuple] = {}
        for g, score, k, n in data:
            if g is not None and k in known:
                want[g] = min(want.get(g, (1, "", 0)), (-score, k, n))
        got = j.first_known(rows, listed, "g", [F.desc("score"), "k", "n"], "k")
        assert got.columns == rows.columns
        assert sorted((r.g, -r.score, r.k, r.n) for r in got.collect()) == sorted((g, *first) for g, first in want.items())


def test_scored_haplotypes_deals_the_best_records_alone(spark, monkeypatch):
    given, scored = [], it.scored_haplotypes
    monkeypatch.setattr(it, "scored_haplotypes", lambda records: given.append(records) or scored(records))
    got = sorted(map(tuple, registry.QUERIES["scored_haplotypes"](spark, FOLDER).collect()))
    assert got and got == sorted(map(tuple, scored(registry._records(spark, FOLDER)).collect()))
    best = given[0]
    assert best.count() == best.select("contig").distinct().count()
    assert not [f for f in best.inputFiles() if "lineitem" in f]  # all were settled by the first row of their contig
