"""Lifting many points: no sort of the points, no pairs of every point and piece, no numbers that only break ties."""

from __future__ import annotations

import random

import pytest

from markerloom.operators import joins as j
from markerloom.plans import fixtures, staging

FOLDER = "/root/testdata/sf0.001"


def test_many_pieces_are_met_by_a_hash(spark, monkeypatch):
    points = fixtures.fixture(spark, FOLDER, "map_markers", columns=("contig", "pos"))
    agp = fixtures.fixture(spark, FOLDER, "agp")
    want = sorted(map(tuple, j.liftover(points, agp).collect()), key=str)
    monkeypatch.setattr(j, "_HASHED", 0)
    monkeypatch.setattr(staging, "TASK_ROWS", 30)
    got = j.liftover(points, agp)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "ShuffledHashJoin" in plan and "SortMergeJoin" not in plan
    assert sorted(map(tuple, got.collect()), key=str) == want


@pytest.mark.parametrize("columns", [("contig", "pos"), ("lg", "male_cm", "female_cm"), ("contig", "pos", "lg"), ("contig",)])
def test_numbered_columns_alone_are_those_of_the_whole_table(spark, monkeypatch, columns):
    whole = fixtures.fixture(spark, FOLDER, "map_markers").select("marker_id", *columns)
    monkeypatch.setattr(staging, "TASK_ROWS", 500)
    staging._shared.clear()
    got = fixtures.fixture(spark, FOLDER, "map_markers", columns=columns).select("marker_id", *columns)
    assert got.count() == whole.count() and got.exceptAll(whole).isEmpty()
    text = got._jdf.queryExecution().optimizedPlan().toString()
    assert "l_shipdate" not in text and ("lg" in columns or "l_tax" not in text)


CHAINS = "id long, score long, tname string, tsize long, tstrand string, tstart long, tend long, qname string, qsize long, qstrand string, qstart long, qend long"


def test_the_best_chain_of_each_point_without_pairs(spark, monkeypatch):
    rng, chains, points = random.Random(5), [], []
    for k in range(400):
        start = rng.randint(0, 3 * j.BIN)
        end = start + rng.choice([0, 1, 500, 40_000, j.BIN, 2 * j.BIN])
        chains.append((k, rng.randint(1, 9), rng.choice(["a", "b", "\u00e4", None]), 9 * j.BIN, "+", start, end, f"q{rng.randint(0, 5)}", 9 * j.BIN, rng.choice("+-"), rng.randint(0, 99), 0))
    points = [(k, rng.choice(["a", "b", "\u00e4", "c", None]), rng.choice([None, *range(1, 3 * j.BIN, 4999)])) for k in range(1500)]
    points += points[:50]
    want = []
    for k, contig, pos in points:
        over = [c for c in chains if contig is not None and pos is not None and c[2] == contig and c[5] < pos <= c[6]]
        if over:
            c = min(over, key=lambda c: (-c[1], c[0]))
            at = c[10] + pos - 1 - c[5]
            want.append((k, contig, pos, c[7], c[8] - at if c[9] == "-" else at + 1))
    monkeypatch.setattr(j, "_BUCKET", 100)
    got = j.liftover_chain(spark.createDataFrame(points, "k long, contig string, pos long"), spark.createDataFrame(chains, CHAINS))
    assert sorted(map(tuple, got.collect())) == sorted(want) and len(want) > 500
    assert "Join" not in got._jdf.queryExecution().optimizedPlan().toString()


def test_the_query_numbers_no_chains(spark, same_as_sql):
    staging._shared.clear()
    same_as_sql("liftover_chain")
    assert not [key for key in staging._shared if "chain" in key]
