"""Passes over pieces in several chromosomes: later ones read and write only what the one before touched."""

from __future__ import annotations

import random

import pytest

from markerloom.operators import iterative as it
from markerloom.operators.settling import Settling
from markerloom.plans.staging import Staging
from test_rounds import LA
from test_scans import neighbours, row_by_row


def test_passes_of_few_changes_write_few_rows(spark, monkeypatch):
    # a chain of pieces that settle one another, one a pass, among many rows that nothing changes
    data, line = [], 0
    for chromosome, score in ((1, 9), (2, 3)):
        for k in range(6):
            line += 1
            name = lambda i: f"m{i}" if i else f"u{chromosome}"
            data.append((line, name(k), 1, 10, "+", chromosome, 1, 1, 10, 10, name(k - 1) if k else "null", "paf" if k else "null", score if k else 0, "null", "null", 0, 0))
    data += [(line + k, f"x{k}", 1, 10, "+", 3, 1, 1, 10, 10, "null", "null", 0, "null", "null", 0, 0) for k in range(1, 2001)]
    written, put = [], Staging.put

    def counted(self, df, *args, **kwargs):
        back = put(self, df, *args, **kwargs)
        written.append(back.count())
        return back

    la = spark.createDataFrame(data, LA)
    monkeypatch.setattr(Staging, "put", counted)
    got = it.propagate(la)
    monkeypatch.undo()
    assert got.filter("chr = 2").count() == 1 and got.count() == len(data) - 5
    assert sum(n >= 2000 for n in written) <= 4 and sum(n for n in written if n < 2000) < 500


@pytest.mark.parametrize("seed", [11, 12])
def test_small_and_whole_passes_agree(spark, seed):
    data = neighbours(seed, 160)
    rng = random.Random(seed)
    data = [(*row[:5], rng.randint(1, 3), *row[6:]) for row in data]  # neighbours of other chromosomes everywhere
    want = data
    la = spark.createDataFrame(data, LA)
    small, whole = Settling(la, 2, False, few=1.0), Settling(la, 2, False, few=0.0)
    while (following := row_by_row(want)) != want:
        want = following
        for settling in (small, whole):
            assert settling.step()
            assert sorted(map(tuple, settling.df.collect())) == sorted(want)
    assert not small.step() and not whole.step()
    assert small.base.count() == len(data)  # no pass but the first was whole
