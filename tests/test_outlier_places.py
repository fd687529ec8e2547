"""The outlier filter sorts its rows once: a row's place tells its stretch between knots, for both splines."""

from __future__ import annotations

import pytest

from markerloom.operators import windows as w
from markerloom.plans.staging import Staging
from tests.conftest import rows_of

DATA = [("ab"[k % 2], k * 7919 % 40000 if k % 50 else None, float(k % 11) + k * 0.01) for k in range(6000)] + [(None, 5, 1.0), ("c", 3, 2.0)]


@pytest.fixture
def frame(spark):
    return spark.createDataFrame(DATA, "lg string, pos long, male_cm double")


def test_whole_rows_are_dealt_once(frame, monkeypatch):
    sizes, put = [], Staging.put

    def counted(self, df, name, **more):
        out = put(self, df, name, **more)
        sizes.append(out.count() if name == "dealt" else 0)
        return out

    monkeypatch.setattr(Staging, "put", counted)
    w.filter_outliers(frame)
    assert sum(n >= len(DATA) for n in sizes) == 1


def test_same_rows_where_stretches_are_dealt_out(frame, monkeypatch):
    want = rows_of(w.filter_outliers(frame).toPandas())
    monkeypatch.setattr(w, "_BROADCAST", 0)
    assert rows_of(w.filter_outliers(frame).toPandas()) == want
