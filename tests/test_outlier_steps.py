"""The outlier filter deals out its rows once at first and once a spline, and keeps rows without a group."""

from __future__ import annotations

from markerloom.operators import windows as w
from markerloom.plans.staging import Staging


def test_rows_are_dealt_out_three_times(spark, monkeypatch):
    names, put = [], Staging.put
    monkeypatch.setattr(Staging, "put", lambda self, df, name, **more: names.append(name) or put(self, df, name, **more))
    data = [("a" if k % 3 else None, k * 7 % 1000, float(k % 11)) for k in range(900)] + [("a", None, 1.0)]
    got = w.filter_outliers(spark.createDataFrame(data, "lg string, pos long, male_cm double")).collect()
    assert names.count("dealt") == 3 and "points" not in names
    assert sorted((r.lg or "", r.pos or 0, r.male_cm) for r in got) == sorted((g or "", p or 0, c) for g, p, c in data)
    assert all(r.penalty is not None for r in got if r.lg and r.pos is not None)
