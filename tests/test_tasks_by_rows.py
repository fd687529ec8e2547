"""Large tables are dealt to as many tasks as their rows need, whatever the session's number of partitions."""

from __future__ import annotations

from pyspark.sql import functions as F

from markerloom.operators import windows as w
from markerloom.plans import staging


def test_trimming_takes_as_many_ranges_as_rows_need(spark, monkeypatch):
    rows = spark.range(600).select(F.col("id").alias("marker_id"), (F.col("id") % 2).alias("lg"), (F.col("id") * 37 % 599 / 10).alias("male_cm"), (F.col("id") * 5 % 601 / 10).alias("female_cm"))
    trim = lambda: w.trim_edges(rows, 5, 20, "lg", ("male_cm", "marker_id"))
    want = sorted(map(tuple, trim().collect()))
    made = []
    monkeypatch.setattr(staging, "TASK_ROWS", 50)
    put = staging.Staging.put
    monkeypatch.setattr(staging.Staging, "put", lambda self, df, name, **more: made.append((name, put(self, df, name, **more))) or made[-1][1])
    assert sorted(map(tuple, trim().collect())) == want
    dealt = dict(made)["dealt"]
    assert dealt.select("_range").distinct().count() > 8


def test_intervals_take_as_many_tasks_as_markers_need(spark, monkeypatch):
    rows = spark.range(600).select(F.concat(F.lit("c"), F.col("id") % 30).alias("contig"), F.col("id").alias("pos"), (F.col("id") * 7 % 5).alias("chr"), F.col("id").alias("line"))
    want = sorted(map(tuple, w.marker_intervals(rows).collect()))
    monkeypatch.setattr(staging, "TASK_ROWS", 50)
    got = w.marker_intervals(rows)
    assert sorted(map(tuple, got.collect())) == want
    assert "RepartitionByExpression [contig" in got._jdf.queryExecution().optimizedPlan().toString() and got.rdd.getNumPartitions() > 8
