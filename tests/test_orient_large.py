"""Maps are turned by an exact sign, however large the sums of a group are."""

from __future__ import annotations

from decimal import Decimal

import numpy as np
from pyspark.sql import functions as F

from markerloom.operators.aggregates import orient_map


def test_sums_beyond_fourteen_digits(spark):
    rows = spark.range(4000).select(F.lit("a").alias("lg"), F.lit(1).alias("map_id"), (F.col("id") * 10**14).alias("pos"), (4 * 10.0**8 - F.col("id") * 10.0**5).alias("male_cm"), F.col("id").cast("double").alias("female_cm"))
    got = {r["pos"] // 10**14: (r["male_cm"], r["female_cm"]) for r in orient_map(rows).collect()}
    assert got == {k: (k * 10.0**5, 3999.0 - k) for k in range(4000)}


def test_sign_equals_exact_sums(spark):
    rng = np.random.default_rng(3)
    rows = []
    for g in range(60):
        far, n = int(rng.choice([0, -(10**9), 10**15])), int(rng.integers(1, 8))
        rows += [(g, 1, far + int(rng.integers(-4, 5)), None if rng.random() < 0.1 else int(rng.integers(-3, 4)) / 1000 + int(rng.choice([0, 10**6])), 0.5) for _ in range(n)]
    got = {}
    for r in orient_map(spark.createDataFrame(rows, "lg int, map_id int, pos bigint, male_cm double, female_cm double")).collect():
        got.setdefault(r["lg"], []).append((r["pos"], r["male_cm"]))
    for g in range(60):
        own = [(x, y) for lg, _, x, y, _ in rows if lg == g]
        known = [(x, int(Decimal(str(y)) * 1000)) for x, y in own if y is not None]
        n, top = len(known), max([y for _, y in own if y is not None], default=None)
        falls = n * sum(x * y for x, y in known) < sum(x for x, _ in known) * sum(y for _, y in known)
        want = [(x, round(top - y, 3) if falls and y is not None else y) for x, y in own]
        key = lambda r: (r[0], r[1] is None, r[1] or 0)
        assert sorted(got[g], key=key) == sorted(want, key=key)
