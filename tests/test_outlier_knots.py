"""The outlier filter's spline in groups that need many knots, against plain least squares."""

import numpy as np
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from markerloom.operators import windows as w


def basis(u, inner):
    """Every cubic B-spline of the knots at ``u``, by the recursion over degrees."""
    knots = np.unique(np.concatenate([[u.min(), u.max()], inner]))
    if len(knots) == 1:
        return np.ones((len(u), 1))
    t = np.concatenate([[knots[0]] * 3, knots, [knots[-1]] * 3])
    last = np.searchsorted(t, knots[-1]) - 1
    out = [((t[k] <= u) & ((u < t[k + 1]) | ((k == last) & (u == knots[-1])))).astype(float) for k in range(len(t) - 1)]
    for degree in (1, 2, 3):
        ratio = lambda a, b: a / b if b > 0 else 0 * a
        out = [ratio(u - t[k], t[k + degree] - t[k]) * out[k] + ratio(t[k + degree + 1] - u, t[k + degree + 1] - t[k + 1]) * out[k + 1] for k in range(len(out) - 1)]
    return np.column_stack(out)


def fitted(u, y, size):
    count = max(1, round(len(u) / size))
    columns = basis(u, np.quantile(u, np.arange(1, count + 1) / (count + 1)))
    return y - columns @ np.linalg.lstsq(columns, y, rcond=1e-12)[0]


def test_residuals_match_least_squares(spark):
    rng = np.random.default_rng(1)
    data = []
    for g, n in (("a", 7000), ("b", 260), ("c", 3), ("d", 1), ("e", 400)):
        x = rng.integers(0, 10**6, n) if g != "e" else rng.integers(0, 4, n)
        data += [(g, int(p), float(np.sin(p / 20000) * 30 + rng.normal())) for p in x]
    df = spark.createDataFrame(data, "lg string, pos long, cm double").withColumn("n", F.count("*").over(W.partitionBy("lg"))).withColumn("u", F.col("pos") / 1e6)
    got = w._with_residual(df, "lg", "cm", 100, "r").toPandas()
    assert len(got) == len(data)
    for _, part in got.groupby("lg"):
        part = part.sort_values(["pos", "cm"])
        assert np.allclose(part["r"], fitted(part["u"].to_numpy(), part["cm"].to_numpy(), 100), atol=1e-5)


def test_outliers_are_found_in_long_groups(spark):
    data = [("L", k * 100, 20.0 * (k % 600 if k % 600 < 300 else 600 - k % 600) / 300 + (6.0 if k == 15100 else 0.0) + 0.05 * (k % 3)) for k in range(30000)]
    got = {r.pos: r.qc for r in w.filter_outliers(spark.createDataFrame(data, "lg string, pos long, male_cm double")).collect()}
    assert len(got) == 30000 and got[1510000] == "FAIL" and sum(q == "FAIL" for p, q in got.items() if abs(p - 1510000) > 10000) < 3000
