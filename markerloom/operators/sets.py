"""Sorts and set operations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def sort_desc(df: DataFrame, col: str, ties: str = "line") -> DataFrame:
    return df.orderBy(F.desc(col), ties)


def concat_tagged(tables: dict[str, DataFrame], tag: str = "source") -> DataFrame:
    """All tables one after another, each row with the name of its table."""
    out = None
    for name, df in tables.items():
        one = df.withColumn(tag, F.lit(name))
        out = one if out is None else out.unionByName(one)
    return out


def same_rows(a: DataFrame, b: DataFrame) -> DataFrame:
    """One row ``(n_a, n_b, same)``: whether two tables hold the same rows equally often.

    Each table is reduced to a count and two sums of row hashes, so nothing is shuffled but those.
    """
    columns = sorted(a.columns)
    fold = lambda df, n: df.agg(F.count("*").alias(f"n_{n}"), F.sum(F.xxhash64(*columns).cast("decimal(20,0)")).alias(f"h_{n}"), F.sum(F.xxhash64(F.lit(1), *columns).cast("decimal(20,0)")).alias(f"g_{n}")).withColumn("one", F.lit(1))
    joined = fold(a, "a").join(fold(b, "b"), "one")
    return joined.select("n_a", "n_b", (F.col("n_a").eqNullSafe(F.col("n_b")) & F.col("h_a").eqNullSafe(F.col("h_b")) & F.col("g_a").eqNullSafe(F.col("g_b"))).alias("same"))
