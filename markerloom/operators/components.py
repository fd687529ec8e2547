"""Connected components of an edge table by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from markerloom.plans.staging import Staging


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select(F.col("hi").alias("u"), F.col("lo").alias("v")).unionAll(edges.select(F.col("lo").alias("u"), F.col("hi").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("v")).select("u", F.least("u", "v").alias("m"))
    return both.join(least, "u").filter(F.col("v") > F.col("u")).select(F.col("v").alias("hi"), F.col("m").alias("lo")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("hi").agg(F.min("lo").alias("m"))
    moved = edges.join(least, "hi").filter(F.col("lo") != F.col("m")).select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
    return moved.unionAll(least.select("hi", F.col("m").alias("lo"))).distinct()


def connected_components(edges: DataFrame, src: str = "src", dst: str = "dst", max_rounds: int = 60) -> DataFrame:
    """``(node, component)`` for every end of an edge; a component is named by its smallest node.

    Each round hangs neighbours below the smallest node they know (large star, small star); the
    number of rounds grows with the logarithm of the longest chain. Hubs are met by a partial
    aggregate and a join that adaptive execution can split, never by collecting neighbours.
    Null ends and self loops are ignored; repeated edges count once; no edges give no rows.
    """
    spark = edges.sparkSession
    staging = Staging(spark, "components")
    work = edges.select(F.greatest(src, dst).alias("hi"), F.least(src, dst).alias("lo")).filter(F.col(src).isNotNull() & F.col(dst).isNotNull() & (F.col(src) != F.col(dst)))
    current = staging.put(work.distinct(), "edges")
    # a sum of decimals cannot overflow, and ANSI mode would raise on longs
    mark = lambda df: df.agg(F.count("*"), F.sum(F.xxhash64("hi", "lo").cast("decimal(20,0)"))).first()
    before = mark(current)
    for _ in range(max_rounds):
        if not before[0]:
            break
        following = staging.put(_small_star(_large_star(current)), "edges")
        after = mark(following)
        staging.drop(current)
        current = following
        if after == before:
            break
        before = after
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    roots = current.select(F.col("lo").alias("node"), F.col("lo").alias("component")).distinct()
    return current.select(F.col("hi").alias("node"), F.col("lo").alias("component")).unionAll(roots)
