"""Pairs of markers of crowded classes are spread over tasks, every pair once."""

from __future__ import annotations

from pyspark.sql import functions as F

from markerloom.operators import linkage as lk


def test_one_class_spreads_over_tasks(spark):
    geno = spark.range(1500).select(F.col("id").alias("marker_id"), F.lit(0b1011001110).cast("bigint").alias("bits"))
    got = lk.pairwise_lod(geno, 10, 3, tile_rows=100)
    tasks = [r["n"] for r in got.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n")).collect()]
    assert sum(tasks) == 1500 * 1499 // 2 and max(tasks) < sum(tasks) / 4


def test_tiles_give_every_pair_once(spark):
    geno = spark.range(120).select(F.col("id").alias("marker_id"), F.when(F.col("id") % 5 == 0, F.lit(255)).otherwise(F.col("id") % 3).cast("bigint").alias("bits"))
    rows = lambda df: sorted(map(tuple, df.collect()))
    got, bits = rows(lk.pairwise_lod(geno, 16, 2, digits=6, tile_rows=7)), {r["marker_id"]: r["bits"] for r in geno.collect()}
    lods = lk._lod_table(16)
    apart = {(a, b): (bits[a] ^ bits[b]).bit_count() for a in bits for b in bits if a < b}
    assert got == sorted((a, b, round(lods[min(r, 16 - r)], 6)) for (a, b), r in apart.items() if lods[min(r, 16 - r)] >= 2)
