"""Pivots and reshaping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def lod_summary(maps: DataFrame, limits: list[int]) -> DataFrame:
    """Markers per group (rows) and LOD limit (columns ``lod_n``), missing ones 0, ordered by group."""
    wide = maps.groupBy("lg").pivot("lod", limits).agg(F.count(F.lit(1))).na.fill(0)
    return wide.select("lg", *[F.col(f"`{n}`").alias(f"lod_{n}") for n in limits]).orderBy("lg")


def map_summary(maps: DataFrame) -> DataFrame:
    """Markers per LOD limit and group in long form, with the share of the limit's markers."""
    counted = maps.groupBy("lod", "lg").agg(F.count("*").alias("markers"))
    total = F.sum("markers").over(W.partitionBy("lod"))
    return counted.select("lod", "lg", "markers", F.round(F.col("markers") / total, 6).alias("share"))


def recomb_summary(log: DataFrame, groups: list[int]) -> DataFrame:
    """Counts by (family, sample) and group (columns ``lg_n``), with mean (2 digits) and max."""
    summed = log.groupBy("family", "sample", "lg").agg(F.sum("n_recomb").alias("n"))
    each = [F.max(F.when(F.col("lg") == g, F.col("n"))).alias(f"lg_{g}") for g in groups]
    return summed.groupBy("family", "sample").agg(F.round(F.avg("n"), 2).alias("mean"), F.max("n").alias("max"), *each)


def build_pedigree(popmap: DataFrame) -> DataFrame:
    """Long pedigree ``(row_no, line, sample, value)`` of a population map in its line order.

    Rows: family, name, parent 1, parent 2, sex, zeros. The first two ``parent`` samples are the
    parents (sexes 1 and 2); their own parents are 0.
    """
    order = W.partitionBy("pop").orderBy("line")
    # the parents are two rows whatever the size of the table
    ranked = popmap.withColumn("rank", F.when(F.col("pop") == "parent", F.row_number().over(order)))
    parents = F.broadcast(ranked.filter("rank <= 2").agg(F.max(F.when(F.col("rank") == 1, F.col("sample"))).alias("p1"), F.max(F.when(F.col("rank") == 2, F.col("sample"))).alias("p2")).withColumn("one", F.lit(1)))
    full = ranked.withColumn("one", F.lit(1)).join(parents, "one")
    is_parent = F.col("pop") == "parent"
    values = F.array(F.lit("Family_1"), F.col("sample"), F.when(is_parent, "0").otherwise(F.col("p1")), F.when(is_parent, "0").otherwise(F.col("p2")), F.when(F.col("rank") == 1, "1").when(F.col("rank") == 2, "2").otherwise("0"), F.lit("0"))
    return full.select("line", "sample", F.posexplode(values).alias("row0", "value")).select((F.col("row0") + 1).alias("row_no"), "line", "sample", "value")


def transpose_table(cells: DataFrame) -> DataFrame:
    """Rows and columns of a long table ``(row, col, value)`` change places; ragged rows stay ragged."""
    return cells.select(F.col("col").alias("row"), F.col("row").alias("col"), "value")


def wide_table(cells: DataFrame, columns: list[int]) -> DataFrame:
    """One row per ``row`` with columns ``c_n``; cells that a ragged table lacks are null."""
    return cells.groupBy("row").agg(*[F.max(F.when(F.col("col") == c, F.col("value"))).alias(f"c_{c}") for c in columns])
