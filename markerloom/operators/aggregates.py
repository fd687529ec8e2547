"""Counts and statistics: contigs, groups, map extents, proximity tables, best by margin."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def contig_lengths(fasta: DataFrame) -> DataFrame:
    """Length per contig; the parts of a contig given on several rows add up, a null sequence is 0."""
    return fasta.groupBy("contig").agg(F.sum(F.coalesce(F.length("seq"), F.lit(0))).cast("bigint").alias("length"))


def lg_counts(markers: DataFrame) -> DataFrame:
    return markers.groupBy("lg").agg(F.count("*").alias("markers"))


def trim_counts(removed: DataFrame, n_lg: int) -> DataFrame:
    """Removed markers of every group from 1 to ``n_lg``, with 0 where there are none."""
    groups = removed.sparkSession.range(1, n_lg + 1).withColumnRenamed("id", "lg")
    counted = removed.groupBy("lg").agg(F.count("*").alias("n"))
    return groups.join(counted, "lg", "left").select("lg", F.coalesce("n", F.lit(0)).alias("removed"))


def map_extent(marey: DataFrame) -> DataFrame:
    """First and last position and the largest map position of either sex, per group and map."""
    return marey.groupBy("lg", "map_id").agg(F.min("pos").alias("first_pos"), F.max("pos").alias("last_pos"), F.max(F.greatest("male_cm", "female_cm")).alias("max_cm"))


def orient_map(marey: DataFrame) -> DataFrame:
    """Turn maps whose position falls as cM grows, so that both rise together.

    The sign of the covariance of position and the first cM column decides per group and map. It
    is summed as exact integers of thousandths, so it does not depend on the order of rows, and
    compared through whole means and what they leave, so no product of two sums has to fit. Rows
    without one of the two do not count.
    """
    whole = F.round(F.col("male_cm") * 1000).cast("decimal(18,0)")
    pos = F.when(whole.isNotNull(), F.col("pos")).cast("decimal(19,0)")
    both = F.when(pos.isNotNull(), whole)
    stats = marey.groupBy("lg", "map_id").agg(
        F.count(both).cast("decimal(18,0)").alias("n"), F.sum(pos * both).alias("xy"), F.sum(pos).alias("x"), F.sum(both).alias("y"), F.max("male_cm").alias("top_male"), F.max("female_cm").alias("top_female"),
    )
    wide = lambda c: c.cast("decimal(38,0)")
    for c in ("x", "y"):
        stats = stats.withColumn(f"{c}_mean", F.expr(f"CASE WHEN n > 0 THEN {c} DIV n END").cast("decimal(19,0)"))
        stats = stats.withColumn(f"{c}_rest", wide(F.col(c) - F.col(f"{c}_mean") * F.col("n")))
    # n * xy - x * y is n * less - x_rest * y_rest, and the rests are smaller than n
    less = wide(wide(F.col("xy") - wide(F.col("x_mean") * F.col("y"))) - wide(F.col("x_rest") * F.col("y_mean")))
    stats = stats.withColumn("less", less)
    falls = F.when(F.abs("less") >= F.col("n"), F.col("less") < 0).otherwise(wide(F.col("less") * F.col("n")) < wide(F.col("x_rest") * F.col("y_rest")))
    falling = stats.select("lg", "map_id", "top_male", "top_female", falls.alias("falls"))
    joined = marey.join(falling, ["lg", "map_id"])
    turn = lambda c, top: F.when(F.col("falls"), F.round(F.col(top) - F.col(c), 3)).otherwise(F.col(c)).alias(c)
    return joined.select("lg", "pos", "map_id", turn("male_cm", "top_male"), turn("female_cm", "top_female"))


def _diagonal(prox: DataFrame) -> DataFrame:
    return prox.filter("contig1 = contig2 AND pos1 = pos2").groupBy(F.col("contig1").alias("contig"), F.col("pos1").alias("pos")).agg(F.sum("weight").alias("s"))


def normalise_proximity(prox: DataFrame, mode: str = "max") -> DataFrame:
    """Scale weights by what either bin holds with itself; bins without such a row count as 0.

    ``max``: 200 / mean where both sums are at most half the mean, else 100 / larger sum.
    ``min``: 100 / mean where either sum is at most the mean, else 100 / smaller sum.
    A divisor of zero, as where no bin has weight with itself, gives null.
    """
    diagonal = _diagonal(prox)
    mean = F.broadcast(diagonal.agg(F.avg("s").alias("mean")).withColumn("one", F.lit(1)))
    side = lambda k: diagonal.select(F.col("contig").alias(f"contig{k}"), F.col("pos").alias(f"pos{k}"), F.col("s").alias(f"s{k}"))
    joined = prox.join(side(1), ["contig1", "pos1"], "left").join(side(2), ["contig2", "pos2"], "left").withColumn("one", F.lit(1)).join(mean, "one")
    s1, s2, avg = F.coalesce("s1", F.lit(0)), F.coalesce("s2", F.lit(0)), F.col("mean")
    if mode == "max":
        factor = F.when((s1 <= avg / 2) & (s2 <= avg / 2), F.try_divide(F.lit(200.0), avg)).otherwise(F.try_divide(F.lit(100.0), F.greatest(s1, s2)))
    elif mode == "min":
        factor = F.when((s1 <= avg) | (s2 <= avg), F.try_divide(F.lit(100.0), avg)).otherwise(F.try_divide(F.lit(100.0), F.least(s1, s2)))
    else:
        raise ValueError(mode)
    return joined.select("contig1", "pos1", "contig2", "pos2", (F.col("weight") * factor).alias("weight"))


def proximity_stats(prox: DataFrame) -> DataFrame:
    return _diagonal(prox).agg(F.avg("s").alias("mean"), F.stddev_samp("s").alias("sd"), F.min("s").alias("min"), F.max("s").alias("max"), F.count("*").alias("n"))


def assign_by_margin(scores: DataFrame, score_diff: float = 2, key: str = "piece", choice: str = "chr", score: str = "score") -> DataFrame:
    """The best choice of each key if its score is positive and leads by ``score_diff``.

    Scores of one (key, choice) are taken at their maximum. A missing second choice counts as 0,
    ties go to the later choice.
    """
    best = scores.groupBy(key, choice).agg(F.max(score).alias("score"))
    order = W.partitionBy(key).orderBy(F.desc("score"), F.desc(choice))
    ranked = best.withColumn("second", F.lead("score").over(order)).withColumn("rn", F.row_number().over(order)).filter("rn = 1")
    return ranked.filter((F.col("score") > 0) & (F.coalesce("second", F.lit(0)) + score_diff <= F.col("score"))).select(key, choice, "score")
