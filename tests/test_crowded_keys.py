"""Pairs inside crowded keys: every pair once, spread over tiles; fixtures numbered once a session."""

import itertools
import random

from pyspark.sql import functions as F

from markerloom.operators import joins as j
from markerloom.plans import fixtures, staging


def rows(df):
    return sorted(map(tuple, df.collect()))


def test_pairs_of_crowded_keys_equal_all_pairs(spark):
    rng = random.Random(2)
    data = [("hot", k) for k in range(90)] + [(f"r{rng.randint(0, 20)}", k) for k in range(100, 180)] + [(None, 5), (None, 6)]
    df = spark.createDataFrame(data, "key string, at int").repartition(5)
    want = sorted((k, a, b) for k in {k for k, _ in data if k} for a, b in itertools.combinations(sorted(x for y, x in data if y == k), 2))
    for tile_rows in (7, 1000):
        got = j.pairs_within(df, "key", ["at"], tile_rows).select("a.key", F.col("a.at").alias("x"), F.col("b.at").alias("y"))
        assert rows(got) == want


def test_one_barcode_spreads_over_tasks(spark):
    held = spark.range(5000).select(F.lit("u").alias("umi"), F.lit("c").alias("contig"), (F.col("id") * 10000 + 1).alias("pos"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        pairs = j.pairs_within(held.select("umi", "contig", "pos"), "umi", ["contig", "pos"], 500).withColumn("task", F.spark_partition_id())
        sizes = [r["count"] for r in pairs.groupBy("task").count().collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sum(sizes) == 5000 * 4999 // 2 and len(sizes) >= 4 and max(sizes) < 0.6 * sum(sizes)


def test_links_of_a_crowded_read_do_not_depend_on_tiles(spark):
    paf = spark.createDataFrame([("r", 9000, k * 50, k * 50 + 80, "+-"[k % 2], f"c{k % 4}", 9000, k * 31, k * 31 + 80, 60, 10) for k in range(40)], "qname string, qlen long, qstart long, qend long, strand string, tname string, tlen long, tstart long, tend long, mapq long, as_score long")
    assert rows(j.longread_links(paf, tile_rows=6)) == rows(j.longread_links(paf))
    sam = paf.select(F.col("qname").alias("read"), F.col("tname").alias("contig"), F.col("tstart").alias("pos"), "mapq", F.col("qstart").alias("line"))
    assert rows(j.hic_pairs(sam, tile_rows=6)) == rows(j.hic_pairs(sam))


def test_overlapping_and_disjoint_pieces_lift_alike(spark):
    agp = [("o1", 1, 100, 1, "W", "c", 1, 100, "+"), ("o2", 1, 50, 1, "W", "d", 1, 50, "-")]
    kinds = "obj string, obj_beg long, obj_end long, part_no long, ctype string, contig string, contig_beg long, contig_end long, orientation string"
    points = spark.createDataFrame([("c", 1), ("c", 77), ("c", 101), ("d", 50), ("e", 1)], "contig string, pos long")
    plain = rows(j.liftover(points, spark.createDataFrame(agp, kinds)).fillna({"lifted_name": "", "lifted_pos": 0}))
    # a later piece that covers the same stretch changes nothing but the way it is found
    more = rows(j.liftover(points, spark.createDataFrame([*agp, ("o9", 1, 30, 1, "W", "c", 50, 79, "+")], kinds)).fillna({"lifted_name": "", "lifted_pos": 0}))
    assert plain == more == [("c", 1, "o1", 1), ("c", 77, "o1", 77), ("c", 101, "", 0), ("d", 50, "o2", 1), ("e", 1, "", 0)]


def test_fixtures_are_numbered_once(spark):
    one, two = (fixtures.fixture(spark, "/root/testdata/sf0.001", "map_markers") for _ in range(2))
    assert one is two
    staging.clear(spark)
    again = fixtures.fixture(spark, "/root/testdata/sf0.001", "map_markers")
    assert again is not one and again.count() == 6000
