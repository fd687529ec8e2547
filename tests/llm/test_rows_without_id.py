"""Rows without id, ids of several texts and rows that repeat each other, in the operators that key by id."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from markerloom.llm import embedding_dedup, language_id, ngram_join, packing, quality
from markerloom.llm.blocks import hash_sample

DOCS = "doc_id long, text string"


def classes(spark, data):
    df = spark.createDataFrame(data, DOCS)
    return sorted(map(tuple, ngram_join.jaccard_classes(df).select("doc_id", "n_shingles", "component_id").collect()), key=str)


def test_near_copies_without_id_link(spark):
    words = [f"w{k}" for k in range(61)]
    one, two, three = " ".join(words), " ".join([*words[:-1], "other"]), " ".join(["first", *words[1:]])
    assert classes(spark, [(1, one), (None, two), (None, three)]) == [(1, 57, 1), (None, 57, 1), (None, 57, 1)]
    # without any id the two are one component without a name; what joins two documents need not have one
    assert classes(spark, [(None, two), (None, three)]) == [(None, 57, None)] * 2
    # 11 words of 61 changed at either end: the middle one links with both, they not with each other
    far = [" ".join([f"a{k}" for k in range(8)] + words[8:]), one, " ".join(words[:-8] + [f"b{k}" for k in range(8)])]
    assert classes(spark, [(9, far[0]), (None, far[1]), (4, far[2])]) == [(4, 57, 4), (9, 57, 4), (None, 57, 4)]


def test_two_texts_under_one_id(spark):
    a, b = " ".join(f"a{k}" for k in range(40)), " ".join(f"b{k}" for k in range(40))
    near = a.replace("a39", "z")
    assert classes(spark, [(5, a), (5, b), (7, near), (8, b + " more")]) == [(5, 36, 5), (5, 36, 5), (7, 36, 5), (8, 37, 5)]


@pytest.mark.parametrize("seed", [1, 2])
def test_random_rows_equal_all_pairs(spark, seed):
    rng = random.Random(seed)
    bases = [[f"{c}{k}" for k in range(30)] for c in "abcd"]
    data = []
    for k in range(120):
        words = list(rng.choice(bases))
        for _ in range(rng.randint(0, 3)):
            words[rng.randrange(30)] = f"x{rng.randint(0, 3)}"
        data.append((rng.choice([k, k, None, rng.randint(0, 20)]), " ".join(words)))
    sets = [{tuple(t.split()[i : i + 5]) for i in range(26)} for _, t in data]
    part = list(range(len(data)))
    for i in range(len(data)):
        for j in range(i):
            if 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
                low, high = sorted((part[i], part[j]))
                part = [low if p == high else p for p in part]
    names = {}
    for p, (i, _) in zip(part, data):
        names[p] = min((x for x in (names.get(p), i) if x is not None), default=None)
    want = sorted(((i, len(s), names[p]) for (i, _), s, p in zip(data, sets, part)), key=str)
    assert classes(spark, data) == want


def test_very_short_and_long_vectors_link(spark):
    rows = [(1, [1e-200, 2e-200], 1), (2, [1.0, 2.0], 1), (3, [1e200, 2e200], 1), (4, [5e-324, 1e-323], 1), (5, [2.0, -1.0], 1), (6, [0.0, 0.0], 1)]
    got = embedding_dedup.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int"))
    assert sorted(map(tuple, got.select("vec_id", "n_links", "component_id").collect())) == [(1, 3, 1), (2, 3, 1), (3, 3, 1), (4, 3, 1), (5, 0, 5), (6, 0, 6)]
    x = np.array([[3.0, -5.0], [1e-310, 0.0]])
    assert (np.abs(embedding_dedup.even_sized(x)).max(axis=1) >= 0.5).all()


def test_held_out_is_never_null(spark, tmp_path):
    folder = str(tmp_path)
    spark.createDataFrame([(None, "some words here", "en", "a", 3), (None, None, None, None, None), (4, "andere worte hier", "de", "a", 3)], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(4, 1, 0), (None, 0, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    for query in (language_id.op7_language_id, quality.op10_quality):
        rows = query(spark, folder).collect()
        assert len(rows) == 3 and all(r.held_out is not None for r in rows) and not any(r.held_out for r in rows if r.doc_id is None)


def test_repeated_rows_spread_over_shards(spark):
    docs = spark.range(6000).select(F.lit(None).cast("bigint").alias("doc_id"), F.lit("").alias("text"))
    got = packing.pack(docs, shard_pieces=500)
    shards = got.groupBy(F.shiftright("sequence_id", 32)).count().collect()
    assert len(shards) == 12 and max(r["count"] for r in shards) < 800 and got.count() == 6000
    assert got.groupBy("sequence_id").agg(F.sum("length").alias("n"), F.max(F.col("offset") + F.col("length")).alias("end")).filter("n <> end OR n > 4096").count() == 0


def test_sample_of_repeated_ids_is_the_same_again(spark):
    df = spark.createDataFrame([(1, f"t{k}") for k in range(50)], DOCS)
    got = {tuple(sorted(r.text for r in hash_sample(df.repartition(k), "doc_id", 3).collect())) for k in (1, 3, 7)}
    assert got == {("t0", "t1", "t10")}
