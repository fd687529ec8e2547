"""Buckets and partitions of the suffix-array dedup at any size, and many buckets in few partitions."""

import random

from markerloom.llm import suffix_dedup as sd


def test_plan_at_two_sizes():
    assert sd.bucket_plan(0, 8 << 20) == (0, sd.BLOCK) and sd.bucket_plan(8 << 20, 8 << 20) == (0, sd.BLOCK)
    assert sd.bucket_plan(30 * 10**9, 8 << 20) == (12, 4 << 20)
    bits, block = sd.bucket_plan(100 * 10**12, 8 << 20)
    assert bits == 20 and block == 64 << 20 and min(1 << bits, sd.PARTITIONS) == 20_000


def test_many_buckets_in_few_partitions_equal_one_bucket(spark):
    rng = random.Random(8)
    shared = ["".join(rng.choice("abcdefgh ") for _ in range(rng.randint(100, 300))) for _ in range(6)]
    texts = ["".join(rng.choice([rng.choice(shared), "".join(rng.choice("ijklmnop ") for _ in range(80))]) for _ in range(rng.randint(1, 5))) for _ in range(60)]
    docs = spark.createDataFrame([(k, t) for k, t in enumerate(texts)] + [(100, None), (101, texts[0])], "doc_id long, text string")
    found = lambda **sizes: sorted(map(tuple, sd.repeated_strings(docs, with_kept=False, **sizes).drop("kept").collect()))
    one = found(bucket_bytes=1 << 30)
    assert sum(r[2] for r in one) > 1000 and found(bucket_bytes=500, partitions=3) == one
