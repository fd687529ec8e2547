"""Many small segments are chained in one call of Python, with the same rows as one by one."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from markerloom.operators import iterative as it


def test_calls_grow_with_buckets_not_with_segments(spark, monkeypatch):
    rng = random.Random(5)
    rows = []
    for k in range(300):
        q, strand = rng.randint(0, 50), rng.choice("+-")
        for j in range(rng.randint(1, 5)):
            t = 120 * j if strand == "+" else 900 - 120 * j
            q += rng.choice([100, 120, 95])
            rows.append((f"r{k}", 2000, q, q + 100, strand, f"c{k % 3}", 1000, t, t + 100 + rng.choice([0, 4]), 60, rng.randint(20, 200)))
    paf = spark.createDataFrame(rows, "qname string, qlen bigint, qstart bigint, qend bigint, strand string, tname string, tlen bigint, tstart bigint, tend bigint, mapq bigint, as_score bigint")
    counted, calls, single = spark.sparkContext.accumulator(0), spark.sparkContext.accumulator(0), it._chain_group

    def watched(frame, *costs):
        calls.add(1)
        counted.add(len(frame))
        return single(frame, *costs)

    monkeypatch.setattr(it, "_chain_group", watched)
    key = lambda df: sorted(map(tuple, df.collect()))
    many = key(it.chain_paf(paf))
    assert 0 < calls.value <= 1 + spark.sparkContext.defaultParallelism < counted.value
    one_by_one = [row for k in range(0, 300, 30) for row in key(it.chain_paf(paf.filter(F.col("qname") == f"r{k}")))]
    assert sorted(one_by_one) == [r for r in many if int(r[0][1:]) % 30 == 0]
    assert any(r[-1] > 1 for r in many)
