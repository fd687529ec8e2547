"""Sharding: against plain prefix sums, with odd rows."""

import zlib

import pytest

from markerloom.llm import sharding

SCHEMA = "doc_id long, text string, size string, shard long"


def plain(data, n, header=16):
    """Shard of every row of a list, by one walk along the global order."""
    rows = sorted(((i is not None, i or 0), len((t or "").encode()) + header, zlib.crc32((t or "").encode())) for i, t, *_ in data)
    total, upto, slots, out = sum(r[1] for r in rows), 0, {}, []
    for (known, i), size, crc in rows:
        upto += size
        shard = min(n - 1, (2 * upto - size) * n // (2 * total))
        out.append((i if known else None, size, crc, shard, slots.get(shard, 0)))
        slots[shard] = slots.get(shard, 0) + 1
    return out


def found(df):
    return [tuple(r) for r in df.select("doc_id", "size", "text_crc32", "shard", "slot").collect()]


@pytest.mark.parametrize("n", [1, 4, 40])
def test_equals_prefix_sums(spark, n):
    data = [(k * 7 % 301, "wörd " * (k % 23), "x", 9) for k in range(301)]
    data += [(None, "no id", "x", 1), (None, None, None, None), (5, "", "", 0), (5, "", "", 0), (-3, "z" * 20000, None, 1)]
    got = found(sharding.assign_shards(spark.createDataFrame(data, SCHEMA).repartition(7), n))
    assert sorted(got, key=str) == sorted(plain(data, n), key=str)


def test_balance_and_hot_rows(spark):
    data = [(k, "abc " * (k % 50), "x", 1) for k in range(3000)] + [(1, "same", "x", 1)] * 1500
    got = found(sharding.assign_shards(spark.createDataFrame(data, SCHEMA).repartition(5)))
    by = {}
    for _, size, _, shard, slot in got:
        by.setdefault(shard, []).append((slot, size))
    sizes = [sum(s for _, s in v) for v in by.values()]
    assert sorted(by) == list(range(40)) and max(sizes) - min(sizes) <= 2 * (50 * 4 + 16)
    assert all(sorted(s for s, _ in v) == list(range(len(v))) for v in by.values())


def test_empty_and_files(spark, tmp_path):
    assert found(sharding.assign_shards(spark.createDataFrame([], SCHEMA))) == []
    data = [(k, f"text {k} " * (k % 9), str(k), 3) for k in range(200)] + [(None, None, None, None)]
    docs = spark.createDataFrame(data, SCHEMA)
    sharding.write_shards(docs, str(tmp_path / "out"), 8)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert sorted(map(tuple, back.select("doc.*").collect()), key=str) == sorted(data, key=str)
    assert sorted(map(tuple, back.select("doc.doc_id", "shard_no", "slot").collect()), key=str) == sorted(((r[0], r[3], r[4]) for r in plain(data, 8)), key=str)
