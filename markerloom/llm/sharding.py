"""Contiguous, balanced shards by prefix sums of byte sizes.

Documents stand in one global order (id, then size, checksum and place of arrival). Partitions are
ranges of that order; each reports its number of rows and bytes, the totals before it are its
offsets, and so every document knows how many bytes stand before it in the whole table. The bytes of
all documents are cut at equal targets: a document belongs to the shard in which its middle byte
falls. Shards are therefore runs of the global order, and each cut misses its target by half a
document at most.

Texts are read once and never shuffled: what is sorted are ids, sizes and checksums. A row's place
of arrival, fixed by a written table, comes last in the order, so that rows that repeat an id and its
text (a third of the table, say) still spread over many ranges.

Defined results: a null text has no bytes; rows without id come first; repeated rows are rows of
their own with slots of their own; a document of more than one shard's bytes fills its shard, and
others may stay empty; an empty table gives an empty table; other columns are not read, whatever
their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from markerloom.plans.staging import Staging

SHARDS, HEADER = 40, 16
def _running(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of one range with their number and the bytes up to and with them."""
    row, upto = 0, 0
    for batch in batches:
        sums = upto + np.cumsum(batch.column("size").to_numpy())
        numbers = np.arange(row, row + len(batch), dtype=np.int64)
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(numbers), pa.array(sums)], names=[*batch.schema.names, "row", "upto"])
        row, upto = row + len(batch), int(sums[-1]) if len(batch) else upto


def assign_shards(docs: DataFrame, n_shards: int = SHARDS, header: int = HEADER, id_col: str = "doc_id", text: str = "text", carry: bool = False) -> DataFrame:
    """``(doc_id, size, text_crc32, shard, slot)``: bytes of the text plus ``header``, and the place of every row.

    With ``carry`` each row also brings its whole document as the struct ``doc``, at the price of
    shuffling the texts once. The driver sees totals of partitions and nothing of any document.
    """
    staging = Staging(docs.sparkSession, "sharding")
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    whole = [F.struct(*docs.columns).alias("doc")] if carry else []
    sized = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), (F.octet_length(body) + F.lit(header)).cast("bigint").alias("size"), F.crc32(body).alias("text_crc32"), *whole)
    sized = staging.put(sized.withColumn("arrival", F.monotonically_increasing_id()), "sizes")
    order = ["doc_id", "size", "text_crc32", "arrival"]
    dealt = sized.repartitionByRange(*order).sortWithinPartitions(*order).drop("arrival").withColumn("part", F.spark_partition_id())
    schema = StructType([*dealt.schema, StructField("row", LongType()), StructField("upto", LongType())])
    summed = staging.put(dealt.mapInArrow(_running, schema), "running", arrow_rows=200 if carry else None)
    totals = sorted(summed.groupBy("part").agg(F.max("upto").alias("bytes")).collect())
    before, total = [], 0
    for part, size in totals:
        before.append((part, total))
        total += size
    offsets = F.broadcast(docs.sparkSession.createDataFrame(before, "part int, bytes_before bigint"))
    # twice the bytes up to the middle of a row, over twice the bytes of all
    shard = F.expr(f"(2 * (bytes_before + upto) - size) * {n_shards} div {2 * max(total, 1)}")
    placed = summed.join(offsets, "part").withColumn("shard", F.least(F.lit(n_shards - 1), shard).cast("int"))
    runs = placed.groupBy("shard", "part").agg(F.count("*").alias("rows"), F.min("row").alias("first"))
    known = placed.join(F.broadcast(_starts(runs)), ["shard", "part"])
    return known.select("doc_id", "size", "text_crc32", "shard", (F.col("row") - F.col("first") + F.col("rows_before")).alias("slot"), *["doc"] * carry)


def _starts(runs: DataFrame) -> DataFrame:
    """First row of each shard's run in each partition, and the shard's rows before it.

    A shard and a partition are both runs of one order, so there are no more such pairs than shards
    and partitions together.
    """
    found, before = [], {}
    for r in sorted(runs.collect(), key=lambda r: (r["shard"], r["part"])):
        found.append((r["shard"], r["part"], r["first"], before.get(r["shard"], 0)))
        before[r["shard"]] = before.get(r["shard"], 0) + r["rows"]
    return runs.sparkSession.createDataFrame(found, "shard int, part int, first bigint, rows_before bigint")


def write_shards(docs: DataFrame, path: str, n_shards: int = SHARDS, header: int = HEADER, id_col: str = "doc_id", text: str = "text") -> None:
    """Write the whole documents as Parquet folders ``shard_no=0``, ``shard_no=1`` ..., each file in slot order.

    Tasks take ranges of (shard, slot), so a large shard is written by several of them.
    """
    placed = assign_shards(docs, n_shards, header, id_col, text, carry=True).select(F.col("shard").alias("shard_no"), "slot", "doc")
    placed.repartitionByRange("shard_no", "slot").sortWithinPartitions("shard_no", "slot").write.partitionBy("shard_no").parquet(path)


def op13_sharding(spark, sf_dir):
    placed = assign_shards(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def oracle() -> str:
    """Prefix sums over the whole table; rows equal in all of the order are interchangeable."""
    from markerloom.llm.blocks import crc32_sql

    return f"""WITH d AS (SELECT doc_id, CAST(octet_length(encode(coalesce(text, ''))) + {HEADER} AS BIGINT) AS size, {crc32_sql("encode(coalesce(text, ''))")} AS text_crc32 FROM documents),
    s AS (SELECT *, CAST(sum(size) OVER (ORDER BY doc_id NULLS FIRST, size, text_crc32 ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS upto, CAST(sum(size) OVER () AS BIGINT) AS total FROM d),
    p AS (SELECT *, CAST(least({SHARDS - 1}, ((2 * upto - size) * {SHARDS}) // (2 * total)) AS INTEGER) AS shard FROM s)
    SELECT doc_id, size, text_crc32, 'bytes' AS law, shard, CAST(row_number() OVER (PARTITION BY shard ORDER BY upto) - 1 AS BIGINT) AS slot, CAST(NULL AS INTEGER) AS grown_shard FROM p"""
