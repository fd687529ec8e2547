"""Filter interaction audit as a stream with retractions.

All document files are read as available-now micro-batches. Each text has a state under its digest:
the smallest id seen so far and who holds it. Texts whose digests fall into one of many buckets share
one entry of the state store, so that a task meets a thousand texts in a call of Python. A document with a larger id fails the
duplicate filter; when a smaller id arrives, the former holders' masks are taken out of the counters
of their parts and put back with the duplicate bit. What leaves the stream are signed counts by part
and mask, a few rows a task and batch; their sums are the counters, from which every order of the
filters is reported. Calling ``follow`` again with the same folder reads new files alone.

Rows of one text are put together inside each task before they are shuffled (one row for each part
and label, with the smallest id among them), so that a text of a third of all documents costs its
state's task a few rows. State is kept by RocksDB on the executors and in the shared folder, so it
need not fit in memory, and a lost executor's part is read back.

Defined results: a null text is empty and a null source is the part of the empty string; a row
without id comes after every id (as the largest long does), and such rows are no copies of each
other; rows that repeat the smallest id of a text are no copies either; several labels of one id
count if any is 1; an empty text has no words and fails the first filter alone, unless it is a copy;
texts of any length are read whole; an empty table has no parts and gives no rows; other columns are
not read, whatever their names.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState

from markerloom.plans.staging import Staging

FILTERS = "ABCDE"
_COPY = 1 << FILTERS.index("E")
_LAST = (1 << 63) - 1
_SPACE = r"[\x20\x09-\x0D]+"
_JOINED = "bucket int, key string, part string, mask int, good int, toxic int, n bigint, least bigint, n_least bigint"
_STATE = "key array<string>, least array<bigint>, part array<string>, good array<int>, toxic array<int>, n array<bigint>"
_COUNTS = "part string, mask int, n bigint, good bigint, toxic bigint"
_CONF = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # many small stores: RocksDB would set aside megabytes of disk for each
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
}


def text_mask(text: Column) -> Column:
    """Bits of the four filters that look at one text: few words, repeated words, capitals, marks."""
    words = F.array_remove(F.split(text, _SPACE), "")
    n, distinct = F.size(words), F.size(F.array_distinct(words))
    capitals = F.length(F.regexp_replace(text, "[^A-Z]+", ""))
    fails = [n < 50, 100 * distinct < 65 * n, 100 * capitals > 5 * F.length(text), text.rlike(r"[#$%&*|]")]
    return sum((F.when(f, 1 << k).otherwise(0) for k, f in enumerate(fails)), F.lit(0)).cast("int")


def _combined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each text, part and label of a batch: how many, the smallest id, how many hold it."""
    for batch in batches:
        if not len(batch):
            continue
        rows = batch.to_pandas()
        group = rows.groupby(["bucket", "key", "part", "mask", "good", "toxic"], sort=False)
        least = group["id"].transform("min")
        out = rows.assign(holds=(rows["id"] == least).astype("int64")).groupby(list(group.keys), sort=False).agg(n=("id", "size"), least=("id", "min"), n_least=("holds", "sum")).reset_index()
        yield pa.RecordBatch.from_pandas(out, preserve_index=False).cast(_arrow(_JOINED))


def _arrow(ddl: str) -> pa.Schema:
    kinds = {"string": pa.string(), "int": pa.int32(), "bigint": pa.int64()}
    return pa.schema([(n, kinds[k]) for n, k in (f.split() for f in ddl.split(", "))])


def _retracted(bucket: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """Signed counts that new rows bring to the texts of a bucket; the state keeps smallest ids and their holders."""
    held: dict[str, tuple[int, dict[tuple, int]]] = {}
    for key, least, *holder, n in zip(*state.get, strict=True) if state.exists else ():
        held.setdefault(key, (least, {}))[1][tuple(holder)] = n
    fresh: dict[str, list[tuple]] = {}
    for f in frames:
        for key, *row in zip(*(f[c].tolist() for c in ("key", "part", "mask", "good", "toxic", "n", "least", "n_least")), strict=True):
            fresh.setdefault(key, []).append(row)
    signed: dict[tuple[str, int], list[int]] = {}

    def count(part: str, mask: int, good: int, toxic: int, n: int) -> None:
        sums = signed.setdefault((part, mask), [0, 0, 0])
        for k, weight in enumerate((1, good, toxic)):
            sums[k] += weight * n

    for key, rows in fresh.items():
        known, holders = held.get(key, (_LAST, {}))
        least, mask = min(known, min(r[5] for r in rows)), rows[0][1]
        if known > least:
            for (part, good, toxic), n in holders.items():
                count(part, mask, good, toxic, -n)
                count(part, mask | _COPY, good, toxic, n)
            holders = {}
        for part, _, good, toxic, n, own, n_own in rows:
            first = n_own if own == least else 0
            if first:
                holders[part, good, toxic] = holders.get((part, good, toxic), 0) + first
                count(part, mask, good, toxic, first)
            if n > first:
                count(part, mask | _COPY, good, toxic, n - first)
        held[key] = (least, holders)
    state.update(tuple(map(list, zip(*((key, least, *holder, n) for key, (least, holders) in held.items() for holder, n in holders.items()), strict=True))))
    yield pd.DataFrame([(*k, *v) for k, v in signed.items()], columns=["part", "mask", "n", "good", "toxic"])


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A task's signed counts by part and mask."""
    sums: dict[tuple[str, int], np.ndarray] = {}
    for batch in batches:
        if len(batch):
            for (part, mask), row in batch.to_pandas().groupby(["part", "mask"], sort=False)[["n", "good", "toxic"]].sum().iterrows():
                sums[part, mask] = sums.get((part, mask), 0) + row.to_numpy()
    found = [(*k, *map(int, v)) for k, v in sums.items() if v.any()]
    if found:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*found, strict=True), _arrow(_COUNTS).types, strict=True)], schema=_arrow(_COUNTS))


def _status(spark: SparkSession, path: str):
    """The file system's status of a path, wherever it lies; None where there is nothing."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    system = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return system.getFileStatus(target) if system.exists(target) else None


def _pattern(spark: SparkSession, path: str) -> str:
    """A folder or pattern as it is; a single file, which a stream takes for a folder, as a pattern of itself."""
    found = _status(spark, path)
    return f"{path[:-1]}[{path[-1]}]" if found is not None and found.isFile() else path


def _buckets(spark: SparkSession, docs: DataFrame, folder: str, texts: int = 1000) -> int:
    """How many buckets the texts of a stream's folder fall into: fixed by the rows there are at its start."""
    path = f"{folder}/buckets"
    if _status(spark, f"{path}/_SUCCESS") is None:
        docs.agg(F.ceil(F.count("*") / texts).alias("n")).write.mode("overwrite").parquet(path)
    return max(1, spark.read.schema("n bigint").parquet(path).first()[0])


def follow(spark: SparkSession, path: str, labels: DataFrame, folder: str, files: int | None = None) -> DataFrame:
    """Process the files below ``path`` that ``folder`` has not seen; counters ``(part, mask, n, good, toxic)``.

    ``files`` is how many go into one micro-batch, by default a quarter of those there now: each batch
    commits all states once, so their number should not grow with the table. ``folder`` holds the stream's checkpoint and the
    signed counts of all batches so far; it must be one that driver and executors share.
    """
    flag = lambda c: F.max(F.coalesce(F.col(c) == 1, F.lit(False)).cast("int")).alias(c)
    known = labels.filter("doc_id IS NOT NULL").groupBy(F.col("doc_id").alias("labelled")).agg(flag("quality"), flag("toxic"))
    present = spark.read.parquet(path)
    files = files or max(1, -(-len(present.inputFiles()) // 4))
    docs = spark.readStream.schema(present.schema).option("maxFilesPerTrigger", files).parquet(_pattern(spark, path))
    told = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    told = told.select("doc_id", "part", F.md5("text").alias("key"), F.pmod(F.xxhash64("text"), F.lit(_buckets(spark, present, folder))).cast("int").alias("bucket"), text_mask(F.col("text")).alias("mask"))
    # a row without id meets no label; a key of its own text spares the join a heap of nulls
    meets = [F.coalesce("doc_id", F.xxhash64("key")) == F.col("labelled"), F.col("doc_id").isNotNull()]
    rated = told.join(known, meets, "left").select("bucket", "key", "part", "mask", F.coalesce("quality", F.lit(0)).alias("good"), F.coalesce("toxic", F.lit(0)).alias("toxic"), F.coalesce("doc_id", F.lit(_LAST)).alias("id"))
    signed = rated.mapInArrow(_combined, _JOINED).groupBy("bucket").applyInPandasWithState(_retracted, _COUNTS, _STATE, "append", "NoTimeout").mapInArrow(_added, _COUNTS)
    before = {k: spark.conf.get(k, None) for k in _CONF}
    try:
        for k, v in _CONF.items():
            spark.conf.set(k, v)
        query = signed.writeStream.format("parquet").outputMode("append").option("path", f"{folder}/signed").option("checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True).start()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    query.awaitTermination()
    signed_counts = spark.read.schema(_COUNTS).parquet(f"{folder}/signed")
    return signed_counts.groupBy("part", "mask").agg(*[F.sum(c).alias(c) for c in ("n", "good", "toxic")])


def report(counters: DataFrame) -> DataFrame:
    """Every order and step of every part, from the counters of its masks.

    ``roles`` says what a mask's documents are at each step of each order (19,200 rows, always), so
    the report is one join on the mask and one sum.
    """
    roles = []
    for order in map("".join, itertools.permutations(FILTERS)):
        for step, letter in enumerate(order, 1):
            bit, before = 1 << FILTERS.index(letter), sum(1 << FILTERS.index(x) for x in order[: step - 1])
            for mask in range(1 << len(FILTERS)):
                fails, gone = bool(mask & bit), bool(mask & before)
                roles.append((mask, order, step, int(not mask & (before | bit)), int(fails and not gone), int(fails and gone), int(mask == bit), 120 // mask.bit_count() if fails else 0))
    table = counters.sparkSession.createDataFrame(roles, "mask int, filter_order string, step int, stays int, leaves int, left int, alone int, share int")
    times = lambda count, role: F.sum(F.col(count) * F.col(role)).cast("bigint")
    return counters.join(F.broadcast(table), "mask").groupBy("part", "filter_order", "step").agg(
        times("n", "stays").alias("kept"), times("n", "leaves").alias("removed"), times("n", "left").alias("redundant"), times("n", "alone").alias("unique_fails"),
        times("good", "leaves").alias("good_lost"), times("toxic", "leaves").alias("toxic_lost"), times("n", "share").alias("shapley"),
    )


def op11_filter_audit(spark, sf_dir):
    staging = Staging(spark, "filter-audit")
    counters = follow(spark, f"{sf_dir}/documents.parquet", spark.read.parquet(f"{sf_dir}/labels.parquet"), staging.root)
    return report(staging.put(counters, "counters"))


def oracle() -> str:
    """Masks by plain conditions and a window over equal texts; all orders by joining the letters."""
    letter = " UNION ALL ".join(f"SELECT '{x}' AS x, {1 << k} AS bit" for k, x in enumerate(FILTERS))
    return rf"""WITH l AS (SELECT doc_id, max(CAST(coalesce(quality = 1, FALSE) AS INTEGER)) AS good, max(CAST(coalesce(toxic = 1, FALSE) AS INTEGER)) AS toxic FROM labels GROUP BY doc_id),
    d AS (SELECT coalesce(source, '') AS part, coalesce(documents.doc_id, {_LAST}) AS id, coalesce(text, '') AS text, coalesce(good, 0) AS good, coalesce(l.toxic, 0) AS toxic FROM documents LEFT JOIN l ON l.doc_id = documents.doc_id),
    w AS (SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words FROM d),
    m AS (SELECT part, CASE WHEN len(words) < 50 THEN 1 ELSE 0 END + CASE WHEN 100 * len(list_distinct(words)) < 65 * len(words) THEN 2 ELSE 0 END + CASE WHEN 100 * length(regexp_replace(text, '[^A-Z]+', '', 'g')) > 5 * length(text) THEN 4 ELSE 0 END
      + CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 8 ELSE 0 END + CASE WHEN id > min(id) OVER (PARTITION BY text) THEN 16 ELSE 0 END AS mask, good, toxic FROM w),
    c AS (SELECT part, mask, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM m GROUP BY ALL),
    x AS ({letter}), o AS (SELECT [a.x, b.x, c.x, d.x, e.x] AS xs, [a.bit, b.bit, c.bit, d.bit, e.bit] AS bits FROM x a, x b, x c, x d, x e WHERE a.bit | b.bit | c.bit | d.bit | e.bit = {(1 << len(FILTERS)) - 1}),
    s AS (SELECT list_aggregate(xs, 'string_agg', '') AS filter_order, CAST(i AS INTEGER) AS step, bits[i] AS bit, CAST(coalesce(list_sum(bits[1:i - 1]), 0) AS INTEGER) AS before FROM o, (SELECT unnest(range(1, 6)) AS i))
    SELECT part, filter_order, step, CAST(sum(CASE WHEN mask & (before | bit) = 0 THEN n ELSE 0 END) AS BIGINT) AS kept, CAST(sum(CASE WHEN mask & bit > 0 AND mask & before = 0 THEN n ELSE 0 END) AS BIGINT) AS removed,
      CAST(sum(CASE WHEN mask & bit > 0 AND mask & before > 0 THEN n ELSE 0 END) AS BIGINT) AS redundant, CAST(sum(CASE WHEN mask = bit THEN n ELSE 0 END) AS BIGINT) AS unique_fails,
      CAST(sum(CASE WHEN mask & bit > 0 AND mask & before = 0 THEN good ELSE 0 END) AS BIGINT) AS good_lost, CAST(sum(CASE WHEN mask & bit > 0 AND mask & before = 0 THEN toxic ELSE 0 END) AS BIGINT) AS toxic_lost,
      CAST(sum(CASE WHEN mask & bit > 0 THEN n * 120 // bit_count(mask) ELSE 0 END) AS BIGINT) AS shapley FROM c, s GROUP BY part, filter_order, step"""
