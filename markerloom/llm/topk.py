"""Exact top-k inner-product search over a pivot-distance index.

Every vector is keyed by its nearest pivot and its distance to it; distances of one pivot are cut
into sorted rings. For a query at distance ``d`` from a pivot, every vector of a ring from ``r0``
to ``r1`` is at least ``max(0, r0 - d, d - r1)`` away (triangle inequality), and since
``2 q.x = |q|^2 + |x|^2 - |q - x|^2``, that bounds the ring's inner products from above. A query
first searches its most promising rings until they hold enough vectors; the k-th score found is
then a floor, and only rings whose bound reaches the floor are opened.

Pivots and ring borders are fitted to a sample of ``sample_rows`` rows at most, in hash order;
every row is indexed. Rings are cut into tiles by a hash and queries into blocks, so neither a
crowded ring nor a crowd of equal queries meets in one task. Only pivots, ring borders and one
summary row a ring reach the driver; their number is fixed by the parameters.

Defined results: vectors that are null or hold null or non-finite components take no part, nor do rows without id; shorter
vectors count as filled up with zeros; an empty vector is all zeros; ties go to the smaller id; a
query's own row is left out, other rows with the same vector are not; with fewer than k candidates
all are returned; rows that repeat an id are one query (of its least vector, and none of them is its
candidate) but candidates each; an empty table gives an empty table; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from markerloom.llm.blocks import hash_sample
from markerloom.llm.vectors import matrix, usable
from markerloom.plans.staging import Staging


def spread_pivots(sample: np.ndarray, count: int) -> np.ndarray:
    """Farthest-first pivots from a sample, starting at the row farthest from the mean."""
    far = ((sample - sample.mean(axis=0)) ** 2).sum(axis=1)
    chosen = [int(far.argmax())]
    least = ((sample - sample[chosen[0]]) ** 2).sum(axis=1)
    while len(chosen) < min(count, len(sample)) and least.max() > 0:
        chosen.append(int(least.argmax()))
        least = np.minimum(least, ((sample - sample[chosen[-1]]) ** 2).sum(axis=1))
    return sample[chosen]


def distances(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    squares = (x * x).sum(axis=1)[:, None] + (pivots * pivots).sum(axis=1)[None, :] - 2 * (x @ pivots.T)
    return np.sqrt(np.maximum(squares, 0))


def best_of_tile(q: np.ndarray, q_ids: np.ndarray, floor: np.ndarray, x: np.ndarray, x_ids: np.ndarray, k: int, rows: int = 512) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query id, vector id, score) of each query's k best of a tile that reach its floor."""
    order = np.argsort(x_ids, kind="stable")
    x, x_ids = x[order], x_ids[order]
    # doubles hold the sums exactly below 2**53; beyond that whole numbers of 64 bits are used
    exact = float(np.abs(q).max(initial=0)) * float(np.abs(x).max(initial=0)) * x.shape[1] < 2**53
    left, right = (q.astype(np.float64), x.astype(np.float64).T) if exact else (q, x.T)
    outs: list[tuple] = []
    for at in range(0, len(q), rows):
        score = (left[at : at + rows] @ right).astype(np.int64)
        score_ok = (score >= floor[at : at + rows, None]) & (x_ids[None, :] != q_ids[at : at + rows, None])
        if score.shape[1] > k:
            # the k-th score of a row; all ties with it stay, the final ranking settles them by id
            masked = np.where(score_ok, score, np.iinfo(np.int64).min)
            kth = np.partition(masked, score.shape[1] - k, axis=1)[:, score.shape[1] - k]
            score_ok &= score >= kth[:, None]
            above = (score_ok & (score > kth[:, None])).sum(axis=1)
            tied = score_ok & (score == kth[:, None])
            score_ok &= ~tied | (tied.cumsum(axis=1) <= (k - above)[:, None])
        i, j = np.nonzero(score_ok)
        outs.append((q_ids[at : at + rows][i], x_ids[j], score[i, j]))
    return tuple(np.concatenate([np.zeros(0, np.int64), *[o[c] for o in outs]]) for c in range(3))


def exact_top_k(vectors: DataFrame, is_query: Column, k: int = 20, id_col: str = "vec_id", vector: str = "vector", n_pivots: int = 12, n_rings: int = 6, sample_rows: int = 4096, tile_rows: int = 2048, block_rows: int = 4096) -> DataFrame:
    """``query_id``, ``rank``, ``id_col`` and ``score``; ``vector`` holds arrays of whole numbers."""
    spark = vectors.sparkSession
    staging = Staging(spark, "top-k")
    source = staging.put(vectors.filter(usable(F.col(vector)) & F.col(id_col).isNotNull()).select(F.col(id_col).cast("bigint").alias("id"), F.coalesce(is_query, F.lit(False)).alias("q"), F.col(vector).cast("array<bigint>").alias("x")), "vectors")
    out_schema = f"query_id bigint, rank int, {id_col} bigint, score bigint"
    width = source.agg(F.max(F.size("x"))).first()[0]
    if width is None:
        return spark.createDataFrame([], out_schema)
    sample = matrix(hash_sample(source.select("id", "x"), "id", sample_rows).select("x").toArrow().column("x"), width)
    pivots = spread_pivots(sample, n_pivots)
    away = distances(sample, pivots)
    nearest, least = away.argmin(axis=1), away.min(axis=1)
    levels = np.arange(1, n_rings) / n_rings
    borders = np.array([np.quantile(least[nearest == p], levels) if (nearest == p).any() else np.zeros(len(levels)) for p in range(len(pivots))])

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = matrix(batch.column(2), width)
            d = distances(x, pivots)
            p, near = (d.argmin(axis=1), d.min(axis=1)) if len(x) else (np.zeros(0, np.int64), np.zeros(0))
            ring = (near[:, None] > borders[p]).sum(axis=1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array((p * n_rings + ring).astype(np.int32)), pa.array(near), pa.array((x * x).sum(axis=1))], names=["id", "q", "x", "shell", "away", "square"])

    indexed = staging.put(source.mapInArrow(index, "id bigint, q boolean, x array<bigint>, shell int, away double, square double"), "index")
    staging.drop(source)
    summary = indexed.groupBy("shell").agg(F.count("*").alias("n"), F.min("away").alias("low"), F.max("away").alias("high"), F.max("square").alias("square")).orderBy("shell").collect()
    shell_no, held = np.array([r["shell"] for r in summary]), np.array([r["n"] for r in summary])
    low, high, square = (np.array([r[c] for r in summary]) for c in ("low", "high", "square"))

    def visits(first: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                q = matrix(batch.column(1), width)
                d = distances(q, pivots)[:, shell_no // n_rings] if len(q) else np.zeros((0, len(shell_no)))
                gap = np.maximum(0, np.maximum(low[None, :] - d, d - high[None, :]) - 1e-6)
                bound = ((q * q).sum(axis=1)[:, None] + square[None, :] - gap * gap) / 2 + 1e-6 * (1 + square[None, :])
                order = np.argsort(-bound, axis=1, kind="stable")
                before = np.cumsum(held[order], axis=1) - held[order]
                opened = np.zeros(bound.shape, dtype=bool)
                np.put_along_axis(opened, order, before < 4 * k + 1, axis=1)
                floor = batch.column(2).to_numpy(zero_copy_only=False) if not first else np.full(len(q), np.iinfo(np.int64).min)
                i, j = np.nonzero(opened if first else ~opened & (bound >= floor[:, None].astype(np.float64)))
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(i)), batch.column(1).take(pa.array(i)), pa.array(floor[i]), pa.array(shell_no[j].astype(np.int32))], names=["id", "x", "floor", "shell"])

        return run

    # rows: number of rings, fixed by the parameters
    cuts = F.broadcast(spark.createDataFrame([(int(s), int(-(-n // tile_rows))) for s, n in zip(shell_no, held, strict=True)], "shell int, tiles int"))

    def searched(queries: DataFrame) -> DataFrame:
        """Scores of the visits (id, x, floor, shell) against the vectors of their rings."""
        queries = staging.put(queries, "visits")
        blocks = queries.groupBy("shell").agg(F.ceil(F.count("*") / block_rows).cast("int").alias("blocks"))
        shape = F.broadcast(blocks.join(cuts, "shell"))
        asked = queries.join(shape, "shell").select("shell", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)).alias("tile"), F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int").alias("block"), F.lit(True).alias("asks"), "id", "x", "floor")
        given = indexed.join(shape, "shell").select("shell", F.pmod(F.xxhash64("id"), F.col("tiles")).cast("int").alias("tile"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), F.lit(False).alias("asks"), "id", "x", F.lit(0).cast("bigint").alias("floor"))

        def score(table: pa.Table) -> pa.Table:
            asks, ids = table.column("asks").to_numpy(), table.column("id").to_numpy()
            x = matrix(table.column("x"), width, np.int64)
            a, b = np.flatnonzero(asks), np.flatnonzero(~asks)
            found = best_of_tile(x[a], ids[a], table.column("floor").to_numpy()[a], x[b], ids[b], k)
            return pa.table(dict(zip(("query_id", "id", "score"), map(pa.array, found), strict=True)))

        return asked.unionAll(given).groupBy("shell", "tile", "block").applyInArrow(score, "query_id bigint, id bigint, score bigint")

    ranked = W.partitionBy("query_id").orderBy(F.desc("score"), "id")
    top = lambda df: df.withColumn("rank", F.row_number().over(ranked)).filter(F.col("rank") <= k)
    queries = indexed.filter("q").groupBy("id").agg(F.min("x").alias("x"))
    near = staging.put(top(searched(queries.mapInArrow(visits(True), "id bigint, x array<bigint>, floor bigint, shell int"))), "near")
    floors = near.filter(F.col("rank") == k).select(F.col("query_id").alias("id"), F.col("score").alias("floor"))
    known = queries.join(floors, "id", "left").select("id", "x", F.coalesce("floor", F.lit(np.iinfo(np.int64).min)).alias("floor"))
    rest = searched(known.mapInArrow(visits(False), "id bigint, x array<bigint>, floor bigint, shell int"))
    final = top(near.select("query_id", "id", "score").unionAll(rest))
    return final.select("query_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias(id_col), "score")


def scaled(vector: Column) -> Column:
    """floor(64 x) of every component as whole numbers; what is null or not finite stays unusable."""
    return F.when(usable(vector), F.transform(vector, lambda x: F.floor(x.cast("double") * 64)))


def op2_exact_topk(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", scaled(F.col("embedding")).alias("vector"))
    return exact_top_k(rows, F.col("vec_id") % 20 == 0)


def oracle(k: int = 20) -> str:
    return f"""
    WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS e FROM embeddings
      WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    s AS (SELECT q.vec_id AS query_id, x.vec_id, CAST(list_dot_product(q.e, x.e) AS BIGINT) AS score FROM v q JOIN v x ON q.vec_id % 20 = 0 AND x.vec_id <> q.vec_id),
    r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
    SELECT query_id, rank, vec_id, score FROM r WHERE rank <= {k}"""
