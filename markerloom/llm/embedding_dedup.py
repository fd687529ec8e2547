"""Embedding near-duplicates by int8 tile products with rigorous quantisation error bounds.

Vectors of one label are compared tile by tile. Each unit vector ``u`` is quantised to int8 codes
``q`` with its own scale ``s``; ``e`` is the exact length of ``u - s q``. Then

    u . v  <=  s t (q . r)  +  |s q| f  +  e |v|

for a second vector with codes ``r``, scale ``t`` and error length ``f``, so a pair whose right
side stays below the threshold cannot link. The others are recomputed in double precision.

Equal vectors of a label are compared once, with their number as weight. A tile pair reports link
counts and a spanning forest of its links, never all pairs.

Vectors are scaled by powers of two first, so components of any size are compared.

Defined results: a vector without label, or one that is null, empty, zero or holds a null or
non-finite component, links with nothing and is its own component; vectors of different lengths
never link; repeated rows link with each other; a row without id gets its vector's component but
counts as no link; ties go to the smaller id; an empty table gives
an empty table; columns other than id, vector and label are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from markerloom.llm.blocks import local_components
from markerloom.llm.vectors import matrix, usable
from markerloom.operators.components import connected_components
from markerloom.plans.staging import Staging


def quantised(unit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """int8 codes, scales, lengths of the decoded vectors and of what decoding misses."""
    scale = np.abs(unit).max(axis=1) / 127
    codes = np.rint(unit / scale[:, None]).astype(np.int8)
    decoded = codes * scale[:, None]
    return codes, scale, np.linalg.norm(decoded, axis=1), np.linalg.norm(unit - decoded, axis=1)


def even_sized(x: np.ndarray) -> np.ndarray:
    """Rows scaled by powers of two, so that squares of very long or short vectors stay in range; no bit is lost."""
    return np.ldexp(x, -np.frexp(np.abs(x).max(axis=1))[1][:, None])


def linked_pairs(a: np.ndarray, b: np.ndarray, threshold: float, rows: int = 256) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs of two matrices with cosine of at least ``threshold``, in double precision."""
    a, b = even_sized(a), even_sized(b)
    size_a, size_b = np.linalg.norm(a, axis=1), np.linalg.norm(b, axis=1)
    (qa, sa, la, ea), (qb, sb, _, eb) = quantised(a / size_a[:, None]), quantised(b / size_b[:, None])
    # single precision holds sums of int8 products exactly up to 2**24
    exact = np.float32 if a.shape[1] * 127 * 127 < 2**24 else np.float64
    codes_b = qb.astype(exact).T
    out_a, out_b = [], []
    for x in range(0, len(a), rows):
        s = slice(x, x + rows)
        bound = (qa[s].astype(exact) @ codes_b) * sa[s, None] * sb[None, :] + la[s, None] * eb[None, :] + ea[s, None] * (1 + 1e-9)
        maybe = bound >= threshold - 1e-9
        i, j = np.nonzero(maybe)
        for at in range(0, len(i), 1 << 16):
            r, c = i[at : at + (1 << 16)] + x, j[at : at + (1 << 16)]
            linked = np.einsum("ij,ij->i", a[r], b[c]) / (size_a[r] * size_b[c]) >= threshold
            out_a.append(r[linked])
            out_b.append(c[linked])
    none = np.zeros(0, np.int64)
    return np.concatenate([none, *out_a]), np.concatenate([none, *out_b])


def near_duplicates(rows: DataFrame, threshold: float = 0.98, tile_rows: int = 2048, id_col: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """``id_col``, ``n_links``, ``component_id`` and ``kept`` of every row."""
    staging = Staging(rows.sparkSession, "near-vectors")
    sound = F.col("label").isNotNull() & usable(F.col("vec")) & F.exists("vec", lambda x: x != 0)
    source = rows.select(F.col(id_col).alias("id"), F.col(vector).alias("vec"), F.col(label).alias("label")).withColumn("sound", F.coalesce(sound, F.lit(False)))
    distinct = source.filter("sound AND id IS NOT NULL").groupBy("label", "vec").agg(F.min("id").alias("rep"), F.count("*").alias("weight"))
    members = staging.put(distinct, "members")
    tiles = members.groupBy("label", F.size("vec").alias("dim")).agg(F.ceil(F.count("*") / tile_rows).cast("int").alias("tiles"))
    dealt = members.withColumn("dim", F.size("vec")).join(tiles, ["label", "dim"]).withColumn("tile", F.pmod(F.xxhash64("rep"), F.col("tiles")).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    paired = dealt.select("label", "dim", F.least("tile", "other").alias("i"), F.greatest("tile", "other").alias("j"), (F.col("tile") <= F.col("other")).alias("first"), "rep", "weight", "vec")

    def compare(table: pa.Table) -> pa.Table:
        rep, weight = table.column("rep").to_numpy(), table.column("weight").to_numpy()
        first, same = table.column("first").to_numpy(), table.column("i")[0].as_py() == table.column("j")[0].as_py()
        x = matrix(table.column("vec"))
        a = np.flatnonzero(first)
        b = a if same else np.flatnonzero(~first)
        i = j = np.zeros(0, np.int64)
        if len(a) and len(b):
            i, j = linked_pairs(x[a], x[b], threshold)
            i, j = a[i], b[j]
            i, j = i[i != j], j[i != j]
        counts = np.bincount(i, weights=weight[j], minlength=len(rep))
        if not same:
            counts = counts + np.bincount(j, weights=weight[i], minlength=len(rep))
        root = local_components(len(rep), i, j)
        moved, some = np.flatnonzero(root != np.arange(len(rep))), np.flatnonzero(counts)
        return pa.table({"src": pa.array(np.concatenate([rep[moved], rep[some]])), "dst": pa.array(np.concatenate([rep[root[moved]], rep[some]])), "links": pa.array(np.concatenate([np.zeros(len(moved), np.int64), counts[some].astype(np.int64)]))})

    found = staging.put(paired.groupBy("label", "dim", "i", "j").applyInArrow(compare, "src bigint, dst bigint, links bigint"), "links")
    components = connected_components(found.filter("src != dst"))
    links = found.filter("src = dst").groupBy(F.col("src").alias("rep")).agg(F.sum("links").alias("links"))
    named = members.join(components, F.col("rep") == F.col("node"), "left").join(links, "rep", "left")
    named = named.select("label", "vec", F.coalesce("component", "rep").alias("component_id"), (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"), F.lit(True).alias("sound"))
    out = source.join(named, ["label", "vec", "sound"], "left")
    component = F.coalesce("component_id", "id")
    return out.select(F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"), component.alias("component_id"), (F.col("id") == component).alias("kept"))


def op4_embedding_dedup(spark, sf_dir):
    return near_duplicates(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def oracle(threshold: float = 0.98) -> str:
    return f"""
    WITH RECURSIVE v AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
    sound AS (SELECT *, list_max(list_transform(e, lambda x: abs(x))) AS most FROM v WHERE label IS NOT NULL AND e IS NOT NULL AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    good AS (SELECT vec_id, label, list_transform(e, lambda x: x / pow(2, floor(log2(most)))) AS e FROM sound WHERE most > 0),
    links AS (SELECT a.vec_id AS x, b.vec_id AS y FROM good a JOIN good b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
      WHERE list_dot_product(a.e, b.e) / (sqrt(list_dot_product(a.e, a.e)) * sqrt(list_dot_product(b.e, b.e))) >= {threshold}),
    reach AS (SELECT vec_id AS x, vec_id AS y FROM v UNION SELECT reach.x, links.y FROM reach JOIN links ON reach.y = links.x),
    named AS (SELECT x, min(y) AS component_id FROM reach GROUP BY x),
    counted AS (SELECT x, count(*) AS n FROM links GROUP BY x)
    SELECT v.vec_id, coalesce(n, 0) AS n_links, component_id, v.vec_id = component_id AS kept FROM v JOIN named ON named.x = vec_id LEFT JOIN counted ON counted.x = vec_id"""
