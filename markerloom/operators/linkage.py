"""Linkage groups: distortion filter, pairwise LOD, single linkage, joining single markers.

Markers of equal genotype words (or of complementary ones, which only name the two forms otherwise)
are one class at distance 0, so pairs are sought among classes. Groups at any LOD limit are what is
left of one maximum spanning forest once its links below the limit are cut: ``linkage_forest`` has the
same groups as all pairs, at every limit it was made for, and is as long as there are markers.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator
from statistics import NormalDist

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from markerloom.operators.components import connected_components
from markerloom.operators.numbering import with_row_number
from markerloom.plans.staging import Staging, small_side

#: Links that one task holds at most, to make a forest of them or to cut it.
IN_TASK = 1_000_000


def chi_square_limit(tolerance: float) -> float:
    """What a chi-square statistic of one degree of freedom exceeds with probability ``tolerance``."""
    return NormalDist().inv_cdf(1 - tolerance / 2) ** 2


def segregation_statistic(bits: Column, individuals: int, ratio: float = 0.5) -> Column:
    """Chi-square statistic of the share of individuals with a 1 against ``ratio``."""
    expected = individuals * ratio
    return F.pow(F.bit_count(bits) - F.lit(float(expected)), F.lit(2)) / (expected * (1 - ratio))


def filter_distorted(genotypes: DataFrame, tolerance: float, individuals: int, ratio: float = 0.5) -> DataFrame:
    """Keep markers whose segregation (``ratio`` of ones) is not rejected at ``tolerance``; 0 keeps all."""
    if not tolerance:
        return genotypes
    if not 0 < tolerance < 1 or not 0 < ratio < 1:
        raise ValueError("tolerance and ratio must lie between 0 and 1")
    return genotypes.filter(segregation_statistic(F.col("bits"), individuals, ratio) <= chi_square_limit(tolerance))


def _lod_table(individuals: int) -> list[float]:
    """LOD of two markers that differ in r of n individuals: n log10 2 + r log10(r/n) + (n-r) log10(1-r/n)."""
    n = float(individuals)
    return [n * math.log10(2) + (r * math.log10(r / n) if r else 0.0) + ((n - r) * math.log10(1 - r / n) if r else 0.0) for r in range(individuals // 2 + 1)]


def _word(bits: int) -> Column:
    """Up to 64 bits as a signed word."""
    return F.lit(bits - (1 << 64) if bits >= 1 << 63 else bits).cast("bigint")


def genotype_classes(genotypes: DataFrame, individuals: int) -> DataFrame:
    """``(marker_id, word)``: a marker's genotype word or its complement, whichever is less."""
    mask = _word((1 << individuals) - 1)
    own = F.col("bits").bitwiseAND(mask)
    return genotypes.select("marker_id", F.least(own, F.bitwise_not(own).bitwiseAND(mask)).alias("word"))


def _bands(individuals: int, most: int) -> tuple[int, int] | None:
    """Bands and errors a band for an exact search within ``most`` differences, or None where tiles cost less.

    Of ``m`` bands one differs in ``most // m`` places at most. A word asks for every value within so
    many of its bands' values (and those of its complement); words of random bits meet by chance in
    that many of the values there are.
    """
    best, found = 1 / 8, None
    for m in range(1, most + 2) if 2 * most < individuals else ():
        errors, width = most // m, individuals // m
        asked = sum(math.comb(width + 1, k) for k in range(errors + 1))
        chance = 2 * m * asked / 2**width
        if 2 * m * asked <= 400 and chance < best:
            best, found = chance, (m, errors)
    return found


def class_pairs(words: DataFrame, individuals: int, most: int, block: int = 2000) -> DataFrame:
    """``(u, v, r)`` of distinct ``words``, ``u < v``, that differ in ``r <= most`` individuals or in all but ``r``.

    Few differences are found by an exact index: words are cut into bands, and only those that
    (nearly) share a band are compared. Otherwise words are dealt to blocks and a pair of blocks is
    one join key, so that the quadratic work is cut into equal parts.
    """
    differ = F.bit_count(F.col("u").bitwiseXOR(F.col("v")))
    r = F.least(differ, individuals - differ)
    bands = _bands(individuals, most)
    if bands is None:
        blocks = max(1, -(-words.count() // block))
        own = words.select("word", F.pmod(F.xxhash64("word"), F.lit(blocks)).alias("own"))
        spread = own.withColumn("other", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(blocks - 1).cast("bigint"))))
        left = spread.select(F.col("word").alias("u"), F.col("own").alias("p"), F.col("other").alias("q"))
        right = spread.select(F.col("word").alias("v"), F.col("other").alias("p"), F.col("own").alias("q"))
        return left.join(right, ["p", "q"]).filter((F.col("u") < F.col("v")) & (r <= most)).select("u", "v", r.cast("int").alias("r"))
    m, errors = bands
    edges = [individuals * k // m for k in range(m + 1)]
    masks = [((1 << hi) - 1) ^ ((1 << lo) - 1) for lo, hi in zip(edges, edges[1:], strict=False)]
    near = [[sum(1 << b for b in flips) for k in range(errors + 1) for flips in itertools.combinations(range(lo, hi), k)] for lo, hi in zip(edges, edges[1:], strict=False)]
    known = F.explode(F.array(*[F.struct(F.lit(k).alias("band"), F.col("word").bitwiseAND(_word(x)).alias("value")) for k, x in enumerate(masks)])).alias("b")
    index = words.select(F.col("word").alias("v"), known).select("v", "b.band", "b.value")
    whole = _word((1 << individuals) - 1)
    asked = words.select(F.col("word").alias("u"), F.explode(F.array(F.col("word"), F.bitwise_not("word").bitwiseAND(whole))).alias("side"))
    flips = F.explode(F.array(*[F.struct(F.lit(k).alias("band"), _word(x).alias("mask"), F.array(*map(_word, n)).alias("flips")) for k, (x, n) in enumerate(zip(masks, near, strict=True))]))
    asked = asked.select("u", "side", flips.alias("b")).select("u", "side", "b.band", "b.mask", F.explode("b.flips").alias("flip")).select("u", "side", "band", F.col("side").bitwiseAND(F.col("mask")).bitwiseXOR(F.col("flip")).alias("value"))
    met = asked.join(index, ["band", "value"]).filter("u < v")
    apart = F.bit_count(F.col("side").bitwiseXOR(F.col("v")))
    # a pair that meets in several bands counts in the first of them
    earlier = [(F.col("band") <= k) | (F.bit_count(F.col("side").bitwiseXOR(F.col("v")).bitwiseAND(_word(x))) > errors) for k, x in enumerate(masks)]
    for e in earlier:
        met = met.filter(e)
    return met.filter(apart <= most).select("u", "v", apart.cast("int").alias("r"))


def class_lods(genotypes: DataFrame, individuals: int, least: float = 0.0) -> tuple[DataFrame, DataFrame]:
    """Markers' classes ``(marker_id, word)``, and ``(a, b, lod)`` of classes, each with itself included."""
    staging = Staging(genotypes.sparkSession, "genotypes")
    lods = _lod_table(individuals)
    most = max((r for r, lod in enumerate(lods) if lod >= least), default=-1)
    classes = staging.put(genotype_classes(genotypes, individuals), "classes")
    words = staging.put(classes.select("word").distinct(), "words")
    if most < 0:
        words = words.limit(0)
    pairs = class_pairs(words, individuals, max(most, 0)).unionAll(words.select("word", F.col("word").alias("v"), F.lit(0)))
    return classes, pairs.select(F.col("u").alias("a"), F.col("v").alias("b"), F.get(F.array(*map(F.lit, lods)), F.col("r")).alias("lod"))


def pairwise_lod(genotypes: DataFrame, individuals: int, least: float = 0.0, digits: int | None = None, tile_rows: int = 4000) -> DataFrame:
    """``(a, b, lod)`` of marker pairs, ``a < b``, with a LOD of ``least`` or more.

    Classes are compared, and each pair of classes then becomes the pairs of their markers. That
    table may be quadratic in the markers; groups are better taken from ``linkage_forest``. A class's
    markers are dealt to tiles of about ``tile_rows``; a pair of tiles is one row of two arrays, which
    is dealt to any task and written out there pair by pair, so no class is met in one task or held
    whole. With ``digits`` LODs are rounded, once a pair of classes.
    """
    spark = genotypes.sparkSession
    staging = Staging(spark, "tiles")
    classes, pairs = class_lods(genotypes, individuals, least)
    sizes = small_side(staging.put(classes.groupBy("word").agg(F.ceil(F.count("*") / tile_rows).cast("bigint").alias("tiles")), "sizes"))
    dealt = classes.join(sizes, "word").withColumn("tile", F.pmod(F.xxhash64("marker_id"), F.col("tiles")))
    tiles = staging.put(dealt.groupBy("word", "tile").agg(F.collect_list("marker_id").alias("markers")), "tiles")
    if digits is not None:
        pairs = pairs.withColumn("lod", F.round("lod", digits))
    side = lambda word, tile, markers: tiles.select(F.col("word").alias(word), F.col("tile").alias(tile), F.col("markers").alias(markers))
    met = pairs.join(side("a", "p", "xs"), "a").join(side("b", "q", "ys"), "b").filter("a <> b OR p <= q")
    tasks = max(4 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    spread = met.repartition(tasks, "a", "b", "p", "q").select((F.col("a") == F.col("b")).alias("own"), "p", "q", "lod", "xs", F.explode("ys").alias("y"))
    two = spread.select("own", "p", "q", "lod", "y", F.explode("xs").alias("x")).filter("NOT own OR p <> q OR x < y")
    return two.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"), "lod")


def strongest_forest(a: np.ndarray, b: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Which links make a maximum spanning forest: every part takes its best link outwards, until none is left."""
    nodes, ends = np.unique(np.concatenate([a, b]), return_inverse=True)
    order = np.argsort(-weight, kind="stable")
    one, two, link = ends[: len(a)][order], ends[len(a) :][order], np.arange(len(a))
    part, chosen = np.arange(len(nodes)), np.zeros(len(a), bool)
    while True:
        open_ = part[one] != part[two]
        one, two, link = one[open_], two[open_], link[open_]
        if not len(link):
            return np.sort(order[chosen])
        best = np.full(len(nodes), len(link))
        np.minimum.at(best, part[one], np.arange(len(link)))
        np.minimum.at(best, part[two], np.arange(len(link)))
        mover = np.flatnonzero(best < len(link))
        at = best[mover]
        chosen[link[at]] = True
        parent = np.arange(len(nodes))
        parent[mover] = part[one[at]] + part[two[at]] - mover
        mutual = mover[(parent[parent[mover]] == mover) & (mover < parent[mover])]
        parent[mutual] = mutual
        while not np.array_equal(parent, parent[parent]):
            parent = parent[parent]
        part = parent[part]


def _forests(frames: Iterator[pd.DataFrame], most: int = IN_TASK) -> Iterator[pd.DataFrame]:
    """The links of a task thinned out to a forest each time they have doubled; given away if it has ``most`` links."""
    kept, waiting, rows = None, [], 0
    for frame in frames:
        waiting.append(frame)
        rows += len(frame)
        if rows >= max(100_000, len(kept) if kept is not None else 0):
            kept, waiting, rows = _thinned([kept, *waiting]), [], 0
            if len(kept) >= most:
                yield kept
                kept = None
    if waiting or kept is not None:
        yield _thinned([kept, *waiting])


def _thinned(frames: list[pd.DataFrame | None]) -> pd.DataFrame:
    rows = pd.concat([f for f in frames if f is not None], ignore_index=True)
    return rows.iloc[strongest_forest(rows["a"].to_numpy(), rows["b"].to_numpy(), rows["lod"].to_numpy())]


def linkage_forest(genotypes: DataFrame, individuals: int, least: float = 0.0, in_task: int = IN_TASK) -> DataFrame:
    """``(a, b, lod)`` links of markers that have the same groups as all pairs at every limit from ``least`` up.

    Every task that compares classes sends a maximum spanning forest of what it found; forests are
    merged eight to a task until one is left, or until they hold more than ``in_task`` links a task,
    where several forests remain. A class's markers hang on the first of them.
    """
    staging = Staging(genotypes.sparkSession, "forest")
    classes, pairs = class_lods(genotypes, individuals, least)
    links = staging.put(pairs.filter("a <> b").mapInPandas(_forests, "a bigint, b bigint, lod double"), "links")
    count, parts = links.count(), len(links.inputFiles())
    while parts > 1 and count <= in_task * -(-parts // 8):
        parts = -(-parts // 8)
        links = staging.put(links.coalesce(parts).mapInPandas(_forests, links.schema), "links")
        count = links.count()
    first = staging.put(classes.groupBy("word").agg(F.min("marker_id").alias("first")), "first")
    at = lambda end: first.select(F.col("word").alias(end), F.col("first").alias(f"{end}1"))
    between = links.join(at("a"), "a").join(at("b"), "b").select(F.least("a1", "b1").alias("a"), F.greatest("a1", "b1").alias("b"), "lod")
    top = _lod_table(individuals)[0]
    if top < least:
        return between.limit(0)
    within = classes.join(first, "word").filter("marker_id <> first").select(F.col("first").alias("a"), F.col("marker_id").alias("b"), F.lit(top).alias("lod"))
    return between.unionAll(within)


def _cuts(frames: Iterator[pd.DataFrame], limits: list[float]) -> Iterator[pd.DataFrame]:
    """Smallest marker of every linked marker's group, for each limit, from all links at once."""
    rows = pd.concat(list(frames) or [pd.DataFrame({"a": [], "b": [], "lod": []})], ignore_index=True).astype({"a": "int64", "b": "int64"})
    nodes, ends = np.unique(np.concatenate([rows["a"], rows["b"]]), return_inverse=True)
    one, two, lod = ends[: len(rows)], ends[len(rows) :], rows["lod"].to_numpy()
    part = np.arange(len(nodes))
    for limit in sorted(limits, reverse=True):
        known = lod >= limit
        while (part[one[known]] != part[two[known]]).any():
            low = np.minimum(part[one[known]], part[two[known]])
            for end in (one, two):
                np.minimum.at(part, part[end[known]], low)
                np.minimum.at(part, end[known], low)
            while not np.array_equal(part, part[part]):
                part = part[part]
        yield pd.DataFrame({"lod": float(limit), "node": nodes, "root": nodes[part]})


def group_roots(lod: DataFrame, limits: list[float], in_task: int = IN_TASK) -> DataFrame:
    """``(lod, node, root)``: the smallest marker of each linked marker's group, at every limit.

    Groups at one limit are made of those at the next higher one. Up to ``in_task`` links are cut in
    one task; more go through one run of components a limit, over the links between the groups of
    the limit above.
    """
    staging = Staging(lod.sparkSession, "roots")
    links = staging.put(lod.filter(F.col("lod") >= min(limits)).select("a", "b", "lod"), "links")
    if links.count() <= in_task:
        return staging.put(links.coalesce(1).mapInPandas(lambda f: _cuts(f, limits), "lod double, node bigint, root bigint"), "roots")
    roots, out, above = staging.put(links.select(F.col("a").alias("node")).unionAll(links.select("b")).distinct().withColumn("root", F.col("node")), "roots"), None, float("inf")
    for limit in sorted(limits, reverse=True):
        new = links.filter((F.col("lod") >= limit) & (F.col("lod") < above))
        for end in ("a", "b"):
            new = new.join(roots.select(F.col("node").alias(end), F.col("root").alias(f"{end}_root")), end)
        merged = connected_components(new, "a_root", "b_root").select(F.col("node").alias("root"), "component")
        roots = staging.put(roots.join(merged, "root", "left").select("node", F.coalesce("component", "root").alias("root")), "roots")
        one = roots.select(F.lit(float(limit)).alias("lod"), "node", "root")
        out, above = one if out is None else out.unionAll(one), limit
    return out


def _numbered_groups(roots: DataFrame, markers: DataFrame, limits: list[float], size_limit: int) -> DataFrame:
    """``(lod, marker_id, lg)``: groups of each limit by size, ties by their first marker; small ones are 0."""
    every = markers.select("marker_id", F.explode(F.array(*[F.lit(float(x)) for x in limits])).alias("lod"))
    named = Staging(markers.sparkSession, "groups").put(every.join(roots.withColumnRenamed("node", "marker_id"), ["lod", "marker_id"], "left").select("lod", "marker_id", F.coalesce("root", "marker_id").alias("root")), "named")
    sizes = named.groupBy("lod", "root").agg(F.count("*").alias("n")).filter(F.col("n") >= size_limit)
    numbered = with_row_number(sizes, ["lod", "-n", "root"], "place")
    before = F.broadcast(numbered.groupBy("lod").agg((F.min("place") - 1).alias("before")))
    ranked = numbered.join(before, "lod").select("lod", "root", (F.col("place") - F.col("before")).alias("lg"))
    return named.join(ranked, ["lod", "root"], "left").select("lod", "marker_id", F.coalesce("lg", F.lit(0)).cast("bigint").alias("lg"))


def separate_chromosomes(lod: DataFrame, markers: DataFrame, limit: float, size_limit: int = 1) -> DataFrame:
    """``(marker_id, lg)``: connected components of links with LOD of ``limit`` or more.

    ``lod`` holds all pairs or a ``linkage_forest``. Groups below ``size_limit`` are 0; the others are
    numbered by size, ties by their first marker.
    """
    return _numbered_groups(group_roots(lod, [limit]), markers, [limit], size_limit).drop("lod")


def lod_sweep(lod: DataFrame, markers: DataFrame, lo: int, hi: int, size_limit: int = 1) -> DataFrame:
    """Groups for every limit from ``lo`` to ``hi``, cut from one table of pairs or one forest."""
    limits = [float(x) for x in range(lo, hi + 1)]
    return _numbered_groups(group_roots(lod, limits), markers, limits, size_limit).withColumn("lod", F.col("lod").cast("int"))


def refine_lg(groups: DataFrame, lod: DataFrame, lg: int, lo: int, hi: int, size_limit: int = 1) -> DataFrame:
    """Re-cluster the markers of one group over limits; further groups get numbers above all old ones.

    ``lod`` holds all pairs, or a ``linkage_forest`` if the groups were cut from it at ``lo`` or below.
    """
    inside = groups.filter(F.col("lg") == lg).select("marker_id")
    own = lod.join(inside.select(F.col("marker_id").alias("a")), "a", "left_semi").join(inside.select(F.col("marker_id").alias("b")), "b", "left_semi")
    swept = lod_sweep(own.select("a", "b", "lod"), inside, lo, hi, size_limit)
    top = F.broadcast(groups.agg(F.max("lg").alias("top")).withColumn("one", F.lit(1)))
    renamed = swept.withColumnRenamed("lg", "sub").withColumn("one", F.lit(1)).join(top, "one").select("lod", "marker_id", F.when(F.col("sub") == 0, F.lit(0)).when(F.col("sub") == 1, F.lit(lg)).otherwise(F.col("top") + F.col("sub") - 1).cast("bigint").alias("lg"))
    limits = F.explode(F.sequence(F.lit(lo), F.lit(hi))).alias("lod")
    return renamed.unionAll(groups.filter(F.col("lg") != lg).select(limits, "marker_id", F.col("lg").cast("bigint").alias("lg")))


def join_singles(groups: DataFrame, lod: DataFrame, limit: float, diff: float, iterate: bool = False, classes: DataFrame | None = None) -> DataFrame:
    """Markers of group 0 join the group of their best LOD if that reaches ``limit`` and leads by ``diff``.

    ``lod`` holds pairs of markers, or with ``classes`` (marker_id, word) pairs of classes, each with
    itself. ``iterate`` goes on with the markers joined so far until no further one joins.
    """
    staging = Staging(groups.sparkSession, "singles")
    named = groups.select("marker_id", F.col("lg").cast("bigint").alias("lg"))
    current = named.join(classes, "marker_id") if classes is not None else named.withColumn("word", F.col("marker_id"))
    pairs = staging.put(lod.filter(F.col("lod") >= limit).select("a", "b", "lod"), "pairs")
    both = pairs.unionAll(pairs.filter("a <> b").select(F.col("b"), F.col("a"), "lod"))
    while True:
        grouped = current.filter("lg > 0").select(F.col("word").alias("b"), F.col("lg").alias("to")).distinct()
        single = current.filter("lg = 0").select(F.col("word").alias("a")).distinct()
        best = both.join(single, "a", "left_semi").join(grouped, "b").groupBy("a", "to").agg(F.max("lod").alias("lod"))
        order = W.partitionBy("a").orderBy(F.desc("lod"), "to")
        ranked = best.withColumn("second", F.lead("lod").over(order)).withColumn("rn", F.row_number().over(order))
        taken = ranked.filter((F.col("rn") == 1) & (F.col("lod") - F.coalesce("second", F.lit(0.0)) >= diff)).select(F.col("a").alias("word"), "to")
        following = current.join(taken, "word", "left").select("marker_id", F.when(F.col("lg") == 0, F.coalesce("to", "lg")).otherwise(F.col("lg")).alias("lg"), "word")
        if not iterate:
            return following.drop("word")
        following = staging.put(following, "round")
        changed = following.filter("lg = 0").count() != current.filter("lg = 0").count()
        staging.drop(current)
        current = following
        if not changed:
            return current.drop("word")


def join_singles_sweep(groups: DataFrame, lod: DataFrame, lo: int, hi: int, diff: float, classes: DataFrame | None = None) -> DataFrame:
    """``join_singles`` for every limit from ``lo`` to ``hi``, tagged by limit; pairs are staged once, at the lowest."""
    staged = Staging(lod.sparkSession, "singles-sweep").put(lod.filter(F.col("lod") >= lo), "pairs")
    out = None
    for limit in range(lo, hi + 1):
        one = join_singles(groups, staged, limit, diff, classes=classes).select(F.lit(limit).alias("lod"), "marker_id", "lg")
        out = one if out is None else out.unionAll(one)
    return out
