"""Mixing sources to target weights by min-cost flow over membership patterns.

Documents that belong to the same set of sources are interchangeable for the flow, so they are
aggregated first: one node per pattern, whose capacity is the sum of its sizes. Tokens flow from
patterns to the sources they belong to and from there to each source's quota. The first pass over
a pattern is free, every further pass costs one more per token (a convex cost), so repeats are
used last. Documents are then selected per pattern in a seeded order.

Only the pattern table reaches the driver; it is as long as there are distinct membership sets,
and more than ``max_patterns`` of them is an error. The selection sums sizes per bucket of the
seeded order first, so that no pattern, however large, is ordered in one task.

Defined results: a null text has size 0; documents of size 0 are never taken; a document without
source takes part under the null source; ties in the seeded order go to the smaller id; repeated
rows and rows without id are separate documents; a very long text counts whole; an empty table gives
an empty table; columns other than the id, the size and the sources are not read.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from markerloom.plans.staging import Staging

_SPACE = "\x20\t\n\x0b\f\r"


def count_words(text: Column) -> Column:
    """Number of runs of characters other than space, tab, LF, VT, FF and CR; 0 for null."""
    marks = F.regexp_replace(F.coalesce(text, F.lit("")), r"[^\x20\x09-\x0D]+", "x")
    return F.length(F.translate(marks, _SPACE, "")).cast("bigint")


def water_filled(sizes: dict[str | None, int], share: float, cap: float, weights: tuple[float, ...]) -> dict[str | None, float]:
    """Targets by source: weights repeat over sources in code-point order, null last.

    The sources share ``share`` times all sizes by weight. A target stops at ``cap`` times its
    source's size; the excess is shared again by weight until none is above.
    """
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    targets, rest, open_ = {}, share * sum(sizes.values()), list(order)
    while open_:
        unit = rest / sum(weight[s] for s in open_)
        full = [s for s in open_ if weight[s] * unit >= cap * sizes[s]]
        if not full:
            targets |= {s: weight[s] * unit for s in open_}
            break
        targets |= {s: float(cap * sizes[s]) for s in full}
        rest -= sum(cap * sizes[s] for s in full)
        open_ = [s for s in open_ if s not in targets]
    return targets


def route(patterns: list[tuple[tuple, int]], quotas: dict, passes: int) -> list[dict]:
    """Cheapest flow of tokens from patterns to quotas: for each pattern, tokens by source.

    Pass ``k`` over a pattern costs ``k`` a token. With such costs the cheapest flow is found pass
    by pass: each pass adds capacity, and shortest augmenting paths (which may reroute what an
    earlier path sent elsewhere) bring the flow to its maximum before the next pass opens.
    """
    flow = [{s: 0 for s in members if s in quotas} for members, _ in patterns]
    left = {s: int(round(q)) for s, q in quotas.items()}
    of: dict = {}
    for p, arcs in enumerate(flow):
        for s in arcs:
            of.setdefault(s, []).append(p)
    for _ in range(passes):
        spare = [size for _, size in patterns]
        while True:
            came: dict = {("p", p): None for p, room in enumerate(spare) if room > 0 and flow[p]}
            front, end = list(came), None
            while front and end is None:
                following = []
                for node in front:
                    kind, x = node
                    if kind == "p":
                        reach = [("s", s) for s in flow[x]]
                    else:
                        if left[x] > 0:
                            end = node
                            break
                        reach = [("p", p) for p in of[x] if flow[p][x] > 0]
                    for other in reach:
                        if other not in came:
                            came[other] = node
                            following.append(other)
                front = following
            if end is None:
                break
            path = [end]
            while came[path[-1]] is not None:
                path.append(came[path[-1]])
            path.reverse()
            moved = min([spare[path[0][1]], left[end[1]], *(flow[b[1]][a[1]] for a, b in zip(path, path[1:], strict=False) if a[0] == "s")])
            for a, b in zip(path, path[1:], strict=False):
                if a[0] == "p":
                    flow[a[1]][b[1]] += moved
                else:
                    flow[b[1]][a[1]] -= moved
            spare[path[0][1]] -= moved
            left[end[1]] -= moved
    return flow


def _seeded_prefix(free: DataFrame, gaps: DataFrame) -> DataFrame:
    """Add ``now``: whether the walk along the seeded order takes a document before its pattern's gap is full.

    ``free`` holds documents that fit their gaps. Sizes are summed per bucket of the order first;
    only the bucket in which the gap is reached is looked at document by document.
    """
    joined = free.join(F.broadcast(gaps), "pattern")
    running = W.partitionBy("pattern").orderBy("bucket").rowsBetween(W.unboundedPreceding, W.currentRow)
    sums = joined.groupBy("pattern", "bucket").agg(F.sum("n").alias("bucket_n")).withColumn("upto", F.sum("bucket_n").over(running))
    placed = joined.join(sums.select("pattern", "bucket", "upto", (F.col("upto") - F.col("bucket_n")).alias("before")), ["pattern", "bucket"])
    border = (F.col("before") < F.col("gap")) & (F.col("upto") > F.col("gap"))
    inside = W.partitionBy("pattern", "bucket").orderBy("h", "id", "row").rowsBetween(W.unboundedPreceding, W.currentRow)
    near = placed.filter(border).withColumn("now", F.col("before") + F.sum("n").over(inside) <= F.col("gap"))
    rest = placed.filter(~border).withColumn("now", F.col("upto") <= F.col("gap"))
    return near.unionAll(rest).select("row", "id", "pattern", "n", "h", "bucket", "now")


def mix_sources(
    docs: DataFrame,
    targets: Callable[[dict], dict],
    passes: int = 2,
    seed: int = 17,
    max_patterns: int = 100_000,
    bucket_docs: int = 4096,
    id_col: str = "doc_id",
    size_col: str = "size",
    sources_col: str = "sources",
) -> DataFrame:
    """Add ``taken`` (tokens the mix takes of a document) and the struct ``mixed`` of its pattern.

    ``docs`` has an id, a size and an array of source names; ``targets`` maps the total size of
    each source (each document counts in all its sources) to the tokens wanted of it. Documents
    are taken whole, at most ``passes`` times. The seeded order is walked to the gap between whole
    passes and the flow, then again past the documents that no longer fit, until none fits: what is
    missing in the end is less than the pattern's smallest document that is not taken once more.
    """
    spark = docs.sparkSession
    staging = Staging(spark, "mixing")
    order = F.xxhash64(F.lit(seed), F.col(id_col), F.col(size_col))
    narrow = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"), F.col(size_col).alias("n"), F.to_json(F.array_sort(F.array_distinct(sources_col))).alias("pattern"), F.array_distinct(sources_col).alias("members"), order.alias("h"))
    narrow = staging.put(narrow, "sizes")  # written, so that a row's number stays what it is
    rows = narrow.groupBy("pattern").agg(F.first("members").alias("members"), F.sum("n").alias("n"), F.count("*").alias("docs")).orderBy("pattern").limit(max_patterns + 1).collect()
    if len(rows) > max_patterns:
        raise ValueError(f"more than {max_patterns} membership patterns")
    sizes: dict = {}
    for r in rows:
        for s in r["members"]:
            sizes[s] = sizes.get(s, 0) + r["n"]
    wanted = targets(sizes)
    flows = route([(tuple(r["members"]), r["n"]) for r in rows], wanted, passes)
    plan = []
    for r, arcs in zip(rows, flows, strict=True):
        total = sum(arcs.values())
        base = min(passes, total // r["n"]) if r["n"] else 0
        bits = max(0, (-(-r["docs"] // bucket_docs) - 1).bit_length())
        plan.append((r["pattern"], int(base), int(total - base * r["n"]) if base < passes else 0, bits))
    planned = spark.createDataFrame(plan, "pattern string, base bigint, rest bigint, bits int")
    bucket = F.expr("CASE WHEN bits = 0 THEN 0L ELSE shiftrightunsigned(h, 64 - bits) END")
    state = narrow.join(F.broadcast(planned), "pattern").select("row", "id", "pattern", "n", "h", bucket.alias("bucket"), "base")
    gaps = {p: rest for p, _, rest, _ in plan if rest > 0}
    fitting = lambda df: df.join(F.broadcast(spark.createDataFrame(sorted(gaps.items()), "pattern string, gap bigint")), "pattern").filter("n > 0 AND n <= gap").select("row", "id", "pattern", "n", "h", "bucket")
    taken: list[DataFrame] = []
    free = fitting(state) if gaps else None
    while free is not None:
        walked = staging.put(_seeded_prefix(free, spark.createDataFrame(sorted(gaps.items()), "pattern string, gap bigint")), "walk")
        got = {r["pattern"]: r["got"] for r in walked.filter("now").groupBy("pattern").agg(F.sum("n").alias("got")).collect()}
        taken.append(walked.filter("now").select("row", F.lit(1).alias("more")))
        # a pattern of which nothing fitted is done; a walk takes the first that fits of every other
        gaps = {p: gaps[p] - n for p, n in got.items() if gaps[p] > n}
        free = fitting(walked.filter("NOT now")) if gaps else None
    once = F.lit(0)
    if taken:
        state = state.join(functools.reduce(DataFrame.unionAll, taken), "row", "left")
        once = F.coalesce("more", F.lit(0))
    final = state
    per = spark.createDataFrame([(r["pattern"], int(r["n"]), [(s, float(wanted.get(s, 0.0)), int(sizes[s])) for s in r["members"]]) for r in rows], "pattern string, pattern_size bigint, members array<struct<source:string,target:double,size:bigint>>")
    return final.withColumn("taken", (F.col("n") * (F.col("base") + once)).cast("bigint")).join(F.broadcast(per), "pattern").select(F.col("id").alias(id_col), F.col("n").alias(size_col), "taken", F.struct("pattern_size", "members").alias("mixed"))


def _sized(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", count_words(F.col("text")).alias("size"), F.array("source").alias("sources"))


def contract_targets(sizes: dict) -> dict:
    return water_filled(sizes, share=1.5, cap=2.0, weights=(3.0, 1.0, 2.0))


def op3_source_mix(spark, sf_dir):
    mixed = mix_sources(_sized(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "source")), contract_targets)
    only = F.get("mixed.members", F.lit(0))
    return mixed.select("doc_id", "size", only["size"].alias("source_size"), only["target"].alias("target"), "taken")
