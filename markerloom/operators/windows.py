"""Order-based operators: trimming, intervals, blocks, assembly tables. ``line`` is the file order."""

from __future__ import annotations

import heapq
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from markerloom.functions.scalars import after_dash, bed_key, leading_int, map_distance, reverse_complement
from markerloom.operators.joins import liftover
from markerloom.operators.numbering import with_row_number
from markerloom.operators.scans import Ordered
from markerloom.plans.staging import Staging, dealt, small_side
from markerloom.sources.readers import CHUNK, chunked

#: Stretches between knots up to which they are sent to every task whole; more are dealt out with the rows.
_BROADCAST = 500_000


def _share(x: float) -> float:
    return x * 0.01 if x >= 1 else x


def trim_edges(markers: DataFrame, cutoff: float, edge: float, by: str = "lg", order: tuple[str, ...] = ("line",)) -> DataFrame:
    """Flag markers outward of the innermost large gap near either end of a group's map.

    The first and last ``edge`` share of markers are searched for steps above ``cutoff`` share of
    the span (values of 1 and more are percent). Adds ``male_pass``, ``female_pass``, ``qc`` and
    rescales both maps so that the least passing position is 0. Groups may be of any size: steps come
    from a scan over ranges, and what holds for a group from sums joined back.
    """
    cutoff, edge = _share(cutoff), _share(edge)
    staging = Staging(markers.sparkSession, "trim")
    sexes = ("male", "female")
    spans = markers.groupBy(by).agg(F.count("*").alias("_n"), *[(F.max(f"{s}_cm") - F.min(f"{s}_cm")).alias(f"_{s}_span") for s in sexes])
    rows = Ordered(markers, [by], list(order), markers.count()).scan(before={f"_{s}_was": f"{s}_cm" for s in sexes}, sums={"_i": F.lit(1)}).df
    rows = _of_group(rows, staging.put(spans, "spans"), by).withColumn("_fs", F.bround(F.col("_n") * edge, 0).cast("int"))
    i, fs, n = F.col("_i"), F.col("_fs"), F.col("_n")
    marks = []
    for s in sexes:
        far = (F.abs(F.col(f"{s}_cm") - F.col(f"_{s}_was")) > F.col(f"_{s}_span") * cutoff) & (fs >= 2)
        marks += [F.max(F.when(far & (i >= 2) & (i <= fs), i)).alias(f"_{s}_head"), F.min(F.when(far & (i - 1 >= n - fs), i)).alias(f"_{s}_tail")]
    rows = staging.put(rows, "rows")
    rows = _of_group(rows, staging.put(rows.groupBy(by).agg(*marks), "marks"), by)
    for s in sexes:
        rows = rows.withColumn(f"{s}_pass", ~(F.coalesce(i < F.col(f"_{s}_head"), F.lit(False)) | F.coalesce(i >= F.col(f"_{s}_tail"), F.lit(False))))
    rows = rows.withColumn("qc", F.col("male_pass") & F.col("female_pass"))
    base = rows.groupBy(by).agg(*[F.min(F.when(F.col("qc"), F.col(f"{s}_cm"))).alias(f"_{s}_base") for s in sexes])
    rows = _of_group(rows, staging.put(base, "base"), by)
    new = {f"{s}_cm": F.round(F.col(f"{s}_cm") - F.col(f"_{s}_base"), 3) for s in sexes}
    return rows.withColumns(new).select(*markers.columns, "male_pass", "female_pass", "qc")


def _of_group(rows: DataFrame, groups: DataFrame, by: str) -> DataFrame:
    """Rows with what is known of their group: ``groups`` is a staged table of one row a group."""
    known = small_side(groups.withColumnRenamed(by, "_group"))
    return rows.join(known, F.col(by).eqNullSafe(F.col("_group")), "left").drop("_group")


def trim_report(trimmed: DataFrame, by: str = "lg") -> DataFrame:
    """Removed markers per group: in the male map only, the female map only, both."""
    m, f = F.col("male_pass"), F.col("female_pass")
    return trimmed.groupBy(by).agg(F.count_if(~m & f).alias("male"), F.count_if(m & ~f).alias("female"), F.count_if(~m & ~f).alias("both"))


def map_position(df: DataFrame, fraction: str = "r", by: str = "lg", order: tuple[str, ...] = ("line",), method: str = "kosambi") -> DataFrame:
    """Add ``cm``: the running sum of map distances along each group."""
    return Ordered(df, [by], list(order)).scan(sums={"cm": map_distance(F.col(fraction), method)}).df


def marker_index(df: DataFrame, by: list[str], order: list) -> DataFrame:
    return df.withColumn("marker", F.row_number().over(W.partitionBy(*by).orderBy(*order)))


def marker_intervals(markers: DataFrame) -> DataFrame:
    """Runs of markers on one contig with one chromosome: first and last position, chromosome, size.

    Markers come in ``line`` order; those of chromosome 0 are left out. Contigs are dealt to as many
    tasks as the markers need.
    """
    order = W.partitionBy("contig").orderBy("line")
    kept = markers.filter("chr > 0")
    kept = dealt(kept, kept.count(), "contig")
    new = F.when(F.lag("chr").over(order) == F.col("chr"), 0).otherwise(1)
    runs = kept.withColumn("new", new).withColumn("run", F.sum("new").over(order.rowsBetween(W.unboundedPreceding, W.currentRow)))
    ends = runs.groupBy("contig", "run").agg(F.min(F.struct("line", "pos")).alias("a"), F.max(F.struct("line", "pos")).alias("b"), F.first("chr").alias("chr"), F.count("*").alias("n"))
    return ends.select("contig", F.col("run").cast("bigint").alias("run"), F.col("a.pos").alias("start"), F.col("b.pos").alias("end"), "chr", "n")


def _left(start: list[int], end: list[int], home: list[int], n: list[int], num_snps: int, num_bps: int) -> list[int]:
    """Which intervals of one contig are left; ``end`` and ``n`` of those that others merge into change.

    A heap gives the shortest poor interval; intervals know their neighbours. One that was dropped,
    merged away or has grown since leaves an old entry in the heap, which is passed over.
    """
    count = len(start)
    alive, before, after = [True] * count, list(range(-1, count - 1)), [*range(1, count), -1]

    def poor(k: int) -> bool:
        return end[k] - start[k] + 1 < num_bps or n[k] < num_snps

    def unlink(k: int) -> None:
        alive[k] = False
        if before[k] >= 0:
            after[before[k]] = after[k]
        if after[k] >= 0:
            before[after[k]] = before[k]

    heap = [(end[k] - start[k] + 1, k) for k in range(count) if poor(k)] if count > 1 else []
    heapq.heapify(heap)
    while heap:
        length, k = heapq.heappop(heap)
        if not alive[k] or length != end[k] - start[k] + 1 or not poor(k):
            continue
        unlink(k)
        a, b = before[k], after[k]
        if a >= 0 and b >= 0 and home[a] == home[b]:
            end[a], n[a] = end[b], n[a] + n[b]
            unlink(b)
            if poor(a):
                heapq.heappush(heap, (end[a] - start[a] + 1, a))
    return [k for k in range(count) if alive[k]]


def _pruned(rows: pd.DataFrame, num_snps: int, num_bps: int) -> pd.DataFrame:
    """Drop the shortest poor interval of each contig until none is poor; equal neighbours merge."""
    rows = rows.sort_values(["contig", "run"])
    contig = rows["contig"].to_numpy()
    edges = [*np.flatnonzero(np.append(True, contig[1:] != contig[:-1])).tolist(), len(rows)]
    start, end, home, n = (rows[c].tolist() for c in ("start", "end", "chr", "n"))
    out: list[tuple] = []
    for lo, hi in zip(edges, edges[1:], strict=False):
        own = start[lo:hi], end[lo:hi], home[lo:hi], n[lo:hi]
        out += [(contig[lo], run, *(c[k] for c in own)) for run, k in enumerate(_left(*own, num_snps, num_bps), 1)]
    return pd.DataFrame(out, columns=["contig", "run", "start", "end", "chr", "n"])


def clean_map(markers: DataFrame, num_snps: int = 2, num_bps: int = 10000, bucket_rows: int = 200_000) -> DataFrame:
    """Marker intervals with the short and the poor ones pruned; a task takes whole contigs, about ``bucket_rows`` at a time."""
    kind = "contig string, run bigint, start bigint, end bigint, chr bigint, n bigint"
    intervals = Staging(markers.sparkSession, "intervals").put(marker_intervals(markers), "intervals")
    buckets = -(-intervals.count() // bucket_rows) + markers.sparkSession.sparkContext.defaultParallelism
    dealt = intervals.withColumn("bucket", F.pmod(F.xxhash64("contig"), F.lit(buckets)))
    return dealt.repartition(buckets, "bucket").groupBy("bucket").applyInPandas(lambda rows: _pruned(rows, num_snps, num_bps), kind)


def join_intervals(intervals: DataFrame, lengths: DataFrame) -> DataFrame:
    """Stretch a contig's intervals to cover it whole; borders fall midway between neighbours."""
    order = W.partitionBy("contig").orderBy("run")
    middle = lambda a, b: F.floor((a + b) / 2).cast("bigint")
    joined = intervals.join(lengths, "contig", "left")
    before, after = F.lag("end").over(order), F.lead("start").over(order)
    start = F.when(before.isNull(), F.lit(1).cast("bigint")).otherwise(middle(before, F.col("start")) + 1)
    end = F.when(after.isNull(), F.col("length")).otherwise(middle(F.col("end"), after))
    return joined.select("contig", "run", start.alias("start"), end.alias("end"), "chr")


def map_to_bed(markers: DataFrame, lengths: DataFrame, num_snps: int = 2, num_bps: int = 10000) -> DataFrame:
    """Bed pieces of a map: pruned intervals, whose uncertain borders become ``lo-hi`` bounds."""
    order = W.partitionBy("contig").orderBy("run")
    df = clean_map(markers, num_snps, num_bps).join(lengths, "contig")
    before, after = F.lag("end").over(order), F.lead("start").over(order)
    bound = lambda lo, hi: F.concat_ws("-", lo.cast("string"), hi.cast("string"))
    start = F.when(before.isNull(), F.lit("1")).otherwise(bound(before + 1, F.col("start")))
    end = F.when(after.isNull(), F.concat(F.col("length").cast("string"), F.lit("*"))).otherwise(bound(F.col("end"), after - 1))
    return df.select("contig", start.alias("start_s"), end.alias("end_s"), F.lit("?").alias("orientation"), "chr")


def _at_borders(pieces: DataFrame, sites: DataFrame, at: str) -> DataFrame:
    """Sites with what a sweep along the contig knows at their ``at``: pieces begun and ended, and the last of each.

    A piece has begun where its start is at or before the site, and lies behind where its end is
    before it. Borders and sites are one list of events in order, so there is no range join.
    """
    event = lambda x, rank, i, begun, ended, row: [F.col("contig"), x.alias("x"), F.lit(rank).alias("rank"), i.alias("i"), begun.alias("begun"), ended.alias("ended"), row.alias("site")]
    piece = F.struct("i", "s", "e", "chr")
    no_piece, no_site = F.lit(None).cast("struct<i int, s bigint, e bigint, chr bigint>"), F.lit(None).cast("struct<id int, lo bigint, hi bigint>")
    site = F.struct(F.col("id").cast("int").alias("id"), F.col("lo").cast("bigint").alias("lo"), F.col("hi").cast("bigint").alias("hi"))
    begins = pieces.select(*event(F.col("s"), 2, F.col("i"), piece, no_piece, no_site))
    ends = pieces.select(*event(F.col("e"), 1, F.col("i"), no_piece, piece, no_site))
    asks = [sites.select(*event(F.col(at), rank, F.col("id"), no_piece, no_piece, site)) for rank in (0, 3)]
    swept = Ordered(begins.unionAll(ends).unionAll(asks[0]).unionAll(asks[1]), ["contig"], ["x", "rank", "i"])
    swept = swept.scan(sums={"starts": F.col("begun").isNotNull().cast("bigint"), "ends": F.col("ended").isNotNull().cast("bigint")}, last={"last_begun": "begun", "last_ended": "ended"})
    told = swept.df.filter("site IS NOT NULL").groupBy("contig", "site").agg(
        F.max(F.when(F.col("rank") == 3, F.col("starts"))).alias(f"{at}_starts"), F.max(F.when(F.col("rank") == 0, F.col("ends"))).alias(f"{at}_ends"),
        F.max(F.when(F.col("rank") == 3, F.col("last_begun"))).alias(f"{at}_begun"), F.max(F.when(F.col("rank") == 0, F.col("last_ended"))).alias(f"{at}_behind"),
    )
    return told.select("contig", "site.*", f"{at}_starts", f"{at}_ends", f"{at}_begun", f"{at}_behind")


def cut_bed(bed: DataFrame, cuts: DataFrame, chromosomes: int | None = None) -> DataFrame:
    """Cut a bed at further sites (``cut_lo``, ``cut_hi``; a null ``cut_hi`` is a single site).

    A cut that crosses one border of a piece's certain part is trimmed to one side of it, one that
    crosses two is dropped. Cuts inside a piece split it; the first cut after a piece ends it; two
    pieces without a cut between them keep their uncertain border. A contig's pieces do not overlap.
    Stretches that no piece owns, and contigs that the bed lacks, go to every chromosome.
    """
    top = chromosomes or bed.agg(F.max("chr")).first()[0] or 0
    number = W.partitionBy("contig").orderBy("s", "e")
    certain = bed.select("contig", after_dash(F.col("start_s")).alias("s"), leading_int(F.col("end_s")).alias("e"), leading_int(F.col("start_s")).alias("first"), after_dash(F.col("end_s")).alias("last"), F.col("chr").cast("bigint").alias("chr"), "start_s", "end_s")
    pieces = certain.withColumn("i", F.row_number().over(number)).withColumn("next_s", F.lead("s").over(number))
    pieces = Staging(bed.sparkSession, "cut-bed").put(pieces, "pieces")
    sites = cuts.withColumn("id", F.row_number().over(W.partitionBy("contig").orderBy("cut_lo", "cut_hi"))).select("contig", "id", F.when(F.col("cut_hi").isNull(), F.col("cut_lo")).otherwise(F.col("cut_lo") - 1).alias("lo"), F.coalesce("cut_hi", "cut_lo").alias("hi"))
    lo, hi = _at_borders(pieces, sites, "lo"), _at_borders(pieces, sites, "hi")
    met = lo.join(hi.drop("lo", "hi"), ["contig", "id"])
    over_s, over_e = F.col("hi_starts") - F.col("lo_starts"), F.col("hi_ends") - F.col("lo_ends")
    met = met.filter(over_s + over_e <= 1)
    trimmed = met.select("contig", "id", F.when(over_e > 0, F.col("hi_behind.e") + 1).otherwise(F.col("lo")).alias("lo"), F.when(over_s > 0, F.col("hi_begun.s") - 1).otherwise(F.col("hi")).alias("hi"))
    placed = _at_borders(pieces, trimmed, "lo")
    within = F.when(F.col("hi") <= F.col("lo_begun.e"), F.struct(F.col("lo_begun.i").alias("i"), F.col("lo_begun.chr").alias("chr")))
    placed = placed.select("contig", "id", "lo", "hi", within.alias("in"), F.col("lo_behind").alias("after"))
    nth = F.row_number().over(W.partitionBy("contig", F.col("in").isNull(), "after.i").orderBy("lo", "hi"))
    owned = placed.withColumn("nth", nth).withColumn("owner", F.when(F.col("in").isNotNull(), F.col("in.chr")).when(F.col("nth") == 1, F.col("after.chr")))
    closing = owned.filter("in IS NULL AND after IS NOT NULL").select("contig", F.col("after.i").alias("i")).distinct()
    cut_only = owned.select("contig").distinct()
    text = lambda a, b: F.concat_ws("-", a.cast("string"), b.cast("string"))
    touched = pieces.join(cut_only, "contig", "left_semi")
    open_ = touched.join(closing, ["contig", "i"], "left_anti")
    between = open_.filter("next_s IS NOT NULL").select("contig", F.col("e").alias("lo"), (F.col("next_s") - 1).alias("hi"), F.col("chr").alias("owner"), text(F.col("e"), F.col("next_s") - 1).alias("end_s"))
    final = touched.filter("next_s IS NULL").join(closing.withColumn("cut", F.lit(True)), ["contig", "i"], "left")
    star = F.concat(F.col("last").cast("string"), F.lit("*"))
    final = final.select("contig", F.lit(2**62).alias("lo"), F.lit(2**62).alias("hi"), F.when(F.col("cut").isNull(), F.col("chr")).alias("owner"), F.when(F.col("cut").isNull(), F.concat(F.col("e").cast("string"), F.lit("-"), star)).otherwise(star).alias("end_s"))
    unknown = cut_only.join(pieces.select("contig"), "contig", "left_anti").select("contig", F.lit(2**62).alias("lo"), F.lit(2**62).alias("hi"), F.lit(None).cast("bigint").alias("owner"), F.lit("N*").alias("end_s"))
    borders = owned.select("contig", "lo", "hi", "owner", text(F.col("lo"), F.col("hi")).alias("end_s")).unionByName(between).unionByName(final).unionByName(unknown)
    order = W.partitionBy("contig").orderBy("lo", "hi")
    first = pieces.filter("i = 1").select("contig", "first", F.col("s").alias("first_s"))
    rows = borders.join(first, "contig", "left").withColumn("before", F.lag(F.struct("lo", "hi")).over(order))
    opening = F.when(F.col("first").isNull(), F.lit("1")).when(F.col("owner").isNull(), F.col("first").cast("string")).otherwise(text(F.col("first"), F.col("first_s")))
    start = F.when(F.col("before").isNull(), opening).otherwise(text(F.col("before.lo") + 1, F.col("before.hi") + 1))
    every = F.sequence(F.lit(1).cast("bigint"), F.lit(max(1, int(top))).cast("bigint"))
    cut = rows.select("contig", start.alias("start_s"), "end_s", F.lit("?").alias("orientation"), F.explode(F.when(F.col("owner").isNull(), every).otherwise(F.array("owner"))).alias("chr"))
    untouched = pieces.join(cut_only, "contig", "left_anti").select("contig", "start_s", "end_s", F.lit("?").alias("orientation"), "chr")
    return cut.unionAll(untouched)


def _broken(rows: Ordered) -> Ordered:
    """Add ``_new``: 1 where a block begins, by ``?`` or another number of signs than the row before."""
    now, before = F.col("orientation"), F.col("_was")
    new = F.when(F.col("_later").isNull(), 1).when(now == "?", 1).when((now != "") & (F.length(now) != F.length(before)), 1).when((now != "") & (before == "?"), 1).otherwise(0)
    return rows.select(_new=new)


def _blocks(la: DataFrame, by: str) -> Ordered:
    return _broken(Ordered(la, [by], ["line"]).scan(before={"_was": "orientation", "_later": F.lit(1)})).scan(sums={"block": F.col("_new")})


def orientation_blocks(la: DataFrame, by: str = "chr") -> DataFrame:
    """Add ``block``: a number that rises where the class of the orientation changes."""
    return _blocks(la, by).df.select(*la.columns, "block")


def prune_blocks(la: DataFrame, by: str = "chr") -> tuple[DataFrame, DataFrame]:
    """Rows of blocks with map support, and the rows of all other blocks."""
    df = Staging(la.sparkSession, "prune").put(orientation_blocks(la, by), "blocks")
    sums = df.groupBy(F.col(by).alias("_by"), F.col("block").alias("_block")).agg(F.sum("map_score").alias("support"))
    df = df.join(sums, (F.col(by) == F.col("_by")) & (F.col("block") == F.col("_block"))).drop("_by", "_block")
    return df.filter("support > 0").drop("support"), df.filter("support <= 0").drop("support")


def _fixed(side: str) -> Column:
    return (F.col(f"{side}_contig") != "null") & ((F.col(f"{side}_type") == "null") | F.col(f"{side}_type").startswith("chain"))


def remove_overlaps(bed: DataFrame, la: DataFrame) -> DataFrame:
    """Trim piece ends to the cut points that neighbouring linked pieces fix.

    An end that is linked (by no alignment or by a chain) fixes a cut; a cut moves to the piece
    beside it on the contig where that has none; ends that are free take their piece's cut. The
    last row of a piece decides its cut points; pieces that the bed lacks stay as they are.
    """
    minus = F.col("orientation").contains("-")
    lo, hi = F.least("start_pos", "alt_start"), F.greatest("end_pos", "alt_end")
    prev, following = _fixed("prev"), _fixed("next")
    cuts = la.withColumn("cs", F.when((prev & ~minus) | (following & minus), lo)).withColumn("ce", F.when((prev & minus) | (following & ~minus), hi))
    latest = lambda c: F.max_by(c, F.when(F.col(c).isNotNull(), F.col("line"))).alias(c)
    held = cuts.groupBy("contig", F.col("orig_start").alias("sm"), F.col("orig_end").alias("em")).agg(latest("cs"), latest("ce"))
    beside = W.partitionBy("contig").orderBy("sm", "em")
    known = bed_key(bed).select("contig", "sm", "em").distinct().join(held, ["contig", "sm", "em"], "left")
    spread = known.withColumn("s", F.coalesce("cs", F.lag("ce").over(beside) + 1)).withColumn("e", F.coalesce("ce", F.lead("cs").over(beside) - 1))
    joined = la.join(spread.select("contig", F.col("sm").alias("orig_start"), F.col("em").alias("orig_end"), "s", "e"), ["contig", "orig_start", "orig_end"], "left")
    free_start, free_end = (~prev & ~minus) | (~following & minus), (~prev & minus) | (~following & ~minus)
    start, end = F.when(free_start, F.coalesce("s", "start_pos")).otherwise(F.col("start_pos")), F.when(free_end, F.coalesce("e", "end_pos")).otherwise(F.col("end_pos"))
    return joined.withColumn("start_pos", start).withColumn("end_pos", end).select(*la.columns)


def _agp(la: DataFrame, name: Callable[[DataFrame], DataFrame], gap_rule: str, gap: int, scaffolds: bool) -> DataFrame:
    named = name(la.filter("end_pos - start_pos >= 0"))
    rows = Ordered(named, ["part"], ["line"]).scan(before={"_was": "orientation", "_was_start": "start_pos", "_was_end": "end_pos", "_later": F.lit(1)})
    later = F.col("_later").isNotNull()
    if scaffolds:
        rows = _broken(rows).scan(sums={"_no": F.col("_new")})
        rows = rows.select(obj=F.concat("obj", F.lit("."), F.col("_no").cast("string"))).grouped("part", "_no")
        later = F.col("_new") == 0
    sign_minus, sign_plus = F.col("orientation").contains("-"), F.col("orientation").contains("+") | (F.col("orientation") == "?")
    if gap_rule == "always":
        gapped = later
    else:
        linked = (F.col("prev_contig") == "null") | ((F.col("prev_type") != "null") & ~F.col("prev_type").startswith("chain"))
        apart = (F.col("prev_contig") != F.col("contig")) | (F.col("_was") != F.col("orientation")) | (sign_plus & (F.col("start_pos") != F.col("_was_end") + 1)) | (sign_minus & (F.col("end_pos") != F.col("_was_start") - 1))
        gapped = later & linked & apart
    rows = rows.select(gap=F.when(gapped & F.lit(gap > 0), gap).otherwise(0), size=F.col("end_pos") - F.col("start_pos") + 1)
    rows = rows.scan(sums={"stop": F.col("gap") + F.col("size"), "last": F.when(F.col("gap") > 0, 2).otherwise(1)}).df
    begin = F.col("stop") - F.col("size")
    piece = F.struct((begin + 1).alias("obj_beg"), F.col("stop").alias("obj_end"), F.col("last").alias("part_no"), F.lit("W").alias("ctype"), F.col("contig").alias("contig"), F.col("start_pos").alias("contig_beg"), F.col("end_pos").alias("contig_end"), F.when(sign_minus, "-").otherwise("+").alias("orientation"), F.lit(None).cast("bigint").alias("gap_length"))
    none = F.lit(None).cast("bigint")
    hole = F.struct((begin - F.col("gap") + 1).alias("obj_beg"), begin.alias("obj_end"), (F.col("last") - 1).alias("part_no"), F.lit("U").alias("ctype"), F.lit(None).cast("string").alias("contig"), none.alias("contig_beg"), none.alias("contig_end"), F.lit(None).cast("string").alias("orientation"), F.col("gap").cast("bigint").alias("gap_length"))
    return rows.select("obj", F.explode(F.when(F.col("gap") > 0, F.array(hole, piece)).otherwise(F.array(piece))).alias("x")).select("obj", "x.*")


def _chromosome(prefix: str) -> Callable[[DataFrame], DataFrame]:
    return lambda df: df.withColumn("obj", F.concat(F.lit(prefix), F.col("chr").cast("string"))).withColumn("part", F.col("chr"))


def make_agp_full(la: DataFrame, prefix: str = "CHR", gap: int = 100) -> DataFrame:
    """One object per chromosome with a gap before every later piece."""
    return _agp(la, _chromosome(prefix), "always", gap, False)


def make_agp_full2(la: DataFrame, prefix: str = "CHR", gap: int = 100) -> DataFrame:
    """One object per chromosome; no gap inside partial haplotypes or where one contig was cut."""
    return _agp(la, _chromosome(prefix), "links", gap, False)


def make_agp(la: DataFrame, prefix: str = "CHR", gap: int = 100) -> DataFrame:
    """One object per orientation block, gaps inside."""
    return _agp(la, _chromosome(prefix), "always", gap, True)


def make_agp2(la: DataFrame, prefix: str = "CHR", gap: int = 100) -> DataFrame:
    """One object per orientation block with the gap rule of ``make_agp_full2``."""
    return _agp(la, _chromosome(prefix), "links", gap, True)


def agp_links(agp: DataFrame) -> DataFrame:
    """Two alignment rows for each pair of neighbours: components linked by one made-up read.

    ``agp`` gives the pieces of contigs (``contig`` within scaffold ``obj``) in object order.
    """
    ordered = W.partitionBy("obj").orderBy("obj_beg")
    rows = agp.filter("ctype = 'W'").withColumn("before", F.lag(F.struct("contig", "contig_beg", "contig_end", "orientation", "part_no")).over(ordered)).filter("before IS NOT NULL")
    name = F.concat_ws("_", F.lit("agp"), F.col("obj"), F.col("part_no").cast("string"))

    def side(prefix: str, at_end: Column, lo: int) -> Column:
        c = lambda x: F.col(f"{prefix}{x}").cast("bigint") if x != "contig" and x != "orientation" else F.col(f"{prefix}{x}")
        start = F.when(at_end, c("contig_end") - 100).otherwise(c("contig_beg") - 1)
        end = F.when(at_end, c("contig_end")).otherwise(c("contig_beg") + 99)
        big = lambda v: F.lit(v).cast("bigint")
        return F.struct(name.alias("qname"), big(200).alias("qlen"), big(lo).alias("qstart"), big(lo + 100).alias("qend"), c("orientation").alias("strand"), c("contig").alias("tname"), (c("contig_end") - c("contig_beg") + 1).alias("tlen"), start.alias("tstart"), end.alias("tend"), big(60).alias("mapq"))

    first = side("before.", F.col("before.orientation") != "-", 0)
    second = side("", F.col("orientation") == "-", 100)
    return rows.select(F.explode(F.array(first, second)).alias("x")).select("x.*")


def assembly_parts(fasta: DataFrame, agp: DataFrame) -> DataFrame:
    """One row per assembly part with its sequence: ``(obj, part_no, seq)``. Missing contigs raise."""
    joined = agp.join(fasta, "contig", "left")
    cut = F.expr("substring(seq, CAST(contig_beg AS INT), CAST(contig_end - contig_beg + 1 AS INT))")
    missing = F.raise_error(F.concat(F.lit("contig not found: "), F.coalesce("contig", F.lit("null")))).cast("string")
    size = F.col("gap_length") if "gap_length" in agp.columns else F.lit(0)
    text = F.when(F.col("ctype") != "W", F.repeat(F.lit("N"), size.cast("int"))).when(F.col("seq").isNull(), missing).when(F.col("orientation") == "-", reverse_complement(cut)).otherwise(cut)
    return joined.select("obj", "part_no", text.alias("seq"))


def build_fasta(fasta: DataFrame, agp: DataFrame, unused: bool = False) -> DataFrame:
    """Objects' whole sequences, parts in order; ``unused`` adds the contigs no object holds.

    A whole object is one string, which Spark limits to 2 GB; ``build_fasta_chunks`` has no such limit.
    """
    parts = assembly_parts(fasta, agp).groupBy("obj").agg(F.sort_array(F.collect_list(F.struct("part_no", "seq"))).alias("p"))
    whole = parts.select(F.col("obj").alias("name"), F.concat_ws("", F.transform("p", lambda x: x["seq"])).alias("seq"))
    if not unused:
        return whole
    return whole.unionAll(fasta.join(agp.select("contig"), "contig", "left_anti").select(F.col("contig").alias("name"), "seq"))


def build_fasta_chunks(chunks: DataFrame, agp: DataFrame, unused: bool = False, chunk: int = CHUNK) -> DataFrame:
    """As ``build_fasta`` for sequences of any length: ``(name, chunk, seq)`` from ``(contig, chunk, seq)``.

    A part meets the chunks of its contig by number; pieces get their place in the object from running
    sums over its parts and are put together chunk by chunk. A contig or a stretch that the sequences
    lack raises.
    """
    whole = F.col("ctype") == "W"
    gap = F.coalesce(F.col("gap_length"), F.lit(0)) if "gap_length" in agp.columns else F.lit(0)
    size = F.when(whole, F.col("contig_end") - F.col("contig_beg") + 1).otherwise(gap).cast("bigint")
    placed = Ordered(agp.withColumn("size", size), ["obj"], ["part_no"]).scan(sums={"stop": F.col("size")}).df.filter("size > 0").withColumn("begin", F.col("stop") - F.col("size"))
    parts = placed.filter(whole).select(F.col("obj").alias("name"), "contig", F.col("contig_beg").cast("bigint").alias("beg"), F.col("contig_end").cast("bigint").alias("end"), "orientation", "begin")
    spread = parts.withColumn("chunk", F.explode(F.sequence(F.expr(f"(beg - 1) div {chunk}"), F.expr(f"(end - 1) div {chunk}"))))
    lo, hi = F.greatest(F.col("beg") - 1, F.col("chunk") * chunk), F.least(F.col("end"), (F.col("chunk") + 1) * chunk)
    cut = F.substring("seq", (lo - F.col("chunk") * chunk + 1).cast("int"), (hi - lo).cast("int"))
    missing = F.raise_error(F.concat(F.lit("sequence not found: "), F.coalesce("contig", F.lit("null")))).cast("string")
    text = F.when(F.col("seq").isNull() | (F.length(cut) < hi - lo), missing).when(F.col("orientation") == "-", reverse_complement(cut)).otherwise(cut)
    at = F.when(F.col("orientation") == "-", F.col("begin") + F.col("end") - hi).otherwise(F.col("begin") + lo - F.col("beg") + 1)
    pieces = spread.join(chunks.select("contig", "chunk", "seq"), ["contig", "chunk"], "left").select("name", at.alias("at"), text.alias("seq"))
    # a gap is written chunk by chunk of the object, as it may be longer than any row
    holes = placed.filter(~whole).select(F.col("obj").alias("name"), "begin", "stop", F.explode(F.sequence(F.expr(f"begin div {chunk}"), F.expr(f"(stop - 1) div {chunk}"))).alias("c"))
    first, behind = F.greatest(F.col("begin"), F.col("c") * chunk), F.least(F.col("stop"), (F.col("c") + 1) * chunk)
    holes = holes.select("name", first.alias("at"), F.repeat(F.lit("N"), (behind - first).cast("int")).alias("seq"))
    built = chunked(pieces.unionAll(holes), ["name"], chunk)
    if not unused:
        return built
    return built.unionAll(chunks.join(agp.select("contig"), "contig", "left_anti").select(F.col("contig").alias("name"), "chunk", "seq"))


def marey_data(markers: DataFrame, agp: DataFrame, variant: str = "interval") -> DataFrame:
    """Markers moved through the assembly, as map against position; unlifted ones are left out.

    ``interval`` keeps both maps, ``average`` their mean.
    """
    lifted = liftover(markers, agp).filter("lifted_pos IS NOT NULL")
    base = [F.col("lifted_name").alias("obj"), F.col("lifted_pos").alias("pos"), "lg", F.lit(1).alias("map_id")]
    if variant == "interval":
        return lifted.select(*base, "male_cm", "female_cm")
    return lifted.select(*base, ((F.col("male_cm") + F.col("female_cm")) * 0.5).alias("cm"))


def marey_data_multi(maps: DataFrame, agp: DataFrame) -> DataFrame:
    """Several maps (``map_id``) whose markers hold ``pairs``, an array of (first, second) cM intervals."""
    lifted = liftover(maps, agp).filter("lifted_pos IS NOT NULL")
    return lifted.select(F.col("lifted_name").alias("obj"), F.col("lifted_pos").alias("pos"), "lg", "map_id", F.explode("pairs").alias("p")).select("obj", "pos", "lg", "map_id", F.col("p.first").alias("cm1"), F.col("p.second").alias("cm2"))


def marey_split(marey: DataFrame, lg: str) -> DataFrame:
    return marey.filter(F.col("lg") == lg)


def marey_split_merge(marey: DataFrame, groups: list[str], each: Callable[[DataFrame], DataFrame] = lambda df: df) -> DataFrame:
    """Apply ``each`` to every named group by itself and put the results together."""
    parts = [each(marey_split(marey, g)) for g in groups]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def filter_outliers(marey: DataFrame, by: str = "lg", x: str = "pos", y: str = "male_cm", resolution: int = 100) -> DataFrame:
    """Add ``qc``: FAIL for markers far off a spline of cM on position in several sliding windows.

    Two passes use windows of a tenth and a seventh of a group's markers, each moved by half its
    width; a marker gains a penalty in every window where its residual is above twice the mean,
    the upper half of the last window one more, and fails at three. The spline is cubic, with a
    knot per ``resolution`` (second pass: 0.7 of it) markers at quantiles. In B-spline form a row
    meets four basis functions, so its Gram sums are aggregated per group and stretch between knots,
    and the banded equations that come of them are solved group by group in the tasks.

    Rows are sorted once, which gives their places; a place tells the stretch, so that later steps
    meet rows with the knots, and with the weights, of their stretches.
    """
    staging = Staging(marey.sparkSession, "outliers")
    lined = with_row_number(marey, [f"`{c}`" for c in (by, x, y)], "_line", rows=marey.count())
    spans = lined.groupBy(by).agg(F.count("*").alias("n"), F.count(x).alias("_known"), F.min(x).alias("_least"), F.max(x).alias("_most"), F.min("_line").alias("_first"))
    df = _of_group(lined, staging.put(spans, "spans"), by).withColumn("i", F.col("_line") - F.col("_first") + 1)
    df = df.withColumn("u", ((F.col(x) - F.col("_least")) / F.greatest(F.col("_most") - F.col("_least"), F.lit(1))).cast("double"))
    # the order by position is that by u, rows without one first
    place = F.when(F.col("u").isNotNull(), F.col("i") - (F.col("n") - F.col("_known")) - 1)
    df = df.withColumn("s", place).withColumn("m", F.greatest(F.col("_known") - 1, F.lit(1))).select(*marey.columns, "n", "i", "u", "s", "m")
    both = df
    passes = ((resolution, 10), (int(resolution * 0.7), 7))
    for k, (size, _) in enumerate(passes):
        both = _with_residual(both, by, y, size, f"res{k}", df)
    both = staging.put(both.drop("u", "s", "m"), "residuals")
    half = [F.greatest(F.bround(F.col("n") / part / 2, 0).cast("int"), F.lit(1)) for _, part in passes]
    for k in range(2):
        count = F.greatest(F.ceil((F.col("n") - half[k]) / half[k]).cast("int"), F.lit(1))
        slot = F.least(F.floor((F.col("i") - 1) / half[k]).cast("int"), count)
        one, two = F.least(slot, count - 1), F.greatest(F.least(slot, count) - 1, F.lit(0))
        both = both.withColumns({f"count{k}": count, f"w{k}0": one, f"w{k}1": F.when(one != two, two)})
    # a group has a window for every half of a tenth or a seventh of its rows, however many rows those are
    windows = [f"w{k}{m}" for k in range(2) for m in range(2)]
    sums = [c for k in range(2) for c in (F.sum(F.abs(f"res{k}")).alias(f"off{k}"), F.count(f"res{k}").alias(f"rows{k}"))]
    met = staging.put(both.groupBy(F.col(by).alias("_group"), *windows).agg(*sums), "windows")
    penalty = F.lit(0)
    for k in range(2):
        each = met.select("_group", F.explode(F.array(f"w{k}0", f"w{k}1")).alias("_window"), f"off{k}", f"rows{k}").filter("_window IS NOT NULL")
        means = staging.put(each.groupBy("_group", "_window").agg((F.sum(f"off{k}") / F.sum(f"rows{k}")).alias("_mean")), "means")
        for m in range(2):
            window, mean = F.col(f"w{k}{m}"), f"_mean{k}{m}"
            of = F.broadcast(means.select(F.col("_group").alias(f"_group{k}{m}"), F.col("_window").alias(f"_window{k}{m}"), F.col("_mean").alias(mean)))
            both = both.join(of, F.col(by).eqNullSafe(F.col(f"_group{k}{m}")) & (window == F.col(f"_window{k}{m}")), "left")
            late = (window == F.col(f"count{k}") - 1) & (F.col("i") >= F.floor((window * half[k] + 1 + F.col("n")) / 2))
            off = (F.abs(f"res{k}") > 2 * F.col(mean)).cast("int") + late.cast("int")
            penalty = penalty + (F.when(window.isNotNull(), off).otherwise(0) if m else off)
    return both.withColumn("penalty", penalty.cast("int")).withColumn("qc", F.when(F.col("penalty") >= 3, "FAIL").otherwise("PASS")).select(*marey.columns, "penalty", "qc")


def _cubic(df: DataFrame) -> DataFrame:
    """Add ``b0`` to ``b3``: the four cubic B-splines at ``u`` between the middle two of the knots ``t0`` to ``t5``.

    Their recurrence goes up a degree a step, so that no step writes out the one before it again.
    """
    left = [F.col("u") - F.col(f"t{2 - d}") for d in range(3)]
    right = [F.col(f"t{3 + d}") - F.col("u") for d in range(3)]
    kept = df.columns
    out = [F.lit(1.0)]
    for degree in (1, 2, 3):
        # knots that coincide leave nothing to share out
        shares = {f"_share{r}": F.coalesce(F.try_divide(out[r], right[r] + left[degree - 1 - r]), F.lit(0.0)) for r in range(degree)}
        df = df.select(*kept, *[v.alias(k) for k, v in shares.items()])
        carried, following = F.lit(0.0), []
        for r in range(degree):
            following.append(carried + right[r] * F.col(f"_share{r}"))
            carried = left[degree - 1 - r] * F.col(f"_share{r}")
        df = df.select(*kept, *[b.alias(f"b{i}") for i, b in enumerate([*following, carried])])
        out = [F.col(f"b{i}") for i in range(degree + 1)]
    alone = F.col("t2") == F.col("t3")
    return df.select(*kept, *[F.when(alone, F.lit(float(i == 0))).otherwise(b).alias(f"b{i}") for i, b in enumerate(out)])


def _ranked(df: DataFrame, by: str) -> DataFrame:
    """Rows with their place ``s`` from 0 by ``u`` in the group, among those that have one, and the last such place ``m``."""
    counts = Staging(df.sparkSession, "spline").put(df.groupBy(by).agg(F.greatest(F.count("u") - 1, F.lit(1)).alias("m")), "counts")
    placed = Ordered(df, [by], ["u"]).scan(sums={"s": F.col("u").isNotNull().cast("bigint")}).df
    return _of_group(placed.withColumn("s", F.when(F.col("u").isNotNull(), F.col("s") - 1)), counts, by)


def _stretches(ranked: DataFrame, by: str, size: int) -> DataFrame:
    """``(by, seg, t0 .. t5, j)``: stretches between knots of every group, each with the nodes ``j`` it follows.

    Node j of 0 .. k + 1 lies at place j / (k + 1) * m; nodes at one position are one knot. The last
    knot ends the last stretch, unless it is alone, so its nodes go to that one.
    """
    staging = Staging(ranked.sparkSession, "spline")
    # between the rows of places s and s + 1; either is met with the node, and the lesser is that of s
    least = lambda s: F.greatest(F.floor((s * (F.col("k") + 1) + F.col("m") - 1) / F.col("m")), F.lit(0))
    known = ranked.filter(F.col("s").isNotNull() & F.col(by).isNotNull()).select(by, "u", "s", "m", _nodes_of(size).alias("k"))
    first, last = least(F.col("s") - 1), F.least(least(F.col("s") + 1) - 1, F.col("k") + 1)
    held = known.filter(first <= last).withColumn("j", F.explode(F.sequence(first, last)))
    ends = held.groupBy(by, "j", "m", "k").agg(F.min("u").alias("u"), F.max("u").alias("after"))
    exact = F.col("j") * F.col("m") / (F.col("k") + 1)
    nodes = ends.select(by, "j", (F.col("u") + (exact - F.floor(exact)) * (F.col("after") - F.col("u"))).alias("u"))
    nodes = nodes.groupBy(by, "u").agg(F.min("j").alias("low"), F.max("j").alias("high"))
    placed = staging.put(Ordered(nodes, [by], ["u"]).scan(sums={"seg": F.lit(1)}).df, "nodes")
    edges = staging.put(placed.groupBy(by).agg(F.count("*").alias("nodes"), F.min("u").alias("start"), F.max("u").alias("stop"), F.max("high").alias("top")), "edges")
    # a knot is one of the six of the stretches beside it
    beside = F.explode(F.array(*[F.struct(F.lit(d).alias("d"), (F.col("seg") + 2 - d).alias("seg")) for d in range(6)]))
    spread = placed.select(by, "u", "low", "high", beside.alias("b")).select(by, "u", "low", "high", "b.d", "b.seg")
    of = lambda c, d: F.max(F.when(F.col("d") == d, F.col(c)))
    knots = spread.groupBy(by, "seg").agg(*[of("u", d).alias(f"t{d}") for d in range(6)], of("low", 2).alias("low"), of("high", 2).alias("high"))
    knots = _of_group(knots, edges, by).filter("t2 IS NOT NULL AND (seg < nodes OR nodes = 1)")
    filled = [F.coalesce(f"t{d}", "start" if d < 2 else "stop").alias(f"t{d}") for d in range(6)]
    upto = F.when(F.col("seg") >= F.col("nodes") - 1, F.col("top")).otherwise(F.col("high"))
    return staging.put(knots.select(by, "seg", *filled, F.explode(F.sequence("low", upto)).alias("j")), "stretches")


def _nodes_of(size: int) -> Column:
    return F.greatest(F.bround(F.col("n") / size, 0), F.lit(1)).cast("bigint")


def _met(rows: DataFrame, stretches: DataFrame, by: str, size: int, how: str) -> DataFrame:
    """Rows with the stretch of the last node up to their place, which is joined by a hash where stretches are many.

    Of rows at one position some may meet the stretch that ends there; its splines have the same values.
    """
    known = stretches.withColumnRenamed(by, "_group").withColumnRenamed("j", "_j")
    if (count := stretches.count()) > _BROADCAST:
        known = dealt(known, count, "_group", "_j").hint("shuffle_hash")
    else:
        known = F.broadcast(known)
    # rows without a place meet none, and are dealt to all tasks
    node = F.coalesce(F.expr("s * (_k + 1) div m"), -1 - F.pmod(F.xxhash64("u", "n", *([] if "i" not in rows.columns else ["i"])), F.lit(1 << 20)))
    rows = rows.withColumn("_k", _nodes_of(size)).withColumn("_node", node)
    return rows.join(known, (F.col(by) == F.col("_group")) & (F.col("_node") == F.col("_j")), how).drop("_k", "_node", "_group", "_j")


def _with_residual(df: DataFrame, by: str, y: str, size: int, name: str, ranked: DataFrame | None = None) -> DataFrame:
    """Add ``name``: ``y`` less its least-squares fit by cubics between one node per ``size`` rows.

    ``ranked`` has the rows with their places ``s`` and the last place ``m``, as then has ``df``.
    """
    kept, kind, staging = df.columns, dict(df.dtypes)[by], Staging(df.sparkSession, "spline")
    if ranked is None:
        df = ranked = staging.put(_ranked(df, by), "rows")
    stretches = _stretches(ranked, by, size)
    used = ranked.filter(F.col("s").isNotNull() & F.col(y).isNotNull()).select(by, y, "n", "u", "s", "m")
    based = _cubic(_met(used, stretches, by, size, "inner"))
    pairs = [(i, j) for i in range(4) for j in range(i, 4)]
    sums = [F.sum(F.col(f"b{i}") * F.col(f"b{j}")).alias(f"g{i}{j}") for i, j in pairs] + [F.sum(F.col(f"b{i}") * F.col(y)).cast("double").alias(f"p{i}") for i in range(4)]
    filled = stretches.select(by, "seg").distinct().join(based.groupBy(by, "seg").agg(*sums), [by, "seg"], "left").fillna(0.0)
    fitted = staging.put(filled.groupBy(by).applyInPandas(_solve, f"`{by}` {kind}, seg bigint, " + ", ".join(f"c{i} double" for i in range(4))), "weights")
    # on a stretch the spline is one cubic, which its values at four points give: rows need no basis functions
    points = stretches.drop("j").distinct().join(fitted, [by, "seg"]).withColumn("at", F.explode(F.array(*map(F.lit, range(4)))))
    points = _cubic(points.withColumn("u", F.col("t2") + (F.col("t3") - F.col("t2")) * F.col("at") / 3))
    value = sum(F.col(f"b{i}") * F.col(f"c{i}") for i in range(4))
    valued = points.groupBy(by, "seg", "t2", "t3").agg(*[F.max(F.when(F.col("at") == k, value)).alias(f"v{k}") for k in range(4)])
    powers = [(1, 0, 0, 0), (-5.5, 9, -4.5, 1), (9, -22.5, 18, -4.5), (-4.5, 13.5, -13.5, 4.5)]
    curve = [sum(F.col(f"v{k}") * F.lit(float(c)) for k, c in enumerate(row)).alias(f"a{i}") for i, row in enumerate(powers)]
    curves = valued.select(by, "seg", F.col("t2").alias("from"), (F.col("t3") - F.col("t2")).alias("width"), *curve)
    curves = staging.put(stretches.select(by, "seg", "j").join(curves, [by, "seg"]).drop("seg"), "curves")
    share = F.coalesce(F.try_divide(F.col("u") - F.col("from"), F.col("width")), F.lit(0.0))
    met = _met(df, curves, by, size, "left").withColumn("_share", F.when(F.col("from").isNotNull(), share))
    rise = F.lit(0.0)
    for i in (3, 2, 1):
        rise = F.col("_share") * (F.col(f"a{i}") + rise)
    return met.withColumn(name, F.col(y) - (F.col("a0") + rise)).select(*kept, name)


def _solve(group: pd.DataFrame) -> pd.DataFrame:
    """Weights of one group's basis functions: the banded normal equations, by elimination.

    A function that no row decides has a pivot of zero; any weight fits it, and it gets zero.
    """
    group = group.sort_values("seg")
    n = len(group)
    band, right = np.zeros((4, n + 3)), np.zeros(n + 3)
    for i in range(4):
        right[i : i + n] += group[f"p{i}"].to_numpy(float)
        for j in range(i, 4):
            band[j - i, i : i + n] += group[f"g{i}{j}"].to_numpy(float)
    diagonal, pivot = band[0].copy(), band[0].copy()
    factor = np.zeros((4, n + 3))  # factor[d, k]: by what row k is taken off row k + d
    for k in range(n + 3):
        if pivot[k] <= 1e-12 * max(diagonal[k], 1e-300):
            pivot[k] = 0.0
            continue
        below = band[1:, k].copy()
        factor[1:, k] = below / pivot[k]
        for d in range(1, min(4, n + 3 - k)):
            pivot[k + d] -= factor[d, k] * below[d - 1]
            right[k + d] -= factor[d, k] * right[k]
            for e in range(1, min(4 - d, n + 3 - k - d)):
                band[e, k + d] -= factor[d, k] * below[d + e - 1]
    weight = np.zeros(n + 6)
    for k in range(n + 2, -1, -1):
        if pivot[k] > 0:
            weight[k] = right[k] / pivot[k] - factor[1:, k] @ weight[k + 1 : k + 4]
    return pd.DataFrame({group.columns[0]: group.iloc[:, 0], "seg": group["seg"]} | {f"c{i}": weight[i : i + n] for i in range(4)})
