"""Greedy and iterative operators, run as rounds of joins that decide all independent rows at once."""

from __future__ import annotations

import functools
import heapq

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from markerloom.functions.scalars import bed_key, to_bin
from markerloom.operators.aggregates import assign_by_margin
from markerloom.operators.components import connected_components
from markerloom.operators.numbering import with_row_number
from markerloom.operators.settling import Settling
from markerloom.plans.staging import Staging, small_side


#: Rounds over the whole table before what is left is looked at component by component.
_SPREAD_ROUNDS = 8
#: Components are looked at earlier where a round leaves more than this share of its rows.
_SLOW = 0.7


def _in_turn(rows: pd.DataFrame) -> pd.DataFrame:
    """Rows of whole components that are accepted, taken one after another by their number."""
    taken, kept = set(), []
    rows = rows.sort_values("turn")
    for k, (a, b, take) in enumerate(zip(rows["a"], rows["b"], rows["take"], strict=True)):
        if a not in taken and b not in taken:
            taken.add(take)
            kept.append(k)
    return rows.iloc[kept][["turn"]]


def _accepted(rows: DataFrame, component_rows: int) -> DataFrame:
    """``turn`` of the rows (turn, a, b, take) accepted one after another by ``turn``.

    A row is accepted if no earlier one has taken either of its ends; it then takes its end
    ``take``. A row that is the first of all at both of its ends depends on no other, so each round
    accepts all of these and drops every row that meets an end they take. A long chain of dependent
    rows would need as many rounds; so after some rounds, or once a round settles few rows, what is
    left is split into components, and those of up to ``component_rows`` rows are walked in order,
    some of them in each task. Larger ones go on in rounds, which end because every round accepts the
    first row left.
    """
    staging = Staging(rows.sparkSession, "greedy")
    left = staging.put(rows.select("turn", "a", "b", "take"), "left")
    parts: list[DataFrame] = []
    count, size, slow, split = 0, left.count(), False, False
    while size:
        count += 1
        if count % _SPREAD_ROUNDS == 0 or (slow and not split):
            split = True  # once early; larger components then go on in rounds
            named = left.join(connected_components(left, "a", "b"), F.col("a") == F.col("node")).drop("node")
            named = staging.put(named, "named")
            small = named.groupBy("component").agg(F.count("*").alias("n")).filter(F.col("n") <= component_rows).select("component")
            buckets = -(-size // max(1, component_rows)) + rows.sparkSession.sparkContext.defaultParallelism
            dealt = named.join(small, "component", "left_semi").withColumn("bucket", F.pmod(F.xxhash64("component"), F.lit(buckets)))
            walked = dealt.repartition(buckets, "bucket").groupBy("bucket").applyInPandas(_in_turn, rows.select("turn").schema)
            parts.append(staging.put(walked, "walked"))
            following = staging.put(named.join(small, "component", "left_anti").drop("component"), "left")
            staging.drop(named)
        else:
            ends = left.select(F.col("a").alias("end"), "turn").unionAll(left.select("b", "turn"))
            # the first of all at both ends is the least turn of two of them, or of one that is both
            first = ends.groupBy("end").agg(F.min("turn").alias("turn")).groupBy("turn").agg(F.count("*").alias("n"))
            accepted = staging.put(left.join(first, "turn").filter(F.col("n") == F.when(F.col("a") == F.col("b"), 1).otherwise(2)).select("turn", "take"), "accepted")
            parts.append(accepted.select("turn"))
            free = left
            for end in ("a", "b"):
                free = free.join(accepted.select(F.col("take").alias(end)).distinct(), end, "left_anti")
            following = staging.put(free.select("turn", "a", "b", "take"), "left")
        staging.drop(left)
        left, before, size = following, size, following.count()
        slow = size > _SLOW * before
    if not parts:
        return rows.select("turn").limit(0)
    return functools.reduce(DataFrame.unionAll, parts)


def full_haplotypes(chains: DataFrame, min_score: float = 50, max_gap: int = 10000, component_rows: int = 500_000) -> DataFrame:
    """Contigs that another one covers: score of ``min_score`` per base and few bases unaligned.

    Chains are judged in ``id`` order; a contig already taken blocks later chains of either side.
    Where both sides qualify, the one with the lesser gap is taken (the target on ties).
    """
    gap_t, gap_q = F.col("tsize") - (F.col("tend") - F.col("tstart")), F.col("qsize") - (F.col("qend") - F.col("qstart"))
    fit_t, fit_q = (F.col("score") >= min_score * F.col("tsize")) & (gap_t <= max_gap), (F.col("score") >= min_score * F.col("qsize")) & (gap_q <= max_gap)
    take = F.when(fit_t & (~fit_q | (gap_t <= gap_q)), F.col("tname")).otherwise(F.col("qname"))
    rows = chains.filter("tname <> qname").filter(fit_t | fit_q).withColumn("flagged", take)
    accepted = _accepted(rows.select(F.col("id").alias("turn"), F.col("tname").alias("a"), F.col("qname").alias("b"), F.col("flagged").alias("take")), component_rows)
    done = rows.join(accepted.select(F.col("turn").alias("id")), "id", "left_semi")
    minus, is_t = F.col("qstrand") == "-", F.col("flagged") == F.col("tname")
    flip = lambda size, lo, hi: (F.when(minus, F.col(size) - F.col(hi)).otherwise(F.col(lo)), F.when(minus, F.col(size) - F.col(lo)).otherwise(F.col(hi)))
    (q_lo, q_hi), (t_lo, t_hi) = flip("qsize", "qstart", "qend"), (F.col("tstart"), F.col("tend"))
    pick = lambda x, y: F.when(is_t, x).otherwise(y)
    return done.select(
        "score", F.col("flagged").alias("contig"), F.lit(1).cast("bigint").alias("start"), pick(F.col("tsize"), F.col("qsize")).alias("end"), pick(F.col("qname"), F.col("tname")).alias("partner"), F.lit(1).cast("bigint").alias("partner_start"), pick(F.col("qsize"), F.col("tsize")).alias("partner_size"),
        pick(t_lo + 1, q_lo + 1).alias("aligned_start"), pick(t_hi, q_hi).alias("aligned_end"), F.col("qstrand").alias("strand"), pick(q_lo + 1, t_lo + 1).alias("partner_aligned_start"), pick(q_hi, t_hi).alias("partner_aligned_end"), "id",
    )


def scored_haplotypes(records: DataFrame, limit: int = 2000, component_rows: int = 500_000) -> DataFrame:
    """Records with score >= (length - limit) / limit, best first, unless their partner is taken.

    Of one piece's records the best counts; ties go by contig, partner and start.
    """
    order = W.partitionBy("contig", "start", "end").orderBy(F.desc("score"), "partner")
    best = records.filter(F.col("score") >= (F.col("end") - F.col("start") + 1 - limit) / limit).withColumn("rn", F.row_number().over(order)).filter("rn = 1").drop("rn")
    numbered = with_row_number(best, ["-score", "contig", "partner", "start", "end"], "turn")
    accepted = _accepted(numbered.select("turn", F.col("contig").alias("a"), F.col("partner").alias("b"), F.col("contig").alias("take")), component_rows)
    return numbered.join(accepted, "turn", "left_semi").select(*records.columns)


def remove_haplotypes(bed: DataFrame, haplotypes: DataFrame) -> DataFrame:
    """Pieces named by haplotype records go to a chromosome of their own, their neighbours are clipped.

    Only the best record of a piece counts (score, then aligned start).
    """
    order = W.partitionBy("contig", "sm", "em").orderBy(F.desc("score"), "aligned_start")
    first = haplotypes.select("contig", F.col("start").alias("sm"), F.col("end").alias("em"), "score", "aligned_start", "aligned_end").withColumn("rn", F.row_number().over(order)).filter("rn = 1").select("contig", "sm", "em", "aligned_start", "aligned_end")
    top = F.broadcast(bed.agg(F.max("chr").alias("top")).withColumn("one", F.lit(1)))
    beside = W.partitionBy("contig").orderBy("sm", "em")
    keyed = bed_key(bed).join(first, ["contig", "sm", "em"], "left").withColumn("one", F.lit(1)).join(top, "one")
    after, before = F.lead("aligned_start").over(beside), F.lag("aligned_end").over(beside)
    number = lambda c: F.regexp_extract(c, r"(\d+)\*?$", 1).cast("bigint")
    lead_ = F.regexp_extract("start_s", r"^(\d+)", 1).cast("bigint")
    start = F.when(F.col("aligned_start").isNotNull(), F.col("aligned_start").cast("string")).when(before.isNotNull(), F.greatest(before + 1, lead_).cast("string")).otherwise(F.col("start_s"))
    end = F.when(F.col("aligned_end").isNotNull(), F.col("aligned_end").cast("string")).when(after.isNotNull(), F.least(after - 1, number("end_s")).cast("string")).otherwise(F.col("end_s"))
    return keyed.select("contig", start.alias("start_s"), end.alias("end_s"), "orientation", F.when(F.col("aligned_start").isNotNull(), F.col("top") + 1).otherwise(F.col("chr")).cast("bigint").alias("chr"))


def propagate(la: DataFrame, score_diff: float = 2, max_rounds: int | None = None, bridge: bool = False) -> DataFrame:
    """Settle pieces that lie in several chromosomes, pass after pass until nothing changes.

    Neighbours are those in ``line`` order of the whole table, so that a piece at a chromosome's
    border has one in the next chromosome. A pass only drops rows and nulls links, so the passes come
    to an end; they are as many as asked for by ``max_rounds`` at most. Each looks at what the one
    before touched, once that is little.
    """
    settling, passes = Settling(la, score_diff, bridge), 0
    while (max_rounds is None or passes < max_rounds) and settling.step():
        passes += 1
    return settling.df


def propagate_bridge(la: DataFrame, score_diff: float = 2, max_rounds: int | None = 1) -> DataFrame:
    """As ``propagate``; a piece between two settled neighbours adds both of their link scores."""
    return propagate(la, score_diff, max_rounds, bridge=True)


def unique_pieces(la: DataFrame) -> DataFrame:
    """Rows of pieces that lie in exactly one chromosome."""
    return la.withColumn("c", F.count("*").over(W.partitionBy("contig", "orig_start", "orig_end"))).filter("c = 1").drop("c")


def link_scores(links: DataFrame) -> DataFrame:
    """Score of each pair of oriented contigs: summed per file, the largest over files."""
    per_file = links.groupBy("file_no", "contig1", "o1", "contig2", "o2").agg(F.sum("score").alias("score"))
    return per_file.groupBy("contig1", "o1", "contig2", "o2").agg(F.max("score").alias("score"))


def _lead(sums: dict[int, list[float]]) -> tuple[float, int | None]:
    """How far the best chromosome of a contig leads the next (or nothing), and which it is."""
    best, second, home = 0.0, 0.0, None
    for chromosome, ends in sums.items():
        score = ends[0] + ends[1]
        if score > best:
            best, second, home = score, best, chromosome
        elif score > second:
            second = score
    return best - second, home


def _best_first(rows: pd.DataFrame, score_diff: float, spread_out: bool = True) -> pd.DataFrame:
    """Contigs of whole components placed one after another, the greatest lead first; without ``spread_out`` no more.

    Rows are scores (contig, chr, end, score) and links (contig, other, end, score), whose contig
    gains ``score`` at ``end`` once ``other`` is placed. The heap keeps old leads, which are passed
    over when they come up; contigs of one lead are placed together. Several components may share one
    heap, as they cannot change each other.
    """
    sums: dict[str, dict[int, list[float]]] = {}
    gains: dict[str, list[tuple[str, int, float]]] = {}
    pairs: dict[tuple[str, str], float] = {}
    for contig, other, chromosome, end, score in zip(*(rows[c].tolist() for c in ("contig", "other", "chr", "end", "score")), strict=True):
        if other is None:
            ends = sums.setdefault(contig, {}).setdefault(int(chromosome), [0.0, 0.0])
            ends[end - 1] = max(ends[end - 1], score)
        else:
            sums.setdefault(contig, {})
            gains.setdefault(other, []).append((contig, end - 1, score))
            pairs[contig, other] = pairs.get((contig, other), 0.0) + score
    placed: dict[str, int] = {}
    heap = [(-lead, contig) for contig, known in sums.items() if (lead := _lead(known)[0]) >= score_diff]
    heapq.heapify(heap)
    while heap:
        top, now = heap[0][0], {}
        while heap and heap[0][0] == top:
            contig = heapq.heappop(heap)[1]
            lead, home = _lead(sums[contig])
            if contig not in placed and lead == -top:
                now[contig] = home
        placed |= now
        changed = set()
        for contig, home in now.items():
            for other, end, score in gains.get(contig, ()):
                if other not in placed:
                    ends = sums[other].setdefault(home, [0.0, 0.0])
                    if score > ends[end]:
                        ends[end] = score
                        changed.add(other)
        for other in changed:
            lead = _lead(sums[other])[0]
            if lead >= score_diff:
                heapq.heappush(heap, (-lead, other))
    spread = {c: {h for h, ends in known.items() if ends[0] + ends[1] >= score_diff} for c, known in sums.items() if spread_out and c not in placed}
    spread = {c: homes for c, homes in spread.items() if homes}
    front = spread
    while front:
        following: dict[str, set[int]] = {}
        for contig, homes in front.items():
            for other, _, _ in gains.get(contig, ()):
                if other not in placed and other not in spread and pairs[other, contig] >= score_diff:
                    following.setdefault(other, set()).update(homes)
        spread |= following
        front = following
    out = [*placed.items(), *((c, h) for c, homes in spread.items() for h in homes)]
    return pd.DataFrame(out, columns=["contig", "chr"])


def _link_ends(links: DataFrame) -> DataFrame:
    """``(x, y, end, score)``: best score of links that meet contig x at an end, from y; one shuffle by the pair.

    Of contig x: its first end is met by y+ and left by x-, its second by y- and left by x+. Scores of
    oriented pairs are those of ``link_scores``.
    """
    turned = F.col("contig1") > F.col("contig2")
    one, two = F.when(F.col("o1") == "-", 1).otherwise(2), F.when(F.col("o2") == "+", 1).otherwise(2)
    keyed = links.filter("score >= 1 AND contig1 <> contig2").select(F.least("contig1", "contig2").alias("lo"), F.greatest("contig1", "contig2").alias("hi"), turned.alias("turned"), "o1", "o2", "file_no", "score")
    oriented = ["lo", "hi", "turned", "o1", "o2"]
    pairs = keyed.repartition("lo", "hi").groupBy(*oriented, "file_no").agg(F.sum("score").alias("score")).groupBy(*oriented).agg(F.max("score").cast("double").alias("score"))
    at = {"lo": F.when(F.col("turned"), two).otherwise(one), "hi": F.when(F.col("turned"), one).otherwise(two)}
    best = pairs.groupBy("lo", "hi").agg(*[F.max(F.when(end == k, F.col("score"))).alias(f"{c}{k}") for c, end in at.items() for k in (1, 2)])
    four = [F.struct(F.col(x).alias("x"), F.col(y).alias("y"), F.lit(k).alias("end"), F.col(f"{x}{k}").alias("score")) for x, y in (("lo", "hi"), ("hi", "lo")) for k in (1, 2)]
    return best.select(F.inline(F.array(*four))).filter("score IS NOT NULL")


def _scores(own: DataFrame, ends: DataFrame, placed: DataFrame) -> DataFrame:
    """Best score at either end, for every contig not placed and every chromosome it touches."""
    near = ends.join(placed.select(F.col("contig").alias("y"), "chr"), "y").select(F.col("x").alias("contig"), "chr", "end", "score")
    base = own.select("contig", "chr", F.lit(1).alias("end"), F.col("s1").alias("score")).unionAll(own.select("contig", "chr", F.lit(2), F.col("s2")))
    free = near.unionAll(base).join(placed, "contig", "left_anti")
    return free.groupBy("contig", "chr", "end").agg(F.max("score").alias("score"))


def _without(links: DataFrame, gone: DataFrame) -> DataFrame:
    """Links between contigs of which neither is ``gone``."""
    gone = gone.select("contig").distinct()
    return links.join(gone.withColumnRenamed("contig", "x"), "x", "left_anti").join(gone.withColumnRenamed("contig", "y"), "y", "left_anti")


#: Leads between which a phase ends grow by this factor.
_LEVEL = 1.1


def _phase(scores: DataFrame, links: DataFrame, crowded: DataFrame, staging: Staging, score_diff: float, component_rows: int) -> DataFrame | None:
    """``(contig, chr)`` that best-first placement gives down to some lead of each component; none if no lead is left.

    Scores only rise, so a contig's lead stays below what its links can still bring the best of its
    chromosomes, less what the next one has already. Contigs that cannot reach a lead are not placed
    before all leads from there on are used up, and change nothing until then. So a phase walks, of
    every component, those that can reach a lead, the least one at which they are ``component_rows``
    scores and links at most. Where even the contigs that reach the greatest lead are more, those that
    have it are placed. Chromosomes that cannot come up to a contig's second are left out.
    """
    sides = scores.groupBy("contig", "chr").agg(*[F.max(F.when(F.col("end") == k, F.col("score"))).alias(f"e{k}") for k in (1, 2)]).fillna(0.0, ["e1", "e2"])
    brought = links.groupBy(F.col("x").alias("contig")).agg(*[F.max(F.when(F.col("end") == k, F.col("score"))).alias(f"l{k}") for k in (1, 2)])
    order = W.partitionBy("contig").orderBy(F.desc_nulls_last("sum"), "chr")
    known = crowded.join(sides, "contig", "left").join(brought, "contig", "left").fillna(0.0, ["e1", "e2", "l1", "l2"]).withColumn("sum", F.col("e1") + F.col("e2"))
    known = known.withColumn("rn", F.row_number().over(order))
    first = lambda k: F.coalesce(F.max(F.when(F.col("rn") == k, F.col("sum"))).over(W.partitionBy("contig")), F.lit(0.0))
    known = known.withColumn("best", first(1)).withColumn("second", first(2))
    most = F.greatest("e1", "l1") + F.greatest("e2", "l2")
    new = F.col("l1") + F.col("l2") - F.col("best")
    reach = F.greatest(F.max(most - F.when(F.col("rn") == 1, F.col("second")).otherwise(F.col("best"))).over(W.partitionBy("contig")), new)
    known = known.withColumn("reach", reach).filter((F.col("rn") <= 2) | (most > F.col("second")))
    known = staging.put(known.select("component", "contig", "chr", "e1", "e2", "rn", (F.col("best") - F.col("second")).alias("lead"), "reach"), "known")
    tops = known.filter("rn = 1").groupBy("component").agg(F.max("lead").alias("top")).filter(F.col("top") >= score_diff)
    least = score_diff if score_diff > 0 else 1e-6
    level = lambda c: F.when(F.col(c) >= least, F.floor(F.log(F.col(c) / least) / float(np.log(_LEVEL))))
    heads = known.filter("rn = 1").select("component", "contig", "reach")
    met = links.join(heads.select(F.col("contig").alias("x"), "component", "reach"), "x").join(heads.select(F.col("contig").alias("y"), F.col("reach").alias("reach_y")), "y")
    met = staging.put(met.select("component", "x", "y", "end", "score", F.least("reach", "reach_y").alias("reach")).filter(F.col("reach") >= score_diff), "met")
    rows = known.select("component", level("reach").alias("level"), F.lit(2).alias("n")).unionAll(met.select("component", level("reach"), F.lit(1)))
    counted = rows.filter("level IS NOT NULL").groupBy("component", "level").agg(F.sum("n").alias("n"))
    down = W.partitionBy("component").orderBy(F.desc("level")).rowsBetween(W.unboundedPreceding, W.currentRow)
    fits = counted.withColumn("upto", F.sum("n").over(down)).filter(F.col("upto") <= component_rows).groupBy("component").agg(F.min("level").alias("level"))
    # the level's own lead is a little more than its contigs', as logarithms are rounded
    floor = F.when(F.col("level") > 0, least * F.pow(F.lit(_LEVEL), F.col("level")) * (1 + 1e-9)).otherwise(F.lit(float(score_diff)))
    plan = staging.put(tops.join(fits, "component", "left").select("component", "top", floor.alias("floor")), "plan")
    if plan.isEmpty():
        return None
    walk = plan.filter("floor <= top").select("component", "floor")
    inside = known.join(F.broadcast(walk), "component").filter(F.col("reach") >= F.col("floor"))
    each = F.inline(F.array(*[F.struct(F.lit(k).alias("end"), F.col(f"e{k}").alias("score")) for k in (1, 2)]))
    whole = inside.filter("chr IS NOT NULL").select("component", "floor", "contig", F.lit(None).cast("string").alias("other"), F.col("chr").cast("bigint").alias("chr"), each)
    between = met.join(F.broadcast(walk), "component").filter(F.col("reach") >= F.col("floor")).select("component", "floor", F.col("x"), F.col("y"), F.lit(None).cast("bigint"), "end", "score")
    walked = whole.unionAll(between).groupBy("component").applyInPandas(lambda part: _best_first(part, part["floor"].iloc[0], False), "contig string, chr bigint")
    slow = plan.filter("floor IS NULL OR floor > top").select("component", "top")
    now = known.filter("rn = 1").join(F.broadcast(slow), "component").filter(F.col("lead") == F.col("top")).select("contig", F.col("chr").cast("bigint").alias("chr"))
    return staging.put(walked.unionAll(now), "now")


def _spread(scores: DataFrame, links: DataFrame, staging: Staging, score_diff: float) -> DataFrame:
    """Chromosomes of contigs that no lead places, one row of neighbours after another."""
    summed = scores.groupBy("contig", "chr").agg(F.sum("score").alias("score"))
    spread = front = staging.put(summed.filter(F.col("score") >= score_diff).select("contig", F.col("chr").cast("bigint").alias("chr")), "spread")
    both = staging.put(links.groupBy("x", "y").agg(F.sum("score").alias("score")).filter(F.col("score") >= score_diff).select("x", "y"), "both")
    while not front.isEmpty():
        reached = both.join(front.select(F.col("contig").alias("y"), "chr"), "y").select(F.col("x").alias("contig"), "chr")
        front = staging.put(reached.join(spread.select("contig").distinct(), "contig", "left_anti").distinct(), "front")
        spread = staging.put(spread.unionAll(front), "spread")
    return spread


def propagate_links(la: DataFrame, links: DataFrame, score_diff: float = 2, component_rows: int = 2_000_000) -> DataFrame:
    """``(contig, chr)``: chromosomes of contigs spread along links, best margin first.

    Contigs placed in one chromosome seed; ambiguous ones are settled by their own scores. Then the
    unplaced contig whose best chromosome leads its next by most (all that tie) is placed, its
    neighbours' scores at the end it touches may rise, and so on down to a lead of ``score_diff``.
    What is left goes to every chromosome it scores ``score_diff`` in, and its unplaced neighbours
    follow it until nothing changes.

    Only a placed neighbour changes a lead, so components of contigs that are not placed yet do not
    wait for each other: each is walked in a task with a priority queue. A component of more than
    ``component_rows`` links and scores goes on in phases: of each, a task walks as many of its contigs,
    those that can lead by most, until no other one could have come before.
    """
    staging = Staging(la.sparkSession, "propagate-links")
    own = la.groupBy("contig", "chr").agg(F.max(F.col("prev_score") + F.col("map_score") / 2).alias("s1"), F.max(F.col("next_score") + F.col("map_score") / 2).alias("s2"))
    own = staging.put(own.filter("s1 + s2 > 0"), "own")
    alone = own.groupBy("contig").agg(F.count("*").alias("n"), F.max("chr").alias("chr")).filter("n = 1").select("contig", "chr")
    unsure = own.join(alone, "contig", "left_anti").select(F.col("contig").alias("piece"), "chr", (F.col("s1") + F.col("s2")).alias("score"))
    settled = assign_by_margin(unsure, score_diff).select(F.col("piece").alias("contig"), "chr")
    placed = staging.put(alone.unionAll(settled), "placed")
    ends = staging.put(_link_ends(links), "ends")
    free = staging.put(_without(ends, placed), "free")
    named = staging.put(connected_components(free, "x", "y"), "components")
    of = named.select(F.col("node").alias("contig"), "component")
    scores = staging.put(_scores(own, ends, placed).join(of, "contig", "left").select(F.coalesce("component", "contig").alias("component"), "contig", "chr", "end", "score"), "scores")
    whole = scores.select("component", "contig", F.lit(None).cast("string").alias("other"), F.col("chr").cast("bigint").alias("chr"), "end", F.col("score").cast("double").alias("score"))
    whole = whole.unionAll(free.join(of, F.col("x") == F.col("contig")).select("component", "contig", F.col("y"), F.lit(None).cast("bigint"), "end", "score"))
    sizes = staging.put(whole.groupBy("component").agg(F.count("*").alias("rows")), "sizes")
    few = sizes.filter(F.col("rows") <= component_rows).select("component")
    buckets = -(-(sizes.filter(F.col("rows") <= component_rows).agg(F.sum("rows")).first()[0] or 0) // max(1, component_rows)) + la.sparkSession.sparkContext.defaultParallelism
    small = whole.join(few, "component", "left_semi").withColumn("bucket", F.pmod(F.xxhash64("component"), F.lit(buckets)))
    walked = [staging.put(small.repartition(buckets, "bucket").groupBy("bucket").applyInPandas(lambda rows: _best_first(rows, score_diff), "contig string, chr bigint"), "walked")]
    large = sizes.filter(F.col("rows") > component_rows).select("component")
    if not large.isEmpty():
        crowded = staging.put(whole.join(large, "component", "left_semi").select("contig", "component").distinct(), "crowded")
        scores = staging.put(scores.join(large, "component", "left_semi").select("contig", "chr", "end", "score"), "scores")
        inside = staging.put(free.join(crowded.select(F.col("contig").alias("x")), "x", "left_semi"), "inside")
        while (now := _phase(scores, inside, crowded, staging, score_diff, component_rows)) is not None:
            walked.append(now)
            near = inside.join(now.select(F.col("contig").alias("y"), "chr"), "y").select(F.col("x").alias("contig"), "chr", "end", "score")
            crowded = staging.put(crowded.join(now, "contig", "left_anti"), "crowded")
            scores = staging.put(scores.unionAll(near).join(now, "contig", "left_anti").groupBy("contig", "chr", "end").agg(F.max("score").alias("score")), "scores")
            inside = staging.put(_without(inside, now), "inside")
        walked.append(_spread(scores, inside, staging, score_diff))
    return functools.reduce(DataFrame.unionAll, walked, placed.select("contig", F.col("chr").cast("bigint").alias("chr")))


def ld_dedupe(links: DataFrame, window: int = 10000) -> DataFrame:
    """The first link, in ``line`` order, of every pair of contigs and bins, in both directions.

    A link and its mirror share one canonical pair of binned ends, so the first row of each pair
    is found by one aggregation.
    """
    one, two = F.struct(F.col("contig1").alias("c"), to_bin(F.col("pos1"), window).alias("b")), F.struct(F.col("contig2").alias("c"), to_bin(F.col("pos2"), window).alias("b"))
    keyed = links.withColumn("x", F.least(one, two)).withColumn("y", F.greatest(one, two))
    first = keyed.groupBy("x", "y").agg(F.min_by(F.struct("contig1", "pos1", "contig2", "pos2", "weight"), "line").alias("r")).select("r.*")
    bins = first.withColumn("bin1", to_bin(F.col("pos1"), window)).withColumn("bin2", to_bin(F.col("pos2"), window))
    there = bins.select("contig1", "bin1", "contig2", "bin2", "weight", "pos1", "pos2")
    return there.unionAll(bins.select(F.col("contig2"), F.col("bin2"), F.col("contig1"), F.col("bin1"), "weight", F.col("pos2"), F.col("pos1")))


_ROW = "qname string, qlen bigint, qstart bigint, qend bigint, strand string, tname string, tlen bigint, tstart bigint, tend bigint, mapq bigint, as_score bigint, cigar string, chained int"


class _MaxTree:
    """The greatest of values at places 0 .. n - 1 below a place; of equal ones that of the least owner."""

    def __init__(self, n: int):
        self.size = 1 << max(0, n - 1).bit_length()
        self.value, self.owner = [-np.inf] * (2 * self.size), [-1] * (2 * self.size)

    def put(self, place: int, value: float, owner: int) -> None:
        values, owners, i = self.value, self.owner, place + self.size
        values[i], owners[i] = value, owner
        while i > 1:
            i >>= 1
            left, right = 2 * i, 2 * i + 1
            better = right if values[right] > values[left] or (values[right] == values[left] and 0 <= owners[right] < owners[left]) else left
            values[i], owners[i] = values[better], owners[better]

    def below(self, place: int) -> tuple[float, int]:
        values, owners, lo, hi = self.value, self.owner, self.size, place + self.size
        best, owner = -np.inf, -1
        while lo < hi:
            for i in ([lo] if lo & 1 else []) + ([hi - 1] if hi & 1 else []):
                if values[i] > best or (values[i] == best and 0 <= owners[i] < owner):
                    best, owner = values[i], owners[i]
            lo, hi = (lo + 1) >> 1, hi >> 1
        return best, owner


def _best_chains(part: dict[str, np.ndarray], gap_open: int, gap_penalty: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Score of the best chain that ends in each part, the part before it (or itself), and its cut.

    Parts come by start on the query. Of those that end before a part begins, on both sequences, the
    best is the greatest of score plus place, found in a tree over ends on the target. Those that
    overlap it, by its first match at most, or touch it are few and are looked at one by one: the
    overlap is cut off at the price of its share of the score. A part leads no further once an
    overlapping part's gap on the query costs more than its chain has.
    """
    n, forward = len(part["score"]), bool(part["forward"])
    q_from, q_to = part["qstart"].astype(np.int64), part["qend"].astype(np.int64)
    # on the minus strand the target is walked backwards
    t_from, t_to = (part["tstart"], part["tend"]) if forward else (-part["tend"], -part["tstart"])
    t_from, t_to = t_from.astype(np.int64), t_to.astype(np.int64)
    score, head, density = part["score"].astype(float), part["head"], part["density"]
    best, before, cuts, open_ = score.copy(), np.arange(n), np.zeros(n, np.int64), np.ones(n, bool)
    by_q, by_t = np.argsort(q_to, kind="stable"), np.argsort(t_to, kind="stable")
    place = np.empty(n, np.int64)
    place[by_t] = np.arange(n)
    ends_q, ends_t = q_to[by_q], t_to[by_t]
    # parts that end on, or up to the first match behind, a part's start; and those that end before it
    near = [(np.searchsorted(ends, start, "left").tolist(), np.searchsorted(ends, start + head, "right").tolist()) for ends, start in ((ends_q, q_from), (ends_t, t_from))]
    ended, done = np.searchsorted(ends_t, t_from, "right").tolist(), 0
    tree = _MaxTree(n)
    price = lambda gap: np.where(gap > 0, gap_open + gap_penalty * gap, 0)
    for k in range(n):
        while done < n and ends_q[done] <= q_from[k]:
            j = int(by_q[done])
            if open_[j] and j < k:
                tree.put(int(place[j]), best[j] - gap_penalty * float(q_to[j] + t_to[j]), j)
            done += 1
        _, far = tree.below(ended[k])
        some = np.concatenate([by_q[near[0][0][k] : near[0][1][k]], by_t[near[1][0][k] : near[1][1][k]], [far] if far >= 0 else []]).astype(np.int64)
        some = some[some < k]
        some = np.unique(some[open_[some]])
        if not len(some):
            continue
        on_q, on_t = q_from[k] - q_to[some], t_from[k] - t_to[some]
        cut = np.maximum(0, np.maximum(-on_q, -on_t))
        first = price(on_q + cut)
        allowed = cut <= head[k]
        spent = allowed & (best[some] + first <= 0)
        for j in some[spent].tolist():
            open_[j] = False
            tree.put(int(place[j]), -np.inf, -1)
        total = np.where(allowed & ~spent, best[some] + score[k] + (first + price(on_t + cut) - cut * density[k]), -np.inf)
        top = int(np.argmax(total))
        if total[top] > best[k]:
            best[k], before[k], cuts[k] = total[top], some[top], cut[top]
    return best, before, cuts


def _merged(rows: dict[str, list], path: list[int], cuts: list[int], score: float) -> tuple:
    """One alignment row of the parts of a chain; gaps between them become insertions and deletions."""
    first, last, forward = path[0], path[-1], rows["strand"][path[0]] == "+"
    text = [rows["cigar"][first]]
    for j, k, cut in zip(path, path[1:], cuts[1:], strict=False):
        ins = rows["qstart"][k] - rows["qend"][j] + cut
        dele = (rows["tstart"][k] - rows["tend"][j] if forward else rows["tstart"][j] - rows["tend"][k]) + cut
        head, _, tail = rows["cigar"][k].partition("M")
        text += [f"{ins}I" if ins > 0 else "", f"{dele}D" if dele > 0 else "", f"{int(head) - cut}M{tail}" if cut else rows["cigar"][k]]
    lo, hi = (first, last) if forward else (last, first)
    same = lambda *names: tuple(rows[c][first] for c in names)
    return (*same("qname", "qlen", "qstart"), rows["qend"][last], *same("strand", "tname", "tlen"), rows["tstart"][lo], rows["tend"][hi], 0, int(score), "".join(text), len(path))


def _chain_group(rows: pd.DataFrame, gap_open: int, gap_penalty: int) -> pd.DataFrame:
    """Alignments of whole segments and their chains, the best of a segment taken off first.

    As soon as the next best chain shares a part with one taken off, chains are sought anew among
    the parts that are left. A call takes many segments, as most have a few rows.
    """
    key = ["qname", "tname", "strand", "segment"]
    rows = rows.sort_values([*key, "qstart", "qend", "tstart", "tend", "as_score"], ignore_index=True)
    new = np.append(True, (rows[key].to_numpy()[1:] != rows[key].to_numpy()[:-1]).any(axis=1)) if len(rows) else np.zeros(0, bool)
    edges = [*np.flatnonzero(new).tolist(), len(rows)]
    rows = rows.drop(columns=["segment", "bucket"], errors="ignore")
    head = rows["cigar"].str.extract(r"^(\d+)M", expand=False).fillna("0").astype("int64").to_numpy()
    shorter = np.minimum(rows["tend"] - rows["tstart"], rows["qend"] - rows["qstart"]).to_numpy()
    part = {c: rows[c].to_numpy() for c in ("qstart", "qend", "tstart", "tend")} | {"score": rows["as_score"].to_numpy(), "head": head, "density": rows["as_score"].to_numpy() / np.maximum(shorter, 1)}
    cells, chains = {c: rows[c].tolist() for c in rows.columns}, []
    for lo, hi in zip(edges, edges[1:], strict=False):
        left, forward = np.arange(lo, hi), cells["strand"][lo] == "+"
        while len(left) > 1:
            best, before, cuts = _best_chains({c: v[left] for c, v in part.items()} | {"forward": forward}, gap_open, gap_penalty)
            used = np.zeros(len(left), bool)
            for top in np.lexsort((np.arange(len(left)), -best)).tolist():
                if used[top]:
                    continue
                path = [top]
                while before[path[-1]] != path[-1]:
                    path.append(int(before[path[-1]]))
                if used[path].any():
                    break
                used[path] = True
                if len(path) > 1:
                    path = path[::-1]
                    chains.append(_merged(cells, left[path].tolist(), cuts[path].tolist(), best[top]))
            left = left[~used]
    merged = pd.DataFrame(chains, columns=[c.split()[0] for c in _ROW.split(", ")])
    return pd.concat([rows.assign(chained=1), merged], ignore_index=True) if chains else rows.assign(chained=1)


def chain_paf(paf: DataFrame, gap_open: int = -12, gap_penalty: int = -1, bucket_rows: int = 20_000) -> DataFrame:
    """Alignments plus the chains of co-linear ones per query, target and strand.

    A chain's score is the sum of its parts less gap costs; an overlap is cut off the first match
    of the later part at the price of its share of score. ``chained`` counts a row's parts. Rows
    without a positive score are dropped; without a CIGAR a row counts as one match.

    Alignments of one query, target and strand are cut into segments wherever the gap on the query
    costs more than all that precedes it scores, which no chain can pay for. Most segments are small;
    a call of Python takes those of a bucket, about ``bucket_rows`` rows, and a bucket is a task.
    """
    whole = F.concat(F.least(F.col("qend") - F.col("qstart"), F.col("tend") - F.col("tstart")).cast("string"), F.lit("M"))
    cigar = F.coalesce("cigar", whole) if "cigar" in paf.columns else whole
    rows = paf.filter("as_score > 0").withColumn("cigar", cigar).select(*[c.split()[0] for c in _ROW.split(", ")[:12]])
    along = W.partitionBy("qname", "tname", "strand").orderBy("qstart", "qend", "tstart", "tend", "as_score")
    earlier = along.rowsBetween(W.unboundedPreceding, -1)
    gap = F.col("qstart") - F.max("qend").over(earlier)
    apart = F.coalesce((gap > 0) & (F.sum("as_score").over(earlier) + gap_open + gap_penalty * gap <= 0), F.lit(False))
    cut = rows.withColumn("apart", apart.cast("int")).withColumn("segment", F.sum("apart").over(along.rowsBetween(W.unboundedPreceding, W.currentRow))).drop("apart")
    counted = cut.withColumn("peers", F.count("*").over(W.partitionBy("qname", "tname", "strand", "segment")))
    alone = counted.filter("peers = 1").drop("peers", "segment").withColumn("chained", F.lit(1))
    several = counted.filter("peers > 1").drop("peers")
    buckets = -(-paf.count() // bucket_rows) + paf.sparkSession.sparkContext.defaultParallelism
    dealt = several.withColumn("bucket", F.pmod(F.xxhash64("qname", "tname", "strand", "segment"), F.lit(buckets)))
    return alone.unionAll(dealt.repartition(buckets, "bucket").groupBy("bucket").applyInPandas(lambda rows: _chain_group(rows, gap_open, gap_penalty), _ROW))
