"""Joins: marker positions, liftover through assemblies and chains, pieces, read and barcode links."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from markerloom.functions.scalars import bed_key, to_bin
from markerloom.plans.staging import Staging, dealt, small_side

#: Width of the bins that turn point-in-interval tests on long contigs into equality joins.
BIN = 1 << 20
#: Pieces beyond which points meet them by a hash in each task; up to it Spark chooses.
_HASHED = 500_000
#: Rows of chain parts, or of points, that a Python task takes at a time.
_BUCKET = 200_000


def attach_positions(ordered: DataFrame, markers: DataFrame) -> DataFrame:
    """Add contig, position and group to an ordered map by marker number; unmatched rows stay."""
    return ordered.join(markers.select("marker_id", "contig", "pos", "lg"), "marker_id", "left")


def to_allmaps(markers: DataFrame, mode: str = "average") -> DataFrame | tuple[DataFrame, DataFrame]:
    """Rows for a consensus-map builder: scaffold, position, group, cM.

    ``average`` takes the mean of both sexes, ``splitsex`` returns a table for either.
    """
    base = [F.col("contig").alias("scaffold"), F.col("pos").alias("position"), "lg"]
    if mode == "average":
        return markers.select(*base, ((F.col("male_cm") + F.col("female_cm")) / 2).alias("cm"))
    return markers.select(*base, F.col("male_cm").alias("cm")), markers.select(*base, F.col("female_cm").alias("cm"))


def _first_cover(pieces: DataFrame, key: str, lo: str, hi: str, rank: list) -> DataFrame:
    """Stretches of each key that pieces cover, with the first piece by ``rank`` of each.

    Returns ``s_key``, ``s_bin``, ``s_lo``, ``s_hi`` and the struct ``s_piece``. Pieces are cut at
    bins, and inside a bin at each other's ends where some of them overlap (mostly none do, which is
    found out first); no two stretches meet, so a point lies in one at most.
    """
    kept = pieces.filter(F.col(lo) <= F.col(hi)).withColumn("s_bin", F.explode(F.sequence(F.floor(F.col(lo) / BIN), F.floor(F.col(hi) / BIN))))
    held = kept.select(F.col(key).alias("s_key"), "s_bin", F.greatest(F.col(lo), F.col("s_bin") * BIN).alias("c_lo"), F.least(F.col(hi), F.col("s_bin") * BIN + (BIN - 1)).alias("c_hi"), F.struct(*pieces.columns).alias("s_piece"), F.struct(*rank).alias("rank"))
    held = Staging(pieces.sparkSession, "cover").put(held, "held")
    bins = W.partitionBy("s_key", "s_bin").orderBy("c_lo", "c_hi").rowsBetween(W.unboundedPreceding, -1)
    if held.withColumn("reached", F.max("c_hi").over(bins)).filter("reached >= c_lo").isEmpty():
        return held.select("s_key", "s_bin", F.col("c_lo").alias("s_lo"), F.col("c_hi").alias("s_hi"), "s_piece")
    edges = held.select("s_key", "s_bin", F.col("c_lo").alias("s_lo")).unionAll(held.select("s_key", "s_bin", F.col("c_hi") + 1)).distinct()
    after = W.partitionBy("s_key", "s_bin").orderBy("s_lo")
    stretches = edges.withColumn("s_hi", F.lead("s_lo").over(after) - 1).filter("s_hi IS NOT NULL")
    covered = stretches.join(held, ["s_key", "s_bin"]).filter("c_lo <= s_lo AND s_hi <= c_hi")
    return covered.groupBy("s_key", "s_bin", "s_lo", "s_hi").agg(F.min_by("s_piece", "rank").alias("s_piece"))


def _pieces(agp: DataFrame, inverse: bool) -> DataFrame:
    w = agp.filter("ctype = 'W'")
    names = ("obj", "obj_beg", "obj_end", "contig", "contig_beg", "contig_end") if inverse else ("contig", "contig_beg", "contig_end", "obj", "obj_beg", "obj_end")
    key, lo, hi, name, to_lo, to_hi = names
    line = F.col("line") if "line" in agp.columns else F.struct("obj", "obj_beg")
    out = w.select(F.col(key).alias("a_key"), F.col(lo).cast("bigint").alias("a_lo"), F.col(hi).cast("bigint").alias("a_hi"), F.col(name).alias("a_to"), F.col(to_lo).cast("bigint").alias("b_lo"), F.col(to_hi).cast("bigint").alias("b_hi"), F.col("orientation").alias("a_or"), line.alias("a_line"))
    return _first_cover(out, "a_key", "a_lo", "a_hi", ["a_line", "a_lo", "b_lo"])


def _placed(points: DataFrame, agp: DataFrame, inverse: bool, contig: str, pos: str) -> DataFrame:
    """Points with their first covering piece (or nulls), each point once."""
    pieces = _pieces(agp, inverse)
    if (count := pieces.count()) > _HASHED:
        # few pieces a point: a hash of them in each task, so that points are neither sorted nor spilled
        pieces = dealt(pieces, count, "s_key", "s_bin").hint("shuffle_hash")
    hit = (F.col(contig) == F.col("s_key")) & (F.floor(F.col(pos) / BIN) == F.col("s_bin")) & F.col(pos).between(F.col("s_lo"), F.col("s_hi"))
    piece = [F.col(f"s_piece.{c}").alias(c) for c in ("a_lo", "a_hi", "a_to", "b_lo", "b_hi", "a_or")]
    return points.join(pieces, hit, "left").select(*points.columns, *piece)


def liftover(points: DataFrame, agp: DataFrame, inverse: bool = False, contig: str = "contig", pos: str = "pos") -> DataFrame:
    """Move points through an assembly: ``lifted_name`` and ``lifted_pos``, null where none covers.

    The first assembly row that covers a point decides; minus pieces count backwards. ``inverse``
    moves from objects to contigs. Piece bounds are met through bins, so that the join is by
    equality however long a contig is.
    """
    placed = _placed(points, agp, inverse, contig, pos)
    moved = F.when(F.col("a_or") == "-", F.col("b_hi") - (F.col(pos) - F.col("a_lo"))).otherwise(F.col("b_lo") + (F.col(pos) - F.col("a_lo")))
    return placed.withColumn("lifted_name", F.col("a_to")).withColumn("lifted_pos", moved.cast("bigint")).drop("a_lo", "a_hi", "a_to", "b_lo", "b_hi", "a_or")


def liftover_unmatched(points: DataFrame, agp: DataFrame, contig: str = "contig", pos: str = "pos") -> DataFrame:
    """Points that no piece covers, with ``reason``: contig absent, or position outside."""
    names = agp.filter("ctype = 'W'").select(F.col("contig").alias("known")).distinct()
    missed = _placed(points, agp, False, contig, pos).filter("a_to IS NULL").select(*points.columns)
    reason = F.when(F.col("known").isNull(), "contig absent").otherwise("position outside")
    return missed.join(names, F.col(contig) == F.col("known"), "left").withColumn("reason", reason).drop("known")


def unused_contigs(lengths: DataFrame, haplotypes: DataFrame, agp: DataFrame) -> DataFrame:
    """Whole-contig assembly rows for contigs neither used nor known as haplotypes."""
    free = lengths.join(agp.select("contig"), "contig", "left_anti").join(haplotypes.select("contig"), "contig", "left_anti")
    one = F.lit(1).cast("bigint")
    return free.select(F.col("contig").alias("obj"), one.alias("obj_beg"), F.col("length").alias("obj_end"), F.lit(1).alias("part_no"), F.lit("W").alias("ctype"), "contig", one.alias("contig_beg"), F.col("length").alias("contig_end"), F.lit("+").alias("orientation"))


def ungrouped_bed(lengths: DataFrame, haplotypes: DataFrame, bed: DataFrame, chromosomes: int) -> DataFrame:
    """The bed plus a whole-contig piece in every chromosome for contigs that it lacks."""
    free = lengths.join(bed.select("contig"), "contig", "left_anti").join(haplotypes.select("contig"), "contig", "left_anti")
    spread = free.withColumn("chr", F.explode(F.sequence(F.lit(1).cast("bigint"), F.lit(chromosomes).cast("bigint"))))
    added = spread.select("contig", F.lit("1").alias("start_s"), F.concat(F.col("length").cast("string"), F.lit("*")).alias("end_s"), F.lit("?").alias("orientation"), "chr")
    return bed.select("contig", "start_s", "end_s", "orientation", F.col("chr").cast("bigint").alias("chr")).unionByName(added)


def _once(bed: DataFrame) -> DataFrame:
    order = W.partitionBy("contig", "sm", "em").orderBy(*(["line"] if "line" in bed.columns else ["start_s", "end_s", "chr"]))
    return bed_key(bed).withColumn("rn", F.row_number().over(order)).filter("rn = 1").drop("rn")


def pick_bed(assigned: DataFrame, bed: DataFrame) -> DataFrame:
    """Bed rows once per chromosome assigned to their (contig, sm, em); a key is used once."""
    return _once(bed).drop("chr", "orientation").join(assigned.select("contig", "sm", "em", "chr"), ["contig", "sm", "em"]).select("contig", "start_s", "end_s", F.lit("?").alias("orientation"), "chr")


def pick_bed_missing(assigned: DataFrame, bed: DataFrame) -> DataFrame:
    return bed_key(bed).join(assigned.select("contig", "sm", "em"), ["contig", "sm", "em"], "left_anti").select("contig", "sm", "em").distinct()


def fix_open_ends(bed: DataFrame, lengths: DataFrame) -> DataFrame:
    """``N*`` ends become the contig's length; a contig without a length raises."""
    joined = bed.join(lengths, "contig", "left")
    known = F.when(F.col("length").isNull(), F.raise_error(F.concat(F.lit("no length for "), F.col("contig"))).cast("string")).otherwise(F.concat(F.col("length").cast("string"), F.lit("*")))
    return joined.withColumn("end_s", F.when(F.col("end_s") == "N*", known).otherwise(F.col("end_s"))).drop("length")


def pairs_within(rows: DataFrame, key: str, order: list[str], tile_rows: int = 1000) -> DataFrame:
    """All pairs of rows of one ``key``, the earlier by ``order`` first, as structs ``a`` and ``b``.

    A key mostly has a handful of rows, which meet by an equality join: both sides are one and the same
    shuffle of the plain columns, and what is compared is made of them behind it. Those of a key of
    more than ``tile_rows`` are dealt to tiles, and each pair of tiles is a join key of its own, so that
    the pairs of one crowded key spread over all tasks.
    """
    keyed = rows.filter(F.col(key).isNotNull())
    counted = Staging(rows.sparkSession, "crowded")
    sizes = keyed.groupBy(F.col(key).alias("r")).agg(F.count("*").alias("n"))
    total, most = sizes.agg(F.sum("n"), F.max("n")).first()
    place = F.struct(*order)
    if (most or 0) <= tile_rows:
        once = dealt(keyed, total or 0, key)
        side = lambda name: once.select(F.col(key).alias(f"{name}_r"), F.struct("*").alias(name), place.alias(f"{name}_o"))
        return side("a").join(side("b"), F.col("a_r") == F.col("b_r")).filter("a_o < b_o").select("a", "b")
    crowded = counted.put(sizes.select("r", F.ceil(F.col("n") / tile_rows).cast("int").alias("tiles")).filter("tiles > 1"), "keys")
    every = F.explode(F.sequence(F.lit(0), F.coalesce("tiles", F.lit(1)) - 1))
    tiled = keyed.join(small_side(crowded), F.col(key) == F.col("r"), "left").withColumn("own", F.pmod(F.xxhash64(place), F.coalesce("tiles", F.lit(1))).cast("int"))
    side = lambda name, own, other: tiled.select("*", every.alias("every")).select(F.col(key).alias("r"), F.col("own").alias(own), F.col("every").alias(other), F.struct(*rows.columns).alias(name), place.alias(f"{name}_o"))
    return side("a", "p", "q").join(side("b", "q", "p"), ["r", "p", "q"]).filter("a_o < b_o").select("a", "b")


def hic_pairs(sam: DataFrame, q: int = 20, tile_rows: int = 1000) -> DataFrame:
    """Contacts of all pairs of a read's kept alignments, in both directions, with the lesser quality."""
    pairs = pairs_within(sam.filter(F.col("mapq") >= q).select("read", "contig", "pos", "mapq", "line"), "read", ["line"], tile_rows)
    quality = F.least("a.mapq", "b.mapq").alias("quality")
    side = lambda x, y: F.struct(F.col(f"{x}.contig").alias("contig1"), F.col(f"{x}.pos").alias("pos1"), F.col(f"{y}.contig").alias("contig2"), F.col(f"{y}.pos").alias("pos2"), quality)
    return pairs.select(F.inline(F.array(side("a", "b"), side("b", "a"))))


def longread_links(paf: DataFrame, q: int = 1, tile_rows: int = 1000) -> DataFrame:
    """Links between a read's alignments on different contigs, both ways, and spans on one contig.

    An overlap on the read is halved into both positions; a mirrored link swaps the contigs and
    turns both orientations.
    """
    rows = paf.filter(F.col("mapq") >= q).select("qname", "qstart", "qend", "strand", "tname", "tstart", "tend", "mapq")
    pairs = pairs_within(rows, "qname", ["qstart", "qend", "tname", "tstart", "tend", "strand", "mapq"], tile_rows)
    ov = F.floor(F.greatest(F.lit(0), F.col("a.qend") - F.col("b.qstart")) / 2)
    one = F.when(F.col("a.strand") == "+", F.col("a.tend") + 1 - ov).otherwise(F.col("a.tstart") + ov).cast("bigint")
    two = F.when(F.col("b.strand") == "+", F.col("b.tstart") + ov).otherwise(F.col("b.tend") + 1 - ov).cast("bigint")
    turn = lambda c: F.when(F.col(c) == "+", "-").otherwise("+")
    linked = pairs.withColumn("p1", one).withColumn("p2", two).withColumn("quality", F.least("a.mapq", "b.mapq"))
    link = lambda x, p, y, q, turned: F.struct(F.col(f"{x}.tname").alias("contig1"), F.col(p).alias("pos1"), F.col(f"{y}.tname").alias("contig2"), F.col(q).alias("pos2"), turned.alias("orientation"), "quality")
    there, back = link("a", "p1", "b", "p2", F.concat("a.strand", "b.strand")), link("b", "p2", "a", "p1", F.concat(turn("b.strand"), turn("a.strand")))
    both = linked.select(F.inline(F.array(there, back)))
    within = rows.select(F.col("tname").alias("contig1"), (F.col("tstart") + 1).alias("pos1"), F.col("tname").alias("contig2"), F.col("tend").alias("pos2"), F.lit("++").alias("orientation"), F.col("mapq").alias("quality"))
    return both.unionAll(within)


def umi_proximity(umis: DataFrame, bin_size: int = 10000, min_d: int = 2, tile_rows: int = 1000) -> DataFrame:
    """Pairs of contig bins and the number of barcodes that both hold, ``min_d`` at least.

    The pairs are the result, so they grow with the square of the bins that one barcode holds; a
    barcode is one molecule and holds few; a crowded one is cut into pairs of tiles. Bins are told apart before the join, so a barcode read
    many times in one bin counts once.
    """
    held = umis.filter(F.col("umi").isNotNull()).select("contig", to_bin(F.col("pos"), bin_size).alias("bin"), "umi").distinct()
    pairs = pairs_within(held, "umi", ["contig", "bin"], tile_rows).select(F.col("a.contig").alias("contig1"), F.col("a.bin").alias("bin1"), F.col("b.contig").alias("contig2"), F.col("b.bin").alias("bin2"))
    counted = pairs.groupBy("contig1", "bin1", "contig2", "bin2").agg(F.count("*").alias("n")).filter(F.col("n") >= min_d)
    return counted.unionAll(counted.select(F.col("contig2"), F.col("bin2"), F.col("contig1"), F.col("bin1"), "n"))


def reciprocal_best(chains: DataFrame, min_score: int = 10000) -> DataFrame:
    """Chains that are the best of their target and of their query; ties go to the smaller id.

    Either best is an aggregate over names, scores and ids; whole chains are only met by the ids that
    are both.
    """
    kept = chains.filter((F.col("score") >= min_score) & (F.col("tname") != F.col("qname")))
    best = lambda c: kept.groupBy(c).agg(F.min(F.struct((-F.col("score")).alias("worst"), "id")).alias("first")).select("first.id")
    both = Staging(chains.sparkSession, "best").put(best("tname").join(best("qname"), "id"), "both")
    return kept.join(small_side(both, 4_000_000), "id", "left_semi").select(*chains.columns)


def first_known(rows: DataFrame, known: DataFrame, by: str, order: list[str | Column], key: str) -> DataFrame:
    """Of every group ``by``, the row that ``order`` puts first among those whose ``key`` is one of ``known``.

    Only the first row of each group is looked up at once: tasks leave out all but the first of their
    own rows before any is dealt. Groups whose first row is not known, if there are any, have all their
    rows looked up. Rows without a group or key are left out.
    """
    rows = rows.dropna(subset=[by, key])
    first = lambda df: df.withColumn("_rn", F.row_number().over(W.partitionBy(by).orderBy(*order))).filter("_rn = 1").drop("_rn")
    marks = known.select(key).distinct().withColumn("_known", F.lit(True))
    judged = Staging(rows.sparkSession, "first-known").put(first(rows).join(marks, key, "left").select(*rows.columns, "_known"), "judged")
    sure, unsure = judged.filter("_known").drop("_known"), judged.filter("_known IS NULL").select(by)
    if unsure.isEmpty():
        return sure
    return sure.unionAll(first(rows.join(small_side(unsure), by, "left_semi").join(known, key, "left_semi").select(*rows.columns)))


def swap_chain(chains: DataFrame) -> DataFrame:
    """Target and query change places; on the minus strand coordinates count from the other end."""
    minus = F.col("qstrand") == "-"
    flip = lambda size, at, other: F.when(minus, F.col(size) - F.col(other)).otherwise(F.col(at))
    return chains.select(
        "id", "score", F.col("qname").alias("tname"), F.col("qsize").alias("tsize"), F.lit("+").alias("tstrand"), flip("qsize", "qstart", "qend").alias("tstart"), flip("qsize", "qend", "qstart").alias("tend"),
        F.col("tname").alias("qname"), F.col("tsize").alias("qsize"), F.col("qstrand"), flip("tsize", "tstart", "tend").alias("qstart"), flip("tsize", "tend", "tstart").alias("qend"),
    )


def _painted(points: pa.Table, parts: pa.Table, rank: list[tuple[str, str]], payload: list[str]) -> pa.Table:
    """Points that a part covers, each with the ``payload`` of the first by ``rank`` that does.

    Parts are taken best first, and each takes the points in it that are still free. A taken point
    leads to the next free one, so none is looked at for every part that covers it.
    """
    count = points.num_rows
    names = pa.chunked_array([*points["_key"].chunks, *parts["_key"].chunks], pa.string()).combine_chunks()
    names = names.chunk(0) if isinstance(names, pa.ChunkedArray) else names
    code = names.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)
    at, lo, hi = points["_pos"].to_numpy(), parts["_lo"].to_numpy(), parts["_hi"].to_numpy()
    known = np.unique(at)
    place = lambda group, k: group * (len(known) + 1) + k
    line = place(code[:count], np.searchsorted(known, at))
    order = np.argsort(line, kind="stable")
    first = np.searchsorted(line[order], place(code[count:], np.searchsorted(known, lo)))
    last = np.searchsorted(line[order], place(code[count:], np.searchsorted(known, hi, "right")))
    best = pc.sort_indices(parts, sort_keys=rank, null_placement="at_start").to_numpy()
    best = best[first[best] < last[best]]
    free, owner = list(range(count + 1)), [-1] * count
    for part, i, end in zip(best.tolist(), first[best].tolist(), last[best].tolist(), strict=True):
        while True:
            while free[i] != i:
                free[i] = free[free[i]]
                i = free[i]
            if i >= end:
                break
            owner[i], free[i] = part, i + 1
    owner = np.array(owner, np.int64)
    hit, by = points.take(order[owner >= 0]), parts.take(owner[owner >= 0])
    columns = [c for c in points.column_names if c not in ("_key", "_pos", "_bucket")]
    return pa.table([*[hit[c] for c in columns], *[by[c] for c in payload]], names=[*columns, *payload])


def liftover_chain(points: DataFrame, chains: DataFrame, contig: str = "contig", pos: str = "pos", ties: tuple[str, ...] = ("id",)) -> DataFrame:
    """Move points to the partner contig through the best chain whose blocks cover them.

    ``chains`` has header columns and ``blocks array<struct<size,dt,dq>>``; without blocks the
    whole aligned range counts as one. Points that no block covers are left out. Positions are
    1-based, chain coordinates 0-based. The greater score is the better chain, of one target's
    equal ones that with the lesser ``ties``, then the earlier block.

    Blocks are cut at bins and meet the points of their (contig, bin) in buckets of some 200,000 rows,
    each sorted by numpy in a task.
    """
    head = list(dict.fromkeys([*ties, "score", "tname", "tstart", "qname", "qsize", "qstrand", "qstart"]))
    if "blocks" in chains.columns:
        each = chains.select(*head, F.posexplode("blocks").alias("no", "b"))
        earlier = W.partitionBy(*head).orderBy("no").rowsBetween(W.unboundedPreceding, -1)
        moved = lambda start, gap: F.col(start) + F.coalesce(F.sum(F.col("b.size") + F.col(f"b.{gap}")).over(earlier), F.lit(0))
        placed = each.withColumn("lo", (moved("tstart", "dt") + 1).cast("bigint")).withColumn("q", moved("qstart", "dq").cast("bigint")).withColumn("hi", F.col("lo") + F.col("b.size") - 1)
    else:
        placed = chains.withColumn("lo", (F.col("tstart") + 1).cast("bigint")).withColumn("q", F.col("qstart").cast("bigint")).withColumn("hi", F.col("tend").cast("bigint"))
    payload = ["qname", "qsize", "qstrand", "lo", "q"]
    carried = list(dict.fromkeys(["score", *ties, *payload]))
    bins = placed.filter("lo <= hi AND tname IS NOT NULL").withColumn("_bin", F.explode(F.sequence(F.floor(F.col("lo") / BIN), F.floor(F.col("hi") / BIN))))
    buckets = -(-max(chains.count(), points.count()) // _BUCKET) + points.sparkSession.sparkContext.defaultParallelism
    bucket = lambda key: F.pmod(F.xxhash64(key, "_bin"), F.lit(buckets)).alias("_bucket")
    parts = bins.select(F.col("tname").alias("_key"), F.greatest("lo", F.col("_bin") * BIN).alias("_lo"), F.least("hi", F.col("_bin") * BIN + (BIN - 1)).alias("_hi"), *[F.col(c).alias(f"_p_{c}") for c in carried], bucket("tname"))
    known = points.filter(F.col(contig).isNotNull() & F.col(pos).isNotNull()).withColumn("_bin", F.floor(F.col(pos) / BIN))
    known = known.select(*points.columns, F.col(contig).alias("_key"), F.col(pos).cast("bigint").alias("_pos"), bucket(contig))
    schema = StructType([*points.schema.fields, *[StructField(f"_p_{c}", parts.schema[f"_p_{c}"].dataType) for c in payload]])
    rank = [("_p_score", "descending"), *[(f"_p_{c}", "ascending") for c in (*ties, "lo")]]
    names = rank, [f"_p_{c}" for c in payload]
    by_bucket = lambda df: df.repartition(buckets, "_bucket").groupBy("_bucket")
    first = by_bucket(known).cogroup(by_bucket(parts)).applyInArrow(lambda x, y: _painted(x, y, *names), schema)
    to = F.col("_p_q") + F.col(pos) - F.col("_p_lo")
    lifted = F.when(F.col("_p_qstrand") == "-", F.col("_p_qsize") - to).otherwise(to + 1).cast("bigint")
    return first.select(*points.columns, F.col("_p_qname").alias("lifted_name"), lifted.alias("lifted_pos"))
