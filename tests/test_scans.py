"""Scans over ranges against plain walks: neighbours and sums across range borders, and the operators on them."""

import random
import time

import pandas as pd
import pytest
from pyspark.sql import functions as F

from markerloom.operators import iterative as it
from markerloom.operators import windows as w
from markerloom.operators.scans import Ordered

LA = "line int, contig string, start_pos long, end_pos long, orientation string, chr long, orig_start long, alt_start long, orig_end long, alt_end long, prev_contig string, prev_type string, prev_score long, next_contig string, next_type string, next_score long, map_score long"


@pytest.mark.parametrize("by", [[], ["g"]])
def test_scan_equals_a_walk(spark, by):
    rng = random.Random(4)
    data = [(rng.choice(["a", "b", None]), k, rng.randint(-9, 9) if rng.random() < 0.7 else None) for k in range(500)] + [("c", 1, 5)]
    got = Ordered(spark.createDataFrame(data, "g string, k int, v long").repartition(5), by, ["k", "g"])
    got = got.scan(before={"was": "v", "had": F.lit(1)}, after={"will": "v"}, sums={"upto": F.col("v"), "i": F.lit(1)}, last={"known": "v"}).df.collect()
    frame = pd.DataFrame(data, columns=["g", "k", "v"]).astype({"v": "Int64"}).sort_values(["k", "g"], na_position="first")
    groups = [frame] if not by else [frame[frame.g.isna()], *(frame[frame.g == x] for x in "abc")]
    want = []
    for rows in groups:
        v, total, known = rows.v.tolist(), 0, None
        for i, (g, k, x) in enumerate(rows.itertuples(index=False, name=None)):
            total += 0 if pd.isna(x) else x
            known = known if pd.isna(x) else x
            none = lambda y: None if y is None or pd.isna(y) else y
            want.append((none(g), k, none(x), none(v[i - 1]) if i else None, 1 if i else None, none(v[i + 1]) if i + 1 < len(v) else None, total, i + 1, none(known)))
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


def test_operators_keep_no_window_of_a_whole_group(spark):
    """One key of many rows is dealt to several tasks: no window is keyed by the group alone."""
    la = spark.createDataFrame([(k, f"c{k}", 1, 10, "+", 1, 1, 1, 10, 10, "null", "null", 0, "null", "null", 0, 1) for k in range(50)], LA)
    markers = la.select("line", F.col("chr").alias("lg"), F.col("line").cast("double").alias("male_cm"), F.col("line").cast("double").alias("female_cm"))
    for made in (w.make_agp2(la), w.orientation_blocks(la), it.propagate(la, max_rounds=1), w.trim_edges(markers, 5, 20)):
        plan = made._jdf.queryExecution().optimizedPlan().toString()
        # what hands on the ranges' borders is keyed by the group, and holds a row for each range
        assert all("_range" in line or "_t_" in line or "_b#" in line or "_a#" in line or "piece" in line or "orig_start" in line for line in plan.split("\n") if "Window [" in line), plan


def row_by_row(la, diff=2, bridge=False):
    """One pass over rows in file order, neighbours across chromosome borders included."""
    rows = [dict(zip([c.split()[0] for c in LA.split(", ")], r, strict=True)) for r in sorted(la)]
    piece = lambda r: (r["contig"], r["orig_start"], r["orig_end"])
    count = {}
    for r in rows:
        count[piece(r)] = count.get(piece(r), 0) + 1
    beside, score = [], {}
    for k, r in enumerate(rows):
        before = piece(rows[k - 1]) if k and rows[k - 1]["contig"] == r["prev_contig"] else None
        after = piece(rows[k + 1]) if k + 1 < len(rows) and rows[k + 1]["contig"] == r["next_contig"] else None
        beside.append((before, after))
        if count[piece(r)] > 1:
            found = []
            if before and count[before] == 1:
                found.append(r["prev_score"] + r["map_score"])
            if after and count[after] == 1:
                found.append(r["next_score"] + r["map_score"])
            if bridge and len(found) == 2:
                found.append(r["prev_score"] + r["next_score"] + r["map_score"])
            for x in found:
                score[piece(r), r["chr"]] = max(score.get((piece(r), r["chr"]), 0), x)
    home = {}
    for p, n in count.items():
        known = sorted((x for (q, _), x in score.items() if q == p), reverse=True)
        if n > 1 and known and known[0] > 0 and (known[1] if len(known) > 1 else 0) + diff <= known[0]:
            home[p] = next(h for (q, h), x in score.items() if q == p and x == known[0])
    lose = set()
    for k, r in enumerate(rows):
        for side, p in zip((-1, 1), beside[k], strict=True):
            if p and count[p] > 1 and p in home and home[p] != r["chr"]:
                lose |= {(k, side), (k + side, -side)}
    out = []
    for k, r in enumerate(rows):
        for side, name in ((-1, "prev"), (1, "next")):
            if (k, side) in lose:
                r |= {f"{name}_contig": "null", f"{name}_type": "null", f"{name}_score": 0}
        if count[piece(r)] == 1 or piece(r) not in home or home[piece(r)] == r["chr"]:
            out.append(tuple(r.values()))
    return out


def neighbours(seed, n=120):
    """Rows that often name their file-order neighbours, in blocks of chromosomes."""
    rng = random.Random(seed)
    names = [f"c{rng.randint(0, 40)}" for _ in range(n)]
    rows = []
    for k in range(n):
        link = lambda at: names[at] if 0 <= at < n and rng.random() < 0.8 else "null"
        rows.append((k, names[k], 1, 10, "+", 1 + k * 4 // n, 1, 1, 10, 10, link(k - 1), "paf", rng.randint(0, 9), link(k + 1), "paf", rng.randint(0, 9), rng.randint(0, 1)))
    return rows


@pytest.mark.parametrize("bridge", [False, True])
def test_propagate_equals_row_by_row(spark, bridge):
    data = neighbours(7)
    la = spark.createDataFrame(data, LA)
    assert sorted(map(tuple, it.propagate(la, max_rounds=1, bridge=bridge).collect())) == sorted(row_by_row(data, bridge=bridge))
    want = data
    while (following := row_by_row(want, bridge=bridge)) != want:
        want = following
    assert sorted(map(tuple, it.propagate(la, bridge=bridge).collect())) == sorted(want)


def pruned_plainly(items, num_snps, num_bps):
    items = [list(x) for x in items]
    if len(items) > 1:
        while items:
            poor = [(e - s + 1, k) for k, (s, e, _, n) in enumerate(items) if e - s + 1 < num_bps or n < num_snps]
            if not poor:
                break
            k = min(poor)[1]
            if 0 < k < len(items) - 1 and items[k - 1][2] == items[k + 1][2]:
                items[k - 1][1], items[k - 1][3] = items[k + 1][1], items[k - 1][3] + items[k + 1][3]
                del items[k + 1]
            del items[k]
    return [tuple(x) for x in items]


def test_clean_map_equals_plain_pruning():
    rng = random.Random(5)
    for _ in range(300):
        at, items = 0, []
        for _ in range(rng.randint(1, 25)):
            at += rng.randint(1, 20)
            end = at + rng.randint(0, 60)
            items.append((at, end, rng.randint(1, 3), rng.randint(1, 4)))
            at = end + 1
        frame = pd.DataFrame(items, columns=["start", "end", "chr", "n"]).assign(contig="c", run=range(1, len(items) + 1)).sample(frac=1, random_state=1)
        got = w._pruned(frame, 2, 30)
        assert list(got[["start", "end", "chr", "n"]].itertuples(index=False, name=None)) == pruned_plainly(items, 2, 30)


def test_clean_map_takes_long_contigs():
    n = 200_000
    frame = pd.DataFrame({"contig": "c", "run": range(n), "start": [k * 100 for k in range(n)], "end": [k * 100 + k % 90 for k in range(n)], "chr": [k % 5 for k in range(n)], "n": [1 + k % 3 for k in range(n)]})
    began = time.time()
    assert len(w._pruned(frame, 2, 80)) < n and time.time() - began < 20


BED = "contig string, start_s string, end_s string, orientation string, chr int"


def cut_in_turn(bed, cuts, top):
    """Cuts taken one by one along each contig; certain parts decide."""
    pieces, out = {}, []
    for contig, start, end, orientation, home in bed:
        lo, hi = end.replace("*", "").split("-")[0], end.replace("*", "").split("-")[-1]
        pieces.setdefault(contig, []).append((int(start.split("-")[-1]), int(lo), home, start, end, int(start.split("-")[0]), int(hi)))
    sites = {}
    for contig, a, b in cuts:
        lo, hi = (a, a) if b is None else (a - 1, b)
        own = pieces.get(contig, [])
        at_s, at_e = [p[0] for p in own if lo < p[0] <= hi], [p[1] for p in own if lo <= p[1] < hi]
        if len(at_s) + len(at_e) <= 1:
            sites.setdefault(contig, []).append((at_e[0] + 1 if at_e else lo, at_s[0] - 1 if at_s else hi))
    everywhere = range(1, top + 1)
    for contig, own in pieces.items():
        left = sorted(sites.get(contig, []))
        if not left:
            out += [(contig, p[3], p[4], "?", p[2]) for p in own]
            continue
        start, early = str(own[0][5]), [c for c in left if c[1] < own[0][0]]
        for c in early:
            out += [(contig, start, f"{c[0]}-{c[1]}", "?", h) for h in everywhere]
            start = f"{c[0] + 1}-{c[1] + 1}"
        if not early:
            start = f"{start}-{own[0][0]}"
        for k, p in enumerate(own):
            final = k + 1 == len(own)
            for c in left:
                if p[0] <= c[0] and c[1] <= p[1]:
                    out.append((contig, start, f"{c[0]}-{c[1]}", "?", p[2]))
                    start = f"{c[0] + 1}-{c[1] + 1}"
            behind = [c for c in left if c[0] > p[1] and (final or c[1] < own[k + 1][0])]
            for m, c in enumerate(behind):
                out += [(contig, start, f"{c[0]}-{c[1]}", "?", h) for h in ([p[2]] if m == 0 else everywhere)]
                start = f"{c[0] + 1}-{c[1] + 1}"
            last = max(x[6] for x in own[-1:])
            if not behind:
                stop = (p[1], f"{last}*") if final else (p[1], own[k + 1][0] - 1)
                out.append((contig, start, f"{stop[0]}-{stop[1]}", "?", p[2]))
                start = f"{p[1] + 1}-{own[k + 1][0]}" if not final else start
            elif final:
                out += [(contig, start, f"{last}*", "?", h) for h in everywhere]
    for contig, left in sites.items():
        if contig not in pieces:
            start = "1"
            for c in sorted(left):
                out += [(contig, start, f"{c[0]}-{c[1]}", "?", h) for h in everywhere]
                start = f"{c[0] + 1}-{c[1] + 1}"
            out += [(contig, start, "N*", "?", h) for h in everywhere]
    return sorted(out)


def test_cut_bed_equals_cutting_in_turn(spark):
    rng = random.Random(6)
    bed, cuts = [], []
    for c in range(60):
        at, pieces = rng.choice([1, 1, 40]), rng.randint(1, 4)
        for k in range(pieces):
            lo, hi = at, at + rng.randint(0, 8)
            stop = hi + rng.randint(20, 60)
            slack = stop + rng.randint(0, 8)
            bed.append((f"c{c}", "1" if lo == 1 else f"{lo}-{hi}", f"{slack}*" if k + 1 == pieces and rng.random() < 0.5 else f"{stop}-{slack}", "?", rng.randint(1, 3)))
            at = slack + 1
        for _ in range(rng.randint(0, 3)):
            a = rng.randint(2, at + 20)
            cuts.append((f"c{c}", a, None if rng.random() < 0.3 else a + rng.randint(0, 12)))
    # cuts that overlap each other have no order of their own
    cuts = [x for x in cuts if sum(y[0] == x[0] and y[1] <= (x[2] or x[1]) + 2 and x[1] <= (y[2] or y[1]) + 2 for y in cuts) == 1]
    cuts += [("absent", 10, 20), ("absent", 50, None)]
    got = w.cut_bed(spark.createDataFrame(bed, BED), spark.createDataFrame(cuts, "contig string, cut_lo long, cut_hi long"), 3)
    assert sorted(map(tuple, got.collect())) == cut_in_turn(bed, cuts, 3)


def test_many_cuts_on_one_contig(spark):
    n = 100_000
    bed = spark.range(n).select(F.lit("c").alias("contig"), F.concat_ws("-", F.col("id") * 100 + 1, F.col("id") * 100 + 3).alias("start_s"), F.concat_ws("-", F.col("id") * 100 + 90, F.col("id") * 100 + 100).alias("end_s"), F.lit("?").alias("orientation"), F.lit(1).alias("chr"))
    cuts = spark.range(n).select(F.lit("c").alias("contig"), (F.col("id") * 100 + 40).alias("cut_lo"), (F.col("id") * 100 + 45).alias("cut_hi"))
    began = time.time()
    assert w.cut_bed(bed, cuts, 2).count() == 2 * n and time.time() - began < 60
