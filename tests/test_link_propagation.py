"""Link propagation against a plain model: one global step after another, the greatest lead first."""

import random
import time

import pytest

from markerloom.operators import iterative as it

LA = "line int, contig string, start_pos long, end_pos long, orientation string, chr long, orig_start long, alt_start long, orig_end long, alt_end long, prev_contig string, prev_type string, prev_score long, next_contig string, next_type string, next_score long, map_score long"
LINKS = "file_no int, contig1 string, o1 string, contig2 string, o2 string, score long"


def plain(placements, links, diff=2):
    """(contig, chr) pairs; placements: (contig, chr, score, score, map score), links: (file, x, o, y, o, score)."""
    ends, pair = {}, {}
    for contig, home, before, after, both in placements:
        one, two = ends.get((contig, home), (0, 0))
        ends[contig, home] = max(one, before + both / 2), max(two, after + both / 2)
    ends = {k: v for k, v in ends.items() if sum(v) > 0}
    files = {}
    for f, x, o1, y, o2, score in links:
        if score >= 1:
            files[f, x, o1, y, o2] = files.get((f, x, o1, y, o2), 0) + score
    for (_, x, o1, y, o2), score in files.items():
        if x != y:
            for a, b, end in ((x, y, 0 if o1 == "-" else 1), (y, x, 0 if o2 == "+" else 1)):
                pair[a, b, end] = max(pair.get((a, b, end), 0), score)
    near = {}
    for a, b, _ in pair:
        near.setdefault(a, set()).add(b)
    homes = {h for _, h in ends}
    contigs = set(near) | {c for c, _ in ends}

    def score(c, h, placed):
        total = 0
        for end in (0, 1):
            total += max([ends.get((c, h), (0, 0))[end]] + [pair.get((c, n, end), 0) for n in near.get(c, ()) if placed.get(n) == h])
        return total

    def lead(c, placed):
        known = sorted(((score(c, h, placed), h) for h in homes), reverse=True) or [(0, None)]
        return known[0][0] - (known[1][0] if len(known) > 1 else 0), known[0][1]

    placed = {}
    for c in contigs:
        own = sorted(((sum(v), h) for (x, h), v in ends.items() if x == c), reverse=True)
        if len(own) == 1 or (own and own[0][0] - own[1][0] >= diff):
            placed[c] = own[0][1]
    while True:
        leads = {c: lead(c, placed) for c in contigs if c not in placed}
        top = max((x for x, _ in leads.values()), default=0)
        if top < diff:
            break
        placed |= {c: h for c, (x, h) in leads.items() if x == top}
    spread = {c: {h for h in homes if score(c, h, placed) >= diff} for c in contigs if c not in placed}
    spread = {c: h for c, h in spread.items() if h}
    front = dict(spread)
    while front:
        new = {}
        for c, hs in front.items():
            for n in near.get(c, ()):
                if n not in placed and n not in spread and sum(pair.get((n, c, e), 0) for e in (0, 1)) >= diff:
                    new.setdefault(n, set()).update(hs)
        spread |= new
        front = new
    return sorted([*placed.items(), *((c, h) for c, hs in spread.items() for h in hs)])


def run(spark, placements, links, **sizes):
    la = [(k, c, 1, 10, "+", h, 1, 1, 10, 10, "null", "null", before, "null", "null", after, both) for k, (c, h, before, after, both) in enumerate(placements)]
    got = it.propagate_links(spark.createDataFrame(la, LA), spark.createDataFrame(links, LINKS), **sizes)
    return sorted(map(tuple, got.collect()))


def random_graph(rng, name):
    n = rng.randint(2, 9)
    contigs = [f"{name}_{k}" for k in range(n)]
    placements = [(rng.choice(contigs), rng.randint(1, 3), rng.randint(0, 6), rng.randint(0, 6), rng.randint(0, 3)) for _ in range(rng.randint(1, n))]
    links = [(rng.randint(1, 2), rng.choice(contigs), rng.choice("+-"), rng.choice(contigs), rng.choice("+-"), rng.randint(0, 9)) for _ in range(rng.randint(1, 3 * n))]
    return placements, links


def test_a_neighbour_whose_lead_rises_goes_first(spark):
    placements = [("p", 1, 4, 0, 0), ("q", 2, 4, 0, 0), ("r", 2, 4, 0, 0)]
    links = [(1, a, "+", b, "+", n) for a, b, n in (("p", "x", 6), ("q", "y", 4), ("z", "y", 10), ("r", "z", 10), ("y", "x", 9))]
    assert run(spark, placements, links) == plain(placements, links) == [("p", 1), ("q", 2), ("r", 2), ("x", 2), ("y", 2), ("z", 2)]


@pytest.mark.parametrize("component_rows,count", [(2_000_000, 200), (12, 40)])
def test_random_graphs_equal_one_after_another(spark, component_rows, count):
    rng = random.Random(component_rows)
    graphs = [random_graph(rng, f"g{k}") for k in range(count)]
    got = run(spark, [p for g in graphs for p in g[0]], [x for g in graphs for x in g[1]], component_rows=component_rows)
    # no chromosome of one graph is known in another, but all of them are 1 to 3
    assert got == sorted(r for p, x in graphs for r in plain(p, x))


def test_long_paths(spark):
    placed = [("s0", 1, 9, 0, 0), ("t0", 1, 5, 0, 0), ("u0", 2, 5, 0, 0)]
    links = [(1, f"s{k}", "+", f"s{k + 1}", "+", 5) for k in range(1000)]
    # t and u pull alike at the head of the second path, which then follows them into both
    links += [(1, "t0", "+", "v0", "+", 4), (1, "u0", "+", "v0", "+", 4)] + [(1, f"v{k}", "+", f"v{k + 1}", "+", 3) for k in range(1000)]
    began = time.time()
    got = dict.fromkeys(run(spark, placed, links))
    assert len(got) == 1001 + 2 + 2 * 1001 and ("s1000", 1) in got and ("v1000", 2) in got
    assert time.time() - began < 60


def test_no_links(spark):
    assert run(spark, [("a", 1, 3, 0, 0), ("b", 1, 3, 0, 0), ("b", 2, 3, 0, 0)], []) == [("a", 1), ("b", 1), ("b", 2)]
