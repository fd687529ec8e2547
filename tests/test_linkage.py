"""Linkage from classes, bands and forests against all pairs of markers; distortion at any tolerance."""

import itertools
import math
import random

import numpy as np
import pytest

from markerloom.operators import linkage as lk


def words(seed, n, individuals, centres=6, flips=4):
    """Genotype words around a few centres, some of them repeated or complemented."""
    rng = random.Random(seed)
    middle = [rng.getrandbits(individuals) for _ in range(centres)]
    out = []
    for k in range(n):
        w = rng.choice(middle)
        for _ in range(rng.randint(0, flips)):
            w ^= 1 << rng.randrange(individuals)
        if rng.random() < 0.3:
            w ^= (1 << individuals) - 1
        out.append((k, w - (1 << 64) if w >= 1 << 63 else w))
    return out


def plain_pairs(data, n, least):
    out = {}
    for (a, x), (b, y) in itertools.combinations(data, 2):
        d = bin((x ^ y) & ((1 << n) - 1)).count("1")
        r = min(d, n - d)
        lod = n * math.log10(2) + (r * math.log10(r / n) if r else 0) + ((n - r) * math.log10(1 - r / n) if r else 0)
        if lod >= least:
            out[a, b] = lod
    return out


def plain_groups(ids, pairs, limit, size_limit=1):
    root = {k: k for k in ids}

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for (a, b), lod in pairs.items():
        if lod >= limit:
            x, y = sorted((find(a), find(b)))
            root[y] = x
    named = {k: find(k) for k in ids}
    sizes = {}
    for r in named.values():
        sizes[r] = sizes.get(r, 0) + 1
    number = {r: i for i, (_, r) in enumerate(sorted((-n, r) for r, n in sizes.items() if n >= size_limit), 1)}
    return {k: number.get(r, 0) for k, r in named.items()}


@pytest.mark.parametrize("individuals,least", [(40, 5), (40, 2), (64, 12), (24, 0), (7, 1)])
def test_pairs_by_bands_or_tiles_equal_all_pairs(spark, individuals, least):
    data = words(individuals, 160, individuals)
    got = {(r.a, r.b): r.lod for r in lk.pairwise_lod(spark.createDataFrame(data, "marker_id long, bits long"), individuals, least).collect()}
    want = plain_pairs(data, individuals, least)
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-9 for k in want)


def test_bands_are_used_where_few_differences_are_allowed():
    assert lk._bands(40, 5) is not None and lk._bands(64, 4) is not None
    assert lk._bands(40, 20) is None and lk._bands(6, 2) is None


@pytest.mark.parametrize("in_task", [1_000_000, 3])
def test_forest_has_the_groups_of_all_pairs_at_every_limit(spark, in_task):
    data = words(3, 200, 40, centres=12, flips=8)
    geno = spark.createDataFrame(data, "marker_id long, bits long")
    forest = lk.linkage_forest(geno, 40, 3)
    roots = lk.group_roots(forest, [3.0, 5.0, 7.0, 9.0, 12.0], in_task)
    pairs, ids = plain_pairs(data, 40, 3), [k for k, _ in data]
    assert forest.count() < len(ids) and len(pairs) > 2 * len(ids)
    for limit in (3.0, 5.0, 7.0, 9.0, 12.0):
        got = {r.node: r.root for r in roots.filter(f"lod = {limit}").collect()}
        want = plain_groups(ids, pairs, limit)
        groups = {}
        for k in ids:
            groups.setdefault(want[k], set()).add(got.get(k, k))
        assert all(len(v) == 1 for v in groups.values()) and len({min(v) for v in groups.values()}) == len(groups)


def test_sweep_and_refine_from_one_forest(spark):
    data = words(8, 150, 40, centres=10, flips=9)
    geno = spark.createDataFrame(data, "marker_id long, bits long")
    pairs, ids = plain_pairs(data, 40, 2), [k for k, _ in data]
    forest = lk.linkage_forest(geno, 40, 2)
    swept = {(r.lod, r.marker_id): r.lg for r in lk.lod_sweep(forest, geno, 2, 6, 3).collect()}
    assert swept == {(n, k): g for n in range(2, 7) for k, g in plain_groups(ids, pairs, n, 3).items()}
    groups = lk.separate_chromosomes(forest, geno, 2)
    base = plain_groups(ids, pairs, 2)
    top, inside = max(base.values()), [k for k in ids if base[k] == 1]
    want = {}
    for n in (4, 5):
        sub = plain_groups(inside, {k: v for k, v in pairs.items() if k[0] in inside and k[1] in inside}, n, 2)
        want |= {(n, k): (sub[k] if sub[k] <= 1 else top + sub[k] - 1) if k in sub else base[k] for k in ids}
    assert {(r.lod, r.marker_id): r.lg for r in lk.refine_lg(groups, forest, 1, 4, 5, 2).collect()} == want


@pytest.mark.parametrize("iterate", [False, True])
def test_singles_by_classes_equal_singles_by_markers(spark, iterate):
    data = words(9, 120, 40, centres=5, flips=6)
    geno = spark.createDataFrame(data, "marker_id long, bits long")
    groups = spark.createDataFrame([(k, 0 if k % 3 == 0 else 1 + k % 4) for k, _ in data], "marker_id long, lg long")
    classes, lods = lk.class_lods(geno, 40, 3)
    one = lk.join_singles(groups, lk.pairwise_lod(geno, 40, 3), 4, 0.5, iterate)
    two = lk.join_singles(groups, lods, 4, 0.5, iterate, classes)
    assert sorted(map(tuple, one.select("marker_id", "lg").collect())) == sorted(map(tuple, two.select("marker_id", "lg").collect()))


def test_strongest_forest_is_the_best_of_all():
    rng = np.random.default_rng(2)
    for _ in range(60):
        n, m = rng.integers(2, 9), rng.integers(1, 20)
        a, b, w = rng.integers(0, n, m), rng.integers(0, n, m), rng.integers(0, 5, m).astype(float)
        kept = lk.strongest_forest(a, b, w)
        for limit in range(5):
            assert plain_parts(n, a, b, w, limit) == plain_parts(n, a[kept], b[kept], w[kept], limit)
        assert len(kept) == n - len(set(plain_parts(n, a, b, w, -1)))


def plain_parts(n, a, b, w, limit):
    part = list(range(n))
    for x, y, v in zip(a, b, w):
        if v >= limit:
            old, new = max(part[x], part[y]), min(part[x], part[y])
            part = [new if p == old else p for p in part]
    return part


@pytest.mark.parametrize("tolerance,limit", [(0.1, 2.7055), (0.05, 3.8415), (0.02, 5.4119), (0.01, 6.6349), (0.001, 10.8276)])
def test_distortion_at_any_tolerance(spark, tolerance, limit):
    assert abs(lk.chi_square_limit(tolerance) - limit) < 1e-3
    geno = spark.createDataFrame([(k, (1 << k) - 1) for k in range(41)], "marker_id long, bits long")
    kept = [r.marker_id for r in lk.filter_distorted(geno, tolerance, 40).collect()]
    assert sorted(kept) == [k for k in range(41) if (2 * k - 40) ** 2 / 40 <= limit]
    quarter = [r.marker_id for r in lk.filter_distorted(geno, tolerance, 40, 0.25).collect()]
    assert sorted(quarter) == [k for k in range(41) if (k - 10) ** 2 / 10 + (k - 10) ** 2 / 30 <= limit]


def test_distortion_takes_no_tolerance_beyond_its_range(spark):
    geno = spark.createDataFrame([(1, 0)], "marker_id long, bits long")
    assert lk.filter_distorted(geno, 0, 40).count() == 1
    with pytest.raises(ValueError):
        lk.filter_distorted(geno, 1.5, 40)
