"""Chains by tree and look-back against the plain sweep over all later parts."""

import random
import time

import numpy as np
import pandas as pd
import pytest

from markerloom.operators import iterative as it


def swept(part, gap_open, gap_penalty):
    """Every part against all later ones, in order of start; the search ends at the first it cannot pay for."""
    n = len(part["score"])
    best, before, cuts = part["score"].astype(float), np.arange(n), np.zeros(n, np.int64)
    price = lambda gap: gap_open + gap_penalty * gap if gap > 0 else 0
    for j in range(n):
        for k in range(j + 1, n):
            on_q = part["qstart"][k] - part["qend"][j]
            on_t = part["tstart"][k] - part["tend"][j] if part["forward"] else part["tstart"][j] - part["tend"][k]
            cut = max(0, -on_q, -on_t)
            if cut > part["head"][k]:
                continue
            first = price(on_q + cut)
            if best[j] + first <= 0:
                break
            total = best[j] + part["score"][k] + (first + price(on_t + cut) - cut * part["density"][k])
            if total > best[k]:
                best[k], before[k], cuts[k] = total, j, cut
    return best, before, cuts


def parts(rng, n, span, forward, whole):
    """Parts of lengths that differ on the two sequences; scores that make shares of a base whole, or any."""
    rows = []
    for _ in range(n):
        q, t, size = rng.randint(0, span), rng.randint(0, span), rng.randint(5, 40)
        rows.append((q, q + size, t, t + size + rng.choice([0, 0, 3]), rng.choice([1, 2]) * size if whole else rng.randint(1, 60), rng.choice([0, 3, size])))
    rows.sort()
    q, qe, t, te, score, head = map(np.array, zip(*rows, strict=True))
    return {"qstart": q, "qend": qe, "tstart": t, "tend": te, "score": score, "head": head, "density": score / np.maximum(np.minimum(qe - q, te - t), 1), "forward": forward}


@pytest.mark.parametrize("whole", [True, False])
def test_random_parts_equal_the_sweep(whole):
    rng = random.Random(12)
    for trial in range(400):
        part = parts(rng, rng.randint(1, 25), rng.choice([60, 200, 600]), bool(trial % 2), whole)
        for costs in ((-12, -1), (-3, -2), (0, -1)):
            got, want = it._best_chains(part, *costs), swept(part, *costs)
            assert np.allclose(got[0], want[0])
            if whole:
                assert np.array_equal(got[1], want[1]) and np.array_equal(got[2], want[2])


@pytest.mark.parametrize("strand", ["+", "-"])
def test_many_co_linear_parts(strand):
    n = 100_000
    at = np.arange(n) * 120
    rows = pd.DataFrame({"qname": "q", "qlen": n * 130, "qstart": at, "qend": at + 100, "strand": strand, "tname": "t", "tlen": n * 130, "tstart": at if strand == "+" else at[::-1], "tend": (at if strand == "+" else at[::-1]) + 100, "mapq": 60, "as_score": 100, "cigar": "100M", "segment": 0})
    began = time.time()
    out = it._chain_group(rows, -12, -1)
    assert out["chained"].max() == n and len(out) == n + 1 and time.time() - began < 60
