"""Conversation trie: against a plain walk over all prefixes, at several shard sizes."""

import hashlib
import random
import zlib

import pytest

from markerloom.llm import prefix_trie as pt

SCHEMA = "conv_id long, turn long, role string, text string, depth string, ids long"


def talk(seed, n=120, words=4):
    """Conversations of few different turns, so that many share their openings."""
    rng = random.Random(seed)
    rows = []
    for c in range(0, n * 3, 3):
        for t in range(rng.randint(1, 6)):
            rows.append((c, t, rng.choice(["user", "assistant"]), " ".join(["w"] * rng.randint(0, words)), "x", 1))
    return rows


def plain(rows, every=20, most=3):
    """Nodes by walking every prefix of every rebuilt conversation."""
    own = {}
    for c, turn, role, text, *_ in rows:
        if c is not None:
            own.setdefault(c, []).append(((turn is not None, turn or 0, role or "", hashlib.md5((text or "").encode()).hexdigest()), (role or "", text or "")))
    own = {c: [x[1] for x in sorted(v)] for c, v in own.items()}
    built = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % (most + 1)
        built[c] = tuple(own.get(c - (abs(c) % every) * (1 if c >= 0 else -1), [])[:h] + turns[h:])
    nodes = {}
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            nodes.setdefault(turns[:d], []).append(c)
    kids = {}
    for path in nodes:
        if path:
            kids.setdefault(path[:-1], []).append(path)
    leaves, saved = {}, {}
    for path in sorted(nodes, key=len, reverse=True):
        below = kids.get(path, [])
        leaves[path] = sum(leaves[k] for k in below) if below else 1
        own_words = len(path[-1][1].split()) if path else 0
        saved[path] = sum(saved[k] for k in below) + (len(nodes[path]) - 1) * own_words
    out = []
    for path, members in nodes.items():
        ends = ",".join(str(c) for c in sorted(members) if len(built[c]) == len(path))
        out.append((min(members), len(path), min(nodes[path[:-1]]) if path else None, len(members), len(kids.get(path, [])), leaves[path], saved[path], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def found(spark, rows, **sizes):
    paths = pt.weighted_paths(pt.opened_conversations(pt.coded_conversations(spark.createDataFrame(rows, SCHEMA))))
    nodes = pt.build_trie(paths, **sizes)
    return sorted(map(tuple, nodes.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256").collect()), key=str)


@pytest.mark.parametrize("sizes", [{}, {"shard_turns": 20, "least_turns": 10**9}, {"shard_turns": 150, "least_turns": 10**9}])
def test_equals_plain_walk(spark, sizes):
    rows = talk(1)
    assert found(spark, rows, **sizes) == plain(rows)


def test_odd_rows_and_hot_copies(spark):
    rows = [(7, None, None, None, None, None), (7, None, "user", "x y", None, None), (7, 1, "user", "x y", "a", 2), (7, 1, "user", "x y", "a", 2)]
    rows += [(None, 1, "user", "not a conversation", "a", 2), (-5, 0, "user", "below zero", "a", 0), (0, 0, "a|b", "c", "", 0), (40, 0, "a", "b|c", "", 0), (3, 0, "user", "w " * 50_000, "", 0)]
    rows += [(c, t, "user", f"same {t}", "", 0) for c in range(100_000, 100_400) for t in range(4)]
    # one turn, an absent base and a number above it: nothing is left
    lone = next(c for c in range(1001, 1019) if zlib.crc32(str(c).encode()) % 4)
    rows += [(lone, 0, "user", "only", "", 0)]
    for sizes in ({}, {"shard_turns": 30, "least_turns": 10**9}):
        assert found(spark, rows, **sizes) == plain(rows)


def test_empty_table_and_turnless_root(spark):
    assert found(spark, []) == []
    lone = next(c for c in range(1001, 1019) if zlib.crc32(str(c).encode()) % 4)
    assert found(spark, [(lone, 0, "user", "only", "", 0)]) == [(lone, 0, None, 1, 0, 1, 0, hashlib.sha256(str(lone).encode()).hexdigest())]


def test_ternary_tree_is_balanced_by_medians():
    tree = pt.TernaryTree()
    for k in pt.median_order(1023):
        tree.insert([k], [1])
    depth, front = 0, [tree.inner[0]]
    while front:
        depth += 1
        front = [x for n in front for x in (tree.lower[n], tree.higher[n]) if x]
    assert depth == 10 and sorted(pt.median_order(9)) == list(range(9))


def test_long_conversation(spark):
    rows = [(20, t, "user", f"turn {t % 50}", "", 0) for t in range(3000)] + [(40, t, "user", f"turn {t % 50}", "", 0) for t in range(2000)]
    got = found(spark, rows, shard_turns=500, least_turns=10**9)
    assert len(got) == len({r[1:3] + r[:1] for r in got}) and max(r[1] for r in got) == 3000
