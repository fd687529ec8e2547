"""Prefix trie of conversations: ternary search trees per range shard, boundary nodes merged level by level.

Turns are coded by a dictionary (one number for each distinct role and text), a conversation is the
array of its turns' numbers, and conversations of equal arrays are one weighted row. These rows are
range partitioned into shards of neighbours in the order of their arrays. Each shard builds a ternary
search tree: a node holds one turn's number, ``lower`` and ``higher`` lead to its siblings and
``inner`` to the turns that follow it. Rows are inserted median first, then the medians of both
halves, so that sibling trees are balanced. One pass over the nodes, children before parents, sums
members, leaves and savings.

A node that lies in two shards is a prefix of the first or of the last row of each. The nodes on
these two paths are not finished by a shard: they leave it as two weighted rows, with what the shard
has found below each of them. These rows are far fewer, and go through the same step again until
one shard is left. Nothing passes through the driver but counts.

Defined results: rows without ``conv_id`` take no part; null roles and texts are empty ones; turns of
equal number come by role, then by the MD5 of their text; repeated rows are turns of their own; a
remainder has the sign of SQL (for a negative id too); an empty table has no root; a conversation of
many turns is one array and one path; long texts are met by digest and word count alone; other
columns are not read, whatever their names.
"""

from __future__ import annotations

import functools
import hashlib
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from markerloom.llm.blocks import crc32_sql
from markerloom.llm.mixing import count_words
from markerloom.operators.numbering import with_row_number
from markerloom.plans.staging import Staging, small_side

_NOTHING = hashlib.sha256(b"").hexdigest()
#: A conversation's number fits in this many bits of a chunk of ids that are written as one text.
_CHUNK_BITS = 16
#: Rows of the merge: a path, the words of its turns, and what is known of the nodes at ``depths``.
_ROW = "ids array<bigint>, words array<bigint>, depths array<int>, members array<bigint>, least array<bigint>, kids array<bigint>, leaves array<bigint>, saved array<bigint>, ends array<string>"
_NODE = "conv_id bigint, depth int, parent bigint, parent_key binary, own_key binary, n_convs bigint, n_children bigint, n_leaves bigint, saved_tokens bigint, ends_sha256 string"
_FIELDS = ("members", "least", "kids", "leaves", "saved", "ends")


class TernaryTree:
    """Nodes in order of creation, so that a node's number is above its parent's; node 0 is the root."""

    def __init__(self) -> None:
        self.turn, self.words, self.parent, self.depth = [0], [0], [-1], [0]
        self.lower, self.higher, self.inner = [0], [0], [0]
        self.members, self.least, self.kids, self.leaves, self.saved, self.ends = [0], [None], [0], [0], [0], [None]

    def _new(self, turn: int, words: int, parent: int) -> int:
        for values, value in ((self.turn, turn), (self.words, words), (self.parent, parent), (self.depth, self.depth[parent] + 1)):
            values.append(value)
        for values in (self.lower, self.higher, self.inner, self.members, self.kids, self.leaves, self.saved):
            values.append(0)
        self.least.append(None)
        self.ends.append(None)
        return len(self.turn) - 1

    def insert(self, ids: list[int], words: list[int]) -> list[int]:
        """The nodes of a path, the root first; what is missing is made."""
        path, node = [0], 0
        for turn, size in zip(ids, words, strict=True):
            at = self.inner[node]
            if not at:
                at = self.inner[node] = self._new(turn, size, node)
            while self.turn[at] != turn:
                side = self.lower if turn < self.turn[at] else self.higher
                if not side[at]:
                    side[at] = self._new(turn, size, node)
                at = side[at]
            path.append(at)
            node = at
        return path

    def add(self, node: int, members: int, least: int | None, kids: int, leaves: int, saved: int, ends: str | None) -> None:
        self.members[node] += members
        self.kids[node] += kids
        self.leaves[node] += leaves
        self.saved[node] += saved
        if least is not None and (self.least[node] is None or least < self.least[node]):
            self.least[node] = least
        if ends is not None:
            self.ends[node] = ends

    def finish(self, open_nodes: set[int]) -> None:
        """Sums from the leaves up; ``open_nodes`` get theirs but are not closed or passed on."""
        for node in range(len(self.turn) - 1, -1, -1):
            if node in open_nodes:
                continue
            self.leaves[node] += not self.kids[node]
            self.saved[node] += (self.members[node] - 1) * self.words[node]
            if node:
                self.add(self.parent[node], self.members[node], self.least[node], 1, self.leaves[node], self.saved[node], None)


def median_order(n: int) -> Iterator[int]:
    """0 to n - 1, the middle first, then the middles of both halves and so on."""
    spans, at = [(0, n)], 0
    while at < len(spans):
        lo, hi = spans[at]
        at += 1
        if lo < hi:
            middle = (lo + hi) // 2
            yield middle
            spans += [(lo, middle), (middle + 1, hi)]


def _key(above: bytes, turn: int) -> bytes:
    """Name of a node by the names on its path: 128 bits, for finding parents in other shards."""
    return hashlib.md5(above + struct.pack("<q", turn)).digest()


def _shard(batches: Iterator[pa.RecordBatch], last: bool, named: bool) -> Iterator[pa.RecordBatch]:
    """The finished nodes of one shard, and its two boundary paths unless it is the ``last`` one.

    ``named``: nodes may have children that an earlier level has finished, and so tell their names.
    """
    rows = [r for b in batches for r in b.to_pylist()]
    if not rows:
        return
    tree = TernaryTree()
    paths: dict[int, list[int]] = {}
    for k in median_order(len(rows)):
        r = rows[k]
        path = tree.insert(r["ids"], r["words"])
        if k in (0, len(rows) - 1):
            paths[k] = path
        for depth, *known in zip(r["depths"], *(r[f] for f in _FIELDS), strict=True):
            tree.add(path[depth], *known)
    boundary = [] if last else [(rows[k], path) for k, path in sorted(paths.items())]
    open_nodes = {n for _, path in boundary for n in path}
    tree.finish(open_nodes)
    keys: dict[int, bytes] = {0: b""}
    for node in range(1, len(tree.turn)) if named else sorted(open_nodes - {0}):
        keys[node] = _key(keys[tree.parent[node]], tree.turn[node])
    yield from _node_batches(tree, open_nodes, keys, named)
    told: set[int] = set()
    spines = []
    for row, path in boundary:
        depths = [d for d, n in enumerate(path) if n not in told]
        told.update(path)
        at = [path[d] for d in depths]
        spines.append({"ids": row["ids"], "words": row["words"], "depths": depths} | {f: [getattr(tree, f)[n] for n in at] for f in _FIELDS})
    if spines:
        yield _batch({"spine": spines, "node": [None] * len(spines)})


def _batch(columns: dict[str, list]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[c], _arrow()[c]) for c in ("node", "spine")], names=["node", "spine"])


@functools.cache
def _arrow() -> dict[str, pa.DataType]:
    """Arrow types of the two kinds of output."""
    kinds = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string(), "binary": pa.binary()}

    def of(ddl: str) -> pa.DataType:
        fields = [f.split() for f in ddl.split(", ")]
        return pa.struct([pa.field(n, pa.list_(kinds[k[6:-1]]) if k.startswith("array") else kinds[k]) for n, k in fields])

    return {"node": of(_NODE), "spine": of(_ROW)}


def _node_batches(tree: TernaryTree, open_nodes: set[int], keys: dict[int, bytes], named: bool, most: int = 10_000) -> Iterator[pa.RecordBatch]:
    """Finished nodes; a parent on a boundary is told by its name, any other by its smallest member."""
    done = [n for n in range(len(tree.turn)) if n not in open_nodes]
    for lo in range(0, len(done), most):
        out = []
        for n in done[lo : lo + most]:
            parent = tree.parent[n]
            away = parent in open_nodes
            out.append({
                "conv_id": tree.least[n], "depth": tree.depth[n], "parent": tree.least[parent] if n and not away else None, "parent_key": keys[parent] if away else None, "own_key": keys[n] if named else None,
                "n_convs": tree.members[n], "n_children": tree.kids[n], "n_leaves": tree.leaves[n], "saved_tokens": tree.saved[n], "ends_sha256": tree.ends[n] or _NOTHING,
            })
        yield _batch({"node": out, "spine": [None] * len(out)})


def build_trie(sequences: DataFrame, shard_turns: int = 500_000, least_turns: int = 10_000) -> DataFrame:
    """One row per node of the trie of weighted paths, which are rows of distinct ``ids``.

    ``shard_turns`` is about how many turns one shard holds in memory (some 300 bytes each). Tables
    too small to fill a shard for every core get shards of ``least_turns`` or more.
    """
    cores = sequences.sparkSession.sparkContext.defaultParallelism
    staging = Staging(sequences.sparkSession, "trie")
    rows, finished, named = staging.put(sequences, "paths"), [], False
    while True:
        turns, count = rows.agg(F.sum(F.size("ids") + 1), F.count("*")).first()
        shards = max(-(-(turns or 0) // shard_turns), min((turns or 0) // least_turns, cores))
        shards = min(shards, count // 4)  # two paths leave a shard, so every level is half the last at most
        last = shards <= 1
        dealt = rows.repartition(1) if last else rows.repartitionByRange(shards, "ids")
        step = functools.partial(_shard, last=last, named=named)
        built = staging.put(dealt.sortWithinPartitions("ids").mapInArrow(step, f"node struct<{_colons(_NODE)}>, spine struct<{_colons(_ROW)}>"), "shards", arrow_rows=2000)
        finished.append(built.filter("node IS NOT NULL").select("node.*"))
        if last:
            break
        rows, named = built.filter("spine IS NOT NULL").select("spine.*"), True
    nodes = staging.put(functools.reduce(DataFrame.unionAll, finished), "nodes")
    names = small_side(nodes.filter("own_key IS NOT NULL").select(F.col("own_key").alias("parent_key"), F.col("conv_id").alias("found")))
    found = nodes.filter("parent_key IS NOT NULL").join(names, "parent_key").withColumn("parent", F.col("found")).select(*nodes.columns)
    return nodes.filter("parent_key IS NULL").unionAll(found).drop("parent_key", "own_key").withColumnRenamed("parent", "parent_conv_id")


def _colons(ddl: str) -> str:
    return ", ".join(f.replace(" ", ": ", 1) for f in ddl.split(", "))


def _gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Chunks of equal paths, which follow each other, as one weighted row; ids are hashed as they pass."""
    path, words, members, least, digest = None, None, 0, None, None

    def row() -> dict:
        return {"ids": path, "words": words, "depths": [len(path)], "members": [members], "least": [least], "kids": [0], "leaves": [0], "saved": [0], "ends": [digest.hexdigest()]}

    done = []
    for batch in batches:
        for r in batch.to_pylist():
            if r["ids"] != path:
                if path is not None:
                    done.append(row())
                path, words, members, least, digest = r["ids"], r["words"], 0, r["least"], hashlib.sha256()
            elif members:
                digest.update(b",")
            digest.update(r["told"].encode())
            members += r["members"]
        yield pa.RecordBatch.from_struct_array(pa.array(done, _arrow()["spine"]))
        done = []
    if path is not None:
        yield pa.RecordBatch.from_struct_array(pa.array([row()], _arrow()["spine"]))


def weighted_paths(conversations: DataFrame) -> DataFrame:
    """Distinct ``ids`` of conversations (conv_id, ids, words) with their number, smallest id and hash of ids.

    Ids are first written out chunk by chunk, in tasks that hold 65,536 of them at most; a path's
    chunks then pass one task in order, which keeps one running hash. So a path that a third of all
    conversations share costs its task a few long rows, and no memory.
    """
    chunk = F.shiftright("conv_id", _CHUNK_BITS)
    told = F.array_join(F.transform(F.array_sort(F.collect_list("conv_id")), lambda c: c.cast("string")), ",")
    chunks = conversations.groupBy("ids", chunk.alias("chunk")).agg(F.first("words").alias("words"), F.count("*").alias("members"), F.min("conv_id").alias("least"), told.alias("told"))
    return chunks.repartition("ids").sortWithinPartitions("ids", "chunk").drop("chunk").mapInArrow(_gathered, _ROW)


def coded_conversations(turns: DataFrame) -> DataFrame:
    """``(conv_id, ids, words)``: each conversation's turns in order, as dictionary numbers and word counts."""
    staging = Staging(turns.sparkSession, "turn-codes")
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    # both digests have one length, so what is hashed again cannot be read in two ways
    told = turns.filter("conv_id IS NOT NULL").select(F.col("conv_id").cast("bigint").alias("conv_id"), "turn", role.alias("role"), F.md5(text).alias("body"), count_words(text).alias("n_words"))
    told = staging.put(told.withColumn("digest", F.md5(F.concat(F.md5("role"), "body"))), "turns")
    codes = with_row_number(told.select("digest").distinct(), ["digest"], "code")
    place = F.struct(F.col("turn").isNotNull().alias("numbered"), "turn", "role", "body", F.col("code"), F.col("n_words"))
    rows = told.join(codes, "digest").groupBy("conv_id").agg(F.array_sort(F.collect_list(place)).alias("rows"))
    return staging.put(rows.select("conv_id", F.col("rows.code").alias("ids"), F.col("rows.n_words").alias("words")), "coded")


def opened_conversations(coded: DataFrame, every: int = 20, most: int = 3) -> DataFrame:
    """Each conversation with its first turns taken from the one whose id is the last multiple of ``every``.

    How many is the CRC-32 of its id modulo ``most + 1``; where there are fewer, it takes all.
    """
    h = F.pmod(F.crc32(F.col("conv_id").cast("string")), F.lit(most + 1)).cast("int")
    opening = coded.filter(F.col("conv_id") % every == 0).select(F.col("conv_id").alias("base"), F.slice("ids", 1, most).alias("base_ids"), F.slice("words", 1, most).alias("base_words"))
    joined = coded.withColumn("base", F.col("conv_id") - F.col("conv_id") % every).withColumn("h", h).join(opening, "base", "left")

    def rebuilt(own: str, other: str) -> F.Column:
        start = F.coalesce(F.slice(other, F.lit(1), F.col("h")), F.array().cast("array<bigint>"))
        return F.concat(start, F.slice(own, F.col("h") + 1, F.size(own)))

    return joined.select("conv_id", rebuilt("ids", "base_ids").alias("ids"), rebuilt("words", "base_words").alias("words"))


def op12_prefix_trie(spark, sf_dir):
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    return build_trie(weighted_paths(opened_conversations(coded_conversations(turns)))).withColumn("depth", F.col("depth").cast("bigint"))


def oracle() -> str:
    """Every prefix of every rebuilt conversation as a list, and every node counted for all its prefixes."""
    h = f"{crc32_sql('encode(CAST(conv_id AS VARCHAR))')} % 4"
    return rf"""WITH t AS (SELECT conv_id, list({{'r': coalesce(role, ''), 't': coalesce(text, '')}} ORDER BY turn NULLS FIRST, coalesce(role, ''), md5(coalesce(text, ''))) AS own FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
    b AS (SELECT a.conv_id, coalesce(o.own[1:h], []) || a.own[h + 1:] AS seq FROM (SELECT *, {h} AS h FROM t) a LEFT JOIN t o ON o.conv_id = a.conv_id - a.conv_id % 20),
    e AS (SELECT conv_id, seq, unnest(range(0, len(seq) + 1)) AS d FROM b),
    p AS (SELECT seq[1:d] AS node, d, min(conv_id) AS conv_id, count(*) AS n_convs, sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (len(seq) = d), '')) AS ends FROM e GROUP BY 1, 2),
    k AS (SELECT node[1:d - 1] AS node, count(*) AS n FROM p WHERE d > 0 GROUP BY 1),
    w AS (SELECT p.*, coalesce(k.n, 0) AS n_children, CASE WHEN d = 0 THEN 0 ELSE (n_convs - 1) * len(regexp_extract_all(p.node[d].t, '[^\x20\x09-\x0D]+')) END AS saving FROM p LEFT JOIN k ON k.node = p.node),
    u AS (SELECT w.node, d, n_children, saving, unnest(range(0, d + 1)) AS above FROM w),
    s AS (SELECT node[1:above] AS node, count(*) FILTER (n_children = 0) AS n_leaves, CAST(sum(saving) AS BIGINT) AS saved_tokens FROM u GROUP BY 1)
    SELECT w.conv_id, w.d AS depth, o.conv_id AS parent_conv_id, w.n_convs, w.n_children, s.n_leaves, s.saved_tokens, w.ends AS ends_sha256
    FROM w JOIN s ON s.node = w.node LEFT JOIN p o ON w.d > 0 AND o.node = w.node[1:w.d - 1]"""
