"""Exact substring dedup by a distributed difference-cover algorithm, cut off at ``length`` bytes.

Two positions with the same ``length``-byte string share, within the next ``v`` bytes, an offset at
which both fall on the difference cover modulo ``v``. So only suffixes that start on the cover are
sampled. The method's four steps, each a shuffle by name:

1. The leading tuples of sampled suffixes are named and the names of a bucket sorted; a suffix whose
   name is met once cannot lie in a repeated string and goes.
2. Recursion: the rest of each text is its string of names. Three names, a step apart, make a triple,
   which is named in turn, sorted, and kept if its name is met again. The triple covers all bytes
   that a repeated string must share from the cover position on, so one recursion is enough.
3. Merge: of all suffixes, sampled or not, those are kept that reach a cover position with a
   repeated triple within ``v`` bytes.
4. These are sorted by the name of their whole ``length``-byte prefix, and adjacent equal prefixes
   are settled: all but the earliest start repeat an earlier one.

Names are fingerprints in place of ranks, as ranks would have to travel back to the texts. The
first two steps use as many bits as their buckets and 32 more (more candidates can come of that,
never fewer). Prefixes of one block of texts are compared byte by byte; those of different blocks
by 72 bits and the bucket, which an independent function deals.

Before each shuffle a task names a block of positions together and sends one position per name;
what repeats inside the block is settled there and goes straight to its document, past the bucket
of its name, so that a string found in every document weighs no more than one per block. Exact
copies of whole texts are settled by digest first, and only the first copy is cut up.

Defined results: a null text counts as empty; nothing is removed from texts shorter than
``length`` or from rows without id; ids must be unique, as no column tells rows of one id apart; texts may be
of any length and are cut into overlapping segments; an empty table gives an empty table; columns
other than id and text are not read.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from markerloom.llm.blocks import mix64
from markerloom.plans.staging import Staging

_U = np.uint64
#: A perfect difference set: every residue modulo 21 is a difference of two of these.
MODULUS, COVER = 21, (0, 1, 4, 14, 16)
_KEY = mix64(np.arange(77, 77 + 128, dtype=np.uint64)) | _U(1)
#: Bytes of text that a task names together, at first, and of a segment of a text.
BLOCK, SEGMENT = 4 << 20, 1 << 20
#: Buckets of names beyond which they grow with the input as well as their number; partitions that hold them.
EVEN_BUCKETS, PARTITIONS = 1 << 16, 20_000


def bucket_plan(total: int, bucket_bytes: int) -> tuple[int, int]:
    """(bits of a bucket's number, bytes of text in a block) for ``total`` bytes of text.

    Up to ``EVEN_BUCKETS`` buckets a bucket holds the names of ``bucket_bytes`` of text. Beyond, number
    and size both grow as the square root, and blocks with the number, so that a block still sends
    many names to each bucket: 30 GB take 4,096 buckets of 8 MB and blocks of 4 MB, 100 TB take
    1,048,576 of 95 MB and blocks of 64 MB.
    """
    buckets = max(1, -(-total // bucket_bytes))
    if buckets > EVEN_BUCKETS:
        buckets = int(EVEN_BUCKETS * math.sqrt(buckets / EVEN_BUCKETS))
    bits = max(0, (buckets - 1).bit_length())
    return bits, BLOCK * max(1, (1 << bits) // EVEN_BUCKETS)


def covers(modulus: int, cover: tuple[int, ...]) -> bool:
    return {(a - b) % modulus for a in cover for b in cover} == set(range(modulus))


def _words(raw: np.ndarray) -> np.ndarray:
    """The 64-bit words that begin at every byte."""
    padded = np.ascontiguousarray(raw)
    return np.ndarray((max(0, len(padded) - 7),), dtype="<u8", buffer=padded.data, strides=(1,)) if len(padded) > 7 else np.zeros(0, np.uint64)


def _offsets(length: int) -> list[int]:
    """Where words begin that cover ``length`` bytes."""
    return [*range(0, length - 7, 8), *([length - 8] if length % 8 else [])]


def names_at(raw: np.ndarray, at: np.ndarray, length: int, other: bool = False) -> np.ndarray:
    """64-bit names of the ``length``-byte strings at positions ``at``; length is 8 or more.

    ``other`` gives names by an independent function.
    """
    words, keys = _words(raw), _KEY[64:] if other else _KEY[:64]
    out = np.full(len(at), _U(length))
    for k, offset in enumerate(_offsets(length)):
        out = (out ^ words[at + offset]) * keys[k % 64]
        out ^= out >> _U(32)
    return mix64(out)


def same_bytes(raw: np.ndarray, a: np.ndarray, b: np.ndarray, length: int) -> np.ndarray:
    """Whether the ``length``-byte strings at positions ``a`` and ``b`` are equal."""
    words, out = _words(raw), np.ones(len(a), bool)
    for offset in _offsets(length):
        out &= words[a + offset] == words[b + offset]
    return out


def _packed(values: np.ndarray) -> bytes:
    """Numbers of 32 bits as four planes of bytes; the planes of small numbers' high bytes are zeros."""
    return np.ascontiguousarray(values.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes()


def _unpacked(data: bytes) -> np.ndarray:
    planes = np.frombuffer(data, np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").ravel().astype(np.int64)


def _by_doc(doc: np.ndarray, at: np.ndarray) -> tuple[bytes, bytes, bytes]:
    """(documents, counts, starts) of positions sorted by document and start.

    Starts are differences inside a document; those of 2**32 and more do not occur, as a text
    column holds less.
    """
    if not len(doc):
        return b"", b"", b""
    change = np.concatenate([[True], doc[1:] != doc[:-1]])
    first = np.flatnonzero(change)
    step = np.diff(at, prepend=0)
    step[first] = at[first]
    return doc[first].astype(np.int64).tobytes(), _packed(np.diff(np.append(first, len(doc)))), _packed(step)


def _positions(docs: bytes, counts: bytes, starts: bytes) -> tuple[np.ndarray, np.ndarray]:
    if not docs:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    n, step = _unpacked(counts), _unpacked(starts)
    total = np.cumsum(step)
    first = np.cumsum(n) - n
    before = np.repeat(total[first] - step[first], n)
    return np.repeat(np.frombuffer(docs, np.int64), n), total - before


#: A row for a bucket of names (``dest`` below the number of buckets), or, above, for a part of the documents.
_SENT = "dest int, names binary, extra binary, docs binary, counts binary, starts binary"
_PARTS = "part int, names binary, docs binary, counts binary, starts binary"
_FOUND = "doc_id bigint, starts binary"


def _table(rows: list[tuple], kind: str) -> pa.Table:
    names = [c.split()[0] for c in kind.split(", ")]
    columns = list(zip(*rows, strict=True)) or [()] * len(names)
    return pa.table({n: pa.array(c, pa.binary() if k else pa.int32()) for k, (n, c) in enumerate(zip(names, columns, strict=True))})


def _dealt(keys: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(key, indices in their order) of each key; narrow keys sort by counting."""
    if not len(keys):
        return
    order = np.argsort(keys.astype(np.uint16) if keys.max() < 65536 else keys, kind="stable")
    used, edges = np.unique(keys[order], return_index=True)
    for k, lo, hi in zip(used.tolist(), edges.tolist(), [*edges[1:].tolist(), len(keys)], strict=True):
        yield k, order[lo:hi]


def _part_of(doc: np.ndarray, parts: int) -> np.ndarray:
    return (mix64(doc.astype(np.uint64)) % _U(parts)).astype(np.int32)


def _sent(doc: np.ndarray, at: np.ndarray, name: np.ndarray, bits: int, second: np.ndarray | None = None, equal: Callable[[np.ndarray, np.ndarray], np.ndarray] | None = None, carry: bool = False) -> pa.Table:
    """Rows for buckets, with one position per name (the earliest), and for parts, with settled ones.

    Positions come sorted by document and start. With ``second`` names, which make up the bucket and
    eight more bits, of equal names all but the earliest are settled, those alone that ``equal``
    finds equal; else all are. ``carry`` sends the names of settled positions along.
    """
    order = np.argsort(name)
    sorted_ = name[order]
    same = sorted_[1:] == sorted_[:-1]
    if equal is not None and same.any():
        pair = np.flatnonzero(same)
        same[pair] = equal(order[pair], order[pair + 1])
    fresh, settled = np.zeros(len(name), bool), np.zeros(len(name), bool)
    if len(name):
        begin = np.flatnonzero(np.concatenate([[True], ~same]))
        size = np.diff(np.append(begin, len(name)))
        fresh[np.minimum.reduceat(order, begin)] = True
        settled[order[np.repeat(size > 1, size)]] = True
        if second is not None:
            settled &= ~fresh
    buckets = 1 << bits
    deal = name if second is None else second
    bucket = (deal >> _U(64 - bits)).astype(np.int32) if bits else np.zeros(len(name), np.int32)
    rest = (name >> _U(32 - bits)).astype(np.uint32) if second is None else name
    extra = None if second is None else ((second >> _U(56 - bits)) & _U(255)).astype(np.uint8)
    rows = []
    one, own = np.flatnonzero(fresh), np.flatnonzero(settled)
    for b, here in _dealt(bucket[one]):
        k = one[here]
        rows.append((b, rest[k].tobytes(), b"" if extra is None else extra[k].tobytes(), *_by_doc(doc[k], at[k])))
    for p, here in _dealt(_part_of(doc[own], buckets)):
        k = own[here]
        rows.append((buckets + p, (name[k] >> _U(32 - bits)).tobytes() if carry else b"", b"", *_by_doc(doc[k], at[k])))
    return _table(rows, _SENT)


def _in_order(doc: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions sorted by document and start."""
    if len(doc) and 0 <= doc.min() and doc.max() < 2**31:
        key = np.sort((doc.astype(np.uint64) << _U(32)) | at.astype(np.uint64))
        return (key >> _U(32)).astype(np.int64), (key & _U(0xFFFFFFFF)).astype(np.int64)
    order = np.lexsort((at, doc))
    return doc[order], at[order]


def _collected(table: pa.Table, carry: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Documents, starts and (with ``carry``) names of a table of rows."""
    found = [_positions(r["docs"], r["counts"], r["starts"]) for r in table.select(["docs", "counts", "starts"]).to_pylist()]
    name = np.concatenate([np.frombuffer(x, np.uint64) for x in table.column("names").to_pylist()]) if carry else np.zeros(0, np.uint64)
    return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found]), name


def _gather(table: pa.Table) -> pa.Table:
    """All starts of each document of a part, one row per document."""
    doc, at = _in_order(*_collected(table, False)[:2])
    first = np.flatnonzero(np.concatenate([[True], doc[1:] != doc[:-1]])) if len(doc) else np.zeros(0, np.int64)
    step = np.diff(at, prepend=0)
    step[first] = at[first]
    ends = np.append(first[1:], len(doc))
    return pa.table({"doc_id": pa.array(doc[first].astype(np.int64)), "starts": pa.array([_packed(step[x:y]) for x, y in zip(first.tolist(), ends.tolist(), strict=True)], pa.binary())})


def _triples(bits: int, step: int):
    """Named triples of a part's documents: the names at a start and one and two steps behind it."""

    def run(table: pa.Table) -> pa.Table:
        doc, at, name = _collected(table, True)
        ids, dense = np.unique(doc, return_inverse=True)
        key, first = np.unique((dense.astype(np.int64) << 32) | at, return_index=True)
        name, found = name[first], np.ones(len(key), bool)
        triple = mix64(name)
        for k in (1, 2):
            place = np.minimum(np.searchsorted(key, key + k * step), max(0, len(key) - 1))
            found &= key[place] == key + k * step
            triple = mix64((triple ^ name[place]) * _KEY[k])
        key, triple = key[found], triple[found]
        return _sent(ids[key >> 32], key & 0xFFFFFFFF, triple, bits)

    return run


def _meet(bits: int, wide: bool, carry: bool):
    """Equal names among the blocks of a bucket: all of them, or (``wide``) all but the earliest.

    What was settled in its block passes through. ``carry`` keeps the names.
    """
    buckets = 1 << bits

    def run(table: pa.Table) -> pa.Table:
        dest = table.column("dest")[0].as_py()
        if dest >= buckets:
            return table.append_column("part", pa.array(np.full(len(table), dest - buckets, np.int32))).select([c.split()[0] for c in _PARTS.split(", ")])
        doc, at, _ = _collected(table, False)
        name = np.concatenate([np.frombuffer(x, np.uint64 if wide else np.uint32) for x in table.column("names").to_pylist()])
        order = np.argsort(name)
        same = name[order[1:]] == name[order[:-1]]
        order = order[np.concatenate([[False], same]) | np.concatenate([same, [False]])]
        doc, at, name = doc[order], at[order], name[order]
        if wide and len(name):
            extra = np.concatenate([np.frombuffer(x, np.uint8) for x in table.column("extra").to_pylist()])[order]
            order = np.lexsort((at, doc, extra, name))
            doc, at, name, extra = doc[order], at[order], name[order], extra[order]
            later = np.concatenate([[False], (name[1:] == name[:-1]) & (extra[1:] == extra[:-1])])
            doc, at = doc[later], at[later]
        order = np.lexsort((at, doc))
        doc, at = doc[order], at[order]
        whole = (name[order].astype(np.uint64) | _U(dest << 32)) if carry else None
        rows = [(p, whole[k].tobytes() if carry else b"", *_by_doc(doc[k], at[k])) for p, k in _dealt(_part_of(doc, buckets))]
        return _table(rows, _PARTS)

    return run


def _segments(batches: Iterator[pa.RecordBatch], overlap: int, segment: int = SEGMENT, block: int = BLOCK) -> Iterator[list[tuple]]:
    """Blocks of (doc, offset, bytes, whether the text ends there, rest of the row).

    Segments of a text overlap by ``overlap`` bytes.
    """
    held, size = [], 0
    for batch in batches:
        for doc, text, *rest in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            data = (text or "").encode()
            for offset in range(0, max(1, len(data) - overlap), segment):
                piece = data[offset : offset + segment + overlap]
                held.append((doc, offset, piece, offset + len(piece) == len(data), rest))
                size += len(piece)
                if size >= block:
                    yield sorted(held, key=lambda x: x[:2])
                    held, size = [], 0
    if held:
        yield sorted(held, key=lambda x: x[:2])


def _laid(block: list[tuple]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes of a block in one array, the first index of each segment, their lengths."""
    sizes = np.array([len(x[2]) for x in block], dtype=np.int64)
    return np.frombuffer(b"".join(x[2] for x in block), np.uint8), np.cumsum(sizes) - sizes, sizes


def _starts(packed: bytes) -> np.ndarray:
    return np.cumsum(_unpacked(packed))


def repeated_strings(docs: DataFrame, length: int = 100, bucket_bytes: int = 8 << 20, id_col: str = "doc_id", text: str = "text", with_kept: bool = True, segment_bytes: int = SEGMENT, partitions: int = PARTITIONS) -> DataFrame:
    """``id_col``, ``n_bytes``, ``n_removed``, ``n_spans``, ``kept_sha256`` and ``kept`` (bytes) of every text.

    Without ``with_kept`` the last column is null and the kept bytes stay in the tasks.

    A byte is removed if some ``length``-byte string that covers it also starts earlier, in an
    earlier document or earlier in the same one.
    """
    # a repeated string shares this many bytes from a cover position on; three tuples a step apart cover them
    shared = length - MODULUS + 1
    step = shared // 3 // MODULUS * MODULUS
    tuple_bytes = shared - 2 * step
    assert covers(MODULUS, COVER) and tuple_bytes >= step >= MODULUS
    spark = docs.sparkSession
    staging = Staging(spark, "suffixes")
    source = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(text, F.lit("")).alias("text"))
    digest = F.sha2("text", 256)
    copies = source.select("doc_id", digest.alias("digest"), F.octet_length("text").cast("bigint").alias("n_bytes"))
    copies = staging.put(copies, "digests")
    firsts = copies.groupBy("digest").agg(F.min("doc_id").alias("first"))
    # only exact copies need telling apart later, and they are far fewer than the documents
    later = staging.put(copies.join(firsts, "digest").filter((F.col("doc_id") != F.col("first")) & (F.col("n_bytes") >= length)).select("doc_id", F.lit(True).alias("copy")), "copies", release=True)
    total = copies.agg(F.sum("n_bytes")).first()[0] or 0
    bits, block_bytes = bucket_plan(total, bucket_bytes)
    staging.drop(copies)
    unique = source.filter(F.col("doc_id").isNotNull() & (F.octet_length("text") >= length)).join(later.select("doc_id"), "doc_id", "left_anti")

    def sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        on = np.zeros(MODULUS, dtype=bool)
        on[list(COVER)] = True
        for block in _segments(batches, length - 1, segment_bytes, block_bytes):
            raw, first, sizes = _laid(block)
            doc, at, name = [], [], []
            for (d, offset, _, last, _), f, n in zip(block, first, sizes, strict=True):
                # segments that do not end a text leave the overlap to the next
                upto = n - tuple_bytes + 1 if last else segment_bytes
                where = np.flatnonzero(on[(np.arange(max(0, upto)) + offset) % MODULUS])
                doc.append(np.full(len(where), d, dtype=np.int64))
                at.append(where + offset)
                name.append(where + f)
            yield from _sent(np.concatenate(doc), np.concatenate(at), names_at(raw, np.concatenate(name), tuple_bytes), bits, carry=True).to_batches()

    # a partition may hold many buckets, each of which is met by itself
    dealt = min(1 << bits, partitions)
    met = lambda sent, wide, carry: sent.repartition(dealt, "dest").groupBy("dest").applyInArrow(_meet(bits, wide, carry), _PARTS).repartition(dealt, "part").groupBy("part")
    named = unique.select("doc_id", "text").mapInArrow(sample, _SENT)
    triples = met(named, False, True).applyInArrow(_triples(bits, step), _SENT)
    sampled = staging.put(met(triples, False, False).applyInArrow(_gather, _FOUND), "sample", release=True)
    merging = source.join(sampled, "doc_id").select("doc_id", "text", "starts")

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _segments(batches, length - 1, segment_bytes, block_bytes):
            raw, first, sizes = _laid(block)
            doc, at, name = [], [], []
            for (d, offset, _, _, rest), f, n in zip(block, first, sizes, strict=True):
                upto = min(n - length + 1, segment_bytes)
                if upto <= 0:
                    continue
                hits = _starts(rest[0]) - offset
                hits = hits[(hits >= 0) & (hits < upto + MODULUS)]
                edge = np.zeros(upto + MODULUS + 1, dtype=np.int64)
                np.add.at(edge, np.maximum(hits - MODULUS + 1, 0), 1)
                np.add.at(edge, hits + 1, -1)
                where = np.flatnonzero(np.cumsum(edge[:upto]) > 0)
                doc.append(np.full(len(where), d, dtype=np.int64))
                at.append(where + offset)
                name.append(where + f)
            if doc:
                place = np.concatenate(name)
                same = lambda x, y, raw=raw, place=place: same_bytes(raw, place[x], place[y], length)
                yield from _sent(np.concatenate(doc), np.concatenate(at), names_at(raw, place, length), bits, names_at(raw, place, length, other=True), same).to_batches()

    prefixes = merging.mapInArrow(merge, _SENT)
    repeats = staging.put(met(prefixes, True, False).applyInArrow(_gather, _FOUND), "repeats", release=True)
    staging.drop(sampled)
    cut = source.join(repeats.join(later, "doc_id", "full"), "doc_id", "left").select("doc_id", "text", "starts", F.coalesce("copy", F.lit(False)).alias("copy"))

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc, text_, starts, copy in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                data = text_.encode()
                n = len(data)
                if copy:
                    begin, end = np.array([0]), np.array([n])
                else:
                    at = _starts(starts or b"")
                    gap = np.flatnonzero(np.diff(at) > length) if len(at) else np.zeros(0, np.int64)
                    begin = at[np.concatenate([[0], gap + 1])] if len(at) else at
                    end = at[np.concatenate([gap, [len(at) - 1]])] + length if len(at) else at
                kept, last = [], 0
                for b, e in zip(begin.tolist(), end.tolist(), strict=True):
                    kept.append(data[last:b])
                    last = e
                kept.append(data[last:])
                left = b"".join(kept)
                rows.append((doc, n, n - len(left), len(begin), hashlib.sha256(left).hexdigest(), left if with_kept else None))
            columns = list(zip(*rows, strict=True)) or [()] * 6
            kinds = [pa.int64()] * 4 + [pa.string(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])

    return cut.mapInArrow(remove, "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, kept binary").withColumnRenamed("doc_id", id_col)


def op6_suffix_dedup(spark, sf_dir):
    return repeated_strings(spark.read.parquet(f"{sf_dir}/documents.parquet"), with_kept=False).drop("kept")
