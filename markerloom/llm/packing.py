"""Packing tokenised documents into training sequences by best-fit decreasing.

Every document becomes token ids and an end id. Documents longer than a sequence are first cut
into full windows; what remains of each is placed, longest first, into the open sequence with the
least room that still holds it. A segment tree over remaining capacities finds that sequence.

Pieces are spread over shards by a hash of themselves and their row, each shard holding a bounded number of them, and each
shard is packed by itself; only its last few sequences stay partly empty.

Defined results: a null text counts as empty; an empty text is the end id alone; a very long text
is read whole, in stretches cut at white space; repeated rows are packed as separate documents, and
rows without id keep a null id; ties in length go by id, start, checksum and row, so reruns over the
same files agree; an empty table gives
an empty table; columns other than id and text, whatever their names, are not read.
"""

from __future__ import annotations

import functools
import itertools
import os
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from markerloom.llm.blocks import give_back
from markerloom.plans.staging import Staging

LENGTH = 4096
END = 2
PIECES = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint"


#: Classes of bytes: white space that always ends a word, ASCII letters, digits and marks, and the rest.
_REST, _BLANK, _LETTER, _DIGIT, _MARK = range(5)
_CLASS = np.zeros(256, np.uint8)
_CLASS[33:127] = _MARK
_CLASS[[9, 10, 13, 32]] = _BLANK
_CLASS[48:58] = _DIGIT
_CLASS[65:91] = _CLASS[97:123] = _LETTER
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: By class of a byte and of the next: whether a new part begins between them.
_CUTS = np.array([[False if a == _BLANK else b == _BLANK or (a != b and _REST not in (a, b)) for b in range(5)] for a in range(5)]).ravel()
_PLAIN = r"^([a-z]+|[!-/:-@\[-`{-~]+)$"


class WordIds:
    """Token ids of texts, part by part, remembering the ids of parts seen before.

    The tokenizer lowers case, drops white space and never joins ASCII letters, digits and marks
    with each other (but for an apostrophe before a letter, which is not cut here), so a text's ids
    are those of its parts in turn. Parts are cut and told apart by array operations on the bytes;
    only a part that is new becomes a Python string. New parts of one class are encoded many at a
    time, and the marks of word ends in the vocabulary tell their ids apart. Up to ``keep`` parts
    are remembered, which takes about 25 bytes each; later ones are encoded each time they come.
    """

    def __init__(self, path: str, keep: int = 700_000):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark already runs a task per core
        from tokenizers import Tokenizer

        self.tokenizer, self.keep = Tokenizer.from_file(path), keep
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.closes = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        self.closes[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self.special = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.known = pa.chunked_array([pa.array([""])])
        self.id_type = np.uint16 if len(self.closes) <= 1 << 16 else np.uint32
        self.size, self.flat, self.held = np.zeros(1, np.int32), np.zeros(1 << 16, self.id_type), 0

    def _plainly(self, names: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, dtype=self.id_type) for e in self.tokenizer.encode_batch_fast(names, add_special_tokens=False)]

    def _encoded(self, parts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
        """Parts in a new order, their numbers of ids, and their ids in one array."""
        plain = pc.match_substring_regex(parts, _PLAIN)
        order, sizes, flat = [], [np.zeros(0, np.int32)], [np.zeros(0, self.id_type)]
        single = parts.filter(plain)
        for at in range(0, len(single), 20_000):
            names = single.slice(at, 20_000).to_pylist()
            ids = np.concatenate(self._plainly([" ".join(names[i : i + 200]) for i in range(0, len(names), 200)]))
            ends = np.flatnonzero(self.closes[ids]) + 1
            if len(ends) == len(names):
                sizes.append(np.diff(ends, prepend=0).astype(np.int32))
                flat.append(ids)
            else:
                each = self._plainly(names)
                sizes.append(np.array([len(x) for x in each], np.int32))
                flat.extend(each)
        order.append(single)
        odd = parts.filter(pc.invert(plain))
        for at in range(0, len(odd), 20_000):
            each = self._plainly(odd.slice(at, 20_000).to_pylist())
            sizes.append(np.array([len(x) for x in each], np.int32))
            flat.extend(each)
        order.append(odd)
        return pa.concat_arrays(order), np.concatenate(sizes), np.concatenate(flat)

    def _remember(self, parts: pa.Array, sizes: np.ndarray, flat: np.ndarray) -> None:
        if self.held + len(flat) > len(self.flat):
            self.flat = np.concatenate([self.flat[: self.held], np.zeros(max(len(self.flat) // 2, 2 * len(flat)), self.id_type)])
        self.flat[self.held : self.held + len(flat)] = flat
        self.held += len(flat)
        self.size = np.concatenate([self.size, sizes])
        self.known = pa.chunked_array([*self.known.chunks, parts]) if self.known.num_chunks < 16 else pa.chunked_array([pa.concat_arrays([*self.known.chunks, parts])])

    def ids(self, data: np.ndarray, starts: np.ndarray) -> list[np.ndarray]:
        """Ids of the texts that begin at ``starts`` in an array of UTF-8 bytes."""
        if not len(data):
            return [np.zeros(0, self.id_type) for _ in starts]
        kinds = _CLASS[data]
        apostrophes = np.flatnonzero(data[:-1] == 39)
        kinds[apostrophes[kinds[apostrophes + 1] == _LETTER]] = _REST
        begins = np.zeros(len(data), dtype=bool)
        begins[1:] = _CUTS[kinds[:-1] * np.uint8(5) + kinds[1:]]
        ends = np.append(starts[1:], len(data))
        begins[starts[starts < ends]] = True
        begins[0] = True
        at = np.flatnonzero(begins).astype(np.int32)
        parts = pa.StringArray.from_buffers(len(at), pa.py_buffer(np.append(at, np.int32(len(data)))), pa.py_buffer(_LOWER[data])).dictionary_encode()
        distinct = pc.ascii_trim(parts.dictionary, " \t\n\r").dictionary_encode()
        found = pc.index_in(distinct.dictionary, self.known)
        unseen = distinct.dictionary.filter(pc.is_null(found))
        sizes, flat = self.size, self.flat[: self.held]
        if len(unseen):
            parts_, more, ids = self._encoded(unseen)
            place = np.empty(len(distinct.dictionary), np.int32)
            seen = found.is_valid().to_numpy(zero_copy_only=False)
            place[seen] = found.drop_null().to_numpy()
            place[~seen] = len(sizes) + pc.index_in(unseen, parts_).to_numpy()
            if len(sizes) < self.keep:
                self._remember(parts_, more, ids)
                sizes, flat = self.size, self.flat[: self.held]
            else:
                sizes, flat = np.concatenate([sizes, more]), np.concatenate([flat, ids])
        else:
            place = found.to_numpy()
        first = (np.cumsum(sizes, dtype=np.int64) - sizes).astype(np.int32 if len(flat) < 2**31 else np.int64)
        part = place[distinct.indices.to_numpy()][parts.indices.to_numpy()]
        size = sizes[part]
        upto = np.cumsum(size, dtype=first.dtype)
        out = flat[np.repeat(first[part] - upto + size, size) + np.arange(upto[-1], dtype=first.dtype)]
        before = np.concatenate([[0], upto])[np.searchsorted(at, np.append(starts, len(data)))]
        texts = [out[a:b] for a, b in zip(before[:-1].tolist(), before[1:].tolist(), strict=True)]
        return self._with_special(data, starts, ends, texts)

    def _with_special(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, texts: list[np.ndarray]) -> list[np.ndarray]:
        """Texts that spell out a special token are encoded whole."""
        whole = data.tobytes() if self.special else b""
        for mark in self.special:
            at = whole.find(mark)
            while at >= 0:
                k = int(np.searchsorted(starts, at, side="right")) - 1
                if at + len(mark) <= ends[k]:
                    texts[k] = self._plainly([whole[starts[k] : ends[k]].decode()])[0]
                    at = whole.find(mark, int(ends[k]))
                else:
                    at = whole.find(mark, at + 1)
        return texts

    def encode(self, texts: list[str], end: int) -> list[np.ndarray]:
        data = [t.encode() for t in texts]
        sizes = np.array([len(d) for d in data], np.int64)
        return [_ended(x, end) for x in self.ids(np.frombuffer(b"".join(data), np.uint8), np.cumsum(sizes) - sizes)]


@functools.lru_cache(maxsize=2)
def _word_ids(path: str) -> WordIds:
    return WordIds(path)


class RoomTree:
    """Open sequences in a segment tree indexed by how many tokens still fit."""

    def __init__(self, capacity: int):
        self.leaves = 1 << capacity.bit_length()
        self.live = [0] * (2 * self.leaves)
        self.open: list[list[int]] = [[] for _ in range(capacity + 1)]

    def _count(self, room: int, by: int) -> None:
        node = room + self.leaves
        while node:
            self.live[node] += by
            node >>= 1

    def add(self, room: int, sequence: int) -> None:
        self.open[room].append(sequence)
        self._count(room, 1)

    def take(self, least: int) -> tuple[int, int] | None:
        """The open sequence with the least room that is at least ``least``, taken out of the tree."""
        node = least + self.leaves
        while not self.live[node]:
            while node & 1:
                node >>= 1
            if node == 0:
                return None
            node += 1
            if node & (node - 1) == 0:
                return None
        while node < self.leaves:
            node = 2 * node if self.live[2 * node] else 2 * node + 1
        room = node - self.leaves
        sequence = self.open[room].pop()
        self._count(room, -1)
        return room, sequence


def best_fit(lengths: list[int], capacity: int) -> tuple[list[int], list[int]]:
    """Sequence number and offset of every piece; pieces are placed from the longest down."""
    tree, sequences, offsets, opened = RoomTree(capacity), [0] * len(lengths), [0] * len(lengths), 0
    for i in sorted(range(len(lengths)), key=lambda k: -lengths[k]):
        found = tree.take(lengths[i])
        if found is None:
            found = (capacity, opened)
            opened += 1
        room, sequences[i] = found
        offsets[i] = capacity - room
        if room > lengths[i]:
            tree.add(room - lengths[i], sequences[i])
    return sequences, offsets


def _ended(ids: np.ndarray, end: int) -> np.ndarray:
    out = np.empty(len(ids) + 1, "<u4")
    out[:-1], out[-1] = ids, end
    return out


def _cut_text(data: np.ndarray, most: int) -> list[tuple[int, int]]:
    """Stretches of a long text of about ``most`` bytes, cut before white space, where no token crosses."""
    edges = [0]
    while len(data) - edges[-1] > most:
        at = edges[-1]
        blanks = np.flatnonzero(_CLASS[data[at + 1 : at + most]] == _BLANK)
        if len(blanks):
            edges.append(at + 1 + int(blanks[-1]))
            continue
        upto = at + most
        while upto < len(data) and not len(blanks):
            blanks = np.flatnonzero(_CLASS[data[upto : upto + most]] == _BLANK)
            upto += most
        if not len(blanks):
            break
        edges.append(upto - most + int(blanks[0]))
    return list(itertools.pairwise([*edges, len(data)]))


def _token_runs(words: WordIds, texts: pa.Array, end: int, most: int) -> Iterator[tuple[int, np.ndarray]]:
    """(index, ids with the end id) of every text, about ``most`` bytes at a time."""
    if texts.null_count:
        texts = pc.fill_null(texts, "")
    wide = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    edges = np.frombuffer(texts.buffers()[1], wide)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
    at = 0
    while at < len(texts):
        upto = max(at + 1, int(np.searchsorted(edges, edges[at] + most, side="right")) - 1)
        piece = data[edges[at] : edges[upto]]
        if len(piece) <= most:
            found = words.ids(piece, edges[at:upto] - edges[at])
        else:
            found = [np.concatenate([words.ids(piece[lo:hi], np.zeros(1, np.int64))[0] for lo, hi in _cut_text(piece, most)])]
        for k, ids in enumerate(found):
            yield at + k, _ended(ids, end)
        at = upto


def tokenized_pieces(docs: DataFrame, path: str, length: int = LENGTH, end: int = END, id_col: str = "doc_id", text: str = "text", slice_bytes: int = 4 << 20) -> DataFrame:
    """One row per piece of every document: full windows and what remains."""

    def batches(batches_: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _word_ids(path)
        for batch in batches_:
            owner, cut, crc, tokens = [], [], [], []
            for i, ids in _token_runs(words, batch.column(1), end, slice_bytes):
                for start in range(0, len(ids), length):
                    piece = ids[start : start + length]
                    owner.append(i)
                    cut.append((start, len(piece)))
                    crc.append(zlib.crc32(piece))
                    tokens.append(len(ids))
            start, size = np.array(cut, np.int64).reshape(-1, 2).T
            columns = [batch.column(0).take(pa.array(owner, pa.int64())), pa.array(start), pa.array(size), pa.array(crc, pa.int64()), pa.array(tokens, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "start", "length", "ids_crc32", "doc_tokens"])
        give_back()

    return docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text")).mapInArrow(batches, PIECES)


def pack(docs: DataFrame, path: str | None = None, length: int = LENGTH, end: int = END, shard_pieces: int = 16384, id_col: str = "doc_id", text: str = "text", slice_bytes: int = 4 << 20) -> DataFrame:
    """Pieces with ``sequence_id`` and ``offset``; ``shard_pieces`` is about what one shard holds.

    A task lays out ``slice_bytes`` of text at a time: fewer take less memory and more time.
    """
    import public_tokenizers

    staging = Staging(docs.sparkSession, "packing")
    pieces = staging.put(tokenized_pieces(docs, path or public_tokenizers.path("word_bpe_49k.json"), length, end, id_col, text, slice_bytes).withColumn("row", F.monotonically_increasing_id()), "pieces", arrow_rows=2000)
    shards = max(1, -(-pieces.count() // shard_pieces))
    # a row's place in the written table is part of its key, so that rows that repeat each other spread
    keyed = pieces.withColumn("shard", F.pmod(F.xxhash64("doc_id", "start", "length", "ids_crc32", "row"), F.lit(shards)))

    def place(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["length", "doc_id", "start", "ids_crc32", "row"], ascending=[False, True, True, True, True])
        sequences, offsets = best_fit(rows["length"].tolist(), length)
        return rows.assign(sequence_id=(rows["shard"].to_numpy() << 32) + np.array(sequences, dtype=np.int64), offset=np.array(offsets, dtype=np.int64)).drop(columns=["shard", "row"])

    return keyed.groupBy("shard").applyInPandas(place, PIECES + ", sequence_id bigint, offset bigint")


def op8_packing(spark, sf_dir):
    return pack(spark.read.parquet(f"{sf_dir}/documents.parquet"))
