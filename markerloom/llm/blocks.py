"""Small helpers that several operators share: hashing, local components, bounded samples."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_U = np.uint64


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit words (the finaliser of the public splitmix64 generator)."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def local_components(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest index reachable from each of ``n`` nodes by the links (a, b)."""
    label = np.arange(n)
    while len(a):
        low = np.minimum(label[a], label[b])
        before = label.copy()
        np.minimum.at(label, a, low)
        np.minimum.at(label, b, low)
        np.minimum.at(label, before[a], low)
        np.minimum.at(label, before[b], low)
        label = label[label]
        if np.array_equal(label, before):
            break
    return label


def hash_sample(df: DataFrame, id_col: str, n: int) -> DataFrame:
    """``n`` rows at most, those whose ids hash lowest; ``df`` should hold only what is needed.

    The n-th hash is found on the ids alone, so that no task sends more than its share of the
    sampled rows to the driver, however many rows and columns there are. Of rows that repeat an id the
    least are taken, by all columns in turn, so reruns agree.
    """
    h = F.xxhash64(id_col)
    cut = df.select(h.alias("h")).orderBy("h").limit(n).agg(F.max("h")).first()[0]
    if cut is None:
        return df.limit(0)
    return df.filter(h <= cut).orderBy(h, *df.columns).limit(n)


def raw_values(column: pa.Array) -> Iterator[np.ndarray]:
    """The bytes of every string or binary value, in place; null counts as empty."""
    wide = np.int64 if column.type in (pa.large_string(), pa.large_binary()) else np.int32
    _, edges, data = column.buffers()
    edges = np.frombuffer(edges, wide)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, wide)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    known = column.is_valid().to_numpy(zero_copy_only=False)
    for lo, hi, ok in zip(edges[:-1].tolist(), edges[1:].tolist(), known.tolist(), strict=True):
        yield data[lo:hi] if ok else data[:0]


def give_back() -> None:
    """Return freed memory to the system at a task's end, as worker processes outlive their tasks."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def crc32_sql(data: str) -> str:
    """DuckDB SQL for the unsigned CRC-32 of a blob, byte by byte through the usual table of 256 remainders."""
    table = []
    for byte in range(256):
        for _ in range(8):
            byte = (byte >> 1) ^ (0xEDB88320 * (byte & 1))
        table.append(str(byte))
    found = f"list_transform(regexp_extract_all(hex({data}), '..'), lambda x: CAST('0x' || x AS BIGINT))"
    step = f"lambda a, b: xor(a >> 8, ([{','.join(table)}]::BIGINT[])[1 + (xor(a, b) & 255)])"
    return f"xor(list_reduce({found}, {step}, CAST(4294967295 AS BIGINT)), CAST(4294967295 AS BIGINT))"
