"""Exchange of many small values between groups of documents.

A unit is a group of documents, by a hash of doc_id, that one task works on at a time. Units send
sorted numbers to buckets (ranges of a hash), a bucket compares what all units sent it, and answers
each unit with one bit per number. Sorted numbers travel as compressed differences, a few bytes
each, and both directions are bounded: a unit by its documents, a bucket by its range of hashes.
Texts are exchanged once; every later step reads that same exchange again.
"""

from __future__ import annotations

import numpy as np
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from civicflow.llm.components import stored

UNIT_BYTES = 5 << 19


def units_for(docs: DataFrame, unit_bytes: int = UNIT_BYTES) -> tuple[DataFrame, int]:
    """``docs`` and its number of units, by the stored size of the largest table that it reads. Input
    of unknown size is written to a table first and read from there."""
    unknown = int(docs.sparkSession.conf.get("spark.sql.defaultSizeInBytes", str(2**63 - 1)))

    def sizes(rows: DataFrame) -> list[int]:
        leaves = rows._jdf.queryExecution().optimizedPlan().collectLeaves()
        return [int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size())]

    found = sizes(docs)
    if not found or max(found) >= unknown:
        docs = stored(docs, "documents")
        found = sizes(docs)
    return docs, max(size // unit_bytes + 1 for size in found)


def unit_of(doc_id: Column, units: int) -> Column:
    return F.pmod(F.xxhash64(doc_id), F.lit(units)).cast("int")


def pack_planes(values: np.ndarray) -> bytes:
    """Unsigned numbers, byte by byte from the lowest, compressed; zero bytes cost almost nothing."""
    planes = values.astype("<u8").view(np.uint8).reshape(-1, 8).T
    return zstandard.compress(np.ascontiguousarray(planes).tobytes(), 1)


def unpack_planes(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(data), np.uint8).reshape(8, -1)
    return np.ascontiguousarray(planes.T).reshape(-1).view("<u8")


def pack_sorted(values: np.ndarray) -> bytes:
    """Ascending unsigned numbers."""
    return pack_planes(np.diff(values, prepend=np.uint64(0)))


def unpack_sorted(data: bytes) -> np.ndarray:
    return np.cumsum(unpack_planes(data), dtype=np.uint64)


def pack_bits(flags: np.ndarray) -> bytes:
    return zstandard.compress(np.packbits(flags).tobytes(), 1)


def unpack_bits(data: bytes, n: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(zstandard.decompress(data), np.uint8), count=n).astype(bool)


def bucket_edges(values: np.ndarray, buckets: int, bits: int = 64) -> np.ndarray:
    """Where each bucket's part of ascending ``values`` of ``bits`` bits starts, and the end."""
    width = ((1 << bits) + buckets - 1) // buckets
    limits = np.array([k * width for k in range(1, buckets)], np.uint64)
    return np.concatenate([[0], np.searchsorted(values, limits), [len(values)]])


def grouped(*keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order that brings equal keys together (stable), and where each group starts in it."""
    order = np.lexsort(keys[::-1]) if len(keys) > 1 else np.argsort(keys[0], kind="stable")
    fresh = np.ones(len(order), bool)
    if len(order):
        fresh[1:] = np.logical_or.reduce([key[order][1:] != key[order][:-1] for key in keys])
    return order, np.flatnonzero(fresh)
