"""Packing of tokenized documents into sequences of a fixed length, best fit decreasing.

Every document is cut into full windows first; what is left of it (less than a window) goes into
the open window with the least room that still takes it. Open windows are found by a segment tree
over the remaining capacity. Packing needs no shuffle: a task packs the documents it reads, some
millions of tokens at a time, and only the last windows of such a batch stay partly empty; those
are topped up with pieces cut from the emptiest ones.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civicflow.llm.tokens import encoded, release, slices

# Less than the defaults: a packing task holds the ids of its batch as well.
CACHED_PIECES = 250_000
ENCODED_BYTES = 1 << 21

PIECES = (
    "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"
)


class RoomTree:
    """Open windows by remaining capacity: a segment tree whose nodes count the windows below."""

    def __init__(self, capacity: int):
        self._leaves = 1 << capacity.bit_length()
        self._count = [0] * (2 * self._leaves)
        self._open: list[list[int]] = [[] for _ in range(capacity + 1)]

    def _change(self, room: int, by: int) -> None:
        node = self._leaves + room
        while node:
            self._count[node] += by
            node >>= 1

    def add(self, window: int, room: int) -> None:
        if room:
            self._open[room].append(window)
            self._change(room, 1)

    def take(self, need: int) -> tuple[int, int] | None:
        """The window with the least room of at least ``need``, and that room."""
        node, count = self._leaves + need, self._count
        if not count[node]:
            while True:  # up until a subtree on the right has windows, then down to its left
                if node == 1:
                    return None
                if not node & 1 and count[node + 1]:
                    node += 1
                    break
                node >>= 1
            while node < self._leaves:
                node = 2 * node if count[2 * node] else 2 * node + 1
        room = node - self._leaves
        self._change(room, -1)
        return self._open[room].pop(), room


def best_fit_decreasing(lengths: list[int], capacity: int) -> list[list[int]]:
    """Windows, each a list of positions in ``lengths``; equal lengths in their given order."""
    tree, windows = RoomTree(capacity), []
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        found = tree.take(lengths[i])
        if found is None:
            found = len(windows), capacity
            windows.append([])
        windows[found[0]].append(i)
        tree.add(found[0], found[1] - lengths[i])
    return windows


def place(lengths: list[int], capacity: int) -> list[list[tuple[int, int, int]]]:
    """Windows of pieces (position in ``lengths``, start, length) that cover every token once.

    Windows that stay partly empty are filled from the one with the fewest tokens, whose pieces
    are cut where needed; so of a batch one window at most is partly empty.
    """
    rest = [(i, n - n % capacity, n % capacity) for i, n in enumerate(lengths) if n % capacity]
    full = [[(i, s, capacity)] for i, n in enumerate(lengths) for s in range(0, n - capacity + 1, capacity)]
    packed = [[rest[j] for j in w] for w in best_fit_decreasing([r[2] for r in rest], capacity)]
    packed.sort(key=lambda w: -sum(p[2] for p in w))
    used = [sum(p[2] for p in w) for w in packed]
    low, high = 0, len(packed) - 1
    while low < high:
        room = capacity - used[low]
        if not room:
            low += 1
            continue
        doc, start, length = packed[high].pop()
        moved = min(room, length)
        packed[low].append((doc, start, moved))
        if moved < length:
            packed[high].append((doc, start + moved, length - moved))
        used[low] += moved
        used[high] -= moved
        if not used[high]:
            del packed[high]
            high -= 1
    return full + packed


def pack(docs: DataFrame, tokenizer: str, window: int = 2048, end_id: int = 1, batch_tokens: int = 1 << 22) -> DataFrame:
    """Pack ``docs`` (doc_id, text; other columns are ignored) into sequences of ``window`` ids.

    ``tokenizer`` is a file of the tokenizers library at the same path on every executor. Returns
    one row per piece: where it starts in its document, its ids (unsigned 32 bits, little-endian),
    the document's number of ids with the end id, its sequence and its offset there. Pieces of a
    sequence follow each other without a gap. A null or empty text has the end id alone; rows with
    the same or no doc_id are packed as documents of their own; an empty table gives no rows. A
    task holds the ids of one batch: ``batch_tokens``, or one longer document.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 33
        keys: list[int | None] = []
        held: list[np.ndarray] = []
        counts: list[np.ndarray] = []
        size = 0
        release()
        for batch in batches:
            for part in slices(batch, 1):
                for doc_ids, ids, count in encoded([part], tokenizer, end_id, ENCODED_BYTES, CACHED_PIECES):
                    keys += doc_ids
                    held.append(ids)
                    counts.append(count)
                    size += len(ids)
                if size >= batch_tokens:
                    out, used = flush(keys, np.concatenate(held), np.concatenate(counts), number)
                    yield from out
                    number += used
                    keys, held, counts, size = [], [], [], 0
            release()
        if keys:
            yield from flush(keys, np.concatenate(held), np.concatenate(counts), number)[0]

    def flush(keys: list, held: np.ndarray, counts: np.ndarray, number: int) -> tuple[Iterator, int]:
        lengths, begin = counts.tolist(), (np.cumsum(counts) - counts).tolist()
        windows = place(lengths, window)
        rows = [
            (doc, start, length, number + w, offset)
            for w, pieces in enumerate(windows)
            for (doc, start, length), offset in zip(pieces, accumulate((p[2] for p in pieces), initial=0))
        ]

        def record(part: list) -> pa.RecordBatch:
            doc, start, length, seq, offset = zip(*part)
            cuts = [held[begin[d] + s : begin[d] + s + n].astype("<u4").tobytes() for d, s, n in zip(doc, start, length)]
            return pa.record_batch(
                [
                    pa.array([keys[d] for d in doc], pa.int64()),
                    pa.array(start, pa.int64()),
                    pa.array(length, pa.int64()),
                    pa.array(cuts, pa.binary()),
                    pa.array([lengths[d] for d in doc], pa.int64()),
                    pa.array(seq, pa.int64()),
                    pa.array(offset, pa.int64()),
                ],
                names=["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"],
            )

        return (record(rows[at : at + 2048]) for at in range(0, len(rows), 2048)), len(windows)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(work, PIECES)
