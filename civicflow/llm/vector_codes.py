"""Vector codes: one byte per part of a vector, codebooks fitted with adaptive bounds.

Vectors are turned to integers and cut into parts; every part position has a codebook, fitted by
rounds of assignment and averaging. Between rounds each part keeps its ``b`` closest entries with
lower bounds of their distances, in ascending order, and one outer bound for all other entries.
When entries move, the bounds give way by as much: a part's entry is proven again where its exact
distance lies below the next bound. Where a bound does not prove it, the entries up to the first
bound that does are compared in integers, and only beyond the outer bound all of them. ``b`` follows
what the round before needed. Bounds decide only what need not be compared; every assignment is
that of integer arithmetic, ties included.

The state of a round is a stored table that the next one reads, so a lost executor costs tasks and
no round. Only codebooks and their sums, which do not grow with the vectors, pass the driver.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from civicflow.llm.components import discard, stored

PARTS = 16
ENTRIES = 64
ROUNDS = 2
SCALE = 256
# Integers up to this size: sums of squared differences stay far within 64 bits.
LARGEST = 1 << 24
# Components compared at a time.
BATCH_CELLS = 1 << 20
# Share of the parts proven by bounds that stay provable when fewer are kept.
PROVEN = 0.99

_WHOLE = "vec_id long, label long, ints binary"
_STATE = _WHOLE + ", codes binary, error long, near binary, bounds binary, needed binary"
_SUMS = "part int, entry int, n long, total array<long>, needed array<long>"


@dataclass(frozen=True)
class Codebooks:
    """``entries`` by part, entry and position within the part; integers."""

    entries: np.ndarray

    def digest(self) -> str:
        return hashlib.sha256(",".join(map(str, self.entries.ravel().tolist())).encode()).hexdigest()

    def decode(self, codes: bytes) -> np.ndarray:
        """The integers that a row's codes stand for."""
        picked = np.frombuffer(codes, _code_type(self.entries.shape[1]))
        return self.entries[np.arange(len(picked)), picked].ravel()


def _code_type(entries: int) -> str:
    return "u1" if entries <= 256 else "<u2"


def _whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Vectors as little-endian 64-bit integers; null for those that have no such form."""
    for batch in batches:
        ints: list[bytes | None] = []
        for value in batch.column(1).to_pylist():
            v = None if value is None or None in value else np.array(value, np.float64)
            if v is not None and np.isfinite(v).all():
                v = np.floor(SCALE * v)
                ints.append(v.astype("<i8").tobytes() if (np.abs(v) <= LARGEST).all() else b"")
            else:
                ints.append(None)
        columns = [batch.column(0), batch.column(2), pa.array(ints, pa.binary())]
        yield pa.record_batch(columns, names=["vec_id", "label", "ints"])


def whole_vectors(vectors: DataFrame) -> DataFrame:
    """Stored (vec_id, label, ints) of rows whose vectors hold finite components only; ``ints`` is
    empty for those with components beyond LARGEST."""
    columns = [F.col("vec_id").cast("long"), "embedding", F.col("label").cast("long")]
    whole = vectors.select(*columns).mapInArrow(_whole, _WHOLE).where("ints is not null")
    return stored(whole, "whole-vectors")


def _seeds(whole: DataFrame, parts: int, entries: int) -> np.ndarray | None:
    """The first codebooks: the parts of the first vectors by id (equal ids in the order of their
    stored bytes); those of another length than the first do not count."""
    size = whole.where("octet_length(ints) > 0").orderBy(F.col("vec_id").asc_nulls_last(), "ints").select(F.octet_length("ints")).first()
    if size is None or size[0] // 8 % parts:
        return None
    first = whole.where(F.octet_length("ints") == size[0]).orderBy(F.col("vec_id").asc_nulls_last(), "ints").limit(entries)
    rows = np.array([np.frombuffer(r.ints, "<i8") for r in first.collect()])
    return np.ascontiguousarray(rows.reshape(len(rows), parts, -1).transpose(1, 0, 2))


def _down(values: np.ndarray) -> np.ndarray:
    """Numbers from 0 as the upper halves of 32-bit floats, never larger than they were."""
    lower = np.nextafter(values.astype("<f4"), np.float32(0))
    return (np.where(np.isinf(values), np.float32(np.inf), lower).astype("<f4").view("<u4") >> 16).astype("<u2")


def _up(halves: np.ndarray) -> np.ndarray:
    return (halves.astype("<u4") << 16).view("<f4").astype(np.float64)


def _squares(parts: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Squared distance of each row of ``parts`` to its row of ``entries``."""
    gap = parts - entries
    return np.einsum("...i,...i->...", gap, gap)


def assign_all(x: np.ndarray, book: np.ndarray, b: int) -> tuple[np.ndarray, ...]:
    """For parts (n, m) and one position's entries (k, m): best distances, the ``b`` closest entries
    (ties to the lower index) and ``b`` bounds: of the second to the last of them, and of all others."""
    squares = _squares(x[:, None, :], book[None, :, :])
    order = np.argsort(squares, axis=1, kind="stable")[:, : b + 1]
    closest = np.take_along_axis(squares, order, 1)
    bounds = np.full((len(x), b), np.inf)
    bounds[:, : order.shape[1] - 1] = np.sqrt(closest[:, 1:])
    return closest[:, 0], order[:, :b], bounds


def reassign(
    x: np.ndarray, book: np.ndarray, moved: np.ndarray, near: np.ndarray, bounds: np.ndarray
) -> tuple[np.ndarray, ...]:
    """As ``assign_all`` from what the last round kept, ``moved`` being how far each entry went since.
    Also how many of the kept entries each part needed; one more than all of them for a full search."""
    n, b = near.shape
    best = _squares(x, book[near[:, 0]])
    winner = near[:, 0].astype(np.int64)
    bounds = bounds - np.concatenate([moved[near[:, 1:]], np.full((n, 1), moved.max(initial=0.0))], axis=1)
    bounds = np.maximum(bounds * (1 - 1e-9) - 1e-9, 0.0)
    # Smallest bound from each place on: all entries from there on are at least so far.
    ordered = np.minimum.accumulate(bounds[:, ::-1], axis=1)[:, ::-1]
    needed = np.zeros(n, np.int64)
    exact = bounds.copy()
    open_rows = np.arange(n)
    for i in range(b):
        reach = np.sqrt(best[open_rows].astype(np.float64)) * (1 + 1e-9) + 1e-9
        open_rows = open_rows[reach >= ordered[open_rows, i]]
        if not len(open_rows):
            break
        needed[open_rows] = i + 1
        if i + 1 == b:
            break
        entry = near[open_rows, i + 1].astype(np.int64)
        square = _squares(x[open_rows], book[entry])
        exact[open_rows, i] = np.sqrt(square)
        closer = (square < best[open_rows]) | ((square == best[open_rows]) & (entry < winner[open_rows]))
        best[open_rows[closer]], winner[open_rows[closer]] = square[closer], entry[closer]

    # The kept entries in the new order: the winner first, the others by their bounds.
    lows = np.concatenate([np.sqrt(_squares(x, book[near[:, 0]]))[:, None], exact[:, :-1]], axis=1)
    lows[near == winner[:, None]] = -1.0
    order = np.argsort(lows, axis=1, kind="stable")
    near = np.take_along_axis(near.astype(np.int64), order, 1)
    bounds = np.concatenate([np.take_along_axis(lows, order, 1)[:, 1:], exact[:, -1:]], axis=1)
    full = np.flatnonzero(needed == b)
    if len(full):
        best[full], near[full], bounds[full] = assign_all(x[full], book, b)
    return best, near, bounds, needed


def _assigner(books: np.ndarray, moved: np.ndarray | None, b: int, kept: int) -> Callable:
    """One round over rows of ``_WHOLE`` (``moved`` is None) or ``_STATE``; ``kept`` bounds are passed
    on, of ``b`` that the rows hold."""
    parts, k, m = books.shape
    kind = _code_type(k)
    step = max(1, BATCH_CELLS // (k * m))

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, step):
                batch = whole.slice(at, step)
                n = batch.num_rows
                x = np.frombuffer(b"".join(batch.column("ints").to_pylist()), "<i8").reshape(n, parts, m)
                codes = np.zeros((n, parts, kept), kind)
                halves = np.zeros((n, parts, kept), "<u2")
                errors = np.zeros(n, np.int64)
                needed = np.zeros((n, parts), "u1")
                if moved is not None:
                    old = np.frombuffer(b"".join(batch.column("near").to_pylist()), kind).reshape(n, parts, b)
                    low = _up(np.frombuffer(b"".join(batch.column("bounds").to_pylist()), "<u2")).reshape(n, parts, b)
                for p in range(parts):
                    if moved is None:
                        best, near, bounds = assign_all(x[:, p], books[p], b)
                    else:
                        best, near, bounds, used = reassign(x[:, p], books[p], moved[p], old[:, p], low[:, p])
                        needed[:, p] = np.minimum(used, 255)
                    errors += best
                    codes[:, p], halves[:, p] = near[:, :kept], _down(_fewer(bounds, kept))
                firsts = np.ascontiguousarray(codes[:, :, 0])
                rows = [pa.array([v.tobytes() for v in a], pa.binary()) for a in (firsts, codes, halves, needed)]
                columns = [*(batch.column(c) for c in ("vec_id", "label", "ints")), rows[0], pa.array(errors, pa.int64()), *rows[1:]]
                yield pa.record_batch(columns, names=["vec_id", "label", "ints", "codes", "error", "near", "bounds", "needed"])

    return assign


def _fewer(bounds: np.ndarray, kept: int) -> np.ndarray:
    """Bounds when only ``kept`` entries stay: the outer one covers those that are left out."""
    return np.concatenate([bounds[:, : kept - 1], bounds[:, kept - 1 :].min(axis=1, keepdims=True)], axis=1)


def _summer(parts: int, k: int, m: int, b: int) -> Callable:
    """Per task: number and sum of the parts of each entry, and how many parts needed how many bounds."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers, totals = np.zeros(parts * k, np.int64), np.zeros((m, parts * k), np.int64)
        uses = np.zeros(b + 1, np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            x = np.frombuffer(b"".join(batch.column("ints").to_pylist()), "<i8").reshape(-1, m)
            codes = np.frombuffer(b"".join(batch.column("codes").to_pylist()), _code_type(k)).reshape(-1, parts)
            slots = (codes.astype(np.int64) + np.arange(parts) * k).ravel()
            numbers += np.bincount(slots, minlength=parts * k)
            # Sums of a batch are exact in floating point: far below 2**53.
            for i in range(m):
                totals[i] += np.bincount(slots, x[:, i].astype(np.float64), parts * k).astype(np.int64)
            needed = np.frombuffer(b"".join(batch.column("needed").to_pylist()), "u1")
            uses += np.bincount(np.minimum(needed, b), minlength=b + 1)
        held = np.flatnonzero(numbers)
        columns = [pa.array(held // k, pa.int32()), pa.array(held % k, pa.int32()), pa.array(numbers[held], pa.int64())]
        # How many bounds were needed goes with the first row.
        lists = pa.array([uses.tolist() if not i else [] for i in range(len(held))], pa.list_(pa.int64()))
        total = pa.array(totals[:, held].T.tolist(), pa.list_(pa.int64()))
        yield pa.record_batch([*columns, total, lists], names=["part", "entry", "n", "total", "needed"])

    return add


def _next_books(state: DataFrame, books: np.ndarray, b: int) -> tuple[np.ndarray, np.ndarray]:
    """Codebooks after averaging, and how many parts needed how many bounds."""
    parts, k, m = books.shape
    sums = state.select("ints", "codes", "needed").mapInArrow(_summer(parts, k, m, b), _SUMS)

    def added(column: str, size: int) -> list[Column]:
        return [F.sum(F.get(column, F.lit(i))).alias(f"{column}{i}") for i in range(size)]

    # At most parts * k rows.
    rows = sums.groupBy("part", "entry").agg(F.sum("n").alias("n"), *added("total", m), *added("needed", b + 1)).collect()
    books, uses = books.copy(), np.zeros(b + 1, np.int64)
    for row in rows:
        books[row["part"], row["entry"]] = [row[f"total{i}"] // row["n"] for i in range(m)]
        uses += [row[f"needed{i}"] or 0 for i in range(b + 1)]
    return books, uses


def _adapted(uses: np.ndarray, k: int, b: int) -> int:
    """The smallest number of bounds that would have proved nearly all parts that the last round's
    bounds proved, an eighth of the entries at least; never more than are kept, as bounds that were
    given up are not known again."""
    proven = np.cumsum(uses[:b]) >= PROVEN * uses[:b].sum()
    return max(1, min(b, max(int(proven.argmax()) + 1, k // 8)))


def compress(
    vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS
) -> tuple[DataFrame, Codebooks | None]:
    """Codes of ``vectors`` (vec_id, embedding, label; other columns are ignored), and the codebooks.

    One row per row whose vector is not null and holds finite components only: vec_id, label, codes
    (a byte a part, two for more than 256 entries; None below), error (squared distance of the
    integers to what the codes stand for). Vectors of another length than that of the smallest
    vec_id, those with integers beyond 2**24, and all if the length is no multiple of ``parts`` keep
    their row, with null codes and error. Equal vec_ids are rows of their own. Fewer vectors than ``entries`` give as many
    entries. Without any vector that can be coded there are no codebooks.
    """
    whole = whole_vectors(vectors)
    no_code = [F.lit(None).cast("binary").alias("codes"), F.lit(None).cast("long").alias("error")]
    books = _seeds(whole, parts, entries)
    if books is None:
        return whole.select("vec_id", "label", *no_code), None
    k, m = books.shape[1:]
    fits = F.octet_length("ints") == parts * m * 8
    b = max(1, k // 4)
    state = stored(whole.where(fits).mapInArrow(_assigner(books, None, b, b), _STATE), "codes")
    for done in range(rounds):
        fresh, uses = _next_books(state, books, b)
        moved = np.sqrt(_squares(fresh, books))
        # After the first assignment nothing is known about the bounds yet.
        kept = _adapted(uses, k, b) if done else b
        following = stored(state.mapInArrow(_assigner(fresh, moved, b, kept), _STATE), "codes")
        discard(state)
        state, books, b = following, fresh, kept
    rest = whole.where(~fits).select("vec_id", "label", *no_code)
    return state.select("vec_id", "label", "codes", "error").unionAll(rest), Codebooks(books)


def with_label_errors(codes: DataFrame) -> DataFrame:
    """``codes`` and label_error, the sum of the errors of all rows with the same label (nulls
    together); null beyond 64 bits. The sums are stored, so that their size decides how they are joined."""
    sums = stored(codes.groupBy(F.col("label").alias("_of")).agg(F.try_sum("error").alias("label_error")), "label-errors")
    return codes.join(sums, F.col("label").eqNullSafe(F.col("_of")), "left").drop("_of")
