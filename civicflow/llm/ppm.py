"""Prediction by partial matching: byte contexts, escapes, exclusion; trained on the corpus.

A gram is a symbol with the ORDER symbols before it. A symbol unseen in a context costs an escape
(as many as the context has distinct symbols, method C) to the next shorter one, where symbols of
the longer context are excluded; below the empty context all remaining symbols are equally likely.
The probability of a symbol depends on its gram alone, so the model is a table of all grams of all
texts, made by Spark and never held by one process: no context is left out.

Units of documents (units.py) send their distinct grams, with the counts of training texts, to
buckets that sum them. Grams of order k are those of order k + 1 without their first symbol. The
table is computed from order 0 upwards; an order takes its parents' rows from the one before, and
all grams that share a parent context meet in one task (at most 257 rows above and 257 * 257
below, whatever the input). The buckets then answer the units with the probability of each gram.

The plain counting score (``base_score``) takes the training count of each word. Units send their
distinct words to buckets in the same way and get the global counts back.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from civicflow.llm import units as U
from civicflow.llm.components import stored
from civicflow.llm.words import BASES, mix, word_hashes

ORDER = 5
END = 256
SYMBOLS = 257
BITS = 9
# Positions worked on at once, and grams of a task that computes their probabilities.
PIECE = 1 << 20
TASK_GRAMS = 1 << 16
# Units whose grams one bucket takes.
BUCKET_UNITS = 4

_LOWER = np.arange(256, dtype=np.uint16)
_LOWER[ord("A") : ord("Z") + 1] += 32
_SENT = "grams boolean, bucket int, unit int, first binary, second binary, counts binary, tokens long"
_REPLY = "unit int, bucket int, counts binary, logs binary, distinct long, tokens long"
_LEVEL = "gram long, n long, low double, total long, distinct long"
_LAST = "bucket int, gram long, logp float"


def stream(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Symbols of some texts, lower-cased, each with its end; where each one's end stands."""
    data = np.frombuffer(b"".join(t + b"\0" for t in texts), np.uint8)
    symbols = _LOWER[data]
    ends = np.cumsum([len(t) + 1 for t in texts], dtype=np.int64) - 1
    symbols[ends] = END
    return symbols, ends


def _grams(symbols: np.ndarray, ends: np.ndarray, start: int, stop: int) -> np.ndarray:
    """Symbols from ``start`` to ``stop``, each with the ORDER symbols before it; places before a
    text's start are END."""
    n, have = stop - start, min(start, ORDER)
    padded = np.full(ORDER + n, END, np.uint64)
    padded[ORDER - have :] = symbols[start - have : stop]
    out = padded[ORDER:].copy()
    for back in range(1, ORDER + 1):
        out |= padded[ORDER - back : ORDER - back + n] << np.uint64(BITS * back)
    # The first symbols of a text would see the text before it.
    begin = np.concatenate([[0], ends[:-1] + 1])
    lo, hi = np.searchsorted(begin, [start - ORDER + 2, stop])
    begin, ends = begin[lo:hi], ends[lo:hi]
    for k in range(ORDER - 1):
        at = begin[ends - begin >= k] + k
        at = at[(at >= start) & (at < stop)] - start
        for back in range(k + 2, ORDER + 1):
            field = np.uint64(((1 << BITS) - 1) << (BITS * back))
            out[at] = out[at] & ~field | np.uint64(END << (BITS * back))
    return out


def _pieces(texts: list[bytes]):
    """Grams of some texts in order, a piece at a time."""
    symbols, ends = stream(texts)
    for start in range(0, len(symbols), PIECE):
        yield _grams(symbols, ends, start, min(start + PIECE, len(symbols)))


def _count(texts: list[bytes], learn: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct grams of all texts, ascending, and how often each is in those to learn from."""
    grams, counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    for flag in (True, False):
        for found in _pieces([t for t, x in zip(texts, learn) if x == flag]):
            found.sort()
            at = np.flatnonzero(np.append(True, found[1:] != found[:-1]))
            number = np.diff(np.append(at, len(found))) * flag
            both = np.concatenate([grams, found[at]])
            order, first = U.grouped(both)
            counts = np.add.reduceat(np.concatenate([counts, number])[order], first)
            grams = both[order][first]
    return grams, counts


def _dealt(grams: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """An order of ascending grams by bucket, ascending in each, and where the buckets start in it.
    Grams that begin with the same three symbols stay together, which keeps their differences small."""
    bucket = mix(grams >> np.uint64(BITS * 3)) % np.uint64(buckets)
    order = np.argsort(bucket, kind="stable")
    return order, np.searchsorted(bucket[order], np.arange(buckets + 1, dtype=np.uint64))


class Lookup:
    """A value for each of some distinct ascending grams; only these are ever asked for."""

    def __init__(self, grams: np.ndarray, values: np.ndarray):
        self.grams, self.values = grams, values
        bits = min(22, max(10, int(len(grams) * 16).bit_length()))
        self.shift = np.uint64(64 - bits)
        slots = self._slots(grams)
        self.table = np.empty(1 << bits, np.float32)
        self.table[slots] = values
        # Slots of several grams are left to a search.
        self.table[np.bincount(slots, minlength=1 << bits) > 1] = np.nan

    def _slots(self, grams: np.ndarray) -> np.ndarray:
        return (grams * np.uint64(BASES[0]) >> self.shift).astype(np.int64)

    def __call__(self, grams: np.ndarray) -> np.ndarray:
        out = self.table[self._slots(grams)]
        rest = np.flatnonzero(np.isnan(out))
        out[rest] = self.values[np.searchsorted(self.grams, grams[rest])]
        return out


def _level(order: int, buckets: int):
    """Log probabilities of all grams of one order from counts and the order below."""

    def extend(above: pa.Table | None, rows: pa.Table) -> pa.Table:
        gram, n = (rows.column(c).to_numpy() for c in ("gram", "n"))
        by = np.argsort(gram)
        gram, n = gram[by], n[by]
        known = n > 0
        first = np.flatnonzero(np.append(True, np.diff(gram >> BITS) != 0)[: len(gram)])
        size = np.diff(np.append(first, len(gram)))

        def per_context(values: np.ndarray) -> np.ndarray:
            return np.repeat(np.add.reduceat(values, first), size) if len(first) else values

        total, distinct = per_context(n), per_context(known.astype(np.int64))
        if above is None:
            low = -np.log(np.maximum(1, SYMBOLS - distinct))
        else:
            parents = above.column("gram").to_numpy()
            by = np.argsort(parents)
            at = by[np.searchsorted(parents, gram & ((1 << BITS * order) - 1), sorter=by)]
            n_above, low_above, total_above, distinct_above = (
                above.column(c).to_numpy()[at] for c in ("n", "low", "total", "distinct")
            )
            # What the parent context has besides the symbols of this one.
            d = distinct_above - distinct
            t = total_above - per_context(np.where(known, n_above, 0))
            found = (n_above > 0) & ~known
            low = np.where(found, np.log(np.maximum(n_above, 1)), low_above + np.log(np.maximum(d, 1)))
            low -= np.log(np.maximum(t + d, 1))
        if order < ORDER:
            columns = [gram, n, low, total, distinct]
            return pa.table({c: pa.array(v) for c, v in zip(("gram", "n", "low", "total", "distinct"), columns)})
        escape = np.log(np.maximum(distinct, 1)) + low
        logp = np.where(known, np.log(np.maximum(n, 1)), escape) - np.log(np.maximum(total + distinct, 1))
        by, edges = _dealt(gram.view(np.uint64), buckets)
        bucket = np.repeat(np.arange(buckets, dtype=np.int32), np.diff(edges))
        columns = [bucket, gram[by], logp[by].astype(np.float32)]
        return pa.table({c: pa.array(v) for c, v in zip(("bucket", "gram", "logp"), columns)})

    return extend if order else lambda rows: extend(None, rows)


def _probabilities(grams: DataFrame, buckets: int) -> DataFrame:
    """(bucket, gram, logp) of all ``grams`` (gram, n): distinct ones with their training counts."""
    orders = F.explode(F.array([F.lit(k) for k in range(ORDER + 1)])).alias("order")
    counts = grams.select("gram", "n", orders)
    counts = counts.select("order", F.expr(f"gram & (shiftleft(1L, {BITS} * (order + 1)) - 1)").alias("gram"), "n")
    counts = stored(counts.groupBy("order", "gram").agg(F.sum("n").alias("n")), "contexts")
    sizes = {r.order: r["count"] for r in counts.groupBy("order").count().collect()}
    table = counts.where("order = 0").groupBy("order").applyInArrow(_level(0, buckets), _LEVEL)
    for k in range(1, ORDER + 1):
        tasks = sizes.get(k, 0) // TASK_GRAMS + 1
        # The parent context: all but the first symbol of the context, and not the symbol itself.
        of_parent = f"pmod(xxhash64(shiftright(gram, {BITS}) & {(1 << BITS * (k - 1)) - 1}L), {tasks})"
        above = table.withColumn("task", F.expr(of_parent)).groupBy("task")
        rows = counts.where(f"order = {k}").withColumn("task", F.expr(of_parent)).groupBy("task")
        table = above.cogroup(rows).applyInArrow(_level(k, buckets), _LEVEL if k < ORDER else _LAST)
    return table


class _Unit:
    """Words of one unit, and its distinct words in ascending order of their hashes."""

    def __init__(self, table: pa.Table):
        self.texts = [(t or "").encode() for t in table.column("text").to_pylist()]
        self.counts, first, second = word_hashes(self.texts, BASES[:2], lower=True)
        second >>= np.uint64(32)
        self.order, self.group = U.grouped(first, second)
        lead = self.order[self.group]
        self.first, self.second = first[lead], second[lead]

    def each(self, values: np.ndarray) -> np.ndarray:
        """A value per distinct word, dealt to all words in the order of the texts."""
        out = np.empty(len(self.order), values.dtype)
        out[self.order] = np.repeat(values, np.diff(np.append(self.group, len(self.order))))
        return out


def _send(units: int, buckets: int):
    def send(table: pa.Table) -> pa.Table:
        unit, words = table.column("unit")[0].as_py(), _Unit(table)
        learn = np.array(table.column("learn").to_pylist(), bool)
        taught = np.repeat(learn, words.counts)[words.order]
        number = np.add.reduceat(taught.astype(np.int64), words.group) if len(words.group) else np.zeros(0, np.int64)
        edges = U.bucket_edges(words.first, units)
        rows = []
        for b, (s, e) in enumerate(zip(edges[:-1].tolist(), edges[1:].tolist())):
            if e > s:
                data = U.pack_sorted(words.first[s:e]), U.pack_planes(words.second[s:e]), U.pack_planes(number[s:e])
                rows.append((False, b, unit, *data, 0))
        # One row more for the tokens to learn from, ends included.
        rows.append((False, units + unit, unit, None, None, None, int(words.counts[learn].sum() + learn.sum())))
        grams, number = _count(words.texts, learn)
        order, edges = _dealt(grams, buckets)
        grams, number = grams[order], number[order]
        for b, (s, e) in enumerate(zip(edges[:-1].tolist(), edges[1:].tolist())):
            if e > s:
                rows.append((True, b, unit, U.pack_sorted(grams[s:e]), None, U.pack_planes(number[s:e]), 0))
        names = ["grams", "bucket", "unit", "first", "second", "counts", "tokens"]
        types = [pa.bool_(), pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.int64()]
        return pa.table({n: pa.array(c, t) for n, c, t in zip(names, zip(*rows), types)})

    return send


def _sum_grams(table: pa.Table) -> pa.Table:
    """Distinct grams of a bucket, with the sums of their counts."""
    grams, sums = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    for start in range(0, table.num_rows, 16):
        part = table.slice(start, 16)
        grams = np.concatenate([grams, *(U.unpack_sorted(x.as_py()) for x in part.column("first"))])
        number = np.concatenate([sums, *(U.unpack_planes(x.as_py()).astype(np.int64) for x in part.column("counts"))])
        order, first = U.grouped(grams)
        sums = np.add.reduceat(number[order], first)
        grams = grams[order][first]
    return pa.table({"gram": pa.array(grams.view(np.int64)), "n": pa.array(sums)})


def _answer(table: pa.Table, model: pa.Table) -> pa.Table:
    """Log probabilities of the grams that each unit sent, in the order sent."""
    grams = model.column("gram").to_numpy().view(np.uint64)
    order = np.argsort(grams)
    grams, logp = grams[order], model.column("logp").to_numpy()[order]
    rows = []
    for unit, bucket, first in zip(*(table.column(c).to_pylist() for c in ("unit", "bucket", "first"))):
        found = logp[np.searchsorted(grams, U.unpack_sorted(first))]
        rows.append((unit, bucket, None, zstandard.compress(found.tobytes(), 1), 0, 0))
    return _replies(rows)


def _replies(rows: list[tuple]) -> pa.Table:
    names = ["unit", "bucket", "counts", "logs", "distinct", "tokens"]
    types = [pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.int64(), pa.int64()]
    return pa.table({n: pa.array(c, t) for n, c, t in zip(names, zip(*rows) if rows else [()] * 6, types)})


def _sum_words(table: pa.Table) -> pa.Table:
    rows = table.to_pylist()
    if rows[0]["first"] is None:
        replies = [(r["unit"], -1, None, None, 0, r["tokens"]) for r in rows]
    else:
        first = [U.unpack_sorted(r["first"]) for r in rows]
        second = np.concatenate([U.unpack_planes(r["second"]) for r in rows])
        number = np.concatenate([U.unpack_planes(r["counts"]) for r in rows])
        order, group = U.grouped(np.concatenate(first), second)
        sums = np.add.reduceat(number[order], group)
        total = np.empty(len(order), np.uint64)
        total[order] = np.repeat(sums, np.diff(np.append(group, len(order))))
        parts = np.split(total, np.cumsum([len(v) for v in first])[:-1])
        distinct = [int((sums > 0).sum())] + [0] * (len(rows) - 1)
        replies = [(r["unit"], r["bucket"], U.pack_planes(p), None, d, 0) for r, p, d in zip(rows, parts, distinct)]
    return _replies(replies)


def score(docs: DataFrame, learn: Column) -> DataFrame:
    """Scores of all ``docs`` (doc_id, text; other columns are ignored) by models of those rows that
    ``learn`` selects: doc_id, learned, n_tokens, n_known, train_tokens, base_score, score.

    Texts are lower-cased (A-Z) and taken whole; a null text is empty. Tokens are words and one end
    per text. ``score`` is the log10 probability of the text's bytes and its end. Rows with the same
    doc_id or text are scored, and learned from, one by one. Without rows to learn from every symbol
    is equally likely. An empty table gives an empty result.
    """
    docs, units = U.units_for(docs)
    doc_id = F.col("doc_id").cast("long")
    learned = F.coalesce(learn, F.lit(False)).alias("learn")
    rows = docs.select(U.unit_of(doc_id, units).alias("unit"), doc_id.alias("doc_id"), "text", learned)
    by_unit = rows.groupBy("unit")
    buckets = units // BUCKET_UNITS + 1
    sent = stored(by_unit.applyInArrow(_send(units, buckets), _SENT), "sent")
    words, grams = (sent.where(c).groupBy("bucket") for c in ("not grams", "grams"))
    known = stored(words.applyInArrow(_sum_words, _REPLY), "word-counts")
    model = _probabilities(stored(grams.applyInArrow(_sum_grams, "gram long, n long"), "grams"), buckets)
    replies = known.unionAll(grams.cogroup(model.groupBy("bucket")).applyInArrow(_answer, _REPLY))
    totals = known.agg(F.sum("tokens").alias("tokens"), F.sum("distinct").alias("words")).first()
    tokens = totals.tokens or 0
    # The end is one more distinct token where there is anything to learn from.
    places = np.log10(tokens + (totals.words or 0) + (tokens > 0) + 1)
    docs_learned = rows.where("learn").count()

    def finish(table: pa.Table, answers: pa.Table) -> pa.Table:
        words = _Unit(table)
        known = np.zeros(len(words.group), np.uint64)
        edges = U.bucket_edges(words.first, units)
        logs_of = {}
        for r in answers.to_pylist():
            if r["logs"] is not None:
                logs_of[r["bucket"]] = np.frombuffer(zstandard.decompress(r["logs"]), np.float32)
            elif r["counts"] is not None:
                known[edges[r["bucket"]] : edges[r["bucket"] + 1]] = U.unpack_planes(r["counts"])
        each = words.each(known)
        edge = np.concatenate([[0], np.cumsum(words.counts)])
        logs = np.concatenate([[0.0], np.cumsum(np.log10(each.astype(np.float64) + 1))])
        seen = np.concatenate([[0], np.cumsum(each > 0)])
        n = words.counts + 1
        grams, _ = _count(words.texts, np.zeros(len(words.texts), bool))
        order, _ = _dealt(grams, buckets)
        logp = np.empty(len(grams), np.float32)
        logp[order] = np.concatenate([logs_of[b] for b in sorted(logs_of)])
        lookup = Lookup(grams, logp)
        each_gram = np.concatenate([lookup(piece) for piece in _pieces(words.texts)])
        begin = np.concatenate([[0], np.cumsum([len(t) + 1 for t in words.texts])[:-1]])
        scores = np.add.reduceat(each_gram, begin, dtype=np.float64) / np.log(10)
        base = np.diff(logs[edge]) + np.log10(docs_learned + 1) - n * places
        return pa.table(
            {
                "doc_id": table.column("doc_id"),
                "learned": table.column("learn"),
                "n_tokens": pa.array(n),
                "n_known": pa.array(np.diff(seen[edge]) + (docs_learned > 0)),
                "train_tokens": pa.array(np.full(len(n), tokens)),
                "base_score": pa.array(base),
                "score": pa.array(scores),
            }
        )

    return by_unit.cogroup(replies.groupBy("unit")).applyInArrow(
        finish,
        "doc_id long, learned boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double",
    )
