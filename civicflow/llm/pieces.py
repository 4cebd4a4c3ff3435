"""SentencePiece encoding and decoding, with max-plus matrices per chunk for giant documents.

A BPE segmentation is the one sequence of pieces in which every piece, and every pair of neighbours,
is its own segmentation. Finding it is a search for the path of the greatest weight where a pair
that would be segmented otherwise weighs minus infinity and any other nothing, so the path of
weight 0 is the result, and the search splits at any place:

* A document longer than ``CHUNK`` characters is cut into chunks at fixed places. The state at a cut
  is the last piece that ends at or before it, and where it ends; the next piece ends behind it.
* Each chunk gives the matrix of weights from every state at its left to every state at its right.
* Matrices are multiplied in a tree, neighbours first, in rounds that give one matrix a document; its
  ends are known, and each product's states are passed down to the cut between its two factors.
* With the states at both its ends known, each chunk is traced back alone.

Inside a chunk, a path passes every place that no piece of the vocabulary crosses (in front of a
blank behind a letter, for one). Between the first and the last of these places a chunk is encoded
like a short text, by words that are cached; only the rest needs the search. Decoding takes a
document whole.

Short documents are encoded where they are read. Results are those of the sentencepiece library.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civicflow.llm.components import stored
from civicflow.llm.tokens import _Cache, slices

CHUNK = 1 << 15
# Bounds of what a worker remembers.
CACHED_WORDS = 200_000
CACHED_PAIRS = 200_000
BATCH_BYTES = 1 << 20
BLANK = "▁"
# A place in a text and the length of the piece that ends there; length 0 stands for a start.
State = tuple[int, int]


class Pieces:
    """A BPE vocabulary of the sentencepiece library, and what follows from it."""

    def __init__(self, path: str):
        import sentencepiece

        self._library = sentencepiece.SentencePieceProcessor(model_file=path)
        model = self._library
        ids = range(model.get_piece_size())
        plain = [i for i in ids if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i))]
        self.ids = {model.id_to_piece(i): i for i in plain}
        self._score = {model.id_to_piece(i): model.get_score(i) for i in plain}
        self._bytes = {int(model.id_to_piece(i)[1:-1], 16): i for i in ids if model.is_byte(i)}
        self._inside = {pair for piece in self.ids for pair in zip(piece, piece[1:])}
        self.longest = max(map(len, self.ids))
        self._fits: dict[tuple[str, str], bool] = {}
        self._cache = _Cache(self._word, CACHED_WORDS)
        shown = {i: piece.replace(BLANK, " ").encode() for piece, i in self.ids.items()}
        shown |= {i: bytes([b]) for b, i in self._bytes.items()}
        self._shown = [shown.get(i, b"") for i in ids]

    # --- whole texts ---------------------------------------------------------------

    def encode(self, texts: Iterable[str | None]) -> list[np.ndarray]:
        self._cache.age()
        return [np.frombuffer(self._text(text), "<u4") if text else np.zeros(0, "<u4") for text in texts]

    def _text(self, text: str) -> bytes:
        """Words behind single blanks come from the cache; other texts go to the library whole."""
        words = text.replace("\n", " \n").split(" ")
        if "" in words[1:] or (not words[0] and text[0] != "\n"):
            return np.array(self._library.encode(text), "<u4").tobytes()
        return b"".join(map(self._cache.__getitem__, words))

    def _word(self, word: str) -> bytes:
        """A word behind a blank, or one that starts with its line feed."""
        ids = self._library.encode(word) if word else [self.ids[BLANK]]
        # The library puts a blank in front; a line feed keeps it apart.
        return np.array(ids[1:] if word[:1] == "\n" else ids, "<u4").tobytes()

    def decode(self, ids: np.ndarray) -> str:
        text = b"".join(map(self._shown.__getitem__, ids.tolist())).decode("utf-8", "replace")
        return text[1:] if text[:1] == " " else text

    # --- search --------------------------------------------------------------------

    def crossed(self, left: str, right: str) -> bool:
        """Whether some piece has these two characters side by side."""
        return (left, right) in self._inside

    def _merge(self, text: str) -> list[str]:
        parts = list(text)
        while True:
            pairs = [(-self._score[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in self._score]
            if not pairs:
                return parts
            _, i = min(pairs)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]

    def fits(self, left: str, right: str) -> bool:
        """Whether two pieces stay as they are side by side; ``left`` may be empty."""
        if left and not self.crossed(left[-1], right[0]):
            return self.fits("", right)
        key = left, right
        if key not in self._fits:
            if len(self._fits) > CACHED_PAIRS:
                self._fits.clear()
            self._fits[key] = self._merge(left + right) == [p for p in key if p]
        return self._fits[key]

    def ending(self, text: str, end: int, least: int) -> Iterator[int]:
        """Starts, not before ``least``, of the pieces that end at a place."""
        for start in range(max(least, end - self.longest, 0), end):
            if end - start == 1 or text[start:end] in self.ids:
                yield start

    def span_ids(self, text: str) -> list[int]:
        """Ids of one piece; of a character without a piece, its bytes."""
        return [self.ids[text]] if text in self.ids else [self._bytes[b] for b in text.encode()]

    def reach(self, text: str, begin: int, end: int, entries: list[State]) -> dict[State, int]:
        """Which entries (bits) lead to each state that ends in (begin, end]: weight 0 or not."""
        nodes: dict[int, dict[int, int]] = {}
        for bit, (at, length) in enumerate(entries):
            nodes.setdefault(at, {})[length] = nodes.get(at, {}).get(length, 0) | 1 << bit
        least = min((at for at, _ in entries), default=begin)
        for at in range(begin + 1, end + 1):
            for start in self.ending(text, at, least):
                piece, sources = text[start:at], 0
                for length, bits in nodes.get(start, {}).items():
                    if bits & ~sources and self.fits(text[start - length : start], piece):
                        sources |= bits
                if sources:
                    nodes.setdefault(at, {})[at - start] = sources
        return {(at, n): bits for at, found in nodes.items() if at > begin for n, bits in found.items()}

    def trace(self, text: str, begin: int, end: State, entry: State) -> list[int]:
        """Ids of the pieces from an entry to a state."""
        reached = self.reach(text, begin, end[0], [entry])
        reached[entry] = 1
        spans, state = [], end
        while state != entry:
            at, length = state
            start = at - length
            spans.append((start, at))
            piece = text[start:at]
            state = next(
                (start, n)
                for n in range(self.longest + 1)
                if (start, n) in reached and self.fits(text[start - n : start], piece)
            )
        return [i for s, e in reversed(spans) for i in self.span_ids(text[s:e])]


@lru_cache(maxsize=4)
def pieces(path: str) -> Pieces:
    return Pieces(path)


class Chunk:
    """Characters [begin, end) of a document, with a margin before them. Places count from the
    margin's start; a document's first chunk begins with a start and a blank."""

    def __init__(self, vocabulary: Pieces, text: str, margin: int):
        self.vocabulary, self.text, self.begin, self.end = vocabulary, text.replace(" ", BLANK), margin, len(text)
        free = (at for at in range(margin, self.end + 1) if self._free(at))
        self.first = next(free, None)
        # Not so near the end that the state there would be one of the chunk's own exits.
        self.last = next((at for at in range(self.end - vocabulary.longest, margin, -1) if self._free(at)), None)
        if self.last is None or self.first is None or self.first >= self.last:
            self.first = self.last = None

    def _free(self, at: int) -> bool:
        """Whether every path passes this place, and what follows does not depend on what was."""
        return 0 < at < self.end and not self.vocabulary.crossed(self.text[at - 1], self.text[at])

    def entries(self) -> list[State]:
        """States at the left: pieces that end there or at most a piece's length before."""
        v = self.vocabulary
        if not self.begin:
            return [(0, 0)]
        ends = range(max(1, self.begin - v.longest + 1), self.begin + 1)
        return [(at, at - start) for at in ends for start in v.ending(self.text, at, 0)]

    def _exits(self, states: dict[State, int]) -> dict[State, int]:
        return {s: bits for s, bits in states.items() if s[0] > self.end - self.vocabulary.longest}

    def matrix(self) -> dict[State, int]:
        """States at the right, each with the entries (bits) it is reached from at weight 0."""
        v, entries = self.vocabulary, self.entries()
        if self.first is None:
            return self._exits(v.reach(self.text, self.begin, self.end, entries))
        if self.first > self.begin:
            left = v.reach(self.text, self.begin, self.first, entries)
            sources = [bits for (at, _), bits in left.items() if at == self.first]
        else:
            sources = [1 << bit for bit, (at, _) in enumerate(entries) if at == self.first]
        through = 0
        for bits in sources:
            through |= bits
        right = v.reach(self.text, self.last, self.end, [(self.last, 0)])
        return self._exits(dict.fromkeys(right, through)) if through else {}

    def ids(self, entry: State, exit_state: State) -> np.ndarray:
        """Ids of the pieces behind ``entry`` up to ``exit_state``."""
        v = self.vocabulary
        if self.first is None:
            return np.array(v.trace(self.text, self.begin, exit_state, entry), "<u4")
        out = []
        if entry[0] < self.first:
            left = v.reach(self.text, self.begin, self.first, [entry])
            end = next(s for s in left if s[0] == self.first)
            out += v.trace(self.text, self.begin, end, entry)
        middle = self.text[self.first : self.last].replace(BLANK, " ")
        if middle[:1] == " ":
            inner = v.encode([middle[1:]])[0] if len(middle) > 1 else np.array([v.ids[BLANK]], "<u4")
        else:
            # In front of a line feed the library's own blank stays apart, and so does the feed.
            inner = v.encode(["\n" + middle])[0][2:]
        tail = v.trace(self.text, self.last, exit_state, (self.last, 0))
        return np.concatenate([np.array(out, "<u4"), inner, np.array(tail, "<u4")])


def _cut(text: str, margin: int) -> Iterator[tuple[int, str, int]]:
    """Chunks of a long text: number, characters with the margin before them, and its length."""
    text = " " + text
    for number, begin in enumerate(range(0, len(text), CHUNK)):
        before = min(begin, margin)
        yield number, text[begin - before : begin + CHUNK], before


@dataclass(frozen=True)
class Matrix:
    """Weights of a stretch of chunks: 0 from the entries (bits) that an exit stands with, minus
    infinity from all others. States are places relative to the stretch's begin (entries) and end
    (exits), so they match from one stretch to the next."""

    entries: list[State]
    exits: dict[State, int]

    def times(self, right: Matrix) -> Matrix:
        """The matrix of both stretches; the product is associative."""
        number = {e: 1 << i for i, e in enumerate(right.entries)}
        exits = {}
        for state, sources in right.exits.items():
            bits = 0
            for middle, own in self.exits.items():
                if sources & number.get(middle, 0):
                    bits |= own
            if bits:
                exits[state] = bits
        return Matrix(self.entries, exits)

    def middle(self, right: Matrix, entry: State, last: State) -> State | None:
        """The state between both stretches on the way from ``entry`` to ``last``, if there is one."""
        bit = 1 << self.entries.index(entry)
        wanted = right.exits[last]
        found = [e for i, e in enumerate(right.entries) if wanted >> i & 1 and self.exits.get(e, 0) & bit]
        return found[0] if len(found) == 1 else None

    def flat(self) -> dict[str, bytes]:
        size = (len(self.entries) + 7) // 8
        weights = b"".join(bits.to_bytes(size, "little") for bits in self.exits.values())
        return {"entries": _flat(self.entries), "exits": _flat(self.exits), "weights": weights}

    @staticmethod
    def of(row: dict) -> Matrix:
        entries, exits = _states(row["entries"]), _states(row["exits"])
        size = (len(entries) + 7) // 8
        bits = [int.from_bytes(row["weights"][i * size : (i + 1) * size], "little") for i in range(len(exits))]
        return Matrix(entries, dict(zip(exits, bits)))


_MATRIX = "row binary, node int, entries binary, exits binary, weights binary"
_ENDS = "row binary, node int, ends binary"


def _product(table: pa.Table) -> pa.Table:
    """The matrix of a node from those of its two children, or of its only one."""
    rows = sorted(table.to_pylist(), key=lambda r: r["node"])
    found = reduce(Matrix.times, map(Matrix.of, rows))
    columns = {"row": rows[0]["row"], "node": rows[0]["node"] // 2} | found.flat()
    return pa.table({name: pa.array([value], _kind(name)) for name, value in columns.items()})


def _root_ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """States at both ends of whole documents: the start, and the state that ends where the text does."""
    for batch in batches:
        rows = batch.to_pylist()
        ends = []
        for row in rows:
            whole = Matrix.of(row)
            last = [s for s, bits in whole.exits.items() if s[0] == 0 and bits & 1]
            ends.append(_flat([whole.entries[0], last[0]]) if len(last) == 1 else None)
        columns = [batch.column("row"), batch.column("node"), pa.array(ends, pa.binary())]
        yield pa.record_batch(columns, names=["row", "node", "ends"])


def _child_ends(table: pa.Table) -> pa.Table:
    """States at both ends of a node's children; none where the state between them is not unique."""
    rows = sorted(table.to_pylist(), key=lambda r: r["node"])
    ends = _states(rows[0]["ends"]) if rows[0]["ends"] else None
    if ends and len(rows) == 2:
        between = Matrix.of(rows[0]).middle(Matrix.of(rows[1]), *ends)
        pairs = [(ends[0], between), (between, ends[1])] if between else [None, None]
    else:
        pairs = [ends] * len(rows)
    columns = {
        "row": [r["row"] for r in rows],
        "node": [r["node"] for r in rows],
        "ends": [_flat(pair) if pair else None for pair in pairs],
    }
    return pa.table({name: pa.array(values, _kind(name)) for name, values in columns.items()})


def _kind(name: str) -> pa.DataType:
    return pa.int32() if name == "node" else pa.binary()


def states_at_cuts(matrices: DataFrame) -> DataFrame:
    """(row, node, ends) of every chunk: the states at its two ends, of ``matrices`` of chunks.

    A scan over a binary tree: rounds of products of neighbours up to one matrix a document, then
    the states at its ends passed down again. No task sees more than two matrices of a document, and
    a document of n chunks takes log2(n) rounds each way.
    """
    levels = [stored(matrices, "matrices")]
    while not levels[-1].where("node > 0").isEmpty():
        pairs = levels[-1].groupBy("row", F.expr("node div 2"))
        levels.append(stored(pairs.applyInArrow(_product, _MATRIX), "matrices"))
    ends = stored(levels[-1].mapInArrow(_root_ends, _ENDS), "ends")
    for level in reversed(levels[:-1]):
        above = ends.select("row", F.col("node").alias("above"), "ends")
        children = level.withColumn("above", F.expr("cast(node div 2 as int)")).join(above, ["row", "above"])
        children = children.groupBy("row", "above").applyInArrow(_child_ends, _ENDS)
        ends = stored(children, "ends")
    return ends


def _shift(states: Iterable[State], by: int) -> list[State]:
    return [(at - by, length) for at, length in states]


def _rows(batches: Iterable[pa.RecordBatch], column: str) -> Iterator[dict]:
    """Rows with a long text, some at a time."""
    for batch in batches:
        for part in slices(batch, batch.schema.get_field_index(column), BATCH_BYTES):
            yield from part.to_pylist()


def encode(docs: DataFrame, model: str) -> DataFrame:
    """Ids of ``docs`` (doc_id, text; other columns are ignored): one row per row, doc_id and ids
    (unsigned 32 bits, little-endian).

    A null or empty text has no ids. Rows with the same or no doc_id stay rows of their own. An
    empty table gives an empty result. ``docs`` is read several times and should be a table.
    """
    docs = docs.select(F.col("doc_id").cast("long"), "text")
    long = F.char_length("text") > CHUNK
    out = "doc_id long, ids binary"

    def short_texts(batches):
        for batch in batches:
            for part in slices(batch, 1, BATCH_BYTES):
                found = [x.tobytes() for x in pieces(model).encode(part.column(1).to_pylist())]
                yield pa.record_batch([part.column(0), pa.array(found, pa.binary())], names=["doc_id", "ids"])

    def cut(batches):
        for row in _rows(batches, "text"):
            parts = list(_cut(row["text"], 2 * pieces(model).longest))
            columns = [
                pa.array([row["doc_id"]] * len(parts), pa.int64()),
                pa.array([row["row"]] * len(parts), pa.binary()),
                *(pa.array(c, t) for c, t in zip(zip(*parts), (pa.int32(), pa.string(), pa.int32()))),
            ]
            yield pa.record_batch(columns, names=["doc_id", "row", "chunk", "part", "margin"])

    def weigh(batches):
        for row in _rows(batches, "part"):
            chunk = Chunk(pieces(model), row["part"], row["margin"])
            exits = chunk.matrix()
            right = dict(zip(_shift(exits, chunk.end), exits.values()))
            columns = {"row": row["row"], "node": row["chunk"]}
            columns |= Matrix(_shift(chunk.entries(), chunk.begin), right).flat()
            yield pa.record_batch([pa.array([v], _kind(c)) for c, v in columns.items()], names=list(columns))

    def trace(batches):
        for row in _rows(batches, "part"):
            chunk = Chunk(pieces(model), row["part"], row["margin"])
            (entry,), (last,) = (_shift([s], -by) for s, by in zip(_states(row["ends"]), (chunk.begin, chunk.end)))
            ids = chunk.ids(entry, last).tobytes()
            columns = [[row["doc_id"]], [row["row"]], [row["chunk"]], [ids]]
            kinds = [pa.int64(), pa.binary(), pa.int32(), pa.binary()]
            yield pa.record_batch(
                [pa.array(c, t) for c, t in zip(columns, kinds)], names=["doc_id", "row", "chunk", "ids"]
            )

    def join(table: pa.Table) -> pa.Table:
        table = table.sort_by("chunk")
        ids = b"".join(table.column("ids").to_pylist())
        copies = table.column("copies")[0].as_py()
        return pa.table(
            {
                "doc_id": pa.array([table.column("doc_id")[0].as_py()] * copies, pa.int64()),
                "ids": pa.array([ids] * copies, pa.binary()),
            }
        )

    # Long rows are told apart by id and text; equal ones are worked on once and counted.
    key = F.unhex(F.sha2(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("-")), F.lit(":"), "text"), 256))
    rows = docs.where(long).withColumn("row", key)
    copies = rows.groupBy("row").agg(F.count("*").cast("int").alias("copies"))
    chunks = rows.dropDuplicates(["row"]).mapInArrow(
        cut, "doc_id long, row binary, chunk int, part string, margin int"
    )
    chunks = chunks.repartition("row", "chunk")
    ends = states_at_cuts(chunks.mapInArrow(weigh, _MATRIX)).withColumnRenamed("node", "chunk")
    traced = chunks.join(ends.where("ends is not null"), ["row", "chunk"]).select("doc_id", "row", "chunk", "part", "margin", "ends")
    traced = traced.mapInArrow(trace, "doc_id long, row binary, chunk int, ids binary").join(copies, "row")
    joined = traced.groupBy("row").applyInArrow(join, out)
    # Should a cut ever leave a choice (it does not where no two pieces have the same score and
    # letters), the document is encoded whole.
    open_rows = rows.join(ends.where("ends is null").select("row").distinct(), "row", "left_semi")
    short = docs.where(~F.coalesce(long, F.lit(False))).unionAll(open_rows.select("doc_id", "text"))
    return short.mapInArrow(short_texts, out).unionAll(joined)


def _flat(states: Iterable[State]) -> bytes:
    return np.array(list(states), "<i4").tobytes()


def _states(data: bytes) -> list[State]:
    return [tuple(s) for s in np.frombuffer(data, "<i4").reshape(-1, 2).tolist()]


def decode(ids: DataFrame, model: str) -> DataFrame:
    """Texts of ``ids`` (doc_id, ids): doc_id, ids, text. Null ids are an empty text."""

    def work(batches):
        for batch in batches:
            for part in slices(batch, 1, BATCH_BYTES):
                vocabulary = pieces(model)
                texts = [vocabulary.decode(np.frombuffer(x or b"", "<u4")) for x in part.column(1).to_pylist()]
                yield pa.record_batch([*part.columns, pa.array(texts, pa.string())], names=["doc_id", "ids", "text"])

    return ids.select("doc_id", "ids").mapInArrow(work, "doc_id long, ids binary, text string")
