"""Token ids of whole texts inside a task, with a cache of pieces that stand between blanks.

Both pre-tokenizers used here never join a character to a following blank, so a text may be cut
in front of every run of white space and the pieces encoded alone. Pieces repeat much more often
than texts do; each is encoded once per worker and found again in a bounded cache.
"""

from __future__ import annotations

import ctypes
import re
import struct
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_RUNS = re.compile(r"\s*\S+|\s+")
# A word, with a line feed before and marks behind it: three pre-tokens at most, of which the
# word needs the model alone and the others are few.
_WORD = re.compile(r"(\n?)([A-Za-zÀ-ÖØ-öø-ÿ]+)([!-&(-/:-@\[-`{-~]{0,4})")
# Marks that are never one token with the letters before them; an apostrophe may be.
_MARKS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"
CACHED_PIECES = 650_000
BATCH_BYTES = 1 << 22
# Encoded at a time: the more, the fewer different pieces there are to look up for each text.
ENCODED_BYTES = 1 << 23
# Only glibc has it, and only glibc needs it.
_TRIM = getattr(ctypes.CDLL(None), "malloc_trim", None)


def _shown_bytes() -> dict[int, str]:
    """How byte-level vocabularies show each byte: printable ones as themselves, the others, in
    order, as the characters from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


_SHOWN = _shown_bytes()


class _Odd(Exception):
    """White space that may belong to the same token as the white space in front of it."""


class _Cache(dict):
    """Ids of pieces, in two generations: the older one goes when the younger is full. With ``marks``
    a word with marks behind it is not kept, but put together from the word and the marks."""

    def __init__(self, encode, limit: int = CACHED_PIECES, marks=None):
        super().__init__()
        self._encode = encode
        self._limit = limit
        self._marks = marks
        self._old: dict[str, bytes] = {}

    def __missing__(self, piece: str) -> bytes:
        ids = self._old.get(piece)
        if ids is None:
            if self._marks:
                word = piece.rstrip(_MARKS)
                if 0 < len(piece) - len(word) < 5 and word.isascii() and word.isalpha():
                    return self[word] + self._marks(piece[len(word) :])
            ids = self._encode(piece)
        self[piece] = ids
        return ids

    def age(self) -> None:
        if len(self) > self._limit:
            self._old = dict(self)
            self.clear()


class Encoder:
    """Ids of texts by a ``tokenizers`` file, as numbers of ``dtype``.

    Strings of special tokens in a text are ordinary text. The cache holds at most twice
    ``cached`` pieces.
    """

    def __init__(self, path: str, cached: int = CACHED_PIECES):
        from tokenizers import Tokenizer

        self._plain = Tokenizer.from_file(path)
        self._plain.encode_special_tokens = True
        size = self._plain.get_vocab_size(with_added_tokens=True)
        self.dtype = np.dtype("<u2") if size <= 2**16 else np.dtype("<u4")
        self._format = "H" if size <= 2**16 else "I"
        normalizer = self._plain.normalizer
        self._lower = normalizer is not None and normalizer.normalize_str("A") == "a"
        self._blank = self._plain.pre_tokenizer.pre_tokenize_str(" a")[0][0] != "a"
        self._model = self._plain.model
        self._known_marks = {"": b"", "\n": self._ids("\n")}
        self._cache = _Cache(self._piece, cached, self._marks)

    def _marks(self, marks: str) -> bytes:
        if marks not in self._known_marks:
            self._known_marks[marks] = self._ids(marks)
        return self._known_marks[marks]

    def encode(self, texts: pa.Array, end: int) -> tuple[np.ndarray, np.ndarray]:
        """All ids of some texts, each followed by ``end``, and the number of ids of each."""
        self._cache.age()
        texts = pc.fill_null(texts.cast(pa.string()), "")
        lists = pc.split_pattern(pc.binary_join_element_wise("\0", pc.replace_substring(texts, "\n", " \n"), ""), " ")
        found = lists.flatten().dictionary_encode()
        which = found.indices.to_numpy()
        first = lists.offsets.to_numpy()[:-1]
        words = found.dictionary.to_numpy(zero_copy_only=False)
        ids, odd = [], np.zeros(len(words) + 1, bool)
        inner = np.ones(len(which), bool)
        inner[first] = False
        for i, word in enumerate(words):
            try:
                ids.append(self._cache[word])
            except _Odd:
                ids.append(b"")
                odd[i] = True
        odd_at = odd[which]
        # A NUL marks the start of a text; one that the text itself has there is odd elsewhere.
        marked = pc.starts_with(found.dictionary, "\0").to_numpy(zero_copy_only=False)
        if marked.sum() and (inner & marked[which]).any():
            odd_at |= inner & marked[which]
        width = self.dtype.itemsize
        pool = np.frombuffer(b"".join(ids), self.dtype)
        size = np.fromiter(map(len, ids), np.int64, len(ids)) // width
        begin = np.cumsum(size) - size
        sizes = size[which]
        counts = np.add.reduceat(sizes, first) + 1 if len(first) else np.zeros(0, np.int64)
        out = np.full(int(counts.sum()), end, self.dtype)
        # Where each piece goes: behind the pieces before it and the ends of the texts before.
        past = np.cumsum(sizes) - sizes
        put = np.ones(len(out), bool)
        put[np.cumsum(counts) - 1] = False
        out[put] = pool[np.repeat(begin[which] - past, sizes) + np.arange(int(sizes.sum()))]
        if not odd_at.any():
            return out, counts
        parts = np.split(out, np.cumsum(counts)[:-1])
        for i in np.unique(np.searchsorted(first, np.flatnonzero(odd_at), "right") - 1).tolist():
            whole = b"".join([self._cache["\0" + piece] for piece in _RUNS.findall(texts[i].as_py())])
            parts[i] = np.append(np.frombuffer(whole, self.dtype), np.array(end, self.dtype))
            counts[i] = len(parts[i])
        return np.concatenate(parts), counts

    def _ids(self, text: str) -> bytes:
        ids = self._plain.encode_batch_fast([text], add_special_tokens=False)[0].ids
        return np.array(ids, self.dtype).tobytes()

    def _word(self, text: str, blank: bool) -> bytes:
        """A word alone, with a blank in front of it where the model joins the two."""
        if self._lower:
            text = text.lower()
        if not text.isascii():
            text = text.encode().decode("latin-1").translate(_SHOWN)
        ids = [token.id for token in self._model.tokenize("Ġ" + text if self._blank and blank else text)]
        return struct.pack(f"<{len(ids)}{self._format}", *ids)

    def _piece(self, piece: str) -> bytes:
        """A piece behind one blank, one that starts with its line feed, or one behind a NUL."""
        if piece.isascii() and piece.isalpha():
            return self._word(piece, True)
        if word := _WORD.fullmatch(piece):
            line, text, marks = word.groups()
            return self._marks(line) + self._word(text, not line) + self._marks(marks)
        if piece[:1] == "\0":
            return self._ids(piece[1:])
        if piece[:1] == "\n" and len(piece) > 1:
            return self._ids(piece)
        if piece[:1].isspace() or not piece:
            raise _Odd
        return self._ids(" " + piece)


@lru_cache(maxsize=4)
def encoder(path: str, cached: int = CACHED_PIECES) -> Encoder:
    """One encoder per file and Python worker."""
    return Encoder(path, cached)


def encoded(
    batches: Iterable[pa.RecordBatch], path: str, end: int, size: int = ENCODED_BYTES, cached: int = CACHED_PIECES
) -> Iterator[tuple[list, np.ndarray, np.ndarray]]:
    """Of batches (doc_id, text): ids of documents, all their token ids, the number of each.

    ``size`` and ``cached`` trade memory for time.
    """
    enc = encoder(path, cached)
    for batch in batches:
        for part in slices(batch, 1, size):
            yield part.column(0).to_pylist(), *enc.encode(part.column(1), end)


def release() -> None:
    """Give freed memory back to the system: workers are reused, and what this and earlier tasks freed
    would stay theirs beside what is held now."""
    pa.default_memory_pool().release_unused()
    if _TRIM:
        _TRIM(0)


def slices(batch: pa.RecordBatch, column: int, size: int = BATCH_BYTES) -> Iterator[pa.RecordBatch]:
    """A batch in parts of about ``size`` bytes of one column, or one longer value."""
    lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    number = np.cumsum(lengths) // size
    edges = np.concatenate([[0], np.flatnonzero(number[1:] != number[:-1]) + 1, [len(number)]])
    for start, end in zip(edges[:-1].tolist(), edges[1:].tolist()):
        if end > start:
            yield batch.slice(start, end - start)
