"""Words of many texts at once, as 64-bit hashes computed on the bytes with numpy.

A word is a run of characters other than U+0020 and U+0009 to U+000D. All arithmetic is modulo
2**64; a hash is a polynomial in a fixed odd base, made relative to the word's own start and mixed.
"""

from __future__ import annotations

import sys
from collections.abc import Iterable

import numpy as np

BATCH_BYTES = 1 << 20
# Fixed odd bases, and the two multipliers of the mixing step.
BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F)
MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))

_BLANK = np.zeros(256, bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every bit of a 64-bit value over all others (a bijection)."""
    x = (x ^ (x >> np.uint64(30))) * MIX[0]
    x = (x ^ (x >> np.uint64(27))) * MIX[1]
    return x ^ (x >> np.uint64(31))


# For each base, its powers and those of its inverse, as many as were needed so far.
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(base: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    if base not in _POWERS or len(_POWERS[base][0]) < size:
        out = []
        for b in (base, pow(base, -1, 1 << 64)):
            powers = np.full((size >> 16) + 1 << 16, b, np.uint64)
            powers[0] = 1
            out.append(np.multiply.accumulate(powers, out=powers))
        _POWERS[base] = out[0], out[1]
    return _POWERS[base]


def _spans(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int) -> np.ndarray:
    """Hash of each span of ``values``, wherever it stands."""
    up, down = _powers(base, len(values))
    past = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values * up[: len(values)])])
    return mix((past[ends] - past[starts]) * down[starts])


def windows(hashes: np.ndarray, size: int, base: int = BASES[2]) -> np.ndarray:
    """Hash of every run of ``size`` consecutive hashes; value i is that of the run from i on."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    starts = np.arange(n)
    return _spans(hashes, starts, starts + size, base)


def _pieces(texts: Iterable[bytes]) -> Iterable[list[tuple[int, bytes]]]:
    """Batches of (text number, part of it); texts are cut in front of a blank only."""
    batch, size = [], 0
    for i, text in enumerate(texts):
        at = 0
        while len(text) - at > BATCH_BYTES:
            end = at + BATCH_BYTES
            while end < len(text) and not _BLANK[text[end]]:
                end += 1
            yield [(i, text[at:end])]
            at = end
        part = text[at:] if at else text
        if size + len(part) > BATCH_BYTES and batch:
            yield batch
            batch, size = [], 0
        batch.append((i, part))
        size += len(part)
    if batch:
        yield batch


def _make_room() -> None:
    """Workers are reused: piece caches of tokenizing tasks before this one go."""
    for name, cache in (("tokens", "encoder"), ("pieces", "pieces")):
        if module := sys.modules.get(f"{__package__}.{name}"):
            getattr(module, cache).cache_clear()


def word_hashes(
    texts: list[bytes],
    bases: tuple[int, ...] = BASES[:1],
    lower: bool = False,
    between: np.ndarray = _BLANK,
    longest: int | None = None,
) -> tuple[np.ndarray, ...]:
    """How many words each text has, and for each base the hashes of all words in order.

    ``between`` says for each byte whether it parts words (white space always should). ``longest``
    takes the first bytes of longer words only.
    """
    _make_room()
    counts = np.zeros(len(texts), np.int64)
    found: list[list[np.ndarray]] = [[np.zeros(0, np.uint64)] for _ in bases]
    for batch in _pieces(texts):
        data = np.frombuffer(b" ".join([part for _, part in batch]), np.uint8)
        if lower:
            data = _LOWER[data]
        inside = np.concatenate([[False], ~between[data], [False]])
        edges = np.flatnonzero(inside[1:] != inside[:-1])
        starts, ends = edges[::2], edges[1::2]
        if longest:
            ends = np.minimum(ends, starts + longest)
        offsets = np.cumsum([0, *(len(part) + 1 for _, part in batch)])
        np.add.at(counts, [i for i, _ in batch], np.diff(np.searchsorted(starts, offsets)))
        values = data.astype(np.uint64) + np.uint64(1)
        for out, base in zip(found, bases):
            out.append(_spans(values, starts, ends, base))
    return counts, *(np.concatenate(x) for x in found)
