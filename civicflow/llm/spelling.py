"""Spelling variants: words one edit apart, found with bit-sliced position indexes.

Words are counted over all texts; each word's near words differ from it by one inserted, deleted or
replaced letter. The vocabulary is dealt to slots by what an edit leaves alone: with one edit in the
first half of a word the second half stays, and the other way round, so near words share a half.
A slot holds one bitset over its words per (position, letter). All of its words are looked up at
once: two recurrences along the positions, 64 words per machine word, keep the set without an error
so far, that with one replaced letter, and, with positions shifted by one, that with one more letter.

A half that very many words share is cut in two again, as often as needed, so no slot grows with the
vocabulary: what is left free of a word shrinks to one letter, and few words differ in just that.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civicflow.llm.components import discard, stored

LEAST_LETTERS = 5
LEAST_COUNT = 3
# A form is at least so many times as frequent.
RATIO = 2
# Letters of the words of a slot; of a group that is still processed whole.
SLOT_LETTERS = 1 << 16
GROUP_LETTERS = 1 << 18
# Bitset words that a step of the recurrences works on, characters and counts held at a time.
STEP_WORDS = 1 << 18
PIECE_CHARS = 1 << 20
HELD_WORDS = 1 << 17

_RUN = re.compile("[A-Za-zÀ-ÿ]+")
_NO_RUN = re.compile("[^A-Za-zÀ-ÿ]")
_LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}
_NEAR = "word string, n long, near string, near_n long"


def misspell(doc_id: str, run: str) -> str:
    """A deterministic slip: one run in 97 loses a letter."""
    h = zlib.crc32(f"{doc_id}:{run}".encode())
    if h % 97:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1 :]


def _pieces(text: str) -> Iterator[str]:
    """Parts of a text; no run is cut."""
    at = 0
    while len(text) - at > PIECE_CHARS:
        cut = _NO_RUN.search(text, at + PIECE_CHARS)
        if cut is None:
            break
        yield text[at : cut.start()]
        at = cut.start()
    yield text[at:] if at else text


def _counter(change: Callable[[str, str], str] | None, least: int) -> Callable:
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words: Counter[str] = Counter()

        def flush() -> pa.RecordBatch:
            columns = [pa.array(list(words), pa.string()), pa.array(list(words.values()), pa.int64())]
            words.clear()
            return pa.record_batch(columns, names=["word", "n"])

        for batch in batches:
            for doc_id, text in zip(batch.column(0), batch.column(1)):
                if not text.is_valid:
                    continue
                name, runs = doc_id.as_py() or "", Counter()
                for piece in _pieces(text.as_py()):
                    runs.update(_RUN.findall(piece))
                lowered: Counter[str] = Counter()
                for run, n in runs.items():
                    if len(run) >= least:
                        lowered[run.lower() if run.isascii() else run.translate(_LOWER)] += n
                for run, n in lowered.items():
                    word = change(name, run) if change else run
                    if len(word) >= least:
                        words[word] += n
                if len(words) > HELD_WORDS:
                    yield flush()
        yield flush()

    return count


def count_words(
    docs: DataFrame,
    change: Callable[[str, str], str] | None = None,
    least_letters: int = LEAST_LETTERS,
    least_count: int = LEAST_COUNT,
) -> DataFrame:
    """Stored (word, n): lower-cased runs of letters A to Z and U+00C0 to U+00FF of all texts of
    ``docs`` (doc_id, text; other columns are ignored), of at least ``least_letters`` letters and
    ``least_count`` occurrences.

    ``change`` may turn a run into another, by the document's id as text (empty if null); it must
    not make runs longer. Null texts have no runs; repeated rows count as often as they occur.
    """
    rows = docs.select(F.col("doc_id").cast("string"), F.col("text"))
    counts = rows.mapInArrow(_counter(change, least_letters), "word string, n long")
    counts = counts.groupBy("word").agg(F.sum("n").alias("n"))
    return stored(counts.where(F.col("n") >= least_count), "vocabulary")


def _bitsets(letters: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of one position: which row of bitsets each letter has, and these rows; the last one is empty."""
    held, which = np.unique(letters, return_inverse=True)
    words = -(-len(letters) // 64)
    flags = np.zeros((len(held) + 1, words * 64), bool)
    flags[which, np.arange(len(letters))] = True
    row_of = np.full(256, len(held))
    row_of[held] = np.arange(len(held))
    return row_of, np.packbits(flags, axis=1, bitorder="little").view("<u8")


def _members(sets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row and member of every bit that is set."""
    row, word = np.nonzero(sets)
    bits = np.unpackbits(np.ascontiguousarray(sets[row, word]).view("u1").reshape(-1, 8), axis=1, bitorder="little")
    which, bit = np.nonzero(bits)
    return row[which], word[which] * 64 + bit


def near_pairs(letters: np.ndarray, lengths: np.ndarray, size: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of rows one edit apart: words of ``size`` letters with each other (once) and with those
    of one more. ``letters`` (n, size + 1) are Latin-1 codes, 0 behind a word's end."""
    shorter = np.flatnonzero(lengths == size)
    bitsets = [_bitsets(letters[:, i]) for i in range(size + 1)]
    of_size = np.packbits(np.pad(lengths == size, (0, -len(lengths) % 64)), bitorder="little").view("<u8")
    words = len(of_size)
    step = max(1, STEP_WORDS // words)
    for at in range(0, len(shorter), step):
        rows = shorter[at : at + step]
        equal = np.full((len(rows), words), ~np.uint64(0))
        replaced = np.zeros_like(equal)
        longer = equal.copy()
        for i in range(size):
            letter = letters[rows, i]
            row_of, sets = bitsets[i]
            here = sets[row_of[letter]]
            row_of, sets = bitsets[i + 1]
            behind = sets[row_of[letter]]
            replaced = (replaced & here) | (equal & ~here)
            equal = equal & here
            longer = (longer & behind) | equal
        a, b = _members(replaced & of_size)
        once = rows[a] < b
        yield rows[a][once], b[once]
        a, b = _members(longer & ~of_size)
        within = b < len(lengths)
        yield rows[a][within], b[within]


def _near(table: pa.Table) -> pa.Table:
    """Near words within a slot; each pair is reported where its first difference is free."""
    size, low, high = (table.column(c)[0].as_py() for c in ("size", "low", "high"))
    words = table.column("word").to_pylist()
    lengths = np.array([len(w) for w in words])
    letters = np.frombuffer("".join(w.ljust(size + 1, "\0") for w in words).encode("latin-1"), "u1").reshape(len(words), size + 1)
    found = [np.zeros((2, 0), np.int64)]
    if (lengths == size).any():
        for a, b in near_pairs(letters, lengths, size):
            first = (letters[a] != letters[b]).argmax(axis=1)
            free = (first >= low) & ((first < high) | (high == size))
            found.append(np.array([a[free], b[free]]))
    a, b = np.concatenate(found, axis=1)
    a, b = pa.array(np.concatenate([a, b])), pa.array(np.concatenate([b, a]))
    columns = [table.column(c).take(i) for i in (a, b) for c in ("word", "n")]
    return pa.table(columns, names=["word", "n", "near", "near_n"])


def _keyed(rows: DataFrame) -> DataFrame:
    """``rows`` (word, n, size, low, high) with what lies outside the free letters as a key."""
    fixed = F.expr("struct(size, low, high, substring(word, 1, low), right(word, size - high))")
    return rows.withColumn("key", F.md5(F.to_json(fixed)))


def _free(rows: DataFrame, least_letters: int) -> DataFrame:
    """Each word with its own length, and that of the words with one letter less, as the shorter
    word's size; with the first half of it free, and with the second."""
    letters = F.char_length("word")
    rows = rows.select("word", "n", F.explode(F.array(letters, letters - 1)).alias("size"))
    rows = rows.where(F.col("size") >= least_letters)
    return _halves(rows.withColumns({"low": F.lit(0), "high": F.col("size")}))


def _halves(rows: DataFrame) -> DataFrame:
    middle = F.expr("cast((low + high) / 2 as int)")
    low, high = F.col("low"), F.col("high")
    parts = F.array(F.struct(low.alias("low"), middle.alias("high")), F.struct(middle.alias("low"), high.alias("high")))
    return rows.select("word", "n", "size", F.explode(parts).alias("part")).select("word", "n", "size", "part.*")


def near_words(vocabulary: DataFrame, least_letters: int = LEAST_LETTERS, group_letters: int = GROUP_LETTERS) -> DataFrame:
    """(word, n, near, near_n) for every word of ``vocabulary`` (word, n; words distinct and of at
    least ``least_letters`` letters) and each of its near words."""
    rows, found = _free(vocabulary, least_letters), []
    while True:
        keyed = stored(_keyed(rows), "spelling-rows")
        groups = keyed.groupBy("key", "size", "low", "high").agg(F.count("*").alias("members")).where("members > 1")
        # A free part of one letter is never cut; only so many words differ in just that.
        large = (F.col("members") * (F.col("size") + 1) > group_letters) & (F.col("high") - F.col("low") > 1)
        groups = stored(groups.withColumn("large", large), "spelling-groups")
        small = groups.where(~F.col("large"))
        shared = small.groupBy("size", "low", "high").agg(F.sum("members").alias("total"))
        slots = F.ceil(F.col("total") * (F.col("size") + 1) / SLOT_LETTERS)
        dealt = keyed.join(small.select("key"), "key").join(shared, ["size", "low", "high"])
        dealt = dealt.withColumn("slot", F.pmod(F.xxhash64("key"), slots))
        pairs = dealt.select("word", "n", "size", "low", "high", "slot").groupBy("size", "low", "high", "slot")
        found.append(stored(pairs.applyInArrow(_near, _NEAR), "near-words"))
        if groups.where("large").isEmpty():
            break
        rows = _halves(keyed.join(groups.where("large").select("key"), "key").drop("key"))
    result = found[0]
    for more in found[1:]:
        result = result.unionAll(more)
    return result


def variants(vocabulary: DataFrame, ratio: int = RATIO, **options: int) -> DataFrame:
    """Each word of ``vocabulary`` (word, n) with its form: word, n, n_near (near words), form (the
    most frequent near word, ties to the smallest in code-point order, if at least ``ratio`` times as
    frequent; else null), form_n, root (where following forms ends; the word itself without one).

    Forms grow in frequency, so they make no circles, and every round of looking up the form's form
    halves what is left of a chain. An empty vocabulary gives an empty result.
    """
    near = near_words(vocabulary, **options)
    best = F.min(F.struct((-F.col("near_n")).alias("falling"), F.col("near").alias("form"))).alias("best")
    formed = near.groupBy("word", "n").agg(F.count("*").alias("n_near"), best)
    fits = -F.col("best.falling") >= ratio * F.col("n")
    form, form_n = F.when(fits, F.col("best.form")), F.when(fits, -F.col("best.falling"))
    formed = stored(formed.select("word", "n_near", form.alias("form"), form_n.alias("form_n")), "forms")

    roots = stored(formed.where("form is not null").select("word", F.col("form").alias("root")), "roots")
    while True:
        next_step = roots.select(F.col("word").alias("root"), F.col("root").alias("further"))
        stepped = roots.join(next_step, "root", "left")
        stepped = stepped.select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved"))
        stepped = stored(stepped, "roots")
        discard(roots)
        done = stepped.where("moved").isEmpty()
        roots = stepped.drop("moved")
        roots.stored_at = stepped.stored_at
        if done:
            break
    rows = vocabulary.join(formed, "word", "left").join(roots, "word", "left")
    return rows.select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        "form",
        "form_n",
        F.coalesce("root", "word").alias("root"),
    )
