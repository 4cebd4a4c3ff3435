"""Benchmark decontamination: a broadcast hash set of test n-grams, verified hits, spans removed.

Everything here is made of DataFrame functions. Test items become windows of ten words; the 64-bit
hashes of these windows are broadcast, together with their words. Every document is cut into words
once, all its windows probe the set where they stand, and a hit counts only if the words themselves
are equal. Only verified hits are shuffled; texts never are, but by ``decontaminate``, which gives
the remaining text back.

What is broadcast is bounded: a test set of more than ``max_windows`` windows, or more than
``max_bytes`` of words, is dealt to parts by its hashes, and the documents are scanned once a part.
"""

from __future__ import annotations

import math
import string
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from civicflow.llm.components import stored

SIZE = 10
MAX_WINDOWS = 500_000
MAX_BYTES = 64 << 20
# What stands between words, after A to Z became a to z and before.
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
CASED_BETWEEN = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
CASED_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def words_of(text: Column) -> Column:
    """Words in order; a null text has none."""
    lowered = F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    return _split(lowered, BETWEEN)


def _split(text: Column, between: str) -> Column:
    """Splitting is twice as fast as extracting; only a first and a last part can be empty."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), between), "")


def _starts(words: Column, size: int | Column) -> Column:
    """1-based starts of all windows of ``size`` words."""
    last = F.size(words) - size + 1
    return F.when(last >= 1, F.sequence(F.lit(1), last)).otherwise(F.array().cast("array<int>"))


def _window_hashes(words: Column, size: int) -> Column:
    return F.transform(_starts(words, size), lambda start: F.xxhash64(F.slice(words, start, size)))


def _row_key(doc_id: Column, text: Column) -> Column:
    """Rows with the same id and text share a key and a result; an id alone may be null or repeated."""
    parts = [F.coalesce(F.concat(F.lit("+"), c.cast("string")), F.lit("-")) for c in (doc_id, text)]
    return F.md5(F.concat_ws("\u0001", *parts))


def test_windows(items: DataFrame, size: int = SIZE) -> tuple[DataFrame, DataFrame]:
    """Stored windows (hash, words, family) of ``items`` (item_id, text), and the items of each
    family (family, item).

    Windows that occur in the same items are one family, so a line that all items share is joined
    with them once and not once a window.
    """
    cut = items.select(F.col("item_id").cast("string").alias("item"), words_of(F.col("text")).alias("words"))
    length = F.least(F.size("words"), F.lit(size))
    held = F.transform(_starts(F.col("words"), length), lambda i: F.slice("words", i, length))
    held = cut.where(F.size("words") > 0).select("item", F.explode(held).alias("words"))
    windows = held.groupBy("words").agg(F.sort_array(F.collect_set("item")).alias("items"))
    family = F.md5(F.to_json(F.struct("items")))
    windows = stored(windows.select(F.xxhash64("words").alias("hash"), "words", family.alias("family"), "items"), "windows")
    families = windows.groupBy("family").agg(F.first("items").alias("items"))
    return windows.drop("items"), families.select("family", F.explode("items").alias("item"))


def _parts(windows: DataFrame, max_windows: int, max_bytes: int) -> list[DataFrame]:
    """``windows`` in parts that are small enough to be broadcast."""
    held = F.sum(F.octet_length(F.concat_ws(" ", "words")) + 80)
    rows, size = windows.agg(F.count("*"), F.coalesce(held, F.lit(0))).first()
    parts = max(1, math.ceil(rows / max_windows), math.ceil(size / max_bytes))
    part = F.pmod(F.col("hash"), F.lit(parts))
    return [windows.where(part == k) if parts > 1 else windows for k in range(parts)]


def find_hits(rows: DataFrame, windows: DataFrame, max_windows: int = MAX_WINDOWS, max_bytes: int = MAX_BYTES) -> DataFrame:
    """Where windows occur: (key, start, end, family) for ``rows`` (key, words); words from 0."""
    lengths = sorted(r[0] for r in windows.select(F.size("words")).distinct().collect())  # at most SIZE
    if not lengths:
        lengths = [1]
    words, n = F.col("words"), F.size("words")
    hashes = [_window_hashes(words, size) for size in lengths]
    # Hashes are a column of their own: a generator that runs a lambda is not compiled, and would copy
    # a document's words for every probe. It is an outer one (the join drops its nulls) because from
    # another Spark infers a filter that cuts the text into words again in each call of the lambda.
    hashed = rows.select("key", "words", F.concat(*hashes).alias("hashes"))
    probes = hashed.select("key", "words", F.posexplode_outer("hashes").alias("place", "hash"))
    # The windows of each length follow those of the length before.
    start, length, before = F.col("place"), F.lit(lengths[0]), F.lit(0)
    for shorter, size in zip(lengths, lengths[1:]):
        before = before + F.greatest(n - shorter + 1, F.lit(0))
        start = F.when(F.col("place") >= before, F.col("place") - before).otherwise(start)
        length = F.when(F.col("place") >= before, F.lit(size)).otherwise(length)

    def hits(part: DataFrame) -> DataFrame:
        part = F.broadcast(part.select("hash", F.col("words").alias("tested"), "family"))
        # Not written as an equality: that would make the words a second key, cut out for every probe.
        same = F.slice(words, start + 1, length).between(F.col("tested"), F.col("tested"))
        found = probes.join(part, (probes.hash == part.hash) & same)
        return found.select("key", start.alias("start"), (start + length).alias("end"), "family")

    return reduce(DataFrame.unionAll, map(hits, _parts(windows, max_windows, max_bytes))).distinct()


def _spans(hits: DataFrame) -> DataFrame:
    """Per key: its hits merged to ``spans`` that do not touch, and the number of words in them."""
    in_order = Window.partitionBy("key").orderBy("start", "end")
    reached = F.max("end").over(in_order.rowsBetween(Window.unboundedPreceding, -1))
    fresh = (reached.isNull() | (F.col("start") > reached)).cast("long")
    numbered = hits.select("key", "start", "end", fresh.alias("fresh"))
    numbered = numbered.withColumn("span", F.sum("fresh").over(in_order.rowsBetween(Window.unboundedPreceding, 0)))
    merged = numbered.groupBy("key", "span").agg(F.min("start").alias("start"), F.max("end").alias("end"))
    spans = F.sort_array(F.collect_list(F.struct("start", "end")))
    return merged.groupBy("key").agg(spans.alias("spans"), F.sum(F.col("end") - F.col("start")).alias("n_hit"))


def _found(docs: DataFrame, items: DataFrame, size: int, **bounds: int) -> DataFrame:
    """Stored (key, spans, n_hit, items) of contaminated rows."""
    windows, families = test_windows(items, size)
    rows = docs.select(_row_key(F.col("doc_id"), F.col("text")).alias("key"), words_of(F.col("text")).alias("words"))
    hits = stored(find_hits(rows, windows, **bounds), "hits")
    named = hits.select("key", "family").distinct().join(families, "family").groupBy("key")
    named = named.agg(F.sort_array(F.collect_set("item")).alias("items"))
    # Only items without an id may leave a hit row without names.
    return stored(_spans(hits).join(named, "key", "left"), "found")


def scan(docs: DataFrame, items: DataFrame, size: int = SIZE, **bounds: int) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, n_words, n_hit, spans, items.

    ``spans`` are the merged runs of words (from 0, end excluded) that lie in an occurrence of a
    window of an item of ``items`` (item_id, text); ``items`` are the ids of items with such windows,
    as strings in order. A window is ``size`` consecutive words, or all words of a shorter item.
    Null and empty texts have no words. Rows of ``items`` with the same id are one item; those
    without id are searched for but not named. Repeated rows of ``docs`` each get their row, rows
    without id too. Other columns of either table are not looked at. ``bounds``
    (``max_windows``, ``max_bytes``) limit what is broadcast at a time.
    """
    found = _found(docs, items, size, **bounds)
    n_words = F.size(_split(F.col("text"), CASED_BETWEEN))
    rows = docs.select("doc_id", _row_key(F.col("doc_id"), F.col("text")).alias("key"), n_words.cast("long").alias("n_words"))
    none = F.array().cast("array<struct<start:int,end:int>>")
    return rows.join(found, "key", "left").select(
        "doc_id",
        "n_words",
        F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("spans", none).alias("spans"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
    )


def without_spans(text: Column, spans: Column) -> Column:
    """``text`` without the words of ``spans``, each gone with what follows it up to the next word."""
    words = _split(text, CASED_BETWEEN)
    between = F.split(text, CASED_WORD)

    def kept(start: Column, end: Column) -> Column:
        return F.transform(
            F.when(end > start, F.sequence(start, end - 1)).otherwise(F.array().cast("array<int>")),
            lambda i: F.concat(F.get(words, i), F.get(between, i + 1)),
        )

    # From the end of each span to the start of the next.
    edges = F.concat(F.array(F.lit(0)), F.transform(spans, lambda s: s["end"]))
    until = F.concat(F.transform(spans, lambda s: s["start"]), F.array(F.size(words)))
    pieces = F.flatten(F.zip_with(edges, until, kept))
    return F.concat(F.get(between, F.lit(0)), F.array_join(pieces, ""))


def decontaminate(docs: DataFrame, items: DataFrame, remove: str = "spans", size: int = SIZE, **bounds: int) -> DataFrame:
    """``docs`` with all its columns and without what ``scan`` finds: ``remove="spans"`` cuts the
    words found out of the texts, ``remove="documents"`` leaves out rows with any.

    Rows without a hit stay as they are, null texts too; a text that was nothing but hits keeps
    what stood before its first word.
    """
    if remove not in ("spans", "documents"):
        raise ValueError("remove is 'spans' or 'documents'")
    found = _found(docs, items, size, **bounds).select(F.col("key").alias("_key"), F.col("spans").alias("_spans"))
    keyed = docs.withColumn("_key", _row_key(F.col("doc_id"), F.col("text")))
    if remove == "documents":
        return keyed.join(found, "_key", "left_anti").select(*docs.columns)
    # Texts are cut up in the rows that need it; their columns do not pass through the others.
    text = F.when(F.col("_spans").isNull(), F.col("text")).otherwise(without_spans(F.col("text"), F.col("_spans")))
    rows = keyed.join(found, "_key", "left")
    return rows.withColumn("text", text).select(*docs.columns)
