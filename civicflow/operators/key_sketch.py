"""Key sketches: which stored parts may hold a key, without reading the parts.

A sketch is a blocked Bloom filter: each key sets four bits of one bucket of 32,768 bits. Its rows
(part, buckets, bucket, bits) are an ordinary table, made by one aggregation and probed by one join
on the bucket, so a probe reads one bucket a key and part, and no key of the part.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKET_BITS = 32_768  # what bitmap_construct_agg makes
BITS_PER_KEY = 12
PROBES = 4
# The positions of so many keys are sorted by one task.
KEYS_PER_TASK = 250_000


def buckets_for(keys: int) -> int:
    """Buckets of a part with so many keys; a power of two, so that few numbers occur."""
    return 1 << max(0, math.ceil(math.log2(max(1, keys) * BITS_PER_KEY / BUCKET_BITS)))


def _bucket(key: Column, buckets: Column) -> Column:
    return F.pmod(F.xxhash64(key), buckets).cast("int")


def _positions(key: Column) -> Column:
    return F.array(*(F.pmod(F.xxhash64(key, F.lit(i)), F.lit(BUCKET_BITS)) for i in range(PROBES)))


def sketches(keys: DataFrame, buckets: int, rows: int | None = None) -> DataFrame:
    """Sketch rows of ``keys`` (part, key), the parts having ``buckets`` buckets each.

    The bitmaps come from a sort, so the keys are dealt out by bucket before they become positions:
    no task sorts a whole part's. ``rows`` says how many keys there are, if that is known.
    """
    placed = keys.select("part", _bucket(F.col("key"), F.lit(buckets)).alias("bucket"), "key")
    number = [] if rows is None else [max(1, math.ceil(rows / KEYS_PER_TASK))]
    dealt = placed.repartition(*number, "part", "bucket")
    spread = dealt.select("part", "bucket", F.explode(_positions(F.col("key"))).alias("at"))
    bits = F.bitmap_construct_agg("at").alias("bits")
    return spread.groupBy("part", "bucket").agg(bits).select("part", F.lit(buckets).alias("buckets"), "bucket", "bits")


def parts_that_may_hold(sketch: DataFrame, keys: DataFrame, sizes: list[int]) -> DataFrame:
    """Distinct ``part`` of ``sketch`` rows that may hold any of ``keys`` (key). ``sizes`` are the
    numbers of buckets that occur. No part that holds a key is missing; one in some hundred others
    is named for each key."""
    wanted = keys.select("key", F.explode(F.array(*(F.lit(n) for n in sorted(sizes)))).alias("buckets"))
    wanted = wanted.withColumns({"bucket": _bucket(F.col("key"), F.col("buckets")), "positions": _positions(F.col("key"))})
    # Bit p of a bitmap is bit p % 8 of byte p / 8.
    byte = "cast(conv(hex(substring(bits, cast(p div 8 as int) + 1, 1)), 16, 10) as int)"
    held = F.expr(f"forall(positions, p -> getbit({byte}, cast(p % 8 as int)) = 1)")
    return sketch.join(wanted, ["buckets", "bucket"]).where(held).select("part").distinct()
