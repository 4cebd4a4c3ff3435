"""Near-duplicate vectors: random-hyperplane sign hashing, exact cosines, components.

Every vector gets one key per table from the signs of its products with random hyperplanes. Vectors
that share a key and the label meet in a bucket, where exact cosines decide; a pair is reported by
the first table that brings it together. Equal vectors are one node with a count, so groups of
copies are never compared. A task works on many small buckets at once; a large bucket is dealt to
blocks, and each pair of blocks is a group of its own. With 48 tables of 14 signs a pair at cosine 0.93 is missed with a probability of 2e-4.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civicflow.llm.components import components, stored

THRESHOLD = 0.93
TABLES = 48
SIGNS = 14
BLOCK_ROWS = 2048
# Rows of small buckets that one group takes, and pairs that are compared at a time.
SLOT_ROWS = 8192
PAIRS = 1 << 17

_SKETCH = "vec_id long, label long, vector binary, node binary, keys binary"


def _planes(size: int) -> np.ndarray:
    return np.random.default_rng([7, size]).standard_normal((size, TABLES * SIGNS))


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    planes: dict[int, np.ndarray] = {}
    powers = 1 << np.arange(SIGNS)
    for batch in batches:
        for at in range(0, batch.num_rows, 2048):
            part = batch.slice(at, 2048)
            keys: list[bytes | None] = []
            vectors, nodes = [], []
            for value, label in zip(part.column(1).to_pylist(), part.column(2).to_pylist()):
                v = None if value is None or label is None or None in value else np.array(value, np.float64)
                if v is None or not np.isfinite(v).all() or not v.any():
                    vectors.append(None)
                    nodes.append(None)
                    keys.append(None)
                    continue
                v = v + 0.0  # no negative zeros
                if len(v) not in planes:
                    planes[len(v)] = _planes(len(v))
                # Scaled by its largest component, so that products cannot overflow.
                signs = (v / np.abs(v).max()) @ planes[len(v)] >= 0
                vectors.append(v.tobytes())
                nodes.append(hashlib.blake2b(v.tobytes() + label.to_bytes(8, "little", signed=True), digest_size=16).digest())
                keys.append((signs.reshape(TABLES, SIGNS) @ powers).astype("<u2").tobytes())
            columns = [part.column(0), part.column(2), pa.array(vectors, pa.binary()), pa.array(nodes, pa.binary())]
            names = ["vec_id", "label", "vector", "node", "keys"]
            yield pa.record_batch([*columns, pa.array(keys, pa.binary())], names=names)


def _unit(rows: list[bytes]) -> np.ndarray:
    vectors = np.frombuffer(b"".join(rows), np.float64).reshape(len(rows), -1)
    vectors = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return vectors / np.sqrt((vectors * vectors).sum(axis=1, keepdims=True))


def _pairs_in_runs(starts: np.ndarray, ends: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Positions of all pairs within runs of rows, some at a time: each row with those behind it."""
    rows = np.arange(starts[0], ends[-1]) if len(starts) else np.zeros(0, np.int64)
    behind = np.repeat(ends, ends - starts) - rows - 1
    past = np.cumsum(behind)
    at = 0
    while at < len(rows):
        stop = max(at + 1, int(np.searchsorted(past, (past[at - 1] if at else 0) + PAIRS, "right")))
        number = behind[at:stop]
        first = np.repeat(rows[at:stop], number)
        step = np.arange(number.sum()) - np.repeat(np.cumsum(number) - number, number)
        yield first, first + 1 + step
        at = stop


def _link(threshold: float):
    def link(table: pa.Table) -> pa.Table:
        """Links between nodes of the same buckets, or of two blocks of one: (a, b)."""
        apart = table.column("i")[0].as_py() != table.column("j")[0].as_py()
        columns = [table.column(c).to_numpy() for c in ("size", "label", "number", "key")]
        order = np.lexsort(columns[::-1])
        columns = [c[order] for c in columns]
        fresh = np.ones(len(order), bool)
        fresh[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in columns])
        starts = np.flatnonzero(fresh)
        ends = np.append(starts[1:], len(order))
        ids, block = (table.column(c).to_numpy()[order] for c in ("id", "block"))
        vectors, keys = (table.column(c).take(pa.array(order)).to_pylist() for c in ("vector", "keys"))
        keys = np.frombuffer(b"".join(keys), "<u2").reshape(len(keys), -1)
        a, b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        # Runs of vectors of one length at a time.
        edges = np.concatenate([[0], np.flatnonzero(columns[0][1:] != columns[0][:-1]) + 1, [len(order)]])
        for low, high in zip(edges[:-1], edges[1:]):
            unit = _unit(vectors[low:high])
            own = (starts >= low) & (starts < high)
            for x, y in _pairs_in_runs(starts[own], ends[own]):
                if apart:
                    other = block[x] != block[y]
                    x, y = x[other], y[other]
                close = np.einsum("ij,ij->i", unit[x - low], unit[y - low]) >= threshold
                x, y = x[close], y[close]
                new = (keys[x] == keys[y]).argmax(axis=1) == columns[2][x]
                a.append(ids[x[new]])
                b.append(ids[y[new]])
        return pa.table({"a": pa.array(np.concatenate(a), pa.int64()), "b": pa.array(np.concatenate(b), pa.int64())})

    return link


def link_nodes(nodes: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Links (a, b) between stored ``nodes`` (id, label, vector, keys) of equal labels."""
    slots = max(1, nodes.count() * TABLES // SLOT_ROWS)
    number = F.explode(F.sequence(F.lit(0), F.lit(TABLES - 1))).alias("number")
    size = F.octet_length("vector").alias("size")
    # Keys are little-endian.
    low, high = (F.expr(f"hex(substring(keys, 2 * number + {at}, 1))") for at in (1, 2))
    key = F.conv(F.concat(high, low), 16, 10).cast("int").alias("key")
    keyed = nodes.select("id", "label", size, "keys", number).select("id", "label", "size", "number", key)
    bucket = ["size", "label", "number", "key"]
    sizes = keyed.groupBy(bucket).agg(F.count("*").alias("n")).where("n > 1")
    sizes = sizes.select(*bucket, F.ceil(F.col("n") / BLOCK_ROWS).cast("int").alias("blocks"))
    rows = keyed.join(sizes, bucket).join(nodes.drop("label"), "id")
    rows = rows.withColumn("block", F.expr("pmod(xxhash64(id), blocks)").cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    mixed = F.xxhash64(*bucket)
    slot = F.when(F.col("blocks") > 1, mixed).otherwise(F.pmod(mixed, F.lit(slots)))
    rows = rows.withColumns({"i": F.least("block", "other"), "j": F.greatest("block", "other"), "slot": slot})
    groups = rows.select("slot", "i", "j", *bucket, "id", "keys", "vector", "block")
    return groups.groupBy("slot", "i", "j").applyInArrow(_link(threshold), "a long, b long")


def near_duplicates(vectors: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row per row of ``vectors`` (vec_id, embedding, label; other columns are ignored): vec_id,
    n_links (other rows linked directly), component_id (smallest vec_id reachable, itself
    included), kept (whether it is its own component's).

    Vectors without label, or null, zero or with null or non-finite components, link with nothing;
    so do vectors of different lengths. Equal vectors of a label are linked with each other. Rows
    with the same vec_id count as rows of their own in n_links and share a component. A row without
    vec_id is linked as others are, but has no component of its own and is kept. An empty table
    gives an empty result.
    """
    vectors = vectors.select(F.col("vec_id").cast("long"), "embedding", F.col("label").cast("long"))
    sketch = stored(vectors.mapInArrow(_sketch, _SKETCH), "vectors")
    able = sketch.where("node is not null")
    nodes = able.groupBy("node").agg(
        F.min("vec_id").alias("least"), F.count("*").alias("copies"), F.min(F.struct("label", "vector", "keys")).alias("of")
    )
    nodes = stored(nodes.select("node", "least", "copies", F.xxhash64("node").alias("id"), "of.*"), "nodes")
    links = stored(link_nodes(nodes.select("id", "label", "vector", "keys"), threshold), "links")

    both = links.unionAll(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    others = both.join(nodes.select(F.col("id").alias("b"), "copies"), "b").groupBy("a").agg(F.sum("copies").alias("others"))
    least = nodes.select("id", "least")
    named = links.join(least.withColumnsRenamed({"id": "a", "least": "x"}), "a").join(
        least.withColumnsRenamed({"id": "b", "least": "y"}), "b"
    )
    # One id may stand for several nodes, which joins them.
    same_id = able.select("vec_id", "node").distinct().join(nodes.select("node", "least"), "node")
    edges = named.select(F.col("x").alias("a"), F.col("y").alias("b")).unionAll(
        same_id.select(F.col("vec_id").alias("a"), F.col("least").alias("b")).where("a <> b")
    )
    roots = components(edges.where("a is not null and b is not null"))

    counted = nodes.join(others, nodes.id == others.a, "left").select("node", "copies", "others")
    rows = sketch.select("vec_id", "node").join(counted, "node", "left")
    rows = rows.join(roots.select(F.col("node").alias("vec_id"), "root"), "vec_id", "left")
    root = F.coalesce("root", "vec_id")
    return rows.select(
        "vec_id",
        (F.coalesce("copies", F.lit(1)) - 1 + F.coalesce("others", F.lit(0))).cast("long").alias("n_links"),
        root.alias("component_id"),
        F.coalesce(root == F.col("vec_id"), F.lit(True)).alias("kept"),
    )
