"""MinHash near-duplicates with min-max signatures.

Every permutation gives two signature values, the smallest and the largest image of a document's
shingles, so a signature of 120 values costs 60 permutations. Values are banded by four; documents
that share a band are candidates, and a candidate pair is linked only after its full shingle sets
were compared. A pair of similarity 0.75 shares no band with a probability of about 1e-5.

Documents with the same set are one node. Inside a band every node is first compared with the
band's smallest node only. Where that leaves a band with several components, each of its nodes is
compared with the one of another component that its signature says is nearest, and last, within
the task that has the band's texts, with all nodes of other components whose signatures do not
exclude a link; of the links found there, one per node and component is returned. Only pairs that
could still join two components are ever compared, each in the first band it shares, and none of
them is left out, so components are the same as those of all pairs.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civicflow.llm.components import components, stored
from civicflow.llm.words import mix, windows, word_hashes

SHINGLE = 5
PERCENT = 75
BAND_ROWS = 4
BANDS = 30
PERMUTATIONS = BANDS * BAND_ROWS // 2
# Share of equal signature bytes below which a pair is not compared: five standard deviations
# under the threshold.
EXCLUDED_BELOW = 0.55
# Rows of a band, and members of an anchor, that one task compares at a time.
BLOCK_ROWS = 2048
GROUP_ROWS = 256

_RANDOM = np.random.default_rng(20240611)
_FACTORS = _RANDOM.integers(0, 2**32, PERMUTATIONS, dtype=np.uint32) | np.uint32(1)
_SHIFTS = _RANDOM.integers(0, 2**32, PERMUTATIONS, dtype=np.uint32)

SKETCH = "doc_id long, n_shingles long, set_key binary, bands array<bigint>, signature binary"


def shingle_sets(texts: list[str | None]) -> list[np.ndarray]:
    """Sorted distinct hashes of the five-word shingles of each text; of a shorter text the hash
    of all its words, and nothing of a text without words."""
    counts, hashes = word_hashes([(t or "").encode() for t in texts], lower=True)
    ends = np.cumsum(counts)
    whole = windows(hashes, SHINGLE)
    sets = []
    for n, end in zip(counts.tolist(), ends.tolist()):
        if n >= SHINGLE:
            sets.append(np.unique(whole[end - n : end - SHINGLE + 1]))
        else:
            sets.append(windows(hashes[end - n : end], n) if n else whole[:0])
    return sets


def signature(shingles: np.ndarray) -> np.ndarray:
    """All minima, then all maxima, of the shingles' images."""
    low = np.full(PERMUTATIONS, 2**32 - 1, np.uint32)
    high = np.zeros(PERMUTATIONS, np.uint32)
    short = (shingles >> np.uint64(32)).astype(np.uint32)
    for at in range(0, len(short), 512):
        images = short[at : at + 512, None] * _FACTORS + _SHIFTS
        np.minimum(low, images.min(axis=0), out=low)
        np.maximum(high, images.max(axis=0), out=high)
    return np.concatenate([low, high])


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    numbers = np.arange(BANDS, dtype=np.uint64)
    for batch in batches:
        for at in range(0, batch.num_rows, 512):
            part = batch.slice(at, 512)
            sets = shingle_sets(part.column(1).to_pylist())
            signed = np.array([signature(s) for s in sets])
            rows = signed.reshape(len(sets), BANDS, BAND_ROWS).astype(np.uint64)
            bands = np.broadcast_to(mix(numbers), (len(sets), BANDS))
            for k in range(BAND_ROWS):
                bands = mix(bands + rows[:, :, k])
            offsets = pa.array(np.arange(len(sets) + 1) * BANDS, pa.int32())
            lists = pa.ListArray.from_arrays(offsets, pa.array(bands.reshape(-1).view(np.int64)))
            keys = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets]
            columns = {
                "doc_id": part.column(0),
                "n_shingles": pa.array([len(s) for s in sets], pa.int64()),
                "set_key": pa.array(keys, pa.binary()),
                "bands": lists,
                "signature": pa.array([s.astype(np.uint8).tobytes() for s in signed], pa.binary()),
            }
            yield pa.record_batch(list(columns.values()), names=list(columns))


def _verify(table: pa.Table) -> pa.Table:
    """Of one anchor: the members whose sets are similar enough to its own."""
    anchor = table.column("anchor")[0].as_py()
    ids = table.column("doc_id").to_pylist()
    own, linked = None, []
    if anchor in ids:
        own = shingle_sets([table.column("text")[ids.index(anchor)].as_py()])[0]
    for at in range(0, len(ids) if own is not None else 0, 64):
        texts = table.column("text").slice(at, 64).to_pylist()
        for i, other in zip(ids[at : at + 64], shingle_sets(texts)):
            common = len(np.intersect1d(own, other, assume_unique=True))
            if i != anchor and 100 * common >= PERCENT * (len(own) + len(other) - common):
                linked.append(i)
    return pa.table({"a": pa.array(linked, pa.int64()), "b": pa.array([anchor] * len(linked), pa.int64())})


def verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """Links (a, b) among ``pairs`` (doc_id, anchor). Members of one anchor are spread over groups
    of about ``GROUP_ROWS``, each with the anchor's text."""
    groups = pairs.groupBy("anchor").agg(F.count("*").alias("n"))
    groups = groups.select("anchor", F.ceil(F.col("n") / GROUP_ROWS).cast("int").alias("groups"))
    members = pairs.join(groups, "anchor").select(
        "doc_id", "anchor", F.expr("pmod(xxhash64(doc_id), groups)").cast("int").alias("part")
    )
    anchors = groups.select(
        F.col("anchor").alias("doc_id"), "anchor", F.explode(F.sequence(F.lit(0), F.col("groups") - 1)).alias("part")
    )
    rows = members.unionAll(anchors).join(texts, "doc_id")
    return rows.groupBy("anchor", "part").applyInArrow(_verify, "a long, b long")


class _Band:
    """Nodes of one band, or of two blocks of it, and who could still join whom."""

    def __init__(self, table: pa.Table):
        self.ids, self.comps, self.block = (table.column(c).to_numpy() for c in ("doc_id", "comp", "block"))
        self.apart = table.column("i")[0].as_py() != table.column("j")[0].as_py()
        rows = table.column("signature").to_pylist()
        self.signed = np.frombuffer(b"".join(rows), np.uint8).reshape(len(rows), -1)
        kinds, sizes = np.unique(self.comps, return_counts=True)
        self.largest = kinds[np.argmax(sizes)]

    def near(self, every: bool) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """For each node outside the largest component, which meets them from the other side:
        nodes of other components that its signature allows, and how much they agree. With
        ``every``, a pair outside the largest component comes from its larger id only."""
        need = EXCLUDED_BELOW * self.signed.shape[1]
        for k in np.flatnonzero(self.comps != self.largest):
            other = self.comps != self.comps[k]
            if self.apart:
                other &= self.block != self.block[k]
            if every:
                other &= (self.comps == self.largest) | (self.ids < self.ids[k])
            near = np.flatnonzero(other)
            same = (self.signed[near] == self.signed[k]).sum(axis=1)
            yield k, near[same >= need], same[same >= need]


def _nearest(table: pa.Table) -> pa.Table:
    """Pairs of each node with its nearest one in another component."""
    band, found = _Band(table), []
    for k, near, same in band.near(every=False):
        if len(near):
            found.append((int(band.ids[k]), int(band.ids[near[np.argmax(same)]])))
    a, b = zip(*found) if found else ((), ())
    return pa.table({"doc_id": pa.array(a, pa.int64()), "anchor": pa.array(b, pa.int64())})


def _links(table: pa.Table) -> pa.Table:
    """Links of each node to other components, found on the full sets."""
    band, found = _Band(table), []
    number = table.column("band")[0].as_py()
    bands = table.column("bands").combine_chunks().flatten().to_numpy().reshape(len(band.ids), -1)
    texts = table.column("text")
    sets = [s for at in range(0, len(texts), 64) for s in shingle_sets(texts.slice(at, 64).to_pylist())]
    sizes = np.array([len(s) for s in sets])
    for k, near, _ in band.near(every=True):
        shared = bands[near] == bands[k]
        near = near[bands[k][shared.argmax(axis=1)] == number]
        own = sets[k]
        for at in range(0, len(near), 256):
            part = near[at : at + 256]
            flat = np.concatenate([sets[i] for i in part])
            hit = own[np.minimum(np.searchsorted(own, flat), len(own) - 1)] == flat
            common = np.add.reduceat(hit, np.cumsum(sizes[part]) - sizes[part], dtype=np.int64)
            part = part[100 * common >= PERCENT * (len(own) + sizes[part] - common)]
            _, first = np.unique(band.comps[part], return_index=True)
            found += [(int(band.ids[k]), int(band.ids[i])) for i in part[first]]
    a, b = zip(*found) if found else ((), ())
    return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})


def _open_bands(members: DataFrame, nodes: DataFrame, roots: DataFrame) -> DataFrame:
    """Members of bands that still hold several components, in groups (band, i, j): block i of a
    band meets block j in one of them, and a band of one block is one group."""
    labelled = members.join(roots.withColumnRenamed("node", "doc_id"), "doc_id", "left").select(
        "band", "doc_id", F.coalesce("root", "doc_id").alias("comp")
    )
    bands = labelled.groupBy("band").agg(
        F.min("comp").alias("low"), F.max("comp").alias("high"), F.count("*").alias("n")
    )
    bands = bands.where("low <> high").select("band", F.ceil(F.col("n") / BLOCK_ROWS).cast("int").alias("blocks"))
    rows = labelled.join(bands, "band").join(nodes, "doc_id")
    rows = rows.withColumn("block", F.expr("pmod(xxhash64(doc_id), blocks)").cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return rows.withColumns({"i": F.least("block", "other"), "j": F.greatest("block", "other")}).drop("blocks", "other")


def _joined(roots: DataFrame, links: DataFrame) -> DataFrame:
    links = stored(links, "links")
    if links.isEmpty():
        return roots
    return components(links.unionAll(roots.select(F.col("node").alias("a"), F.col("root").alias("b"))))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text; other columns are ignored): doc_id, n_shingles,
    component_id (smallest doc_id reachable over links, itself included) and kept.

    A null, empty or blank text has no shingles and links with nothing. Rows with the same doc_id
    are one node, whatever their texts. A row without doc_id takes no part and is kept; its
    component is null. An empty table gives an empty result. ``docs`` is read twice and should be
    a table or a written intermediate.
    """
    docs = docs.select(F.col("doc_id").cast("long"), "text")
    sketch = stored(docs.mapInArrow(_sketch, SKETCH), "sketch")
    named = sketch.where("n_shingles > 0 and doc_id is not null")
    classes = named.groupBy("set_key").agg(F.min("doc_id").alias("doc_id"))
    nodes = named.select("set_key", "doc_id", "bands", "signature").join(classes, ["set_key", "doc_id"])
    nodes = stored(nodes.dropDuplicates(["set_key", "doc_id"]).drop("set_key"), "nodes")

    rows = nodes.select("doc_id", F.explode("bands").alias("band"))
    shared = rows.groupBy("band").agg(F.min("doc_id").alias("anchor"), F.max("doc_id").alias("last"))
    shared = shared.where("anchor <> last").select("band", "anchor")
    members = stored(rows.join(shared, "band"), "bands")
    wanted = members.select("doc_id").distinct()
    texts = stored(docs.join(wanted, "doc_id", "left_semi"), "texts")

    pairs = members.where("doc_id <> anchor").select("doc_id", "anchor").distinct()
    # Several sets under one doc_id are one node: such an id is linked over its smallest class.
    same_id = named.select("doc_id", "set_key").join(classes.withColumnRenamed("doc_id", "b"), "set_key")
    links = stored(verified(pairs, texts).unionAll(same_id.select(F.col("doc_id").alias("a"), "b").where("a <> b")), "links")
    roots = components(links)
    members = members.drop("anchor")
    groups = ["band", "i", "j"]
    pairs = _open_bands(members, nodes.drop("bands"), roots).groupBy(groups).applyInArrow(
        _nearest, "doc_id long, anchor long"
    )
    pairs = pairs.select(F.least("doc_id", "anchor").alias("doc_id"), F.greatest("doc_id", "anchor").alias("anchor"))
    roots = _joined(roots, verified(stored(pairs.distinct(), "pairs"), texts))
    last = _open_bands(members, nodes.join(texts, "doc_id"), roots).groupBy(groups).applyInArrow(_links, "a long, b long")
    roots = _joined(roots, last)
    roots = roots.select(F.col("node").alias("doc_id"), "root")
    root = F.coalesce("root", "doc_id")
    return sketch.select("doc_id", "n_shingles").join(roots, "doc_id", "left").select(
        "doc_id", "n_shingles", root.alias("component_id"), F.coalesce(root == F.col("doc_id"), F.lit(True)).alias("kept")
    )
