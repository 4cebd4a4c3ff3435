"""Exact top-k search by inner product over an impact-ordered index.

Vectors are integers (floor(256 x)). A shard of the index keeps, for every dimension, its postings
in descending order of their value: postings with the same value are a segment of one impact. A
query takes segments by descending contribution (value times the query's own), a level at a time
over all dimensions, and adds them to accumulators. Below the level reached, no dimension can add
more than that level, which bounds every vector from above; exact scores of the best accumulators
bound the k-th score from below. Levels are taken until the bounds leave few possible members, all
of which are then scored exactly, so the result is that of scoring everything.

Queries come in groups and vectors in shards, and every group meets every shard in one task.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

SHARD_ROWS = 8192
GROUP_ROWS = 256
# Levels as shares of the largest contribution; the last takes all that is left.
LEVELS = (1 / 8, 0.0, -1 / 16)
# Bounds are good enough when they leave this share of a shard.
POSSIBLE = 1 / 64


class Shard:
    """Postings of some vectors, by dimension and descending value."""

    def __init__(self, ids: np.ndarray, values: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.ids, self.values = ids[order], values[order]
        self.postings = np.argsort(-self.values, axis=0, kind="stable").T.copy()
        self.impacts = np.take_along_axis(self.values.T, self.postings, axis=1)
        self.rising = -self.impacts  # ascending, for binary search

    def _above(self, d: int, q: int, level: float) -> int:
        """How many postings of a dimension, from the query's best side, contribute ``level``."""
        if q > 0:
            return int(np.searchsorted(self.rising[d], level // -q, "right"))
        return len(self.ids) - int(np.searchsorted(self.rising[d], -(level // q), "left"))

    def best(self, query: np.ndarray, own: int, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores of the ``k`` best vectors other than ``own``, ties to the smaller id."""
        allowed = np.flatnonzero(self.ids != own)
        k = min(k, len(allowed))
        if not k:
            return self.ids[:0], self.ids[:0]
        dims = np.flatnonzero(query)
        n = len(self.ids)
        # Both ends of every dimension, as Python's integers: products may leave 64 bits.
        ends = [int(query[d]) * int(self.impacts[d, end]) for d in dims for end in (0, -1)]
        largest = max(ends, default=0)
        done = np.zeros(len(query), np.int64)
        # Sum of contributions, and how many of them.
        held, count = np.zeros(n, np.int64), np.zeros(n, np.int64)
        possible = allowed
        # Where a bound could leave 64 bits, all vectors are scored.
        levels = LEVELS if max(map(abs, ends), default=0) * len(dims) < 1 << 61 else ()
        for share in levels:
            level = int(np.ceil(largest * share)) if largest else 0
            for d in dims.tolist():
                q, to = int(query[d]), self._above(d, int(query[d]), level)
                if to > done[d]:
                    part = slice(done[d], to) if q > 0 else slice(n - to, n - done[d])
                    held[self.postings[d, part]] += self.impacts[d, part] * q
                    count[self.postings[d, part]] += 1
                    done[d] = to
            bound = held + (len(dims) - count) * (level - 1)
            first = allowed[np.argpartition(-bound[allowed], k - 1)[:k]]
            least = (self.values[first] @ query).min()
            possible = allowed[bound[allowed] >= least]
            if len(possible) <= max(4 * k, n * POSSIBLE):
                break
        scores = self.values[possible] @ query
        chosen = np.lexsort((self.ids[possible], -scores))[:k]
        return self.ids[possible][chosen], scores[chosen]


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    column = column.combine_chunks()
    return column.flatten().to_numpy().reshape(len(column), -1)


def _search(k: int):
    def search(vectors: pa.Table, queries: pa.Table) -> pa.Table:
        found: list[tuple[int, np.ndarray, np.ndarray]] = []
        if vectors.num_rows and queries.num_rows:
            shard = Shard(vectors.column("id").to_numpy(), _matrix(vectors.column("values")))
            rows = _matrix(queries.column("values"))
            for own, query in zip(queries.column("id").to_pylist(), rows):
                found.append((own, *shard.best(query, own, k)))
        columns = {
            "query_id": pa.array([own for own, ids, _ in found for _ in ids], pa.int64()),
            "vec_id": pa.array(np.concatenate([ids for _, ids, _ in found]) if found else [], pa.int64()),
            "score": pa.array(np.concatenate([s for *_, s in found]) if found else [], pa.int64()),
        }
        return pa.table(columns)

    return search


def quantised(vectors: DataFrame) -> DataFrame:
    """(id, values) of the vectors that take part."""
    whole = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    values = F.transform("embedding", lambda x: F.floor(x.cast("double") * 256))
    vectors = vectors.where(F.col("vec_id").isNotNull() & whole & (F.size("embedding") > 0))
    return vectors.select(F.col("vec_id").cast("long").alias("id"), values.alias("values"))


def top_k(vectors: DataFrame, is_query: Column, k: int = 5) -> DataFrame:
    """The ``k`` best rows of ``vectors`` (vec_id, embedding; other columns are ignored) for every
    row that ``is_query`` (a condition on ``id``) selects: query_id, rank from 1, vec_id, score.

    Vectors that are null or empty, hold null or non-finite components or have no vec_id take no
    part. Only vectors of the same length are compared, and none with one of the query's own id.
    Rows with the same vec_id are candidates of their own, and one query. Ties go to the smaller
    vec_id. An empty table gives an empty result.
    """
    rows = quantised(vectors).withColumn("size", F.size("values"))
    asked = is_query & F.col("id").isNotNull()
    sizes = rows.groupBy("size").agg(F.count("*").alias("n"), F.count(F.when(asked, 1)).alias("m"))
    sizes = sizes.where("m > 0").select(
        "size",
        F.ceil(F.col("n") / SHARD_ROWS).cast("int").alias("shards"),
        F.ceil(F.col("m") / GROUP_ROWS).cast("int").alias("groups"),
    )
    # One row for each length of vectors.
    rows = rows.join(sizes, "size")
    # Equal vectors of one id would crowd a shard; a second hash spreads whatever shares an id.
    shard, group = F.expr("pmod(xxhash64(id, values), shards)"), F.expr("pmod(xxhash64(id), groups)")
    index = rows.select(
        "size", "id", "values", shard.cast("int").alias("shard"), F.explode(F.sequence(F.lit(0), F.col("groups") - 1)).alias("part")
    )
    # Aliases make these columns of their own, apart from those of the index.
    queries = rows.where(asked).dropDuplicates(["size", "id"]).select(
        *(F.col(c).alias(c) for c in ("size", "id", "values")), F.explode(F.sequence(F.lit(0), F.col("shards") - 1)).alias("shard"), group.cast("int").alias("part")
    )
    keys = ["size", "shard", "part"]
    found = index.groupBy(keys).cogroup(queries.groupBy(keys)).applyInArrow(
        _search(k), "query_id long, vec_id long, score long"
    )
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
