"""Connected components of a link table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civicflow.session import scratch_dir
from civicflow.sources.tables import delete_path


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written below the shared folder and read again: later plans start from the files."""
    path = scratch_dir(df.sparkSession, name)
    df.write.parquet(path)
    table = df.sparkSession.read.schema(df.schema).parquet(path)
    table.stored_at = path
    return table


def discard(table: DataFrame) -> None:
    """Delete what ``stored`` wrote, once nothing that is still to run reads it."""
    delete_path(table.sparkSession, table.stored_at)


def _state(edges: DataFrame) -> tuple:
    hashed = F.xxhash64("node", "root").cast("decimal(38,0)")
    return tuple(edges.agg(F.count("*"), F.sum(hashed)).first())


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (a, b) that is not its own root; the root is the
    smallest id of the node's component.

    Every round keeps the components and brings each node nearer to its root; a round that changes
    nothing ends the loop. Rounds are stored, so a lost executor costs one round at most. Groups
    are only aggregated and joined, never held by one task.
    """
    high, low = F.greatest("a", "b").alias("node"), F.least("a", "b").alias("root")
    edges = stored(links.where("a <> b").select(high, low).distinct(), "links")
    before = _state(edges)
    while before[0]:
        both = edges.select(F.col("node").alias("u"), F.col("root").alias("v")).unionAll(
            edges.select(F.col("root").alias("u"), F.col("node").alias("v"))
        )
        least = both.groupBy("u").agg(F.min("v").alias("m"))
        least = least.select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("node"), F.col("m").alias("root"))
        large = large.distinct()
        lowest = large.groupBy("node").agg(F.min("root").alias("m"))
        small = large.join(lowest, "node").where("root <> m").select(F.col("root").alias("node"), F.col("m").alias("root"))
        small = small.unionAll(lowest.select("node", F.col("m").alias("root"))).distinct()
        edges = stored(small, "links")
        after = _state(edges)
        if after == before:
            break
        before = after
    return edges
