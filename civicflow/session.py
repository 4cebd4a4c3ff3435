"""Session settings the results depend on, and the shared folder for intermediate tables."""

from __future__ import annotations

import contextlib
import math
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession

# Set at run time, so a session somebody else built gives the same results.
# forceOptimizeSkewedJoin lets AQE split a hot join key even where that costs the
# next operator another exchange.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}

# A shuffle partition of this size sorts in an executor's memory share without much spilling.
PARTITION_BYTES = 128 * 1024 * 1024
_INITIAL_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
# What AQE merges partitions up to, and what a scan packs into one task.
_TASK_BYTES = ("spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.files.maxPartitionBytes")

_scratch: dict[str, str] = {}


def configure(spark: SparkSession) -> SparkSession:
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def partitions_for(df: DataFrame, expansion: float = 1.0, partition_bytes: int | None = None) -> int:
    """Shuffle partitions for work on ``df``: by its size, at least the session's own number.

    The size is that of the stored tables ``df`` reads; inputs of unknown size do not count.
    ``expansion`` says how much larger rows are than the files (compressed text, columnar
    encoding). There is no upper bound; on clusters where so many blocks cost more than larger
    partitions do, give a larger ``partition_bytes``.
    """
    spark = df.sparkSession
    unknown = int(spark.conf.get("spark.sql.defaultSizeInBytes", str(2**63 - 1)))
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = [int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size())]
    known = sum(size for size in sizes if size < unknown)
    wanted = math.ceil(known * expansion / (partition_bytes or PARTITION_BYTES))
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), wanted)


def shuffle_partitions(spark: SparkSession) -> int:
    """How many partitions a shuffle starts with."""
    return int(spark.conf.get(_INITIAL_PARTITIONS, None) or spark.conf.get("spark.sql.shuffle.partitions"))


@contextlib.contextmanager
def sized_shuffles(df: DataFrame, expansion: float = 1.0) -> Iterator[None]:
    """Let the tasks of the enclosed jobs hold about PARTITION_BYTES of rows each.

    Shuffles start with enough partitions for ``df``: AQE merges what turns out small, but it
    cannot make partitions smaller than the number a shuffle starts with. Blocks and files are
    compressed, so they are merged and packed only as far as ``expansion`` allows.
    """
    spark = df.sparkSession
    settings = {_INITIAL_PARTITIONS: partitions_for(df, expansion), **task_limits(spark, expansion)}
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, str(value))
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def task_limits(spark: SparkSession, expansion: float) -> dict[str, int]:
    """Settings by which scans pack, and AQE merges, no more into one task than ``expansion`` makes
    PARTITION_BYTES of; never more than the session's own."""
    most = max(1, int(PARTITION_BYTES / expansion))
    in_bytes = spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes
    return {key: min(most, in_bytes(spark.conf.get(key))) for key in _TASK_BYTES}


def copied(spark: SparkSession) -> SparkSession:
    """A session with the settings and views of this one, whose settings change alone."""
    return SparkSession(spark.sparkContext, spark._jsparkSession.cloneSession())


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh path for one intermediate table, below the folder all executors share.

    The folder is the session's ``spark.checkpoint.dir``. Only a local session without
    that setting gets a temporary folder of its own.
    """
    return f"{_scratch_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def _scratch_root(spark: SparkSession) -> str:
    app = spark.sparkContext.applicationId
    if app not in _scratch:
        base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
        if base is None:
            if not spark.sparkContext.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
            base = tempfile.mkdtemp(prefix="civicflow-")
        _scratch[app] = f"{base.rstrip('/')}/civicflow-{app}"
    return _scratch[app]
