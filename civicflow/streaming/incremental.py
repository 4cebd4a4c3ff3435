"""Pick up newly landed files as a stream and merge each micro-batch into the star schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from civicflow import contracts
from civicflow.operators import quality
from civicflow.plans.load import load_star
from civicflow.plans.transform import ACCEPTED, EXPANSION, QUARANTINED, judge, stage_clean
from civicflow.session import configure, copied, sized_shuffles, task_limits
from civicflow.sources import landing, snapshots, tables


def landed_stream(
    spark: SparkSession, root: str, max_files: int | None = None, max_bytes: int | None = None
) -> DataFrame:
    """The landing zone as a streaming source; the checkpoint remembers which files were read.

    One micro-batch takes everything new, unless ``max_files`` or ``max_bytes`` splits a
    backlog.
    """
    reader = (
        spark.readStream.schema(landing.landing_schema())
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", contracts.CORRUPT_COLUMN)
        .option("pathGlobFilter", landing.RAW_FILES)
    )
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if max_bytes is not None:
        reader = reader.option("maxBytesPerTrigger", max_bytes)
    return reader.json(root)


def stream_id(spark: SparkSession, checkpoint: str) -> str:
    """The identity of a stream, as its checkpoint keeps it."""
    return spark.read.schema("id string").json(f"{checkpoint}/metadata").first()["id"]


def process_batch(
    batch: DataFrame,
    name: str,
    work_root: str,
    warehouse_root: str,
    quarantine: bool = False,
    keep_versions: int | None = None,
    max_corrupt: float = contracts.MAX_CORRUPT_RATE,
    max_quarantined: float = contracts.MAX_QUARANTINE_RATE,
) -> None:
    """Clean, check and merge one micro-batch; running it again under its name changes nothing.

    The clean rows are written under the batch's own path, where a repeat replaces them and
    which goes after the load; the load skips a batch it has committed. With ``quarantine`` the rows
    set apart are committed with the batch, to a table that no later load or expiry takes them from
    (:func:`civicflow.plans.load.read_quarantine`). A hard failure raises, which stops the stream
    with the batch unread. A batch without rows is not loaded; one that was set apart whole is.
    """
    spark = batch.sparkSession
    if snapshots.committed(spark, warehouse_root, name):
        return
    path = f"{work_root}/{name}"
    numbered = batch.withColumn(landing.ROW_ID, landing.scan_position())
    staged = stage_clean(numbered, path, landing.ROW_ID)
    checks = [*quality.default_checks(), quality.corrupt_rate()]
    with sized_shuffles(staged, EXPANSION):
        result = judge(staged, checks, quarantine, max_corrupt, max_quarantined)
    quality.require_pass(result)
    apart = staged.where(F.col("disposition") == QUARANTINED).drop("disposition") if quarantine else None
    if result.row_count or (apart is not None and not apart.isEmpty()):
        accepted = staged.where(F.col("disposition") == ACCEPTED).select(*tables.PROCESSED_COLUMNS)
        load_star(spark, accepted, warehouse_root, batch_id=name, keep_versions=keep_versions, quarantined=apart)
    tables.delete_path(spark, path)


def start(
    spark: SparkSession,
    raw_root: str,
    warehouse_root: str,
    work_root: str,
    *,
    max_files: int | None = None,
    max_bytes: int | None = None,
    **batch_options,
) -> StreamingQuery:
    """Process everything landed since the last start, then stop (``availableNow``).

    ``work_root`` holds the checkpoint and the staged batches. A batch is named by the stream's
    identity and its number, so a stream with another checkpoint is another stream: it reads
    everything landed and merges it again, which neither skips nor repeats a case.
    ``batch_options`` go to :func:`process_batch`. The stream runs in a copy of the session, in which
    a scan packs only so many of the compressed files into one task.
    """
    spark = configure(copied(spark))
    checkpoint = f"{work_root}/checkpoint"

    def handle(batch: DataFrame, batch_id: int) -> None:
        name = f"{stream_id(spark, checkpoint)}-{batch_id}"
        process_batch(batch, name, f"{work_root}/staged", warehouse_root, **batch_options)

    for key, value in task_limits(spark, EXPANSION).items():
        spark.conf.set(key, str(value))
    return (
        landed_stream(spark, raw_root, max_files, max_bytes)
        .writeStream.foreachBatch(handle)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
