"""Plain table readers and writers, and the few file operations that are not Spark jobs."""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession

from civicflow import contracts
from civicflow.operators.summaries import latest_rows

PROCESSED_COLUMNS = contracts.names(contracts.RAW_FEED) + contracts.names(contracts.DERIVED_FIELDS)


def write_parquet(df: DataFrame, path: str) -> None:
    """Replace the Parquet dataset at ``path``, stale parts included."""
    df.write.mode("overwrite").parquet(path)


def read_processed(spark: SparkSession, path: str) -> DataFrame:
    """Clean cases as a transform run wrote them, in contract column order."""
    return spark.read.parquet(path).select(*PROCESSED_COLUMNS)


def write_preview(df: DataFrame, path: str, rows: int = contracts.PREVIEW_ROWS) -> None:
    """The newest ``rows`` cases as one CSV file with a header."""
    preview = latest_rows(df, contracts.PREVIEW_COLUMNS, rows)
    preview.coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path exists, on whichever file system it names."""
    file_system, hadoop_path = _located(spark, path)
    return file_system.exists(hadoop_path)


def delete_path(spark: SparkSession, path: str) -> bool:
    """Delete a path with everything below it; false when there was nothing."""
    file_system, hadoop_path = _located(spark, path)
    return file_system.delete(hadoop_path, True)


def each_file(spark: SparkSession, path: str):
    """Files below a path, one after the other, as the file system lists them."""
    file_system, hadoop_path = _located(spark, path)
    return file_system.listFiles(hadoop_path, True)


def run_paths(spark: SparkSession, root: str, pattern: str) -> list[str]:
    """Directories below ``root`` that match a pattern, relative to it."""
    file_system, hadoop_path = _located(spark, f"{root}/{pattern}")
    depth = pattern.count("/") + 1
    found = file_system.globStatus(hadoop_path) or []
    return sorted("/".join(status.getPath().toString().split("/")[-depth:]) for status in found)


def child_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the files and directories directly below a path; none if it is not there."""
    file_system, hadoop_path = _located(spark, path)
    if not file_system.exists(hadoop_path):
        return []
    return sorted(status.getPath().getName() for status in file_system.listStatus(hadoop_path))


def stored_bytes(spark: SparkSession, path: str) -> int:
    """Size of all files below a path."""
    file_system, hadoop_path = _located(spark, path)
    return file_system.getContentSummary(hadoop_path).getLength()


def read_text(spark: SparkSession, path: str) -> str:
    """A small file as text."""
    file_system, hadoop_path = _located(spark, path)
    stream = file_system.open(hadoop_path)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def create_exclusively(spark: SparkSession, path: str, text: str) -> bool:
    """Write a small file that must not be there yet; false if it is, also for the slower of two
    writers at the same moment.

    The text is written beside it first and then takes the name, whole or not at all: by a hard
    link on a local file system, elsewhere by a rename that replaces nothing.
    """
    jvm = spark.sparkContext._jvm
    file_system, target = _located(spark, path)
    file_system.mkdirs(target.getParent())
    draft = _located(spark, f"{path.rsplit('/', 1)[0]}/.{uuid.uuid4().hex}")[1]
    stream = file_system.create(draft, False)
    try:
        stream.write(text.encode())
    finally:
        stream.close()
    try:
        if file_system.getScheme() == "file":
            local = [jvm.java.nio.file.Path.of(p.toUri().getPath(), _java_array(spark, jvm.String)) for p in (target, draft)]
            jvm.java.nio.file.Files.createLink(*local)
        else:
            context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(file_system.getUri(), file_system.getConf())
            rename = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
            context.rename(draft, target, _java_array(spark, rename))
    except Py4JJavaError as error:
        if "FileAlreadyExists" not in error.java_exception.getClass().getName():
            raise
        return False
    finally:
        file_system.delete(draft, False)
    return True


def _java_array(spark: SparkSession, kind):
    return spark.sparkContext._gateway.new_array(kind, 0)


def _located(spark: SparkSession, path: str):
    hadoop_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hadoop_path


def read_json_log(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON rows appended at ``path``; an empty table when nothing was written yet."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).json(path)


def describe_schema(df: DataFrame) -> DataFrame:
    """One row per column: position, name, type, nullability."""
    fields = [
        (i, f.name, f.dataType.simpleString(), f.nullable) for i, f in enumerate(df.schema.fields, 1)
    ]
    return df.sparkSession.createDataFrame(fields, "position int, name string, type string, nullable boolean")
