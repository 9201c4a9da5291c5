"""Whole files as they arrive: monthly snapshots and JSON arrays.

Such files cannot be read as rows of a stream, because they are wide (columns are
picked by name) or because a file is one value. So the stream is one of file
names, and each micro-batch reads the files it has got.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StringType, StructField, StructType

from lodgeflow.sources.files import FOREIGN, json_batches, read_csv
from lodgeflow.streaming.minutes import started


def file_names(
    spark: SparkSession, path: str, *, max_files: int | None = None, only: str | None = None
) -> DataFrame:
    """``path`` and ``length`` of the files that arrive in folders of any depth; contents are not read."""
    options = {"recursiveFileLookup": True}
    if max_files:
        options["maxFilesPerTrigger"] = max_files
    if only:
        options["pathGlobFilter"] = only
    schema = "path string, modificationTime timestamp, length bigint, content binary"
    files = spark.readStream.format("binaryFile").schema(schema).options(**options).load(path)
    return files.select("path", "length")


def land_snapshots(
    spark: SparkSession,
    root: str,
    table: str,
    checkpoint: str,
    schema: StructType,
    *,
    partition: str = "snapshot_month",
    every: str | None = None,
    max_files: int | None = 64,
    **options,
) -> StreamingQuery:
    """Land the CSV files that arrive under ``root/<partition>=<value>/`` as Parquet, each file once.

    Read the table with :func:`landed_snapshots`, also while the query runs and
    before anything has arrived. A file that is replaced under its old name is
    not read again.
    """

    def put(names: DataFrame, batch_id: int) -> None:
        paths = [r.path for r in names.collect()]  # of one micro-batch: at most max_files
        if paths:
            rows = read_csv(spark, paths, schema, keep=("_metadata",), **{**FOREIGN, **options})
            month = F.regexp_extract("_metadata.file_path", f"/{partition}=([^/]+)/", 1)
            rows = rows.withColumn(partition, month).drop("_metadata")
            rows.hint("rebalance").write.mode("overwrite").parquet(f"{table}/batch_id={batch_id}")

    empty = StructType([*schema.fields, StructField(partition, StringType())])
    spark.createDataFrame([], empty).write.mode("overwrite").parquet(f"{table}/batch_id=-1")
    return started(file_names(spark, root, max_files=max_files).writeStream.foreachBatch(put), checkpoint, every)


def landed_snapshots(spark: SparkSession, table: str) -> DataFrame:
    return spark.read.parquet(table).drop("batch_id")


def each_array(
    spark: SparkSession,
    path: str,
    schema: StructType,
    put: Callable[[DataFrame, int], None],
    checkpoint: str,
    *,
    broken: str,
    every: str | None = None,
    max_files: int | None = None,
    only: str | None = None,
) -> StreamingQuery:
    """Call ``put(rows, batch_id)`` with the rows of arriving files that each hold one JSON array.

    The rows are those of :func:`lodgeflow.sources.read_json_batches`:
    ``batch_minute``, the 0-based ``row_index`` in the file, and ``schema``, whose
    fields may be VARIANT. A file that is no such array does not stop the stream;
    its name and text go to ``broken``. ``put`` must replace what it wrote for the
    same ``batch_id``.
    """
    options = {"recursiveFileLookup": True, "wholetext": True}
    if max_files:
        options["maxFilesPerTrigger"] = max_files
    if only:
        options["pathGlobFilter"] = only
    files = spark.readStream.format("text").options(**options).load(path)
    files = files.select("value", F.col("_metadata.file_path").alias("file"))

    def split(batch: DataFrame, batch_id: int) -> None:
        rows, unread = json_batches(batch, schema)
        put(rows, batch_id)
        unread.write.mode("overwrite").json(f"{broken}/batch_id={batch_id}")

    return started(files.writeStream.foreachBatch(split), checkpoint, every)
