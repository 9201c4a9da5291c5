"""File scans. Any Hadoop file-system URI works: local, ``s3a://``, ``hdfs://``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from lodgeflow.functions.timestamps import batch_minute_from_path

#: Stands for null where a blank field can't: a character that Unicode reserves for such use.
NULL = "\ufdd0"

#: RFC-4180 text: quotes inside a field are doubled, fields may hold newlines.
#: A blank field is null and a quoted blank is the empty text.
QUOTED = {"sep": ",", "quote": '"', "escape": '"', "mode": "PERMISSIVE", "nullValue": NULL, "emptyValue": ""}

#: For files of other origin, where a quoted blank means null as a plain one does.
FOREIGN = {"nullValue": ""}

#: Microseconds survive a text round trip only with an explicit format.
MICROS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """A Parquet table: columnar, splittable, filters and columns pushed down."""
    return spark.read.parquet(path)


def _typed(raw: DataFrame, schema: StructType, keep: tuple[str, ...] = ()) -> DataFrame:
    """Pick the schema's columns by name; text that does not parse becomes null."""
    typed = [F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schema.fields]
    return raw.select(*typed, *keep)


def read_csv(
    spark: SparkSession,
    path: str | list[str],
    schema: StructType | None = None,
    *,
    header: bool = True,
    infer: bool = False,
    multi_line: bool = True,
    keep: tuple[str, ...] = (),
    **options: str,
) -> DataFrame:
    """Read CSV or, by file extension, compressed CSV.

    With a header, ``schema`` selects columns **by name** and types them with
    ``try_cast``; other columns of a wide file are never parsed, and a file
    whose header differs from the first one is refused instead of being read
    shifted. Without a header ``schema`` is positional. With neither schema nor
    ``infer`` all columns are strings. ``infer`` costs a second pass.

    A blank field is null, a quoted blank the empty text; ``**FOREIGN`` takes
    both for null. ``keep`` names further columns to carry along, such as
    partition columns.
    ``multi_line`` and gzip both make a file one task: for a large table keep
    the files small, pass ``multi_line=False`` where fields hold no newline, or
    land it once as Parquet (:func:`lodgeflow.sinks.write_table`).
    """
    reader = spark.read.options(**{**QUOTED, "multiLine": multi_line, "header": header, **options})
    if not header:
        return reader.schema(schema).csv(path) if schema else reader.csv(path, inferSchema=infer)
    raw = reader.csv(path, enforceSchema=False, inferSchema=infer and schema is None)
    return _typed(raw, schema, keep) if schema else raw


def spread(rows: DataFrame, path: str) -> DataFrame:
    """Rows of a file that only one task can read, dealt to many for what follows.

    That is so for gzip, by the path's extension; other rows are returned as they are.
    """
    return rows.hint("rebalance") if path.rstrip("/").endswith(".gz") else rows


def read_dated(
    spark: SparkSession,
    root: str,
    schema: StructType,
    *,
    dates: list[str] | None = None,
    partition: str = "date",
    **options,
) -> DataFrame:
    """Read CSV files below ``root/<partition>=<value>/`` with the value as a column.

    ``dates`` lists only those directories, which on an object store is cheaper
    than listing the whole root and pruning; a later filter on the partition
    column is pruned as well. No dates give no rows.
    """
    if dates is not None and not dates:
        return spark.createDataFrame([], StructType([*schema.fields, StructField(partition, StringType())]))
    paths = [f"{root.rstrip('/')}/{partition}={d}" for d in dates] if dates else root
    return read_csv(
        spark, paths, schema, keep=(partition,), basePath=root, **options
    ).withColumn(partition, F.col(partition).cast("string"))


def read_minute_csv(
    spark: SparkSession, path: str | list[str], schema: StructType, **options
) -> DataFrame:
    """Read any number of minute files in one job, each row with its ``batch_minute``.

    The minute is the stamp in the file's path, in any of the layouts of
    :data:`lodgeflow.functions.timestamps.MINUTE_STAMPS`.
    """
    rows = read_csv(spark, path, schema, keep=("_metadata",), **options)
    return rows.withColumn(
        "batch_minute", batch_minute_from_path(F.col("_metadata.file_path"))
    ).drop("_metadata")


def read_json_rows(
    spark: SparkSession,
    path: str | list[str],
    schema: StructType,
    *,
    multi_line: bool = True,
    **options: str,
) -> DataFrame:
    """Read files that each hold one JSON array of objects, with their ``batch_minute``.

    ``multi_line=False`` reads JSON Lines instead, which Spark can split.
    """
    rows = spark.read.schema(schema).options(**options).json(path, multiLine=multi_line)
    return rows.select(
        batch_minute_from_path(F.col("_metadata.file_path")).alias("batch_minute"),
        *schema.fieldNames(),
    )


def read_json_batches(
    spark: SparkSession, path: str | list[str], schema: StructType, *, file: str | None = None
) -> DataFrame:
    """As :func:`read_json_rows`, plus ``row_index``: the 0-based place in its file.

    The index comes from the array itself, so no window or shuffle is needed.
    ``file`` names a column for the file's path.
    A file is a minute's batch and is read as one value; broken JSON fails the
    query. For larger batches use JSON Lines and
    :func:`lodgeflow.operators.row_positions`.
    """
    files = spark.read.text(path, wholetext=True)
    files = files.select("value", F.col("_metadata.file_path").alias("file"))
    return json_batches(files, schema, strict=True, file=file)[0]


def json_batches(
    files: DataFrame, schema: StructType, *, strict: bool = False, file: str | None = None
) -> tuple[DataFrame, DataFrame]:
    """The rows of ``files`` (``value``: a JSON array, ``file``: its path), and the files that hold none.

    ``strict`` makes a broken file an error instead.
    """
    array = f"array<{schema.simpleString()}>"
    mode = "FAILFAST" if strict else "PERMISSIVE"
    batch = F.from_json("value", array, {"mode": mode})
    rows = files.select(
        batch_minute_from_path(F.col("file")).alias("batch_minute"),
        *([F.col("file").alias(file)] if file else []),
        F.posexplode(batch).alias("row_index", "row"),
    ).select(
        "batch_minute", F.col("row_index").cast("bigint").alias("row_index"), *([file] if file else []), "row.*"
    )
    return rows, files.where(batch.isNull())
