"""File sinks. All refuse an existing target unless told to overwrite it.

Overwriting a whole target writes beside it and then exchanges the two, so a job
that fails leaves the former result (:mod:`lodgeflow.sinks.publish`).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, DataFrameWriter
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from lodgeflow.sinks.publish import replace
from lodgeflow.sources.files import MICROS, NULL, QUOTED

_TIMES = {"timestampFormat": MICROS, "timestampNTZFormat": MICROS}


def _write(
    rows: DataFrame, path: str, mode: str, put: Callable[[DataFrameWriter, str], None], partition_by: list[str] | None = None
) -> None:
    """``put(writer, folder)``: straight to ``path``, or to its successor if ``mode`` is overwrite."""
    def start(mode: str) -> DataFrameWriter:
        writer = rows.write.mode(mode).options(**_TIMES)
        return writer.partitionBy(*partition_by) if partition_by else writer

    if mode == "overwrite":
        replace(rows.sparkSession, path, lambda folder: put(start("errorifexists"), folder))
    else:
        put(start(mode), path)


def write_csv(
    rows: DataFrame,
    path: str,
    *,
    header: bool = False,
    mode: str = "errorifexists",
    compression: str | None = None,
    partition_by: list[str] | None = None,
) -> None:
    """Write CSV part files that :func:`lodgeflow.sources.read_csv` reads back unchanged.

    Quotes are doubled and white space around a text is kept. Other readers see
    null as a blank field and the empty text as a quoted blank. In a file of one
    column a null is written as the reserved character ``NULL``, as readers skip
    blank lines; a text that is just this character is refused.
    """
    columns = [f for f in rows.schema.fields if f.name not in (partition_by or ())]
    texts = [f.name for f in columns if isinstance(f.dataType, StringType)]
    refused = F.raise_error(F.lit("a text is the reserved null marker U+FDD0"))
    rows = rows.withColumns({c: F.when(F.col(c) == NULL, refused).otherwise(F.col(c)) for c in texts})
    options = {
        "quote": QUOTED["quote"],
        "escape": QUOTED["escape"],
        "nullValue": NULL if len(columns) == 1 else "",
        "emptyValue": '""',
        "ignoreLeadingWhiteSpace": False,
        "ignoreTrailingWhiteSpace": False,
    }
    put = lambda writer, folder: writer.options(**options).csv(folder, header=header, compression=compression)
    _write(rows, path, mode, put, partition_by)


def write_raw(rows: DataFrame, root: str, day: str, *, partition: str = "day") -> str:
    """Land one day's extract as CSV with header, replacing that day. Returns its path."""
    path = f"{root.rstrip('/')}/{partition}={day}"
    write_csv(rows, path, header=True, mode="overwrite")
    return path


def write_json(
    rows: DataFrame,
    path: str,
    *,
    mode: str = "errorifexists",
    partition_by: list[str] | None = None,
) -> None:
    """Write JSON Lines; no rows is a valid, empty result."""
    _write(rows, path, mode, lambda writer, folder: writer.json(folder), partition_by)


def write_table(rows: DataFrame, path: str, *, mode: str = "errorifexists") -> None:
    """Land rows as Parquet in evenly sized files, whatever the input files' sizes."""
    _write(rows.hint("rebalance"), path, mode, lambda writer, folder: writer.parquet(folder))


def write_partitioned(
    rows: DataFrame,
    path: str,
    partition_by: list[str],
    *,
    mode: str = "overwrite",
    overwrite: str = "static",
    cluster: bool = True,
) -> None:
    """Write Parquet below one directory per value of ``partition_by``.

    ``overwrite="static"`` replaces the whole target, ``"dynamic"`` only the
    partitions present in ``rows``. ``cluster`` first brings each partition's
    rows together, so a partition gets few files instead of one per task.
    Adaptive execution then splits a partition that is too large for one task,
    which a plain ``repartition`` on the same columns would not do.
    """
    if cluster:
        rows = rows.hint("rebalance", *[F.col(c) for c in partition_by])
    if overwrite == "dynamic":  # Spark itself writes beside the partitions and then exchanges them
        rows.write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by).parquet(path)
    else:
        _write(rows, path, mode, lambda writer, folder: writer.parquet(folder), partition_by)
