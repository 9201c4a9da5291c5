"""Database scans through Spark's JDBC source.

Ranges are DataFrame filters, which Spark turns into the database's own WHERE
clause; no SQL text is put together from values.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F

from lodgeflow.operators.windows import in_range


@dataclass(frozen=True)
class RangeRead:
    """A half-open range of ``column`` read over ``partitions`` connections.

    Bounds are ``yyyy-MM-dd HH:mm:ss`` texts. They also bound the partitioning
    of the read, so each task fetches one slice of the range.
    """

    column: str
    start: str
    end: str
    partitions: int = 16
    fetch_size: int = 10_000
    options: dict[str, str] = field(default_factory=dict)

    def reader_options(self) -> dict[str, str]:
        return {
            "partitionColumn": self.column,
            "lowerBound": self.start,
            "upperBound": self.end,
            "numPartitions": str(self.partitions),
            "fetchsize": str(self.fetch_size),
            "pushDownPredicate": "true",
            **self.options,
        }


def _reader(spark: SparkSession, url: str, options: dict[str, str]) -> DataFrameReader:
    return spark.read.format("jdbc").options(url=url, **options)


def read_jdbc_range(
    spark: SparkSession, url: str, table: str, columns: list[str], span: RangeRead
) -> DataFrame:
    """Read ``columns`` of the rows whose ``span.column`` lies in ``[start, end)``."""
    rows = _reader(spark, url, span.reader_options()).option("dbtable", table).load()
    # Cast the bounds, not the column: a cast on the column would not push down.
    type_ = rows.schema[span.column].dataType
    start, end = (F.lit(bound).cast(type_) for bound in (span.start, span.end))
    return rows.where(in_range(F.col(span.column), start, end)).select(*columns)


def read_jdbc_table(
    spark: SparkSession,
    url: str,
    table: str,
    *,
    key: str | None = None,
    bounds: tuple[int, int] | None = None,
    partitions: int = 16,
    **options: str,
) -> DataFrame:
    """Read a whole table; with a numeric ``key`` and its ``bounds``, in parallel."""
    if key and bounds:
        options |= {
            "partitionColumn": key,
            "lowerBound": str(bounds[0]),
            "upperBound": str(bounds[1]),
            "numPartitions": str(partitions),
        }
    return _reader(spark, url, {"fetchsize": "10000", **options}).option("dbtable", table).load()


def read_jdbc_query(spark: SparkSession, url: str, query: str, **options: str) -> DataFrame:
    """Let the database answer ``query``. The result arrives over one connection."""
    return _reader(spark, url, {"fetchsize": "10000", **options}).option("query", query).load()
