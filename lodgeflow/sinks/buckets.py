"""Bucketed tables: rows that share a key's hash lie together, so joins on the key need no shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def write_bucketed(
    rows: DataFrame, name: str, path: str, keys: list[str], *, buckets: int, mode: str = "errorifexists"
) -> DataFrame:
    """Write table ``name`` to ``path`` in ``buckets`` by ``keys``; return it.

    One file per bucket, from one shuffle, sorted by the keys. Tables that are
    joined need the same number of buckets. Reading a bucket is one task, so the
    rows of a key must be few: write sums per key and day rather than the facts
    (:func:`lodgeflow.operators.daily_counts`).
    """
    rows.repartition(buckets, *keys).write.mode(mode).bucketBy(buckets, *keys).sortBy(*keys).option("path", path).saveAsTable(name)
    return rows.sparkSession.table(name)


def attach_bucketed(
    spark: SparkSession, name: str, path: str, schema: str, keys: list[str], *, buckets: int
) -> DataFrame:
    """Make files that :func:`write_bucketed` wrote known to another session's catalog as ``name``."""
    by = ", ".join(f"`{k}`" for k in keys)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({schema}) USING parquet "
        f"CLUSTERED BY ({by}) SORTED BY ({by}) INTO {int(buckets)} BUCKETS LOCATION '{path}'"
    )
    return spark.table(name)
