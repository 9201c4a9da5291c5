"""Jobs over minute batches of JSON, and over CSV rows that do not fit their schema."""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from lodgeflow import operators, schemas, sinks, sources, streaming
from lodgeflow.functions import VALID_STATUSES, anomaly_messages, booking_rules
from lodgeflow.session import scratch_dir

log = logging.getLogger(__name__)


def quality_report(
    spark: SparkSession, bookings: str, output_path: str, *, mode: str = "overwrite"
) -> DataFrame:
    """Write the anomalies of all booking batches and their number per batch; return the latter.

    ``bookings`` is a glob of JSON array files, one per minute, for example
    ``root/*/bookings.json``. ``output_path/anomalies`` holds one JSON object
    per bad row, in a directory per day, ``output_path/counts`` one per batch.
    The files are read once, so both agree while more arrive.
    """
    rows = sources.read_json_batches(spark, bookings, schemas.DIRTY_BOOKINGS)
    checked = rows.select("batch_minute", "row_index", anomaly_messages(booking_rules(rows)).alias("anomalies"))
    landed = scratch_dir(spark, "checked")
    sinks.write_table(checked, landed)
    checked = sources.read_table(spark, landed)
    bad = checked.where(F.size("anomalies") > 0).withColumn("day", F.to_date("batch_minute"))
    sinks.write_json(
        bad.hint("rebalance", F.col("day")), f"{output_path}/anomalies", mode=mode, partition_by=["day"]
    )
    counts = checked.groupBy("batch_minute").agg(F.count_if(F.size("anomalies") > 0).alias("num_anomalies"))
    sinks.write_json(counts, f"{output_path}/counts", mode=mode)
    return counts


def spoilt_rows_report(
    spark: SparkSession, path: str, schema: StructType, output_path: str, *, multi_line: bool = True
) -> dict[str, int]:
    """Write the records of a CSV that its schema would spoil as JSON; return the counts of all its rows.

    Each line of ``output_path`` holds a record's values, and under ``_rescued``
    the problem, the whole record and the texts that became null. The counts are
    those of :func:`lodgeflow.sources.rescued_counts`, taken in the same pass.
    """
    seen = Observation()
    counts = [c.alias(name) for name, c in sources.rescued_counts(schema).items()]
    rows = sources.read_csv_rescued(spark, path, schema, multi_line=multi_line, **sources.FOREIGN).observe(seen, *counts)
    sinks.write_json(rows.where(F.col("_rescued").isNotNull()), output_path, mode="overwrite")
    found = seen.get
    log.info("%s: %s", path, ", ".join(f"{name} {n}" for name, n in found.items()))
    return found


def page_visits_report(
    spark: SparkSession, visits: str, output_path: str, *, mode: str = "overwrite"
) -> DataFrame:
    """Write and return the mean page visits per minute batch of a glob of JSON array files."""
    rows = sources.read_json_rows(spark, visits, schemas.PAGE_VISITS)
    means = operators.avg_page_visits(rows, "batch_minute")
    sinks.write_json(means, output_path, mode=mode)
    return means


def stream_quality(
    spark: SparkSession,
    bookings_root: str,
    output_path: str,
    checkpoint: str,
    *,
    statuses: tuple[str, ...] = VALID_STATUSES,
    every: str | None = None,
    max_files: int | None = None,
    only: str | None = None,
) -> StreamingQuery:
    """:func:`quality_report` as booking batches arrive, each file once.

    ``output_path/checked/batch_id=<n>`` holds ``batch_minute, row_index,
    anomalies`` of every row of a micro-batch, clean ones with no message; files
    that are no JSON array go to ``output_path/broken``. Read the report with
    :func:`streamed_anomalies` and :func:`streamed_anomaly_counts`.
    """
    schema = schemas.DIRTY_BOOKINGS

    def put(rows: DataFrame, batch_id: int) -> None:
        found = anomaly_messages(booking_rules(rows, valid_statuses=statuses)).alias("anomalies")
        checked = rows.select("batch_minute", "row_index", found)
        checked.write.mode("overwrite").parquet(f"{output_path}/checked/batch_id={batch_id}")

    nothing = spark.createDataFrame([], schemas.ANOMALIES)
    nothing.write.mode("overwrite").parquet(f"{output_path}/checked/batch_id=-1")
    return streaming.each_array(
        spark, bookings_root, schema, put, checkpoint,
        broken=f"{output_path}/broken", every=every, max_files=max_files, only=only,
    )


def streamed_anomalies(spark: SparkSession, output_path: str) -> DataFrame:
    """``batch_minute, row_index, anomalies`` of the rows that broke a rule so far."""
    checked = sources.read_table(spark, f"{output_path}/checked").drop("batch_id")
    return checked.where(F.size("anomalies") > 0)


def streamed_anomaly_counts(spark: SparkSession, output_path: str) -> DataFrame:
    """Bad rows per batch so far; 0 for a clean batch."""
    checked = sources.read_table(spark, f"{output_path}/checked")
    return checked.groupBy("batch_minute").agg(F.count_if(F.size("anomalies") > 0).alias("num_anomalies"))


def stream_page_visits(
    spark: SparkSession,
    visits_root: str,
    output_path: str,
    checkpoint: str,
    *,
    every: str | None = None,
    max_files: int | None = None,
    only: str | None = None,
) -> StreamingQuery:
    """Sums of page visits per minute batch as files arrive; read means with :func:`streamed_page_visits`."""

    def put(rows: DataFrame, batch_id: int) -> None:
        sums = rows.groupBy("batch_minute").agg(F.sum("page_visits").alias("visits"), F.count("page_visits").alias("n"))
        sums.write.mode("overwrite").parquet(f"{output_path}/sums/batch_id={batch_id}")

    nothing = spark.createDataFrame([], "batch_minute timestamp_ntz, visits bigint, n bigint")
    nothing.write.mode("overwrite").parquet(f"{output_path}/sums/batch_id=-1")
    return streaming.each_array(
        spark, visits_root, schemas.PAGE_VISITS, put, checkpoint,
        broken=f"{output_path}/broken", every=every, max_files=max_files, only=only,
    )


def streamed_page_visits(spark: SparkSession, output_path: str) -> DataFrame:
    """Mean page visits per minute batch so far."""
    sums = sources.read_table(spark, f"{output_path}/sums").groupBy("batch_minute")
    return sums.agg(F.try_divide(F.sum("visits"), F.sum("n")).alias("avg_page_visits"))
