"""The minute cadence as Structured Streaming queries over arriving files.

State is one row per open window and key; the watermark bounds how long a
window stays open and thereby which late rows still count.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener
from pyspark.sql.types import StructType

from lodgeflow.functions.cleaning import to_score
from lodgeflow.functions.sums import exact_parts, merged_parts
from lodgeflow.functions.timestamps import month_stamp
from lodgeflow.operators.popularity import join_copies
from lodgeflow.operators.windows import means_of_partials
from lodgeflow.sources.files import QUOTED


def file_stream(
    spark: SparkSession,
    path: str,
    schema: StructType,
    fmt: str = "parquet",
    *,
    max_files: int | None = None,
    only: str | None = None,
    **options,
) -> DataFrame:
    """Rows of the files that arrive under ``path``, each file once.

    CSV and JSON files may arrive in folders of any depth, such as one per
    minute. ``only`` is a glob of file names to take. ``max_files`` bounds a
    micro-batch. CSV is read with a header and quoted fields, which may hold
    newlines with ``multiLine=True``, with ``schema`` in the files' column order.
    """
    if fmt == "csv":
        options = {**QUOTED, "header": True, "enforceSchema": False, **options}
    if fmt in ("csv", "json"):
        options = {"recursiveFileLookup": True, **options}
    if max_files:
        options["maxFilesPerTrigger"] = max_files
    if only:
        options["pathGlobFilter"] = only
    return spark.readStream.format(fmt).schema(schema).options(**options).load(path)


def as_event_time(rows: DataFrame, ts: str, delay: str) -> DataFrame:
    """Make ``ts`` the event time, accepting rows up to ``delay`` late.

    Watermarks need TIMESTAMP, so a TIMESTAMP_NTZ column is cast under the
    session time zone, which this package sets to UTC.
    """
    return rows.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, delay)


def windowed_counts(
    rows: DataFrame,
    ts: str,
    keys: list[str],
    counted: str,
    name: str,
    *,
    length: str = "1 minute",
    delay: str = "1 hour",
) -> DataFrame:
    """Streaming counterpart of :func:`lodgeflow.operators.tumbling_count`."""
    return (
        as_event_time(rows, ts, delay)
        .groupBy(F.window(ts, length).alias("_window"), *keys)
        .agg(F.count(counted).alias(name))
        .select(F.col("_window.start").cast("timestamp_ntz").alias("window_start"), *keys, name)
    )


def minute_scores(
    rows: DataFrame, ts: str, listing: str, score: Column, *, delay: str = "1 hour"
) -> DataFrame:
    """Exact sum and number of the scores of each listing and minute.

    One row of state per open minute and listing. Write it as updates;
    :func:`hourly_scores` forms the one-hour windows from the log, complete up
    to the newest minute at any time.
    """
    parts = exact_parts(to_score(score))
    return (
        as_event_time(rows, ts, delay)
        .groupBy(F.window(ts, "1 minute").alias("_minute"), F.col(listing).alias("listing_id"))
        .agg(*[part.alias(c) for c, part in parts.items()])
        .select(F.col("_minute.start").cast("timestamp_ntz").alias("_start"), "listing_id", *parts)
    )


def hourly_scores(spark: SparkSession, log: str) -> DataFrame:
    """Mean score per listing over one-hour windows that start every minute, from the log of minutes."""
    return means_of_partials(newest(spark, log, list(merged_parts())), ["listing_id"], "avg_review_score")


def join_listings(
    counts: DataFrame, listings: DataFrame, attributes: list[str], count_name: str
) -> DataFrame:
    """Join streamed counts per ``listing_id`` with the listings table.

    The stream is aggregated before the join, so its state holds no listing
    attributes, and copies of a listing multiply the count as they do in batch.
    """
    keys = [c for c in counts.columns if c != count_name]
    return join_copies(
        listings.withColumnRenamed("id", "listing_id"),
        counts,
        ["listing_id"],
        attributes,
        count_name,
    ).select(*keys, *attributes, count_name)


def join_snapshots(counts: DataFrame, snapshots: DataFrame, count_name: str) -> DataFrame:
    """Join streamed counts per minute and ``listing_id`` with the listings of each minute's month.

    ``snapshots`` holds ``id, name, price, snapshot_month``; months without one
    contribute nothing.
    """
    keys = [c for c in counts.columns if c != count_name]
    return join_copies(
        snapshots.withColumnRenamed("id", "listing_id"),
        counts.withColumn("snapshot_month", month_stamp(F.col("window_start"))),
        ["listing_id", "snapshot_month"],
        ["name", "price"],
        count_name,
    ).select(*keys, "name", "price", count_name)


def started(writer, checkpoint: str, every: str | None) -> StreamingQuery:
    """Start a stream: a micro-batch ``every`` so often, or without it up to the end of the present input."""
    trigger = {"processingTime": every} if every else {"availableNow": True}
    return writer.option("checkpointLocation", checkpoint).trigger(**trigger).start()


def write_updates(
    counts: DataFrame, path: str, checkpoint: str, *, every: str | None = None
) -> StreamingQuery:
    """Keep a log of changed counts under ``path``, one directory per micro-batch.

    A repeated micro-batch replaces its own directory, so a retry after a
    failure leaves no duplicates. :func:`latest_counts` reads the log, also
    before anything has arrived. Without ``every`` the query stops once it has
    seen all present files.
    """

    def put(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    empty = counts.sparkSession.createDataFrame([], counts.schema)
    empty.write.mode("overwrite").parquet(f"{path}/batch_id=-1")
    empty.write.mode("overwrite").parquet(f"{path}_snapshots/upto=-1")
    return started(counts.writeStream.outputMode("update").foreachBatch(put), checkpoint, every)


def newest(spark: SparkSession, path: str, values: list[str]) -> DataFrame:
    """The newest ``values`` of each combination of the other columns in a log.

    Reads the last snapshot and the batches after it.
    """
    return _newest(*_since_snapshot(spark, path), values)


def compact(spark: SparkSession, path: str, values: list[str]) -> int:
    """Write a snapshot of a log up to its last batch but one; return that batch's number.

    The log itself stays, so a running query and other readers are not
    disturbed; batches up to the snapshot are no longer read.
    """
    snapshot, log = _since_snapshot(spark, path)
    (last,) = log.agg(F.max("batch_id")).first()
    upto = (last or 0) - 1
    if upto >= 0:
        rows = _newest(snapshot, log.where(F.col("batch_id") <= upto), values)
        rows.write.mode("overwrite").parquet(f"{path}_snapshots/upto={upto}")
    return upto


def _since_snapshot(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    snapshots, log = spark.read.parquet(f"{path}_snapshots"), spark.read.parquet(path)
    # From the names alone: no file of the snapshots is read for this.
    upto = max(int(f.rstrip("/").rpartition("/upto=")[2].split("/")[0]) for f in snapshots.inputFiles())
    snapshot = snapshots.where(F.col("upto") == upto).withColumnRenamed("upto", "batch_id")
    return snapshot, log.where(F.col("batch_id") > upto)


def _newest(snapshot: DataFrame, log: DataFrame, values: list[str]) -> DataFrame:
    rows = snapshot.unionByName(log)
    keys = [c for c in rows.columns if c not in (*values, "batch_id")]
    last = F.max_by(F.struct(*values), "batch_id").alias("_last")
    return rows.groupBy(*keys).agg(last).select(*keys, "_last.*")


def latest_counts(spark: SparkSession, path: str, count_name: str) -> DataFrame:
    """The newest count of each window and key in a log of :func:`write_updates`."""
    return newest(spark, path, [count_name])


def write_closed(
    rows: DataFrame, path: str, checkpoint: str, *, every: str | None = None
) -> StreamingQuery:
    """Append windows to Parquet once the watermark has closed them.

    Windows still open when the input ends are held back until later rows
    move the watermark on.
    """
    writer = rows.writeStream.outputMode("append").format("parquet").option("path", path)
    return started(writer, checkpoint, every)


class LateRows(StreamingQueryListener):
    """Adds up the rows that queries drop as late: ``spark.streams.addListener(LateRows())``."""

    def __init__(self) -> None:
        self.total = 0

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        self.total += sum(s.numRowsDroppedByWatermark for s in event.progress.stateOperators)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass
