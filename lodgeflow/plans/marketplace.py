"""Jobs over listings, reviews and bookings."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timedelta
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from lodgeflow import operators, schemas, sinks, sources, streaming
from lodgeflow.functions import batch_minute_from_path, minute_start, month_stamp, to_score


def _read(spark: SparkSession, path: str, schema: StructType | None, multi_line: bool) -> DataFrame:
    rows = sources.read_csv(spark, path, schema, multi_line=multi_line, **sources.FOREIGN)
    return sources.spread(rows, path)


def popular_listings(
    spark: SparkSession,
    listings: str,
    reviews: str,
    output: str,
    *,
    header: bool = True,
    multi_line: bool = True,
) -> None:
    """Review count per listing, most reviewed first, to new CSV files.

    ``listings`` and ``reviews`` are CSV or gzip CSV files or folders.
    ``multi_line=False`` lets Spark split files whose fields hold no newline.
    """
    named = StructType([schemas.LISTINGS["id"], schemas.LISTINGS["name"]])
    ranked = operators.reviews_per_listing(
        _read(spark, listings, named, multi_line), _read(spark, reviews, schemas.REVIEWS, multi_line)
    )
    sinks.write_csv(ranked, output, header=header)


def bookings_report(
    spark: SparkSession,
    listings_file: str,
    bookings_file: str,
    output_path: str,
    *,
    multi_line: bool = True,
) -> None:
    """Booking count per listing, name and price, replacing the CSV at ``output_path``.

    ``multi_line`` concerns the listings; bookings hold no newlines.
    """
    counts = operators.bookings_per_listing(
        _read(spark, listings_file, schemas.LISTINGS, multi_line),
        _read(spark, bookings_file, schemas.BOOKINGS, False),
    )
    sinks.write_csv(counts, output_path, mode="overwrite")


def _listing_snapshots(spark: SparkSession, root: str, months: list[str] | None = None) -> DataFrame:
    return sources.read_dated(
        spark, root, schemas.LISTINGS, dates=months, partition="snapshot_month", **sources.FOREIGN
    )


def _minute(text: str) -> str:
    return str(datetime.fromisoformat(text).replace(second=0, microsecond=0))


def bookings_from_minute_files(
    spark: SparkSession,
    bookings: str,
    listings_root: str,
    output_path: str,
    *,
    start: str | None = None,
    end: str | None = None,
    layout: str = "underscore",
) -> None:
    """Booking count per minute file and listing, replacing the CSV at ``output_path``.

    ``bookings`` is a glob of files named after their minute, for example
    ``root/*/bookings.csv``; the minute of the name counts, as one run per file
    would have it. With ``start`` and ``end`` it is the root of the minutes'
    folders, of which only those of ``[start, end)`` are listed and read. Each
    minute meets the listings of its month, from
    ``listings_root/snapshot_month=<yyyy-MM>/``.
    """
    if (start is None) != (end is None):
        raise ValueError("start and end belong together")
    months = None
    if start is not None:
        bookings = sources.minute_folders(spark, bookings, sources.minutes_between(start, end), layout)
        months = _months(spark, listings_root, sources.months_between(start, end))
    counts = operators.snapshot_bookings(
        _listing_snapshots(spark, listings_root, months), _minute_bookings(spark, bookings), by="minute", time="batch_minute"
    )
    sinks.write_csv(counts, output_path, mode="overwrite")


def _minute_bookings(spark: SparkSession, bookings: str | list[str]) -> DataFrame:
    if not bookings:
        return spark.createDataFrame([], StructType([*schemas.BOOKINGS.fields, schemas.ANOMALIES["batch_minute"]]))
    return sources.read_minute_csv(spark, bookings, schemas.BOOKINGS, multi_line=False, **sources.FOREIGN)


def _months(spark: SparkSession, listings_root: str, months: list[str]) -> list[str]:
    """Those of ``months`` whose listings are there."""
    found = sources.existing_folders(spark, listings_root, [f"snapshot_month={m}" for m in months])
    return [path.rpartition("=")[2] for path in found]


def catch_up_from_minute_files(
    spark: SparkSession, bookings_root: str, listings_root: str, ledger: str, start: str, end: str, *, layout: str = "underscore"
) -> None:
    """:func:`bookings_from_minute_files` for the minutes of ``[start, end)`` that the ledger lacks.

    A minute is finished once its folder and the listings of its month are there;
    other minutes are left to a later run. Read the result with
    ``operators.Ledger(ledger).rows(spark)``.
    """

    def read(minutes: DataFrame) -> tuple[DataFrame, DataFrame]:
        asked = [r.minute for r in minutes.collect()]  # of the range asked for
        folders = sources.minute_folders(spark, bookings_root, asked, layout)
        stamped = spark.createDataFrame([(f,) for f in folders], "path string")
        there = stamped.select(batch_minute_from_path(F.col("path")).alias("minute"))
        return _minute_bookings(spark, folders), there

    _catch_up(spark, listings_root, ledger, start, end, read, "batch_minute")


def catch_up_from_database(
    spark: SparkSession, url: str, listings_root: str, ledger: str, start: str, end: str, *, table: str = "bookings", **options: str
) -> None:
    """:func:`bookings_from_database` for the minutes of ``[start, end)`` that the ledger lacks.

    Only ranges of missing minutes whose month has listings are read.
    """

    def read(minutes: DataFrame) -> tuple[DataFrame, DataFrame]:
        span = sources.RangeRead("booking_time", _minute(start), _minute(end), options=options)
        rows = sources.read_jdbc_range(spark, url, table, schemas.BOOKINGS.fieldNames(), span)
        return rows.where(operators.in_minutes(F.col("booking_time"), minutes)), minutes

    _catch_up(spark, listings_root, ledger, start, end, read, "booking_time")


def _catch_up(
    spark: SparkSession,
    listings_root: str,
    ledger: str,
    start: str,
    end: str,
    read: Callable[[DataFrame], tuple[DataFrame, DataFrame]],
    time: str,
) -> None:
    """``read`` gives the bookings of the minutes it gets, and which of these minutes it has found."""
    book = operators.Ledger(ledger)
    book.open(spark)
    months = _months(spark, listings_root, sources.months_between(start, end))
    known = month_stamp(F.col("minute")).isin(months)
    missing = book.missing(spark, start, end).where(known)
    if not missing.take(1):
        return
    rows, minutes = read(missing)
    rows = rows.withColumn("minute", minute_start(F.col(time))).join(minutes, "minute", "left_semi").drop("minute")
    snapshots = _listing_snapshots(spark, listings_root, months)
    book.publish(operators.snapshot_bookings(snapshots, rows, by="minute", time=time), minutes)


def bookings_from_database(
    spark: SparkSession,
    url: str,
    listings_root: str,
    output_path: str,
    start: str,
    end: str,
    *,
    table: str = "bookings",
    **options: str,
) -> None:
    """Booking count per minute and listing for all bookings in ``[start, end)``, both cut to the minute.

    One job covers any number of minutes. Each booking meets the listings of
    its own month, from ``listings_root/snapshot_month=<yyyy-MM>/``.
    """
    span = sources.RangeRead("booking_time", _minute(start), _minute(end), options=options)
    bookings = sources.read_jdbc_range(spark, url, table, schemas.BOOKINGS.fieldNames(), span)
    counts = operators.snapshot_bookings(
        _listing_snapshots(spark, listings_root, _months(spark, listings_root, sources.months_between(start, end))),
        bookings,
        by="minute",
    )
    sinks.write_csv(counts, output_path, mode="overwrite")


def review_scores(
    spark: SparkSession, customer_reviews: str, output_path: str, *, multi_line: bool = True
) -> None:
    """Mean score per listing from a reviews CSV, replacing the CSV at ``output_path``."""
    reviews = _read(spark, customer_reviews, None, multi_line)
    sinks.write_csv(operators.avg_review_score(reviews), output_path, mode="overwrite")


def review_scores_from_database(
    spark: SparkSession,
    url: str,
    output_path: str,
    start: str,
    end: str,
    *,
    table: str = "customer_reviews",
    **options: str,
) -> None:
    """Mean score per listing for every one-hour window starting in ``[start, end)``, cut to the minute."""
    start, end = _minute(start), _minute(end)
    read_end = str(datetime.fromisoformat(end) + timedelta(hours=1))
    span = sources.RangeRead("review_date", start, read_end, options=options)
    reviews = sources.read_jdbc_range(
        spark, url, table, schemas.CUSTOMER_REVIEWS.fieldNames(), span
    )
    scores = hourly_scores(reviews, start, end)
    sinks.write_csv(scores, output_path, mode="overwrite")


def hourly_scores(reviews: DataFrame, start: str, end: str) -> DataFrame:
    """Sliding one-hour means of ``review_score`` whose window starts in ``[start, end)``."""
    means = operators.sliding_mean(
        reviews, "review_date", ["listing_id"], to_score(F.col("review_score")), "avg_review_score"
    )
    type_ = means.schema["window_start"].dataType
    first, last = (F.lit(t).cast(type_) for t in (start, end))
    return means.where(operators.in_range(F.col("window_start"), first, last))


class BookingStreams(NamedTuple):
    """The running queries of :func:`stream_bookings`."""

    listings: StreamingQuery
    bookings: StreamingQuery

    def awaitTermination(self) -> None:  # noqa: N802  as the queries' own
        for query in self:
            query.awaitTermination()

    def stop(self) -> None:
        for query in self:
            query.stop()


def booking_log(log: str, delay: str = "1 hour") -> streaming.CountLog:
    """The log of bookings per minute and listing under ``log``."""
    counted = {"booking_count": F.count("booking_id")}
    return streaming.CountLog(f"{log}/bookings", schemas.BOOKINGS, "booking_time", ("listing_id",), counted, delay=delay)


def stream_bookings(
    spark: SparkSession,
    bookings_root: str,
    listings_root: str,
    log: str,
    checkpoint: str,
    *,
    delay: str = "1 hour",
    every: str | None = None,
    max_files: int | None = None,
) -> BookingStreams:
    """Log bookings per minute and listing, and the listings of each month, as their CSV files arrive.

    Neither waits for the other: bookings stay in the log until the listings of
    their month are there, from ``listings_root/snapshot_month=<yyyy-MM>/``, and
    meet them in :func:`arrived_bookings`. Bookings later than ``delay`` go to the
    log's side table, from which ``booking_log(log).fold_late(spark)`` takes them.
    """
    arriving = streaming.file_stream(spark, bookings_root, schemas.BOOKINGS, "csv", max_files=max_files)
    return BookingStreams(
        streaming.land_snapshots(
            spark, listings_root, f"{log}/listings", f"{checkpoint}/listings", schemas.LISTINGS, every=every
        ),
        booking_log(log, delay).write(arriving, f"{checkpoint}/bookings", every=every),
    )


def arrived_bookings(spark: SparkSession, log: str) -> DataFrame:
    """Booking count per minute and listing of all months whose listings have arrived."""
    counts = booking_log(log).rows(spark)
    return streaming.join_snapshots(counts, streaming.landed_snapshots(spark, f"{log}/listings"), "booking_count")


def waiting_bookings(spark: SparkSession, log: str) -> DataFrame:
    """Bookings per month that has no listings yet."""
    months = streaming.landed_snapshots(spark, f"{log}/listings").select("snapshot_month").distinct()
    counts = booking_log(log).rows(spark).withColumn("snapshot_month", month_stamp(F.col("window_start")))
    by_month = counts.groupBy("snapshot_month").agg(F.sum("booking_count").alias("booking_count"))
    return by_month.join(months, "snapshot_month", "left_anti")


def write_arrived_bookings(spark: SparkSession, log: str, output_path: str, *, fold_late: bool = False) -> None:
    """:func:`arrived_bookings` as CSV, replacing the one at ``output_path``; ``fold_late`` takes late rows in first."""
    if fold_late:
        booking_log(log).fold_late(spark)
    sinks.write_csv(arrived_bookings(spark, log), output_path, mode="overwrite")
