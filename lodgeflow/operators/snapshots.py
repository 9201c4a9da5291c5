"""Facts joined with the dimension snapshot of their month."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodgeflow.functions.timestamps import month_stamp
from lodgeflow.operators.popularity import join_copies


def snapshot_bookings(
    snapshots: DataFrame,
    bookings: DataFrame,
    *,
    by: str = "month",
    time: str = "booking_time",
) -> DataFrame:
    """Bookings per listing, each joined with its month's listings snapshot.

    ``snapshots`` holds ``id, name, price, snapshot_month`` (``yyyy-MM``).
    ``by="month"`` counts per month, ``by="minute"`` per ``batch_minute``, for
    any number of minutes and months in one job. Months without a snapshot
    contribute nothing.

    Bookings are grouped by a time value; the month's text is formed once per
    group instead of once per booking.
    """
    if by == "month":
        when, shown = F.trunc(time, "month"), "snapshot_month"
    elif by == "minute":
        when, shown = F.window(time, "1 minute"), "batch_minute"
    else:
        raise ValueError("by must be 'month' or 'minute'")
    counts = bookings.groupBy("listing_id", when.alias("_when")).agg(
        F.count("booking_id").alias("booking_count")
    )
    if by == "minute":
        counts = counts.withColumn("batch_minute", F.col("_when.start"))
    start = F.col("_when" if by == "month" else "batch_minute")
    counts = counts.withColumn("snapshot_month", month_stamp(start)).drop("_when")
    return join_copies(
        snapshots.withColumnRenamed("id", "listing_id"),
        counts,
        ["listing_id", "snapshot_month"],
        ["name", "price"],
        "booking_count",
    ).select(shown, "listing_id", "name", "price", "booking_count")
