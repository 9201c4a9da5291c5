"""Facts counted per listing: reviews and bookings."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def join_copies(
    listings: DataFrame, counts: DataFrame, on: list[str], attributes: list[str], count_name: str
) -> DataFrame:
    """Join counted facts with the listings; ``on`` and ``attributes`` are listing columns.

    Gives what joining single facts and then counting would: listings are
    reduced to one row per key and attributes with its number of copies, and
    the count is multiplied by it. Facts and listings are thus both aggregated
    before they meet, so a listing that holds a large share of the facts, or a
    group of copies that holds a large share of the listings, shrinks inside
    each map task and never travels whole. The copies are shuffled once more
    for the join; grouping within a shuffle by ``on`` alone would save that,
    but send all copies of a listing to one task unreduced.
    """
    copies = listings.groupBy(*on, *attributes).agg(F.count(F.lit(1)).alias("_copies"))
    return copies.join(counts, on).withColumn(count_name, F.col(count_name) * F.col("_copies"))


def reviews_per_listing(listings: DataFrame, reviews: DataFrame) -> DataFrame:
    """``id, name, num_reviews``, most reviewed first, ties by ``id`` and ``name``.

    The tie-break also lets the range partitioning of the sort cut through a
    long run of equal counts.
    """
    counts = reviews.groupBy(F.col("listing_id").alias("_id")).agg(F.count("id").alias("num_reviews"))
    return (
        join_copies(listings, counts.withColumnRenamed("_id", "id"), ["id"], ["name"], "num_reviews")
        .select("id", "name", "num_reviews")
        .orderBy(F.desc("num_reviews"), "id", "name")
    )


def bookings_per_listing(
    listings: DataFrame, bookings: DataFrame, statuses: Iterable[str] | None = None
) -> DataFrame:
    """``listing_id, name, price, booking_count``. All statuses count unless some are named."""
    if statuses is not None:
        bookings = bookings.where(F.col("status").isin(*statuses))
    counts = bookings.groupBy("listing_id").agg(F.count("booking_id").alias("booking_count"))
    return join_copies(
        listings.withColumnRenamed("id", "listing_id"),
        counts,
        ["listing_id"],
        ["name", "price"],
        "booking_count",
    ).select("listing_id", "name", "price", "booking_count")


def daily_counts(facts: DataFrame, counted: str, time: str | None = None) -> DataFrame:
    """Facts per ``listing_id`` and ``day`` as partial counts ``n``, for a bucketed table.

    A listing that holds a third of all facts has no more rows here than there
    are days, so its bucket stays small. Without ``time`` there is one row per
    listing and call, as for one appended delivery.
    """
    keys = ["listing_id"] + ([F.to_date(time).alias("day")] if time else [])
    return facts.groupBy(*keys).agg(F.count(counted).alias("n"))


def counts_per_listing(
    listings: DataFrame, partial: DataFrame, attributes: list[str], count_name: str
) -> DataFrame:
    """``id``, ``attributes`` and the total of the partial counts ``n`` of each listing that has any.

    The same rows as joining single facts and then counting. With both tables
    bucketed by their listing alike, nothing below or in the join is shuffled.
    """
    counts = partial.groupBy(F.col("listing_id").alias("id")).agg(F.sum("n").alias(count_name))
    return join_copies(listings, counts, ["id"], attributes, count_name).select("id", *attributes, count_name)


def top_k(rows: DataFrame, k: int, *order: Column | str) -> DataFrame:
    """The first ``k`` rows in ``order``; each task keeps only its own best ``k``."""
    return rows.orderBy(*order).limit(k)
