"""Means per listing and per minute batch."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodgeflow.functions.cleaning import to_score
from lodgeflow.functions.sums import exact_mean


def avg_review_score(
    reviews: DataFrame, listing: str = "listing_id", score: str = "review_score"
) -> DataFrame:
    """``listing_id, avg_review_score``: scores as 32-bit floats, bad ones left out.

    A listing with no usable score stays, with a null mean. A mean has the same
    bits however the reviews are spread over files and tasks.
    """
    return reviews.groupBy(F.col(listing).alias("listing_id")).agg(
        exact_mean(to_score(F.col(score))).alias("avg_review_score")
    )


def avg_page_visits(visits: DataFrame, batch: str | None = None) -> DataFrame:
    """Mean ``page_visits``, overall or per ``batch`` column. No rows give null."""
    grouped = visits.groupBy(batch) if batch else visits.groupBy()
    return grouped.agg(F.avg("page_visits").alias("avg_page_visits"))
