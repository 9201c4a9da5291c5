"""End-to-end jobs: read, compute, write. ``python -m lodgeflow <job> --help``."""

from lodgeflow.plans.extracts import extract_order_lines, transform_orders
from lodgeflow.plans.marketplace import (
    BookingStreams,
    arrived_bookings,
    booking_log,
    bookings_from_database,
    bookings_from_minute_files,
    bookings_report,
    catch_up_from_database,
    catch_up_from_minute_files,
    popular_listings,
    review_scores,
    review_scores_from_database,
    stream_bookings,
    waiting_bookings,
    write_arrived_bookings,
)
from lodgeflow.plans.quality import (
    page_visits_report,
    quality_report,
    spoilt_rows_report,
    stream_page_visits,
    stream_quality,
    streamed_anomalies,
    streamed_anomaly_counts,
    streamed_page_visits,
)

__all__ = [
    "BookingStreams",
    "arrived_bookings",
    "booking_log",
    "bookings_from_database",
    "bookings_from_minute_files",
    "bookings_report",
    "catch_up_from_database",
    "catch_up_from_minute_files",
    "extract_order_lines",
    "page_visits_report",
    "popular_listings",
    "quality_report",
    "review_scores",
    "review_scores_from_database",
    "spoilt_rows_report",
    "stream_bookings",
    "stream_page_visits",
    "stream_quality",
    "streamed_anomalies",
    "streamed_anomaly_counts",
    "streamed_page_visits",
    "transform_orders",
    "waiting_bookings",
    "write_arrived_bookings",
]
