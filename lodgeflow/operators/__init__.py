from lodgeflow.operators.ledger import Ledger, in_minutes
from lodgeflow.operators.orders import (
    clean_order_lines,
    order_lines_extract,
    top_order_lines,
)
from lodgeflow.operators.popularity import (
    bookings_per_listing,
    counts_per_listing,
    daily_counts,
    reviews_per_listing,
    top_k,
)
from lodgeflow.operators.positions import row_positions
from lodgeflow.operators.quality import anomaly_counts, row_anomalies
from lodgeflow.operators.scores import avg_page_visits, avg_review_score
from lodgeflow.operators.snapshots import snapshot_bookings
from lodgeflow.operators.windows import (
    in_range,
    means_of_partials,
    rows_in_range,
    sliding_mean,
    tumbling_count,
)

__all__ = [
    "Ledger",
    "anomaly_counts",
    "avg_page_visits",
    "avg_review_score",
    "bookings_per_listing",
    "clean_order_lines",
    "counts_per_listing",
    "daily_counts",
    "in_minutes",
    "in_range",
    "means_of_partials",
    "order_lines_extract",
    "reviews_per_listing",
    "row_anomalies",
    "row_positions",
    "rows_in_range",
    "sliding_mean",
    "snapshot_bookings",
    "top_k",
    "top_order_lines",
    "tumbling_count",
]
