from lodgeflow.functions.checks import VALID_STATUSES, Rule, anomaly_messages, booking_rules, is_missing
from lodgeflow.functions.cleaning import clean_currency, order_month, order_year, to_score
from lodgeflow.functions.sums import exact_mean, exact_parts, exact_sum, mean_of_parts, merged_parts
from lodgeflow.functions.timestamps import (
    MINUTE_STAMPS,
    batch_minute_from_path,
    day_stamp,
    minute_end,
    minute_stamp,
    minute_start,
    month_stamp,
    time_text,
)

__all__ = [
    "MINUTE_STAMPS",
    "VALID_STATUSES",
    "Rule",
    "anomaly_messages",
    "batch_minute_from_path",
    "booking_rules",
    "clean_currency",
    "day_stamp",
    "exact_mean",
    "exact_parts",
    "exact_sum",
    "is_missing",
    "mean_of_parts",
    "merged_parts",
    "minute_end",
    "minute_stamp",
    "minute_start",
    "month_stamp",
    "order_month",
    "order_year",
    "time_text",
    "to_score",
]
