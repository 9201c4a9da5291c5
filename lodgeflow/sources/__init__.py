from lodgeflow.sources.files import (
    FOREIGN,
    MICROS,
    json_batches,
    read_csv,
    read_dated,
    read_json_batches,
    read_json_rows,
    read_minute_csv,
    read_table,
    spread,
)
from lodgeflow.sources.jdbc import (
    RangeRead,
    read_jdbc_query,
    read_jdbc_range,
    read_jdbc_table,
)
from lodgeflow.sources.rescue import RESCUED, read_csv_rescued, rescued_counts
from lodgeflow.sources.stamps import existing_folders, minute_folders, minutes_between, months_between

__all__ = [
    "FOREIGN",
    "MICROS",
    "RESCUED",
    "RangeRead",
    "existing_folders",
    "json_batches",
    "minute_folders",
    "minutes_between",
    "months_between",
    "read_csv",
    "read_csv_rescued",
    "read_dated",
    "read_jdbc_query",
    "read_jdbc_range",
    "read_jdbc_table",
    "read_json_batches",
    "read_json_rows",
    "read_minute_csv",
    "read_table",
    "rescued_counts",
    "spread",
]
