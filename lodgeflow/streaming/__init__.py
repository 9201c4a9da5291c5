from lodgeflow.streaming.arrivals import each_array, file_names, land_snapshots, landed_snapshots
from lodgeflow.streaming.counts import CountLog
from lodgeflow.streaming.minutes import (
    LateRows,
    as_event_time,
    compact,
    file_stream,
    hourly_scores,
    join_listings,
    join_snapshots,
    latest_counts,
    minute_scores,
    newest,
    windowed_counts,
    write_closed,
    write_updates,
)

__all__ = [
    "CountLog",
    "LateRows",
    "as_event_time",
    "compact",
    "each_array",
    "file_names",
    "file_stream",
    "hourly_scores",
    "join_listings",
    "join_snapshots",
    "land_snapshots",
    "landed_snapshots",
    "latest_counts",
    "minute_scores",
    "newest",
    "windowed_counts",
    "write_closed",
    "write_updates",
]
