from lodgeflow.sinks.buckets import attach_bucketed, write_bucketed
from lodgeflow.sinks.files import (
    write_csv,
    write_json,
    write_partitioned,
    write_raw,
    write_table,
)
from lodgeflow.sinks.publish import recover, replace

__all__ = [
    "attach_bucketed",
    "recover",
    "replace",
    "write_bucketed",
    "write_csv",
    "write_json",
    "write_partitioned",
    "write_raw",
    "write_table",
]
