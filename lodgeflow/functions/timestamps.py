"""Minutes, months and the text stamps that name minute batches."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# The stamp layouts used in file and directory names.
MINUTE_STAMPS = {
    "underscore": "yyyy-MM-dd_HHmm",
    "dashed": "yyyy-MM-dd_HH-mm",
    "compact": "yyyyMMdd_HHmm",
}
MONTH_STAMP = "yyyy-MM"
DAY_STAMP = "yyyyMMdd"
TIME_TEXT = "yyyy-MM-dd HH:mm:ss"

# The last stamp of any layout in a path.
_STAMP_IN_PATH = r".*(?<!\d)(\d{4}-?\d{2}-?\d{2}_\d{2}-?\d{2})(?!\d)"


def minute_start(ts: Column) -> Column:
    """``ts`` without its seconds.

    Unlike ``date_trunc`` this keeps TIMESTAMP_NTZ as it is, so the session
    time zone plays no part.
    """
    return ts - F.make_dt_interval(secs=F.extract(F.lit("SECOND"), ts))


def minute_end(ts: Column, minutes: int = 1) -> Column:
    """The exclusive end of the ``minutes``-long range that starts at ``ts``'s minute."""
    return minute_start(ts) + F.make_dt_interval(mins=F.lit(minutes))


def minute_stamp(ts: Column, layout: str = "underscore") -> Column:
    return F.date_format(ts, MINUTE_STAMPS[layout])


def month_stamp(ts: Column) -> Column:
    return F.date_format(ts, MONTH_STAMP)


def day_stamp(ts: Column) -> Column:
    return F.date_format(ts, DAY_STAMP)


def time_text(ts: Column) -> Column:
    return F.date_format(ts, TIME_TEXT)


def batch_minute_from_path(path: Column) -> Column:
    """The minute that a batch file is named after, or null without a stamp."""
    digits = F.replace(F.regexp_extract(path, _STAMP_IN_PATH, 1), F.lit("-"), F.lit(""))
    return F.try_to_timestamp(digits, F.lit("yyyyMMdd_HHmm")).cast("timestamp_ntz")
