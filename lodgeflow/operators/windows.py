"""Time ranges and windows. All ranges are half-open: ``start <= t < end``."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodgeflow.functions.sums import exact_parts, mean_of_parts, merged_parts


def in_range(ts: Column, start: Column, end: Column) -> Column:
    return (ts >= start) & (ts < end)


def rows_in_range(rows: DataFrame, ts: str, start: str, minutes: int = 1) -> DataFrame:
    """Rows from the text time ``start``, cut to its minute, for ``minutes``.

    The bounds are literals of the column's own type, so the filter reaches the
    Parquet scan or the database; a wall-clock column is compared as such,
    whatever the session's time zone.
    """
    first = datetime.fromisoformat(start).replace(second=0, microsecond=0)
    last = first + timedelta(minutes=minutes)
    type_ = rows.schema[ts].dataType
    return rows.where(in_range(F.col(ts), *(F.lit(str(t)).cast(type_) for t in (first, last))))


def tumbling_count(
    rows: DataFrame, ts: str, keys: list[str], counted: str, name: str, length: str = "1 minute"
) -> DataFrame:
    """``window_start``, ``keys`` and the count of non-null ``counted`` per window.

    A row without a time, as after text that is no time, lies in no window.
    """
    return (
        rows.groupBy(F.window(ts, length).alias("_window"), *keys)
        .agg(F.count(counted).alias(name))
        .select(F.col("_window.start").alias("window_start"), *keys, name)
    )


def sliding_mean(
    rows: DataFrame,
    ts: str,
    keys: list[str],
    value: Column,
    name: str,
    *,
    minutes: int = 60,
    slide: int = 1,
) -> DataFrame:
    """Mean of ``value`` over windows of ``minutes`` that start every ``slide`` minutes.

    Expanding every row into ``minutes / slide`` windows is what a sliding
    ``window()`` does. Here rows first become one exact partial sum per slide step
    and key. Those partials are brought together per key and block of
    ``minutes``, so that after the expansion each task adds up all steps of a
    block before the second shuffle: a full block of 60 minutes sends 119 rows
    instead of 3,600.
    """
    parts = exact_parts(value)
    partials = (
        rows.groupBy(F.window(ts, f"{slide} minutes").alias("_step"), *keys)
        .agg(*[part.alias(c) for c, part in parts.items()])
        .select(F.col("_step.start").alias("_start"), *keys, *parts)
    )
    return means_of_partials(partials, keys, name, minutes=minutes, slide=slide)


def means_of_partials(
    partials: DataFrame, keys: list[str], name: str, *, minutes: int = 60, slide: int = 1
) -> DataFrame:
    """Sliding means from one row per slide step and key: ``_start``, ``keys`` and the parts of an exact sum.

    The parts are those of :func:`lodgeflow.functions.exact_parts`, so a mean has
    the same bits however its rows were spread and grouped.
    """
    steps, rest = divmod(minutes, slide)
    if rest:
        raise ValueError("minutes must be a multiple of slide")
    step = F.make_dt_interval(mins=F.lit(slide))
    reach = F.make_dt_interval(mins=F.lit((steps - 1) * slide))
    blocks = partials.withColumn(
        "_block", F.window("_start", f"{minutes} minutes").getField("start")
    ).repartition(*keys, "_block")
    starts = F.explode(F.sequence(F.col("_start") - reach, F.col("_start"), step))
    return (
        blocks.select(starts.alias("window_start"), *keys, *merged_parts())
        .groupBy("window_start", *keys)
        .agg(mean_of_parts().alias(name))
    )
