"""Data-quality reports over batches of bookings."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodgeflow.functions.checks import Rule, anomaly_messages
from lodgeflow.operators.positions import row_positions


def row_anomalies(
    rows: DataFrame,
    rules: Iterable[Rule],
    *,
    batch: str = "batch_minute",
    index: str = "row_index",
    order_by: str | None = None,
) -> DataFrame:
    """``batch_minute, row_index, anomalies`` of the rows that break a rule.

    Batch files bring their ``index`` along. For a table without one, name the
    unique ``order_by`` column that gives the order within a batch.
    """
    found = rows.withColumn("anomalies", anomaly_messages(rules))
    if order_by:
        found = row_positions(
            found.select(batch, F.col(order_by).alias("_key"), "anomalies"), batch, "_key", index
        )
    return found.where(F.size("anomalies") > 0).select(
        F.col(batch).alias("batch_minute"), F.col(index).alias("row_index"), "anomalies"
    )


def anomaly_counts(
    rows: DataFrame, rules: Iterable[Rule], *, batch: str = "batch_minute"
) -> DataFrame:
    """Rows that break at least one rule, per batch; 0 for a clean batch."""
    broken = reduce(or_, [r.failed for r in rules])
    return rows.groupBy(F.col(batch).alias("batch_minute")).agg(
        F.count_if(broken).alias("num_anomalies")
    )
