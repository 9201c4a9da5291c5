"""Results by minute, each minute done once, however often and however partly jobs run."""

from __future__ import annotations

from dataclasses import dataclass
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lodgeflow.operators.windows import in_range

_DONE = "minute timestamp_ntz, run string"


@dataclass(frozen=True)
class Ledger:
    """Rows per minute under ``root``, and which minutes are finished.

    A run writes its rows into a folder of its own and then, as its last act, one
    file that names the minutes it has finished. Rows that no such file names are
    never read, so a run that fails has done nothing and its minutes stay missing.
    Minutes that two runs have finished are read from one of them.
    """

    root: str

    def open(self, spark: SparkSession) -> None:
        """Make the ledger readable before its first run; harmless afterwards."""
        spark.createDataFrame([], "minute timestamp_ntz").write.mode("overwrite").parquet(f"{self.root}/done/run=none")

    def done(self, spark: SparkSession) -> DataFrame:
        """``minute`` and the ``run`` that counts for it."""
        runs = spark.read.schema(_DONE).parquet(f"{self.root}/done")
        return runs.groupBy("minute").agg(F.min("run").alias("run"))

    def missing(self, spark: SparkSession, start: str, end: str) -> DataFrame:
        """The unfinished ``minute`` values of ``[start, end)``, both cut to the minute."""
        bounds = [F.date_trunc("minute", F.lit(t).cast("timestamp_ntz")).cast("timestamp_ntz") for t in (start, end)]
        last = bounds[1] - F.expr("INTERVAL 1 MINUTE")
        minutes = F.sequence(bounds[0], last, F.expr("INTERVAL 1 MINUTE"))
        asked = spark.range(1).select(F.explode(F.when(bounds[0] <= last, minutes)).alias("minute"))
        return asked.join(self.done(spark), "minute", "left_anti")

    def publish(self, rows: DataFrame, minutes: DataFrame, minute: str = "batch_minute") -> str:
        """Write ``rows``, then mark all of ``minutes`` as finished, also those without rows."""
        run = f"run-{uuid4().hex}"  # text that cannot be taken for a number
        rows.withColumnRenamed(minute, "minute").write.parquet(f"{self.root}/rows/run={run}")
        # One file, whose appearance is what finishes the minutes.
        minutes.select("minute").coalesce(1).write.parquet(f"{self.root}/done/run={run}")
        return run

    def rows(self, spark: SparkSession, minute: str = "batch_minute") -> DataFrame:
        """The rows of all finished minutes, once a run has published some."""
        rows = spark.read.parquet(f"{self.root}/rows")
        return rows.join(self.done(spark), ["minute", "run"], "left_semi").drop("run").withColumnRenamed("minute", minute)


def in_minutes(ts: Column, minutes: DataFrame, most: int = 32) -> Column:
    """A filter for times that lie in runs of consecutive ``minutes``, which reaches the scan or the database.

    Up to ``most`` runs become a range each, more are covered by one range; so
    join with ``minutes`` as well.
    """
    step = F.expr("INTERVAL 1 MINUTE")
    shifted = lambda by: minutes.select((F.col("minute") + by).alias("minute"))
    starts = minutes.join(shifted(step), "minute", "left_anti")
    ends = minutes.join(shifted(-step), "minute", "left_anti")
    firsts, lasts = ([r[0] for r in t.orderBy("minute").limit(most + 1).collect()] for t in (starts, ends))
    if len(firsts) > most:
        first, last = minutes.agg(F.min("minute"), F.max("minute")).first()
        firsts, lasts = [first], [last]
    ranges = [in_range(ts, F.lit(a), F.lit(b) + step) for a, b in zip(firsts, lasts)]
    found = F.lit(False)
    for one in ranges:
        found = found | one
    return found
