"""A log of windowed sums that loses no row, however late it arrives.

Each micro-batch adds one directory of its own sums, so no window is kept open as
state and a window's value is the sum of what was logged for it. Rows behind the
watermark go to a side table as they are, written by the same query; a job folds
them into the log. A repeated micro-batch or job replaces its own directories, so
retries count nothing twice.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from lodgeflow.streaming.minutes import started

#: The newest event time up to a batch, and what became of the batch's rows.
MARKS = "batch_id bigint, newest timestamp_ntz, on_time bigint, late bigint, without_time bigint"


@dataclass(frozen=True)
class CountLog:
    """Sums per window and ``keys`` of the rows of ``schema``, kept under ``path``.

    ``sums`` names aggregates that add up over any split of the rows: counts, or
    sums of whole numbers. ``ts`` is the event time; rows without one lie in no
    window and are only counted. ``delay`` is how long after the newest row seen a
    window still takes rows without the job.
    """

    path: str
    schema: StructType
    ts: str
    keys: tuple[str, ...]
    sums: dict[str, Column] = field(hash=False)
    length: str = "1 minute"
    delay: str = "1 hour"

    def write(self, rows: DataFrame, checkpoint: str, *, every: str | None = None) -> StreamingQuery:
        """Start to log the streamed ``rows``; without ``every``, up to the end of the present input."""
        spark = rows.sparkSession
        nothing = spark.createDataFrame([], self.schema)
        self._put(self._counted(nothing), "counts", -1)
        self._put(self._counted(nothing), "folded", -1)
        self._put(self._counted(nothing), "snapshots", -1)
        self._put(nothing, "late", -1)
        self._put(spark.createDataFrame([(-1, None, 0, 0, 0)], MARKS), "marks", -1)
        return started(rows.select(*self.schema.fieldNames()).writeStream.foreachBatch(self._add), checkpoint, every)

    def _add(self, batch: DataFrame, batch_id: int) -> None:
        """Log one batch. Its watermark comes from the batches before it, so a repeated batch splits alike."""
        spark = batch.sparkSession
        before = spark.read.parquet(f"{self.path}/marks/batch_id={batch_id - 1}").select("newest").first()[0]
        time = F.col(self.ts).cast("timestamp_ntz")
        late = F.coalesce(time < F.lit(self._closed(spark, before)).cast("timestamp_ntz"), F.lit(False))
        # A pass of its own over the times: metrics observed in the pass below would miss rows that its filters drop early.
        found = batch.agg(
            F.max(time).alias("newest"),
            F.count_if(time.isNotNull() & ~late).alias("on_time"),
            F.count_if(late).alias("late"),
            F.count_if(time.isNull()).alias("without_time"),
        ).first()
        self._put(self._counted(batch.where(~late)), "counts", batch_id)
        if found["late"]:
            self._put(batch.where(late), "late", batch_id)
        newest = max(filter(None, (before, found["newest"])), default=None)
        mark = (batch_id, newest, found["on_time"], found["late"], found["without_time"])
        self._put(spark.createDataFrame([mark], MARKS), "marks", batch_id)

    def _closed(self, spark: SparkSession, newest: datetime | None) -> datetime | None:
        """All windows that end up to the watermark end up to the start of the window it lies in."""
        mark = F.lit(newest).cast("timestamp_ntz") - F.expr(f"INTERVAL {self.delay}")
        found = spark.range(1).select(mark.alias("mark")).select(F.window("mark", self.length)["start"]).first()
        return found and found[0]

    def _counted(self, rows: DataFrame, *more: str) -> DataFrame:
        window = F.window(F.col(self.ts).cast("timestamp_ntz"), self.length).alias("_window")
        sums = [value.alias(name) for name, value in self.sums.items()]
        grouped = rows.groupBy(window, *more, *self.keys).agg(*sums)
        return grouped.select(*more, F.col("_window.start").alias("window_start"), *self.keys, *self.sums)

    def _put(self, rows: DataFrame, part: str, batch_id: int) -> None:
        rows.write.mode("overwrite").parquet(f"{self.path}/{part}/batch_id={batch_id}")

    def _read(self, spark: SparkSession, part: str) -> DataFrame:
        return spark.read.parquet(f"{self.path}/{part}").where("batch_id >= 0")

    def marks(self, spark: SparkSession) -> DataFrame:
        """Per batch: the newest time so far, and its rows on time, late and without a time."""
        return self._read(spark, "marks")

    def late_rows(self, spark: SparkSession) -> DataFrame:
        """All rows that came behind the watermark, as they were, with their ``batch_id``."""
        return self._read(spark, "late")

    def fold_late(self, spark: SparkSession) -> None:
        """Count the late rows of batches that no earlier run has folded.

        Each batch's late rows become one directory, so a run that failed is
        simply repeated. The side table stays.
        """
        done = self._read(spark, "folded").select("batch_id").distinct()
        waiting = self.late_rows(spark).join(F.broadcast(done), "batch_id", "left_anti")
        counted = self._counted(waiting, "batch_id").hint("rebalance", F.col("batch_id"))
        counted.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(
            f"{self.path}/folded"
        )

    def rows(self, spark: SparkSession) -> DataFrame:
        """``window_start``, keys and sums of everything logged and folded so far."""
        logged = self._since(spark, *self._snapshot(spark))
        return self._summed(logged)

    def _summed(self, logged: DataFrame) -> DataFrame:
        sums = [F.sum(name).cast(logged.schema[name].dataType).alias(name) for name in self.sums]
        return logged.groupBy("window_start", *self.keys).agg(*sums)

    def compact(self, spark: SparkSession) -> int:
        """Write the sums up to the last batch but one as a snapshot; return that batch's number.

        Late rows are folded first. Directories up to the snapshot stay, for other
        readers, and are no longer read.
        """
        self.fold_late(spark)
        (last,) = self._read(spark, "marks").agg(F.max("batch_id")).first()
        upto = (last or 0) - 1
        snapshot, start = self._snapshot(spark)
        if upto > start:
            logged = self._since(spark, snapshot, start).where(F.col("batch_id") <= upto)
            self._put(self._summed(logged), "snapshots", upto)
        return upto

    def _snapshot(self, spark: SparkSession) -> tuple[DataFrame, int]:
        """The newest snapshot, and the batch up to which it goes."""
        found = spark.read.parquet(f"{self.path}/snapshots")
        upto = max(int(f.rpartition("/batch_id=")[2].split("/")[0]) for f in found.inputFiles())
        return found.where(F.col("batch_id") == upto), upto

    def _since(self, spark: SparkSession, snapshot: DataFrame, upto: int) -> DataFrame:
        parts = [self._read(spark, part).where(F.col("batch_id") > upto) for part in ("counts", "folded")]
        return snapshot.unionByName(parts[0]).unionByName(parts[1])
