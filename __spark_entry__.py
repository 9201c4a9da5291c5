"""

The rental tables are bound to the given ones: parts, customers and users stand
in for listings; line items, orders and events for reviews, bookings and page
visits. Every query runs over whole tables.
"""

from __future__ import annotations

import os
from collections.abc import Callable
from datetime import datetime, timedelta
from functools import wraps
from importlib.util import find_spec
from pathlib import Path

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from lodgeflow import functions as fn
from lodgeflow import operators as ops
from lodgeflow import plans, schemas, sinks, sources, streaming
from lodgeflow.session import scratch_dir

SMOKE_DIR = "/root/testdata/sf0.001"
STATUSES = ("view", "click", "purchase")


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return sources.read_table(spark, f"{sf_dir}/{name}.parquet")


# Bindings ------------------------------------------------------------------


def _part_listings(spark: SparkSession, sf: str) -> DataFrame:
    return _table(spark, sf, "part").select(
        F.col("p_partkey").alias("id"), F.col("p_name").alias("name")
    )


def _line_reviews(spark: SparkSession, sf: str) -> DataFrame:
    return _table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("id"),
        F.col("l_partkey").alias("listing_id"),
        F.format_string("%.1f", "l_quantity").alias("review_score"),
    )


def _customer_listings(spark: SparkSession, sf: str) -> DataFrame:
    return _table(spark, sf, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("price")
    )


def _order_bookings(spark: SparkSession, sf: str) -> DataFrame:
    return _table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("booking_id"), F.col("o_custkey").alias("listing_id")
    )


def _dated_bookings(spark: SparkSession, sf: str) -> DataFrame:
    return _table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("booking_id"),
        F.col("o_custkey").alias("listing_id"),
        F.lit(0).cast("bigint").alias("user_id"),
        F.col("o_orderdate").alias("booking_time"),
        F.lit("confirmed").alias("status"),
    )


def _event_bookings(spark: SparkSession, sf: str) -> DataFrame:
    return _table(spark, sf, "events").select(
        F.col("event_id").alias("booking_id"),
        F.col("user_id").alias("listing_id"),
        F.col("ts").alias("booking_time"),
        F.col("event_type").alias("status"),
    )


def _wholesale(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    return (
        _table(spark, sf, "orders").select(
            F.col("o_orderkey").alias("OrderID"),
            F.col("o_orderdate").alias("OrderDate"),
            F.col("o_custkey").alias("CustomerID"),
        ),
        _table(spark, sf, "lineitem").select(
            F.col("l_orderkey").alias("OrderID"),
            F.col("l_quantity").alias("Quantity"),
            F.col("l_extendedprice").alias("UnitPrice"),
        ),
        _table(spark, sf, "customer").select(
            F.col("c_custkey").alias("CustomerID"), F.col("c_name").alias("CustomerName")
        ),
    )


def _dirty_bookings(spark: SparkSession, sf: str) -> DataFrame:
    """Blank texts at regular places, and the zeros that ids and props hold anyway."""
    event = F.col("event_id")
    return _table(spark, sf, "events").select(
        "event_id",
        fn.minute_start(F.col("ts")).alias("batch_minute"),
        F.when(event % 7 == 0, "").otherwise(event.cast("string")).alias("booking_id"),
        F.get_json_object("props", "$.k").try_cast("bigint").alias("listing_id"),
        "user_id",
        F.when(event % 11 == 0, "").otherwise(fn.time_text(F.col("ts"))).alias("booking_time"),
        F.when(event % 5 == 0, "").otherwise(F.col("event_type")).alias("status"),
    )


def _event_visits(spark: SparkSession, sf: str) -> DataFrame:
    return _table(spark, sf, "events").select(
        fn.minute_start(F.col("ts")).alias("batch_minute"),
        F.round(F.col("value") * 100).cast("bigint").alias("page_visits"),
    )


# Batch queries -------------------------------------------------------------


def reviews_per_listing(spark: SparkSession, sf: str) -> DataFrame:
    return ops.reviews_per_listing(_part_listings(spark, sf), _line_reviews(spark, sf))


def top_listings(spark: SparkSession, sf: str) -> DataFrame:
    ranked = ops.reviews_per_listing(_part_listings(spark, sf), _line_reviews(spark, sf))
    return ops.top_k(ranked, 20, F.desc("num_reviews"), "id", "name")


def bookings_per_listing(spark: SparkSession, sf: str) -> DataFrame:
    return ops.bookings_per_listing(_customer_listings(spark, sf), _order_bookings(spark, sf))


def avg_review_score_by_listing(spark: SparkSession, sf: str) -> DataFrame:
    return ops.avg_review_score(_line_reviews(spark, sf))


def order_lines_extract(spark: SparkSession, sf: str) -> DataFrame:
    return ops.order_lines_extract(*_wholesale(spark, sf))


def order_lines_top100(spark: SparkSession, sf: str) -> DataFrame:
    return ops.top_order_lines(*_wholesale(spark, sf), 100)


def extract_row_count(spark: SparkSession, sf: str) -> DataFrame:
    """Counted while the extract is written, without another pass."""
    seen = Observation()
    rows = order_lines_extract(spark, sf).observe(seen, F.count(F.lit(1)).alias("num_rows"))
    sinks.write_table(rows, scratch_dir(spark, "extract"))
    return spark.createDataFrame([(seen.get["num_rows"],)], "num_rows bigint")


def order_lines_transformed(spark: SparkSession, sf: str) -> DataFrame:
    lines = order_lines_extract(spark, sf).withColumn(
        "unit_price", F.concat(F.lit("$"), F.format_number("unit_price", 2))
    )
    return ops.clean_order_lines(lines)


def clean_currency(spark: SparkSession, sf: str) -> DataFrame:
    price = F.concat(F.lit("$"), F.format_number("o_totalprice", 2))
    return _table(spark, sf, "orders").select(
        "o_orderkey", fn.clean_currency(price).alias("total_amount_clean")
    )


def orders_by_year_month(spark: SparkSession, sf: str) -> DataFrame:
    day = F.col("o_orderdate")
    return (
        _table(spark, sf, "orders")
        .groupBy(fn.order_year(day).alias("order_year"), fn.order_month(day).alias("order_month"))
        .agg(F.count(F.lit(1)).alias("num_orders"))
    )


def row_anomalies(spark: SparkSession, sf: str) -> DataFrame:
    rows = _dirty_bookings(spark, sf)
    rules = fn.booking_rules(rows, valid_statuses=STATUSES)
    return ops.row_anomalies(rows, rules, order_by="event_id").withColumn(
        "anomalies", F.concat_ws("; ", "anomalies")
    )


def anomaly_counts(spark: SparkSession, sf: str) -> DataFrame:
    rows = _dirty_bookings(spark, sf)
    return ops.anomaly_counts(rows, fn.booking_rules(rows, valid_statuses=STATUSES))


def avg_page_visits(spark: SparkSession, sf: str) -> DataFrame:
    return ops.avg_page_visits(_event_visits(spark, sf), "batch_minute")


def avg_page_visits_overall(spark: SparkSession, sf: str) -> DataFrame:
    return ops.avg_page_visits(_event_visits(spark, sf))


def bookings_in_range(spark: SparkSession, sf: str) -> DataFrame:
    return ops.rows_in_range(
        _event_bookings(spark, sf), "booking_time", "2024-01-05 10:00:30", minutes=60
    )


def batch_stamps(spark: SparkSession, sf: str) -> DataFrame:
    ts = F.col("ts")
    return _table(spark, sf, "events").select(
        "event_id",
        fn.minute_start(ts).alias("batch_minute"),
        fn.minute_end(ts).alias("batch_end"),
        fn.minute_stamp(ts, "underscore").alias("stamp_underscore"),
        fn.minute_stamp(ts, "dashed").alias("stamp_dashed"),
        fn.minute_stamp(ts, "compact").alias("stamp_compact"),
        fn.month_stamp(ts).alias("stamp_month"),
        fn.day_stamp(ts).alias("stamp_day"),
        fn.time_text(ts).alias("time_text"),
    )


def bookings_per_minute(spark: SparkSession, sf: str) -> DataFrame:
    return ops.tumbling_count(
        _event_bookings(spark, sf), "booking_time", ["status"], "booking_id", "booking_count"
    )


def hourly_sliding_score(spark: SparkSession, sf: str) -> DataFrame:
    return ops.sliding_mean(
        _table(spark, sf, "events"),
        "ts",
        ["event_type"],
        fn.to_score(F.col("value")),
        "avg_review_score",
    )


def monthly_snapshot_bookings(spark: SparkSession, sf: str) -> DataFrame:
    """Prices of the months in which a part was returned, against all its lines."""
    lines = _table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("booking_id"),
        F.col("l_partkey").alias("listing_id"),
        F.col("l_shipdate").alias("booking_time"),
        F.col("l_extendedprice").alias("price"),
        "l_returnflag",
    )
    prices = (
        lines.where(F.col("l_returnflag") == "R")
        .groupBy(
            F.col("listing_id").alias("id"),
            fn.month_stamp(F.col("booking_time")).alias("snapshot_month"),
        )
        .agg(F.max("price").alias("price"))
    )
    return ops.snapshot_bookings(_part_listings(spark, sf).join(prices, "id"), lines)


def _purchase_snapshots(spark: SparkSession, sf: str) -> DataFrame:
    prices = (
        _table(spark, sf, "events")
        .where(F.col("event_type") == "purchase")
        .groupBy(
            F.col("user_id").alias("id"), fn.month_stamp(F.col("ts")).alias("snapshot_month")
        )
        .agg(F.max("value").alias("price"))
    )
    return _customer_listings(spark, sf).drop("price").join(prices, "id")


def _urgent_snapshots(spark: SparkSession, sf: str) -> DataFrame:
    """Prices of the months in which a customer had an urgent order."""
    orders = _table(spark, sf, "orders").where(F.col("o_orderpriority") == "1-URGENT")
    month = fn.month_stamp(F.col("o_orderdate")).alias("snapshot_month")
    prices = orders.groupBy(F.col("o_custkey").alias("id"), month).agg(F.max("o_totalprice").alias("price"))
    return _customer_listings(spark, sf).drop("price").join(prices, "id").select("id", "name", "price", "snapshot_month")


def minute_snapshot_bookings(spark: SparkSession, sf: str) -> DataFrame:
    """Prices of the months in which a user bought, against all events by minute."""
    return ops.snapshot_bookings(
        _purchase_snapshots(spark, sf), _event_bookings(spark, sf), by="minute"
    )


# Sinks and sources, written to a scratch folder and read back ---------------


def partitioned_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_dir(spark, "orders-by-month")
    orders = _table(spark, sf, "orders").select(
        "o_orderkey",
        "o_totalprice",
        fn.order_year(F.col("o_orderdate")).alias("order_year"),
        fn.order_month(F.col("o_orderdate")).alias("order_month"),
    )
    sinks.write_partitioned(orders, path, ["order_year", "order_month"])
    return sources.read_table(spark, path)


def _csv_roundtrip(
    spark: SparkSession, sf: str, table: str, *, header: bool = True, **sink
) -> DataFrame:
    path = scratch_dir(spark, f"{table}-csv")
    rows = _table(spark, sf, table)
    sinks.write_csv(rows, path, header=header, **sink)
    return sources.read_csv(
        spark, path, rows.schema, header=header, timestampNTZFormat=sources.MICROS
    )


def csv_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    return _csv_roundtrip(spark, sf, "customer")


def csv_gz_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    return _csv_roundtrip(spark, sf, "customer", compression="gzip")


def csv_headerless_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    return _csv_roundtrip(spark, sf, "orders", header=False)


def csv_roundtrip_events(spark: SparkSession, sf: str) -> DataFrame:
    return _csv_roundtrip(spark, sf, "events")


def csv_roundtrip_documents(spark: SparkSession, sf: str) -> DataFrame:
    """Whole texts with line breaks, quotes and commas inside a field."""
    return _csv_roundtrip(spark, sf, "documents")


def csv_roundtrip_blanks(spark: SparkSession, sf: str) -> DataFrame:
    """Every 5th text blank and every 7th null, beside other columns and in a file of its own."""
    place = F.col("doc_id")
    text = F.when(place % 7 == 0, None).when(place % 5 == 0, "").otherwise(F.col("text"))
    rows = _table(spark, sf, "documents").select("doc_id", text.alias("text"))
    both, alone = scratch_dir(spark, "blanks-csv"), scratch_dir(spark, "single-csv")
    sinks.write_csv(rows, both, header=True)
    sinks.write_csv(rows.select("text"), alone, header=True)
    single = sources.read_csv(spark, alone, rows.select("text").schema)
    return sources.read_csv(spark, both, rows.schema).unionByName(
        single.select(F.lit(-1).cast("bigint").alias("doc_id"), "text")
    )


def csv_all_strings(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_dir(spark, "scores-csv")
    sinks.write_csv(_line_reviews(spark, sf), path, header=True)
    return ops.avg_review_score(sources.read_csv(spark, path)).withColumn(
        "listing_id", F.col("listing_id").cast("bigint")
    )


def csv_inferred(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_dir(spark, "bookings-csv")
    sinks.write_csv(_order_bookings(spark, sf), path, header=True)
    bookings = sources.read_csv(spark, path, infer=True)
    return ops.bookings_per_listing(_customer_listings(spark, sf), bookings)


def json_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_dir(spark, "events-json")
    rows = _table(spark, sf, "events")
    sinks.write_json(rows, path)
    return sources.read_json_rows(
        spark, path, rows.schema, multi_line=False, timestampNTZFormat=sources.MICROS
    ).drop("batch_minute")


#: Rows of an array file; a longer hour has several files.
ARRAY_ROWS = 10_000


def _array_files(rows: DataFrame, root: str) -> str:
    """JSON array files named after an hour's first minute, its rows in order of event_id, ARRAY_ROWS to a file."""
    fields = [c for c in rows.columns if c not in ("event_id", "ts")]
    hours = rows.withColumn("stamp", fn.minute_stamp(F.date_trunc("hour", "ts").cast("timestamp_ntz")))
    placed = ops.row_positions(hours, "stamp", "event_id", "place").withColumn("part", F.expr(f"place div {ARRAY_ROWS}"))
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    listed = F.array_sort(F.collect_list(F.struct("place", F.struct(*fields).alias("row"))))
    arrays = placed.repartition(tasks, "stamp", "part").groupBy("stamp", "part").agg(listed.alias("all"))
    value = F.to_json(F.transform("all", lambda x: x["row"]), {"ignoreNullFields": "false"})
    arrays.select("stamp", "part", value.alias("value")).write.partitionBy("stamp", "part").text(root)
    return root


def _whole_hours(found: DataFrame, file: str = "file") -> DataFrame:
    """Places within an hour from the places within its files."""
    before = F.regexp_extract(file, "/part=([0-9]+)/", 1).cast("bigint") * ARRAY_ROWS
    return found.withColumn("row_index", F.col("row_index") + before).drop(file)


def _array_bookings(spark: SparkSession, sf: str) -> DataFrame:
    """Fields that hold numbers, texts or blanks."""
    event = F.col("event_id")
    return _table(spark, sf, "events").select(
        "event_id",
        "ts",
        (event % 7).alias("booking_id"),
        F.when(event % 3 == 0, "0").otherwise(event.cast("string")).alias("listing_id"),
        "user_id",
        F.when(event % 11 == 0, "").otherwise(fn.time_text(F.col("ts"))).alias("booking_time"),
        F.when(event % 5 == 0, None).otherwise(F.col("event_type")).alias("status"),
    )


def _array_visits(spark: SparkSession, sf: str) -> DataFrame:
    return _table(spark, sf, "events").select(
        "event_id",
        "ts",
        F.col("event_id").alias("id"),
        F.round(F.col("value") * 100).cast("bigint").alias("page_visits"),
    )


def json_array_anomalies(spark: SparkSession, sf: str) -> DataFrame:
    """Rules over batches read as VARIANT."""
    root = _array_files(_array_bookings(spark, sf), scratch_dir(spark, "booking-arrays"))
    read = _whole_hours(sources.read_json_batches(spark, root, schemas.DIRTY_BOOKINGS, file="file"))
    found = ops.row_anomalies(read, fn.booking_rules(read, valid_statuses=STATUSES))
    return found.withColumn("anomalies", F.concat_ws("; ", "anomalies"))


def json_array_page_visits(spark: SparkSession, sf: str) -> DataFrame:
    root = _array_files(_array_visits(spark, sf), scratch_dir(spark, "visit-arrays"))
    return ops.avg_page_visits(sources.read_json_rows(spark, root, schemas.PAGE_VISITS), "batch_minute")


def dated_directories(spark: SparkSession, sf: str) -> DataFrame:
    root = scratch_dir(spark, "orders-dated")
    orders = _table(spark, sf, "orders").withColumn("date", fn.month_stamp(F.col("o_orderdate")))
    sinks.write_csv(orders, root, header=True, partition_by=["date"])
    schema = StructType([StructField("o_orderkey", LongType()), StructField("o_custkey", LongType())])
    return sources.read_dated(spark, root, schema)


# Streams over the event files ----------------------------------------------


def _event_stream(spark: SparkSession, sf: str) -> DataFrame:
    schema = _table(spark, sf, "events").schema
    return streaming.file_stream(spark, sf, schema, only="events.parquet")


def stream_bookings_per_minute(spark: SparkSession, sf: str) -> DataFrame:
    log = scratch_dir(spark, "minute-counts")
    counts = streaming.windowed_counts(
        _event_stream(spark, sf), "ts", ["event_type"], "event_id", "booking_count"
    )
    streaming.write_updates(counts, log, scratch_dir(spark, "checkpoint")).awaitTermination()
    return streaming.latest_counts(spark, log, "booking_count")


def stream_static_bookings(spark: SparkSession, sf: str) -> DataFrame:
    log = scratch_dir(spark, "listing-counts")
    counts = streaming.windowed_counts(
        _event_stream(spark, sf).withColumnRenamed("user_id", "listing_id"),
        "ts",
        ["listing_id"],
        "event_id",
        "booking_count",
    )
    joined = streaming.join_listings(
        counts, _customer_listings(spark, sf), ["name", "price"], "booking_count"
    )
    streaming.write_updates(joined, log, scratch_dir(spark, "checkpoint")).awaitTermination()
    return streaming.latest_counts(spark, log, "booking_count")


def stream_hourly_score(spark: SparkSession, sf: str) -> DataFrame:
    log = scratch_dir(spark, "minute-scores")
    scores = streaming.minute_scores(_event_stream(spark, sf), "ts", "event_type", F.col("value"))
    streaming.write_updates(scores, log, scratch_dir(spark, "checkpoint")).awaitTermination()
    return streaming.hourly_scores(spark, log)


def stream_monthly_bookings(spark: SparkSession, sf: str) -> DataFrame:
    """The stream's counterpart of ``minute_snapshot_bookings``."""
    log = scratch_dir(spark, "monthly-counts")
    counts = streaming.windowed_counts(
        _event_stream(spark, sf).withColumnRenamed("user_id", "listing_id"),
        "ts",
        ["listing_id"],
        "event_id",
        "booking_count",
    )
    joined = streaming.join_snapshots(counts, _purchase_snapshots(spark, sf), "booking_count")
    streaming.write_updates(joined, log, scratch_dir(spark, "checkpoint")).awaitTermination()
    return streaming.latest_counts(spark, log, "booking_count")


def stream_arriving_months(spark: SparkSession, sf: str) -> DataFrame:
    """Orders as bookings; the prices of every second month arrive only after them."""
    root, listings, log = (scratch_dir(spark, d) for d in ("bookings-in", "months-in", "month-log"))
    checkpoint = scratch_dir(spark, "checkpoint")
    sinks.write_csv(_dated_bookings(spark, sf), root, header=True)
    months = _urgent_snapshots(spark, sf)
    for rest in (0, 1):
        some = months.where(F.substring("snapshot_month", 6, 2).cast("int") % 2 == rest)
        mode = "append" if rest else "errorifexists"
        sinks.write_csv(some, listings, header=True, partition_by=["snapshot_month"], mode=mode)
        plans.stream_bookings(spark, root, listings, log, checkpoint, delay="4000 days").awaitTermination()
    found = plans.arrived_bookings(spark, log)
    return found.select("window_start", "listing_id", "name", F.col("price").cast("double").alias("price"), "booking_count")


def stream_late_bookings(spark: SparkSession, sf: str) -> DataFrame:
    """The second half of the month first, then the first half, which is late: kept, and folded by the job."""
    root, path, checkpoint = (scratch_dir(spark, d) for d in ("late-in", "late-log", "checkpoint"))
    events = _table(spark, sf, "events")
    log = streaming.CountLog(
        path, events.schema, "ts", ("event_type",), {"booking_count": F.count("event_id")}, delay="10 minutes"
    )
    middle = F.lit("2024-01-16").cast("timestamp_ntz")
    for part, some in enumerate((F.col("ts") >= middle, F.col("ts") < middle)):
        sinks.write_table(events.where(some), f"{root}/part-{part}")
        stream = streaming.file_stream(spark, root, events.schema, recursiveFileLookup=True)
        log.write(stream, checkpoint).awaitTermination()
    log.fold_late(spark)
    return log.rows(spark)


def stream_json_anomalies(spark: SparkSession, sf: str) -> DataFrame:
    """The stream's counterpart of ``anomaly_counts``, over array files that arrive in several batches."""
    root = _array_files(_array_bookings(spark, sf), scratch_dir(spark, "booking-arrays"))
    out = scratch_dir(spark, "streamed-quality")
    plans.stream_quality(
        spark, root, out, scratch_dir(spark, "checkpoint"), statuses=STATUSES, max_files=400
    ).awaitTermination()
    return plans.streamed_anomaly_counts(spark, out)


def stream_json_page_visits(spark: SparkSession, sf: str) -> DataFrame:
    root = _array_files(_array_visits(spark, sf), scratch_dir(spark, "visit-arrays"))
    out = scratch_dir(spark, "streamed-visits")
    plans.stream_page_visits(spark, root, out, scratch_dir(spark, "checkpoint"), max_files=400).awaitTermination()
    return plans.streamed_page_visits(spark, out)


# Rows that do not fit, minutes done later, tables that join in place ---------


def csv_rescued(spark: SparkSession, sf: str) -> DataFrame:
    """Every 13th record cut short, every 17th too long, with bad numbers and times in between."""
    event, path = F.col("event_id"), scratch_dir(spark, "spoilt-csv")
    fields = [
        event.cast("string"),
        F.when(event % 7 == 0, F.concat(F.lit("u"), "user_id")).otherwise(F.col("user_id").cast("string")),
        F.when(event % 11 == 0, "soon").otherwise(fn.time_text(F.col("ts"))),
        F.col("event_type"),
    ]
    record = F.when(event % 13 == 0, F.concat_ws(",", *fields[:2])).otherwise(
        F.concat_ws(",", *fields, F.when(event % 17 == 0, '"x, y"'))
    )
    _table(spark, sf, "events").select(record).write.text(path)
    schema = StructType([schemas.BOOKINGS[c] for c in ("booking_id", "listing_id", "booking_time", "status")])
    rows = sources.read_csv_rescued(spark, path, schema, header=False, multi_line=False)
    bad = F.col("_rescued.bad")
    return rows.select(
        *schema.fieldNames(),
        F.col("_rescued.problem").alias("problem"),
        F.col("_rescued.record").alias("record"),
        bad["listing_id"].alias("bad_listing_id"),
        bad["booking_time"].alias("bad_booking_time"),
    )


def catch_up_bookings(spark: SparkSession, sf: str) -> DataFrame:
    """``minute_snapshot_bookings`` by a ledger: some minutes first, then those that are missing."""
    ledger = ops.Ledger(scratch_dir(spark, "ledger"))
    ledger.open(spark)
    bookings, snapshots = _event_bookings(spark, sf), _purchase_snapshots(spark, sf)
    first, last = (fn.time_text(f("booking_time")) for f in (F.min, F.max))
    start, end = bookings.agg(first, last).first()
    end = str(datetime.fromisoformat(end) + timedelta(minutes=1))
    for bounds in (("2024-01-10 12:00:00", "2024-01-12 00:00:00"), (start, end)):
        minutes = ledger.missing(spark, *bounds)
        rows = bookings.where(ops.in_minutes(F.col("booking_time"), minutes))
        ledger.publish(ops.snapshot_bookings(snapshots, rows, by="minute"), minutes)
    return ledger.rows(spark)


def bucketed_reviews(spark: SparkSession, sf: str) -> DataFrame:
    """``reviews_per_listing`` over bucketed tables, joined without a shuffle."""
    tables = []
    lines = _table(spark, sf, "lineitem").select("l_orderkey", F.col("l_partkey").alias("listing_id"), "l_shipdate")
    parts = ops.daily_counts(lines, "l_orderkey", "l_shipdate")
    for rows, key in ((_part_listings(spark, sf), "id"), (parts, "listing_id")):
        path = scratch_dir(spark, "bucketed")
        tables.append(sinks.write_bucketed(rows, path.rpartition("/")[2].replace("-", "_"), path, [key], buckets=16))
    return ops.counts_per_listing(*tables, ["name"], "num_reviews")


QUERIES = (
    reviews_per_listing,
    top_listings,
    bookings_per_listing,
    avg_review_score_by_listing,
    order_lines_extract,
    order_lines_top100,
    extract_row_count,
    order_lines_transformed,
    clean_currency,
    orders_by_year_month,
    row_anomalies,
    anomaly_counts,
    avg_page_visits,
    avg_page_visits_overall,
    bookings_in_range,
    batch_stamps,
    bookings_per_minute,
    hourly_sliding_score,
    monthly_snapshot_bookings,
    minute_snapshot_bookings,
    partitioned_roundtrip,
    csv_roundtrip,
    csv_gz_roundtrip,
    csv_headerless_roundtrip,
    csv_roundtrip_events,
    csv_roundtrip_documents,
    csv_roundtrip_blanks,
    csv_all_strings,
    csv_inferred,
    json_roundtrip,
    json_array_anomalies,
    json_array_page_visits,
    dated_directories,
    stream_bookings_per_minute,
    stream_static_bookings,
    stream_monthly_bookings,
    stream_hourly_score,
    stream_arriving_months,
    stream_late_bookings,
    stream_json_anomalies,
    stream_json_page_visits,
    csv_rescued,
    catch_up_bookings,
    bucketed_reviews,
)


def entry(spark: SparkSession) -> DataFrame:
    """Most reviewed listings of the smoke tables."""
    return reviews_per_listing(spark, SMOKE_DIR)


def _training_data() -> tuple[dict[str, Callable], dict[str, str]]:
    """Queries and SQL of the optional llm subpackage and its pipeline, where they are installed."""
    if find_spec("lodgeflow.llm") is None or find_spec("lodgeflow.llm.queries") is None:
        return {}, {}
    from lodgeflow.llm.queries import ORACLES, QUERIES as found

    found, oracles = dict(found), dict(ORACLES)
    if find_spec("corpus_pipeline") is not None:
        import corpus_pipeline

        found["pipeline"] = corpus_pipeline.run
        if corpus_pipeline.ORACLE_SQL:
            oracles["pipeline"] = corpus_pipeline.ORACLE_SQL
    return {name: _importable(query) for name, query in found.items()}, oracles


def _importable(query: Callable) -> Callable:
    """``query`` with this folder on the path of Python workers, wherever the driver was started.

    A cluster without this folder needs the package installed or sent with ``--py-files``.
    """

    @wraps(query)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        environment, root = spark.sparkContext.environment, str(Path(__file__).resolve().parent)
        paths = environment.get("PYTHONPATH", "").split(os.pathsep)
        if root not in paths:
            environment["PYTHONPATH"] = os.pathsep.join(filter(None, [*paths, root]))
        return query(spark, sf_dir)

    return run


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {query.__name__: query for query in QUERIES} | _training_data()[0]


# SQL counterparts ------------------------------------------------------------

_EXTRACT = """
SELECT o_orderkey AS order_id, o_orderdate AS order_date, c_name AS customer_name,
       l_quantity AS quantity, l_extendedprice AS unit_price
FROM orders
LEFT JOIN lineitem ON o_orderkey = l_orderkey
LEFT JOIN customer ON o_custkey = c_custkey
"""

_REVIEWS = """
SELECT p_partkey AS id, p_name AS name, count(l_orderkey) AS num_reviews
FROM part JOIN lineitem ON p_partkey = l_partkey
GROUP BY p_partkey, p_name
"""

_BOOKINGS = """
SELECT c_custkey AS listing_id, c_name AS name, c_acctbal AS price,
       count(o_orderkey) AS booking_count
FROM customer JOIN orders ON c_custkey = o_custkey
GROUP BY c_custkey, c_name, c_acctbal
"""

_SCORES = """
SELECT l_partkey AS listing_id, avg(CAST(l_quantity AS REAL)) AS avg_review_score
FROM lineitem GROUP BY l_partkey
"""

_PER_MINUTE = """
SELECT date_trunc('minute', ts) AS {window}, event_type AS {key}, count(event_id) AS booking_count
FROM events GROUP BY ALL
"""

_HOURLY = """
SELECT window_start, event_type AS {key}, avg(CAST(value AS REAL)) AS avg_review_score
FROM (
  SELECT event_type, value,
         unnest(generate_series(date_trunc('minute', ts) - INTERVAL 59 MINUTE,
                                date_trunc('minute', ts), INTERVAL 1 MINUTE)) AS window_start
  FROM events
)
GROUP BY window_start, event_type
"""

_MINUTE_SNAPSHOTS = """
WITH snapshots AS (
  SELECT c_custkey AS id, c_name AS name, max(value) AS price,
         strftime(ts, '%Y-%m') AS snapshot_month
  FROM customer JOIN events ON c_custkey = user_id
  WHERE event_type = 'purchase'
  GROUP BY ALL
)
SELECT date_trunc('minute', ts) AS {minute}, id AS listing_id, name, price,
       count(event_id) AS booking_count
FROM snapshots JOIN events ON id = user_id AND snapshot_month = strftime(ts, '%Y-%m')
GROUP BY ALL
"""

_DIRTY = """
WITH dirty AS (
  SELECT event_id, date_trunc('minute', ts) AS batch_minute,
         row_number() OVER (PARTITION BY date_trunc('minute', ts) ORDER BY event_id) - 1
           AS row_index,
         event_id % 7 = 0 AS no_booking,
         CAST(regexp_extract(props, '"k": *(-?[0-9]+)', 1) AS BIGINT) = 0 AS no_listing,
         user_id = 0 AS no_user,
         event_id % 11 = 0 AS no_time,
         event_id % 5 = 0 OR event_type = '' AS no_status,
         event_type
  FROM events
), checked AS (
  SELECT *, NOT no_status AND event_type NOT IN ('view', 'click', 'purchase') AS bad_status
  FROM dirty
)
"""

_ARRAY_ROWS = """
WITH t AS (
  SELECT date_trunc('hour', ts) AS batch_minute, event_id, user_id, event_type,
         row_number() OVER (PARTITION BY date_trunc('hour', ts) ORDER BY event_id) - 1 AS row_index
  FROM events
), found AS (
  SELECT batch_minute, row_index, concat_ws('; ',
    CASE WHEN event_id % 7 = 0 THEN 'Missing booking_id' END,
    CASE WHEN user_id = 0 THEN 'Missing user_id' END,
    CASE WHEN event_id % 11 = 0 THEN 'Missing booking_time' END,
    CASE WHEN event_id % 5 = 0 OR event_type = '' THEN 'Missing status'
         WHEN event_type NOT IN ('view', 'click', 'purchase')
           THEN 'Invalid status: ' || event_type END) AS anomalies
  FROM t
)
"""


def oracle_sql() -> dict[str, str]:
    return _training_data()[1] | {
        "reviews_per_listing": _REVIEWS,
        "top_listings": f"{_REVIEWS} ORDER BY num_reviews DESC, id, name LIMIT 20",
        "bookings_per_listing": _BOOKINGS,
        "avg_review_score_by_listing": _SCORES,
        "order_lines_extract": _EXTRACT,
        "order_lines_top100": f"""{_EXTRACT}
            ORDER BY order_id NULLS LAST, order_date NULLS LAST, customer_name NULLS LAST,
                     quantity NULLS LAST, unit_price NULLS LAST
            LIMIT 100""",
        "extract_row_count": f"SELECT count(*) AS num_rows FROM ({_EXTRACT})",
        "order_lines_transformed": f"""
            SELECT order_id, order_date, customer_name, quantity,
                   '$' || format('{{:,.2f}}', unit_price) AS unit_price,
                   unit_price AS total_amount_clean,
                   CAST(year(order_date) AS INT) AS order_year,
                   CAST(month(order_date) AS INT) AS order_month
            FROM ({_EXTRACT})""",
        "clean_currency": "SELECT o_orderkey, o_totalprice AS total_amount_clean FROM orders",
        "orders_by_year_month": """
            SELECT CAST(year(o_orderdate) AS INT) AS order_year,
                   CAST(month(o_orderdate) AS INT) AS order_month, count(*) AS num_orders
            FROM orders GROUP BY ALL""",
        "row_anomalies": f"""{_DIRTY}
            SELECT batch_minute, row_index,
                   concat_ws('; ',
                     CASE WHEN no_booking THEN 'Missing booking_id' END,
                     CASE WHEN no_listing THEN 'Missing listing_id' END,
                     CASE WHEN no_user THEN 'Missing user_id' END,
                     CASE WHEN no_time THEN 'Missing booking_time' END,
                     CASE WHEN no_status THEN 'Missing status' END,
                     CASE WHEN bad_status THEN 'Invalid status: ' || event_type END) AS anomalies
            FROM checked
            WHERE no_booking OR no_listing OR no_user OR no_time OR no_status OR bad_status""",
        "anomaly_counts": f"""{_DIRTY}
            SELECT batch_minute,
                   count(*) FILTER (WHERE no_booking OR no_listing OR no_user OR no_time
                                          OR no_status OR bad_status) AS num_anomalies
            FROM checked GROUP BY batch_minute""",
        "avg_page_visits": """
            SELECT date_trunc('minute', ts) AS batch_minute,
                   avg(CAST(round(value * 100) AS BIGINT)) AS avg_page_visits
            FROM events GROUP BY ALL""",
        "avg_page_visits_overall": """
            SELECT avg(CAST(round(value * 100) AS BIGINT)) AS avg_page_visits FROM events""",
        "bookings_in_range": """
            SELECT event_id AS booking_id, user_id AS listing_id, ts AS booking_time,
                   event_type AS status
            FROM events
            WHERE ts >= TIMESTAMP '2024-01-05 10:00:00' AND ts < TIMESTAMP '2024-01-05 11:00:00'""",
        "batch_stamps": """
            SELECT event_id, date_trunc('minute', ts) AS batch_minute,
                   date_trunc('minute', ts) + INTERVAL 1 MINUTE AS batch_end,
                   strftime(ts, '%Y-%m-%d_%H%M') AS stamp_underscore,
                   strftime(ts, '%Y-%m-%d_%H-%M') AS stamp_dashed,
                   strftime(ts, '%Y%m%d_%H%M') AS stamp_compact,
                   strftime(ts, '%Y-%m') AS stamp_month,
                   strftime(ts, '%Y%m%d') AS stamp_day,
                   strftime(ts, '%Y-%m-%d %H:%M:%S') AS time_text
            FROM events""",
        "bookings_per_minute": _PER_MINUTE.format(window="window_start", key="status"),
        "hourly_sliding_score": _HOURLY.format(key="event_type"),
        "monthly_snapshot_bookings": """
            WITH snapshots AS (
              SELECT p_partkey AS id, p_name AS name, max(l_extendedprice) AS price,
                     strftime(l_shipdate, '%Y-%m') AS snapshot_month
              FROM part JOIN lineitem ON p_partkey = l_partkey
              WHERE l_returnflag = 'R'
              GROUP BY ALL
            )
            SELECT snapshot_month, id AS listing_id, name, price,
                   count(l_orderkey) AS booking_count
            FROM snapshots JOIN lineitem
              ON id = l_partkey AND snapshot_month = strftime(l_shipdate, '%Y-%m')
            GROUP BY ALL""",
        "minute_snapshot_bookings": _MINUTE_SNAPSHOTS.format(minute="batch_minute"),
        "partitioned_roundtrip": """
            SELECT o_orderkey, o_totalprice, CAST(year(o_orderdate) AS INT) AS order_year,
                   CAST(month(o_orderdate) AS INT) AS order_month
            FROM orders""",
        "csv_roundtrip": "SELECT * FROM customer",
        "csv_gz_roundtrip": "SELECT * FROM customer",
        "csv_headerless_roundtrip": "SELECT * FROM orders",
        "csv_roundtrip_events": "SELECT * FROM events",
        "csv_roundtrip_documents": "SELECT * FROM documents",
        "csv_roundtrip_blanks": """
            WITH t AS (
              SELECT doc_id, CASE WHEN doc_id % 7 = 0 THEN NULL WHEN doc_id % 5 = 0 THEN ''
                                  ELSE text END AS text
              FROM documents)
            SELECT doc_id, text FROM t UNION ALL SELECT CAST(-1 AS BIGINT), text FROM t""",
        "json_array_anomalies": f"{_ARRAY_ROWS} SELECT * FROM found WHERE anomalies <> ''",
        "stream_json_anomalies": f"""{_ARRAY_ROWS}
            SELECT batch_minute, count(*) FILTER (WHERE anomalies <> '') AS num_anomalies
            FROM found GROUP BY batch_minute""",
        "json_array_page_visits": """
            SELECT date_trunc('hour', ts) AS batch_minute,
                   avg(CAST(round(value * 100) AS BIGINT)) AS avg_page_visits
            FROM events GROUP BY ALL""",
        "stream_json_page_visits": """
            SELECT date_trunc('hour', ts) AS batch_minute,
                   avg(CAST(round(value * 100) AS BIGINT)) AS avg_page_visits
            FROM events GROUP BY ALL""",
        "csv_all_strings": _SCORES,
        "csv_inferred": _BOOKINGS,
        "json_roundtrip": "SELECT * FROM events",
        "dated_directories": """
            SELECT o_orderkey, o_custkey, strftime(o_orderdate, '%Y-%m') AS date FROM orders""",
        "stream_bookings_per_minute": _PER_MINUTE.format(window="window_start", key="event_type"),
        "stream_static_bookings": """
            SELECT date_trunc('minute', ts) AS window_start, c_custkey AS listing_id,
                   c_name AS name, c_acctbal AS price, count(event_id) AS booking_count
            FROM events JOIN customer ON user_id = c_custkey
            GROUP BY ALL""",
        "stream_hourly_score": _HOURLY.format(key="listing_id"),
        "stream_monthly_bookings": _MINUTE_SNAPSHOTS.format(minute="window_start"),
        "stream_arriving_months": """
            WITH snapshots AS (
              SELECT c_custkey AS id, c_name AS name, max(o_totalprice) AS price,
                     strftime(o_orderdate, '%Y-%m') AS snapshot_month
              FROM customer JOIN orders ON c_custkey = o_custkey
              WHERE o_orderpriority = '1-URGENT'
              GROUP BY ALL
            )
            SELECT date_trunc('minute', o_orderdate) AS window_start, id AS listing_id, name, price,
                   count(o_orderkey) AS booking_count
            FROM snapshots JOIN orders ON id = o_custkey AND snapshot_month = strftime(o_orderdate, '%Y-%m')
            GROUP BY ALL""",
        "stream_late_bookings": _PER_MINUTE.format(window="window_start", key="event_type"),
        "csv_rescued": """
            WITH fields AS (
              SELECT event_id, event_id % 13 = 0 AS short, event_id % 17 = 0 AS surplus, event_type,
                     user_id, event_id % 7 = 0 AS no_listing, event_id % 11 = 0 AS no_time, ts,
                     CASE WHEN event_id % 7 = 0 THEN 'u' ELSE '' END || user_id AS listing,
                     CASE WHEN event_id % 11 = 0 THEN 'soon' ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END AS time
              FROM events
            )
            SELECT event_id AS booking_id, CASE WHEN NOT no_listing THEN user_id END AS listing_id,
                   CASE WHEN NOT (short OR no_time) THEN date_trunc('second', ts) END AS booking_time,
                   CASE WHEN NOT short THEN event_type END AS status,
                   CASE WHEN short THEN 'short' WHEN surplus THEN 'surplus'
                        WHEN no_listing OR no_time THEN 'bad text' END AS problem,
                   CASE WHEN short THEN event_id || ',' || listing
                        WHEN surplus THEN event_id || ',' || listing || ',' || time || ',' || event_type || ',"x, y"'
                   END AS record,
                   CASE WHEN no_listing THEN listing END AS bad_listing_id,
                   CASE WHEN no_time AND NOT short THEN time END AS bad_booking_time
            FROM fields""",
        "catch_up_bookings": _MINUTE_SNAPSHOTS.format(minute="batch_minute"),
        "bucketed_reviews": _REVIEWS,
    }
