"""Ranges, positions, windows, snapshots and blank CSV fields on small tables."""

from datetime import datetime

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from lodgeflow import operators as ops
from lodgeflow import sinks, sources
from lodgeflow.operators.positions import row_positions


def test_ranges_ignore_the_session_zone(spark, tmp_path, plan):
    times = [datetime(2024, 3, 31, h, m) for h in (1, 2, 3) for m in (0, 30)]
    spark.createDataFrame([(t,) for t in times], "t timestamp_ntz").write.parquet(f"{tmp_path}/t")
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")
    try:
        rows = ops.rows_in_range(spark.read.parquet(f"{tmp_path}/t"), "t", "2024-03-31 02:30:59")
        assert [r.t for r in rows.collect()] == [datetime(2024, 3, 31, 2, 30)]
        assert "GreaterThanOrEqual(t,2024-03-31T02:30)" in plan(rows)
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    with pytest.raises(ValueError):
        ops.rows_in_range(rows, "t", "2024-01-01' OR true --")


@pytest.mark.parametrize("bits", [1, 2, 20])
def test_positions_with_offsets(spark, bits):
    keys = [-(1 << 63), -9, -8, -1, 0, 1, 2, 3, 4, 7, 100, 10**12, (1 << 63) - 1]
    rows = [(b, k) for b in ("x", "y", None) for k in keys if (k + len(b or "")) % 5 or b == "x"]
    got = row_positions(spark.createDataFrame(rows, "b string, k bigint"), "b", "k", bits=bits).collect()
    for batch in ("x", "y", None):
        mine = sorted(k for b, k in rows if b == batch)
        assert {r.k: r.row_index for r in got if r.b == batch} == {k: n for n, k in enumerate(mine)}


@pytest.mark.parametrize(("minutes", "slide"), [(60, 1), (60, 15), (10, 5)])
def test_sliding_mean_is_the_window_function(spark, rows, minutes, slide):
    df = spark.range(200).selectExpr(
        "timestamp'2024-01-01 00:00:00' + make_dt_interval(0, 0, 0, (id * id * 37) % 20000) AS t",
        "id % 3 AS k", "if(id % 7 = 0, null, cast(id AS double)) AS v",
    )
    want = df.groupBy(F.window("t", f"{minutes} minutes", f"{slide} minutes").alias("w"), "k").agg(F.avg("v").alias("m"))
    got = ops.sliding_mean(df, "t", ["k"], F.col("v"), "m", minutes=minutes, slide=slide)
    assert rows(got.selectExpr("window_start", "k", "round(m, 9)")) == rows(want.selectExpr("w.start", "k", "round(m, 9)"))


def test_snapshots_count_copies_of_a_listing(spark, rows):
    listings = spark.createDataFrame(
        [(1, "A", "$1", "2024-01")] * 2 + [(1, "A", "$2", "2024-02")], "id bigint, name string, price string, snapshot_month string"
    )
    bookings = spark.createDataFrame(
        [(k, 1, datetime(2024, m, 3)) for k, m in enumerate((1, 1, 2, 3))], "booking_id bigint, listing_id bigint, booking_time timestamp_ntz"
    )
    assert rows(ops.snapshot_bookings(listings, bookings)) == [("2024-01", 1, "A", "$1", 4), ("2024-02", 1, "A", "$2", 1)]


@pytest.mark.parametrize("header", [True, False])
def test_single_column_keeps_nulls_and_blanks(spark, tmp_path, header):
    df = spark.createDataFrame([("a",), (None,), ("",), ("b",), (None,), (" ",)], "t string")
    sinks.write_csv(df, f"{tmp_path}/out", header=header)
    back = sources.read_csv(spark, f"{tmp_path}/out", df.schema, header=header)
    assert sorted(back.collect(), key=repr) == sorted(df.collect(), key=repr)


def test_the_null_marker_is_refused_as_text(spark, tmp_path):
    with pytest.raises((PySparkException, Py4JJavaError), match="reserved null marker"):
        sinks.write_csv(spark.createDataFrame([("﷐",)], "t string"), f"{tmp_path}/out")


def test_foreign_blanks_are_null(spark, tmp_path):
    (tmp_path / "f.csv").write_text('a,b\n,""\n')
    assert tuple(sources.read_csv(spark, f"{tmp_path}/f.csv", **sources.FOREIGN).first()) == (None, None)
    assert tuple(sources.read_csv(spark, f"{tmp_path}/f.csv").first()) == (None, "")


def test_no_dates_give_no_rows(spark, tmp_path):
    schema = spark.range(1).schema
    assert sources.read_dated(spark, str(tmp_path), schema, dates=[]).collect() == []


def test_top_ids_are_found_once(spark, plan):
    orders = spark.range(1000).selectExpr("id AS OrderID", "date'2024-01-01' AS OrderDate", "id % 9 AS CustomerID")
    lines = spark.range(5000).selectExpr("id % 1000 AS OrderID", "1 AS Quantity", "1.0D AS UnitPrice")
    customers = spark.range(9).selectExpr("id AS CustomerID", "'c' AS CustomerName")
    top = ops.top_order_lines(orders, lines, customers, 10)
    assert top.count() == 10
    full = ops.order_lines_extract(orders, lines, customers).orderBy("order_id").limit(10)
    assert sorted(top.collect()) == sorted(full.collect())
