from datetime import datetime

import pytest
from pyspark.sql import functions as F

from lodgeflow import functions as fn


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("$1,234.00", 1234.0),
        ("230.00", 230.0),
        ("$1$,2,3", 123.0),
        ("-$5.5", -5.5),
        ("", None),
        ("n/a", None),
        (None, None),
    ],
)
def test_clean_currency(spark, text, want):
    df = spark.createDataFrame([(text,)], "price string")
    assert df.select(fn.clean_currency(F.col("price"))).first()[0] == want


def test_clean_currency_takes_numbers(spark):
    assert spark.range(1).select(fn.clean_currency(F.lit(7.25))).first()[0] == 7.25


def test_score_is_a_32_bit_float(spark):
    df = spark.createDataFrame([("4.3",), ("5",), ("bad",), (None,)], "s string")
    got = df.select(fn.to_score(F.col("s")).cast("double")).collect()
    assert [r[0] for r in got] == [4.300000190734863, 5.0, None, None]


def test_year_and_month(spark):
    df = spark.createDataFrame([("1997-03-31",)], "d string").select(F.col("d").cast("date"))
    assert tuple(df.select(fn.order_year(F.col("d")), fn.order_month(F.col("d"))).first()) == (1997, 3)


@pytest.mark.parametrize("type_", ["timestamp_ntz", "timestamp"])
def test_minute_bounds_keep_the_type(spark, type_):
    ts = F.lit("2024-02-29 23:59:59.999999").cast(type_)
    df = spark.range(1).select(
        fn.minute_start(ts).alias("start"), fn.minute_end(ts).alias("end"), fn.minute_end(ts, 60).alias("hour")
    )
    assert {f.dataType.simpleString() for f in df.schema} == {type_}
    assert tuple(df.first()) == (
        datetime(2024, 2, 29, 23, 59),
        datetime(2024, 3, 1),
        datetime(2024, 3, 1, 0, 59),
    )


def test_minute_start_before_1970(spark):
    ts = F.lit("1969-12-31 23:59:30.5").cast("timestamp_ntz")
    assert spark.range(1).select(fn.minute_start(ts)).first()[0] == datetime(1969, 12, 31, 23, 59)


def test_stamps(spark):
    ts = F.lit("2025-01-02 03:04:05").cast("timestamp_ntz")
    got = spark.range(1).select(
        *[fn.minute_stamp(ts, layout) for layout in fn.MINUTE_STAMPS],
        fn.month_stamp(ts),
        fn.day_stamp(ts),
        fn.time_text(ts),
    )
    assert tuple(got.first()) == (
        "2025-01-02_0304",
        "2025-01-02_03-04",
        "20250102_0304",
        "2025-01",
        "20250102",
        "2025-01-02 03:04:05",
    )


@pytest.mark.parametrize(
    ("path", "want"),
    [
        ("file:///d/page_visits/2025-01-02_0304.json", datetime(2025, 1, 2, 3, 4)),
        ("s3a://b/bookings/2025-01-02_03-04/bookings.json", datetime(2025, 1, 2, 3, 4)),
        ("/d/customer_reviews/20250102_0304/customer_reviews.csv", datetime(2025, 1, 2, 3, 4)),
        ("/runs/2024-01-01_0000/2025-01-02_0304.json", datetime(2025, 1, 2, 3, 4)),
        ("/d/2025-13-02_0304.json", None),
        ("/d/120250102_03045.json", None),
        ("/d/plain.json", None),
    ],
)
def test_batch_minute_from_path(spark, path, want):
    assert spark.range(1).select(fn.batch_minute_from_path(F.lit(path))).first()[0] == want


def _missing(spark, value, type_):
    df = spark.createDataFrame([(value,)], f"x {type_}")
    return df.select(fn.is_missing(df, "x")).first()[0]


@pytest.mark.parametrize(
    ("value", "type_", "want"),
    [
        (None, "string", True),
        ("", "string", True),
        ("0", "string", False),
        (" ", "string", False),
        (None, "bigint", True),
        (0, "bigint", True),
        (7, "bigint", False),
        (0.0, "double", True),
        (float("nan"), "double", False),
        (False, "boolean", True),
        (True, "boolean", False),
        ([], "array<int>", True),
        ([0], "array<int>", False),
        (datetime(1970, 1, 1), "timestamp_ntz", False),
    ],
)
def test_missing_by_type(spark, value, type_, want):
    assert _missing(spark, value, type_) is want


@pytest.mark.parametrize(
    ("json", "want"),
    [
        ("0", True),
        ("0.0", True),
        ("-0.0", True),
        ("0e5", True),
        ('""', True),
        ("null", True),
        ("false", True),
        ("[]", True),
        ("{}", True),
        ('"0"', False),
        ('"false"', False),
        ('"[]"', False),
        ('"abc"', False),
        ("5", False),
        ("0.1", False),
        ("true", False),
        ("[0]", False),
    ],
)
def test_missing_in_variant(spark, json, want):
    df = spark.createDataFrame([(json,)], "j string").select(F.parse_json("j").alias("x"))
    assert df.select(fn.is_missing(df, "x")).first()[0] is want


def test_messages_in_rule_order(spark):
    df = spark.createDataFrame(
        [
            (1, "2", 3, "t", "confirmed"),
            (0, "", None, "", ""),
            (1, "0", 3, "t", "error"),
            (1, "2", 3, "t", "Confirmed"),
            (1, "2", 3, "t", None),
        ],
        "booking_id bigint, listing_id string, user_id bigint, booking_time string, status string",
    )
    got = [r[0] for r in df.select(fn.anomaly_messages(fn.booking_rules(df))).collect()]
    assert got == [
        [],
        [
            "Missing booking_id",
            "Missing listing_id",
            "Missing user_id",
            "Missing booking_time",
            "Missing status",
        ],
        ["Invalid status: error"],
        ["Invalid status: Confirmed"],
        ["Missing status"],
    ]
