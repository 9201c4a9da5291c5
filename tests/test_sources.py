import gzip
from datetime import date, datetime

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.sql.types import LongType, StringType, StructField, StructType

from lodgeflow import schemas, sources

LISTINGS = (
    "junk,id,name,price\n"
    'x,1,"Cosy, ""quiet"" flat\nwith a view","$1,200.00"\n'
    "y,2,Loft\n"
    "z,3,Villa,$90,extra,fields\n"
    "w,bad,Barn,$5\n"
)
WANT = [
    (1, 'Cosy, "quiet" flat\nwith a view', "$1,200.00"),
    (2, "Loft", None),
    (3, "Villa", "$90"),
    (None, "Barn", "$5"),
]


def test_quoted_multi_line_by_name(spark, tmp_path):
    path = tmp_path / "listings.csv"
    path.write_text(LISTINGS)
    df = sources.read_csv(spark, str(path), schemas.LISTINGS)
    assert df.schema == schemas.LISTINGS
    assert [tuple(r) for r in df.collect()] == WANT


def test_gzip(spark, tmp_path):
    path = tmp_path / "listings.csv.gz"
    path.write_bytes(gzip.compress(LISTINGS.encode()))
    assert [tuple(r) for r in sources.read_csv(spark, str(path), schemas.LISTINGS).collect()] == WANT


def test_all_strings_and_inferred(spark, tmp_path):
    path = tmp_path / "r.csv"
    path.write_text("listing_id,review_score\n1,4.5\n2,\n")
    strings = sources.read_csv(spark, str(path))
    assert strings.dtypes == [("listing_id", "string"), ("review_score", "string")]
    inferred = sources.read_csv(spark, str(path), infer=True)
    assert inferred.dtypes == [("listing_id", "int"), ("review_score", "double")]
    assert [tuple(r) for r in inferred.collect()] == [(1, 4.5), (2, None)]


def test_headerless_is_positional(spark, tmp_path):
    path = tmp_path / "r.csv"
    path.write_text("7,1\n8,1\n")
    df = sources.read_csv(spark, str(path), schemas.REVIEWS, header=False)
    assert [tuple(r) for r in df.collect()] == [(7, 1), (8, 1)]


def test_files_with_shifted_headers_are_refused(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,listing_id\n1,2\n")
    (tmp_path / "b.csv").write_text("listing_id,id\n2,1\n")
    with pytest.raises(Py4JJavaError, match="CSV header does not conform"):
        sources.read_csv(spark, str(tmp_path), schemas.REVIEWS).collect()


def test_only_needed_columns_are_parsed(spark, tmp_path, plan):
    path = tmp_path / "listings.csv"
    path.write_text(LISTINGS)
    assert "ReadSchema: struct<id:string>" in plan(
        sources.read_csv(spark, str(path), schemas.LISTINGS).select("id")
    )


def test_dated_directories(spark, tmp_path, plan, rows):
    for day, name in (("2024-11", "Old"), ("2024-12", "New")):
        (tmp_path / f"date={day}").mkdir()
        (tmp_path / f"date={day}" / "listings.csv").write_text(f"id,name\n1,{name}\n")
    schema = StructType([StructField("id", LongType()), StructField("name", StringType())])
    everything = sources.read_dated(spark, str(tmp_path), schema)
    assert rows(everything) == [(1, "New", "2024-12"), (1, "Old", "2024-11")]
    december = everything.where("date = '2024-12'")
    assert rows(december) == [(1, "New", "2024-12")]
    assert "PartitionFilters: [isnotnull(date" in plan(december)
    assert rows(sources.read_dated(spark, str(tmp_path), schema, dates=["2024-11"])) == [
        (1, "Old", "2024-11")
    ]


def test_year_partitions_stay_text(spark, tmp_path):
    (tmp_path / "date=2024").mkdir()
    (tmp_path / "date=2024" / "r.csv").write_text("id,listing_id\n1,2\n")
    assert sources.read_dated(spark, str(tmp_path), schemas.REVIEWS).first()["date"] == "2024"


def test_minute_files(spark, tmp_path, rows):
    for stamp, booking in (("2025-01-01_0930", 5), ("2025-01-01_09-31", 6)):
        (tmp_path / stamp).mkdir()
        (tmp_path / stamp / "bookings.csv").write_text(
            "booking_id,listing_id,user_id,booking_time,status\n"
            f"{booking},1,2,2025-01-01 09:30:00,confirmed\n"
        )
    df = sources.read_minute_csv(spark, f"{tmp_path}/*/bookings.csv", schemas.BOOKINGS)
    assert rows(df.select("batch_minute", "booking_id", "booking_time")) == [
        (datetime(2025, 1, 1, 9, 30), 5, datetime(2025, 1, 1, 9, 30)),
        (datetime(2025, 1, 1, 9, 31), 6, datetime(2025, 1, 1, 9, 30)),
    ]


def test_dates_and_numbers_are_typed(spark, tmp_path):
    path = tmp_path / "o.csv"
    path.write_text("order_id,order_date,customer_name,quantity,unit_price\n1,2013-01-02,A,,$3\n2,soon,B,2,\n")
    got = [tuple(r) for r in sources.read_csv(spark, str(path), schemas.ORDER_LINES).collect()]
    assert got == [(1, date(2013, 1, 2), "A", None, "$3"), (2, None, "B", 2, None)]


def test_json_arrays(spark, tmp_path, rows):
    (tmp_path / "2025-01-01_0930.json").write_text(
        '[\n    {"id": 1, "name": "A", "price": 120, "page_visits": 3},\n'
        '    {"id": 2, "name": "B", "price": 90, "page_visits": 4}\n]'
    )
    (tmp_path / "2025-01-01_0931.json").write_text("[]")
    df = sources.read_json_rows(spark, str(tmp_path), schemas.PAGE_VISITS)
    minute = datetime(2025, 1, 1, 9, 30)
    assert rows(df) == [(minute, 1, "A", 120, 3), (minute, 2, "B", 90, 4)]


def test_json_batches_number_their_rows(spark, tmp_path, rows):
    (tmp_path / "2025-01-01_0930.json").write_text('[{"id": 7}, {"id": 5}, {"id": 7}]')
    (tmp_path / "2025-01-01_0931.json").write_text('[{"id": 9}]')
    df = sources.read_json_batches(spark, str(tmp_path), StructType([StructField("id", LongType())]))
    first, second = datetime(2025, 1, 1, 9, 30), datetime(2025, 1, 1, 9, 31)
    assert rows(df) == [(first, 0, 7), (first, 1, 5), (first, 2, 7), (second, 0, 9)]
    assert df.schema["row_index"].dataType == LongType()


def test_broken_json_batch_fails(spark, tmp_path):
    (tmp_path / "2025-01-01_0930.json").write_text('[{"id": 7}, {"id"')
    with pytest.raises(Py4JJavaError, match="MALFORMED_RECORD_IN_PARSING"):
        sources.read_json_batches(
            spark, str(tmp_path), StructType([StructField("id", LongType())])
        ).collect()


class _Reader:
    """Stands in for a DataFrameReader: no database may be started here."""

    def __init__(self, table):
        self.table, self.seen = table, {}

    def format(self, name):
        self.seen["format"] = name
        return self

    def options(self, **options):
        self.seen |= options
        return self

    def option(self, key, value):
        self.seen[key] = value
        return self

    def load(self):
        return self.table


class _Session:
    def __init__(self, table=None):
        self.read = _Reader(table)


def test_jdbc_range(spark, rows):
    table = spark.createDataFrame(
        [
            (1, datetime(2025, 1, 1, 9, 29, 59, 999999), "x"),
            (2, datetime(2025, 1, 1, 9, 30), "x"),
            (3, datetime(2025, 1, 1, 9, 30, 59, 999999), "x"),
            (4, datetime(2025, 1, 1, 9, 31), "x"),
        ],
        "booking_id int, booking_time timestamp, extra string",
    )
    session = _Session(table)
    span = sources.RangeRead("booking_time", "2025-01-01 09:30:00", "2025-01-01 09:31:00", 4)
    df = sources.read_jdbc_range(session, "jdbc:x", "bookings", ["booking_id"], span)
    assert rows(df) == [(2,), (3,)]
    # The bounds, not the column, are cast: the comparison stays on the bare column.
    assert "cast(booking_time" not in df._jdf.queryExecution().optimizedPlan().toString()
    assert session.read.seen == {
        "format": "jdbc",
        "url": "jdbc:x",
        "dbtable": "bookings",
        "partitionColumn": "booking_time",
        "lowerBound": "2025-01-01 09:30:00",
        "upperBound": "2025-01-01 09:31:00",
        "numPartitions": "4",
        "fetchsize": "10000",
        "pushDownPredicate": "true",
    }


def test_jdbc_table_and_query():
    session = _Session()
    sources.read_jdbc_table(session, "jdbc:x", "t", key="id", bounds=(1, 9), partitions=3, driver="d")
    assert session.read.seen["partitionColumn"] == "id"
    assert session.read.seen["numPartitions"] == "3"
    assert session.read.seen["driver"] == "d"
    session = _Session()
    sources.read_jdbc_query(session, "jdbc:x", "SELECT 1")
    assert session.read.seen["query"] == "SELECT 1"
