"""Every file-based job on small files, and the extract on stand-in tables."""

import json
from pathlib import Path

import pytest

from lodgeflow import __main__ as cli
from lodgeflow import plans, schemas, sources

LISTINGS = 'id,name,price\n1,"Cosy ""den""\nby the sea",$10\n2,Loft,$20\n'
BOOKINGS = "booking_id,listing_id,user_id,booking_time,status\n" + "".join(
    f"{k},{1 + k % 2},9,2025-01-01 09:{k % 60:02d}:00,confirmed\n" for k in range(10)
)


def _write(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)
    return str(path)


def _text(path):
    return "".join(p.read_text() for p in sorted(Path(path).glob("part-*")))


def _json(path):
    return [json.loads(x) for p in sorted(Path(path).rglob("part-*")) for x in p.read_text().splitlines()]


def test_popular_listings(spark, tmp_path):
    listings = _write(tmp_path / "l.csv", LISTINGS)
    reviews = _write(tmp_path / "r.csv", "id,listing_id\n1,2\n2,2\n3,1\n")
    plans.popular_listings(spark, listings, reviews, f"{tmp_path}/out")
    assert _text(f"{tmp_path}/out").replace("id,name,num_reviews\n", "") == '2,Loft,2\n1,"Cosy ""den""\nby the sea",1\n'


def test_bookings_report(spark, tmp_path):
    listings, bookings = _write(tmp_path / "l.csv", LISTINGS), _write(tmp_path / "b.csv", BOOKINGS)
    for _ in range(2):  # the second run replaces the first
        plans.bookings_report(spark, listings, bookings, f"{tmp_path}/out")
    assert sorted(_text(f"{tmp_path}/out").replace("\nby", " by").splitlines()) == [
        '1,"Cosy ""den"" by the sea",$10,5', "2,Loft,$20,5",
    ]


def test_minute_files_meet_their_month(spark, tmp_path):
    for month, price in (("2025-01", "$1"), ("2025-02", "$2")):
        _write(tmp_path / "l" / f"snapshot_month={month}" / "l.csv", f"id,name,price\n1,A,{price}\n2,B,{price}\n")
    for minute in ("2025-01-31_2359", "2025-02-01_0000", "2025-03-01_0000"):
        _write(tmp_path / "b" / minute / "bookings.csv", BOOKINGS)
    plans.bookings_from_minute_files(spark, f"{tmp_path}/b/*/bookings.csv", f"{tmp_path}/l", f"{tmp_path}/out")
    assert sorted(x.split(",", 1)[1] for x in _text(f"{tmp_path}/out").splitlines()) == [
        "1,A,$1,5", "1,A,$2,5", "2,B,$1,5", "2,B,$2,5",
    ]


def test_review_scores(spark, tmp_path):
    reviews = _write(tmp_path / "r.csv", 'listing_id,review_score,review_comment\n1,4,"a\nb"\n1,5,c\n2,bad,d\n')
    plans.review_scores(spark, reviews, f"{tmp_path}/out")
    assert sorted(_text(f"{tmp_path}/out").splitlines()) == ["1,4.5", "2,"]


def _minutes(root, n, rows):
    for k in range(n):
        _write(root / f"2025-01-01_09{k:02d}" / "bookings.json", json.dumps(rows(k)))


def test_quality_report_is_complete(spark, tmp_path):
    row = {"booking_id": 1, "listing_id": "0", "user_id": 3, "booking_time": "x", "status": "confirmed"}
    _minutes(tmp_path / "in", 25, lambda k: [row, row | {"status": ""}] if k % 5 else [row])
    counts = plans.quality_report(spark, f"{tmp_path}/in/*/bookings.json", f"{tmp_path}/out")
    assert counts.count() == len(_json(f"{tmp_path}/out/counts")) == 25
    bad = _json(f"{tmp_path}/out/anomalies")
    assert len(bad) == sum(r["num_anomalies"] for r in _json(f"{tmp_path}/out/counts")) == 20
    assert all(r["anomalies"] == ["Missing status"] and r["row_index"] == 1 for r in bad)
    assert [p.name for p in Path(tmp_path, "out", "anomalies").glob("day=*")] == ["day=2025-01-01"]


def test_page_visits_from_the_command_line(spark, tmp_path, monkeypatch):
    _minutes(tmp_path / "in", 25, lambda k: [{"id": 1, "name": "A", "price": 2, "page_visits": v} for v in (k, k + 1)])
    monkeypatch.setattr(cli, "get_spark", lambda name: spark)
    monkeypatch.setattr(type(spark), "stop", lambda self: None)
    cli.main(["page-visits", "--visits", f"{tmp_path}/in/*/bookings.json", "--output_path", f"{tmp_path}/out"])
    assert sorted(r["avg_page_visits"] for r in _json(f"{tmp_path}/out")) == [k + 0.5 for k in range(25)]


@pytest.mark.parametrize("currency", [True, False])
def test_transform_orders(spark, tmp_path, currency):
    price = "$1,234.50" if currency else "12.5"
    lines = _write(tmp_path / "o.csv", f'order_id,order_date,customer_name,quantity,unit_price\n1,2013-05-02,A,2,"{price}"\n')
    plans.transform_orders(spark, lines, f"{tmp_path}/out", currency=currency)
    (row,) = spark.read.parquet(f"{tmp_path}/out").collect()
    assert (row.order_year, row.order_month) == (2013, 5)
    if currency:
        assert row.total_amount_clean == 1234.5
    else:
        assert row.unit_price == 12.5 and isinstance(row.unit_price, float)


def test_extract_reads_each_table_once_and_whole(spark, tmp_path, monkeypatch):
    tables = {
        "Sales.Orders": spark.range(300).selectExpr("id AS OrderID", "date'2013-01-01' AS OrderDate", "id % 7 AS CustomerID"),
        "Sales.OrderLines": spark.range(5000).selectExpr("if(id < 4000, 5, id % 200) AS OrderID", "1 AS Quantity", "2.0D AS UnitPrice"),
        "Sales.Customers": spark.range(7).selectExpr("id AS CustomerID", "concat('c', id) AS CustomerName"),
    }
    read = []
    monkeypatch.setattr(sources, "read_jdbc_table", lambda s, url, name, **o: read.append((name, o)) or tables[name])
    path = plans.extract_order_lines(spark, "jdbc:x", f"{tmp_path}/raw", "20250101", splits={"Sales.Orders": ("OrderID", (0, 300))})
    assert [name for name, _ in read] == list(tables)
    assert read[0][1]["key"] == "OrderID" and read[1][1]["key"] is None
    assert sources.read_csv(spark, path, schemas.ORDER_LINES).count() == 5100
    first = plans.extract_order_lines(spark, "jdbc:x", f"{tmp_path}/raw", "20250102", limit=10)
    assert sources.read_csv(spark, first, schemas.ORDER_LINES).count() == 10


def test_a_large_csv_is_split(spark, tmp_path):
    path = _write(tmp_path / "b.csv", BOOKINGS + "1,1,1,2025-01-01 09:00:00,confirmed\n" * 20_000)
    setting = "spark.sql.files.maxPartitionBytes"
    spark.conf.set(setting, "100k")
    try:
        rows = sources.read_csv(spark, path, schemas.BOOKINGS, multi_line=False)
        assert rows.rdd.getNumPartitions() > 4
    finally:
        spark.conf.unset(setting)
