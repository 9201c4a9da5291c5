"""Spoilt CSV rows are kept with what was lost, and counted in the pass that reads them."""

import json
from datetime import datetime

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from lodgeflow import __main__ as cli
from lodgeflow import schemas, sources

HEADER = "booking_id,listing_id,host,user_id,booking_time,status\n"
ROWS = [
    '1,7,"a, ""b""",5,2025-01-01 09:00:00,confirmed',
    "x2,7,h,5,nope,confirmed",
    "3,7,h",
    '4,7,"h,i",5,2025-01-01 09:00:00,confirmed,extra,',
    "5,,h,,,",
    '6,7,"two\nlines",5,2025-13-01 09:00:00,pending',
]


def read(spark, path, **options):
    return sources.read_csv_rescued(spark, str(path), schemas.BOOKINGS, **options)


@pytest.fixture
def table(spark, tmp_path):
    (tmp_path / "a.csv").write_text(HEADER + "\n".join(ROWS) + "\n")
    return read(spark, tmp_path / "a.csv")


def test_each_problem_is_told(table):
    found = {(r.booking_id, r.user_id, r.booking_time, r.status): r._rescued for r in table.collect()}
    nine = datetime(2025, 1, 1, 9)
    assert found[(1, 5, nine, "confirmed")] is None and found[(5, None, None, None)] is None
    bad = found[(None, 5, None, "confirmed")]
    assert (bad.problem, bad.record, bad.bad) == ("bad text", None, {"booking_id": "x2", "booking_time": "nope"})
    short, surplus = found[(3, None, None, None)], found[(4, 5, nine, "confirmed")]
    assert (short.problem, short.record, short.bad) == ("short", "3,7,h", {})
    assert (surplus.problem, surplus.record) == ("surplus", '4,7,"h,i",5,2025-01-01 09:00:00,confirmed,extra,')
    assert found[(6, 5, None, "pending")].bad == {"booking_time": "2025-13-01 09:00:00"}


def test_counted_in_the_same_pass(spark, table, tmp_path):
    counts, seen = sources.rescued_counts(schemas.BOOKINGS), Observation()
    table.observe(seen, *[c.alias(n) for n, c in counts.items()]).write.parquet(f"{tmp_path}/out")
    assert seen.get == {
        "n_rows": 6, "n_short": 1, "n_surplus": 1, "n_bad_text": 2,
        "bad_booking_id": 1, "bad_listing_id": 0, "bad_user_id": 0, "bad_booking_time": 2,
    }
    assert table.agg(*[c.alias(n) for n, c in counts.items()]).first().asDict() == seen.get


def test_without_a_header_and_by_lines(spark, tmp_path):
    rows = ["1,7,5,2025-01-01 09:00:00,a", "2,7,5", "3,7,5,late,a", "4,7,5,2025-01-01 09:00:00,a,b,c"]
    (tmp_path / "a.csv").write_text("\n".join(rows) + "\n")
    found = read(spark, tmp_path / "a.csv", header=False, multi_line=False).orderBy("booking_id").collect()
    assert [r._rescued and r._rescued.problem for r in found] == [None, "short", "bad text", "surplus"]
    assert [r.booking_id for r in found] == [1, 2, 3, 4]


def test_sound_rows_equal_the_plain_reader(spark, table, tmp_path):
    plain = sources.read_csv(spark, f"{tmp_path}/a.csv", schemas.BOOKINGS)
    assert sorted(map(repr, table.drop("_rescued").collect())) == sorted(map(repr, plain.collect()))


def test_an_empty_file(spark, tmp_path):
    (tmp_path / "a.csv").write_text(HEADER)
    assert read(spark, tmp_path / "a.csv").agg(F.count("*")).first()[0] == 0


def test_only_texts(spark, tmp_path):
    schema = schemas.BOOKINGS["status"]
    from pyspark.sql.types import StructType

    (tmp_path / "a.csv").write_text("status,b\nx,1\ny\n")
    found = sources.read_csv_rescued(spark, f"{tmp_path}/a.csv", StructType([schema])).orderBy("status").collect()
    assert [r._rescued and r._rescued.problem for r in found] == [None, "short"]


def test_the_job_writes_and_counts_spoilt_rows(spark, table, tmp_path, monkeypatch, caplog):
    monkeypatch.setattr(cli, "get_spark", lambda name: spark)
    monkeypatch.setattr(type(spark), "stop", lambda self: None)
    with caplog.at_level("INFO", logger="lodgeflow.plans.quality"):
        cli.main(["spoilt-rows", "--table", "bookings", "--path", f"{tmp_path}/a.csv", "--output_path", f"{tmp_path}/out"])
    out = [json.loads(x) for p in (tmp_path / "out").glob("part-*") for x in p.read_text().splitlines()]
    assert sorted(r["_rescued"]["problem"] for r in out) == ["bad text", "bad text", "short", "surplus"]
    assert "n_rows 6, n_short 1, n_surplus 1, n_bad_text 2, bad_booking_id 1" in caplog.text
