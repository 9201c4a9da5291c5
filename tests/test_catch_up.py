"""Minutes done once, picked up later, and read from their own folders only."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from lodgeflow import __main__ as cli
from lodgeflow import operators, plans, schemas, sources

HEADER = "booking_id,listing_id,user_id,booking_time,status\n"


def _minute(root, stamp, n, text=None):
    folder = root / stamp
    folder.mkdir(parents=True)
    rows = "".join(f"{k},7,1,2025-01-31 00:00:00,confirmed\n" for k in range(n))
    (folder / "bookings.csv").write_text(text or HEADER + rows)


def _listings(root, month, price="$1"):
    folder = root / f"snapshot_month={month}"
    folder.mkdir(parents=True)
    (folder / "l.csv").write_text(f"id,name,price\n7,A,{price}\n")


def _result(spark, tmp_path):
    rows = operators.Ledger(f"{tmp_path}/ledger").rows(spark)
    return sorted((r.batch_minute.strftime("%d_%H%M"), r.price, r.booking_count) for r in rows.collect())


def _runs(tmp_path):
    return len(list((tmp_path / "ledger" / "rows").glob("run=*")))


def test_missing_minutes_are_picked_up(spark, tmp_path):
    def run(start="2025-01-31 23:58:30", end="2025-02-01 00:02:00"):
        plans.catch_up_from_minute_files(spark, f"{tmp_path}/in", f"{tmp_path}/l", f"{tmp_path}/ledger", start, end)
        return _result(spark, tmp_path)

    _listings(tmp_path / "l", "2025-01")
    _minute(tmp_path / "in", "2025-01-31_2358", 1)
    _minute(tmp_path / "in", "2025-01-31_2200", 1)
    _minute(tmp_path / "in", "2025-02-01_0000", 4)
    assert run() == [("31_2358", "$1", 1)]
    done = operators.Ledger(f"{tmp_path}/ledger").done(spark).select("minute").collect()
    assert [r[0] for r in done] == [datetime(2025, 1, 31, 23, 58)]
    _minute(tmp_path / "in", "2025-01-31_2359", 2)
    _listings(tmp_path / "l", "2025-02", "$2")
    whole = [("01_0000", "$2", 4), ("31_2358", "$1", 1), ("31_2359", "$1", 2)]
    assert run() == whole and _runs(tmp_path) == 2
    assert run() == whole
    last = max((tmp_path / "ledger" / "rows").glob("run=*"), key=lambda p: p.stat().st_mtime)
    assert spark.read.parquet(str(last)).count() in (0, 2)  # minutes that were done are not done again


def test_a_run_that_fails_has_done_nothing(spark, tmp_path):
    book = operators.Ledger(f"{tmp_path}/ledger")
    book.open(spark)
    minutes = book.missing(spark, "2025-01-01 09:00:00", "2025-01-01 09:02:00")
    rows = minutes.select(F.col("minute").alias("batch_minute"), F.lit(1).alias("n"))
    broken = minutes.select(F.raise_error(F.lit("broken")).cast("timestamp_ntz").alias("minute"))
    with pytest.raises(Exception, match="broken"):
        book.publish(rows, broken)
    assert book.rows(spark).count() == 0 and book.missing(spark, "2025-01-01 09:00", "2025-01-01 09:02").count() == 2
    book.publish(rows, minutes)
    assert book.rows(spark).count() == 2
    book.publish(rows, spark.createDataFrame([(datetime(2025, 1, 1, 9),)], "minute timestamp_ntz"))  # done twice
    assert book.rows(spark).count() == 2


def test_an_empty_range(spark, tmp_path):
    book = operators.Ledger(f"{tmp_path}/ledger")
    book.open(spark)
    assert book.missing(spark, "2025-01-01 09:00:00", "2025-01-01 09:00:59").count() == 0
    assert list(sources.minutes_between("2025-01-01 09:00:10", "2025-01-01 09:00:59")) == []
    assert sources.months_between("2025-01-31 23:59:00", "2025-02-01 00:00:00") == ["2025-01"]
    assert sources.months_between("2024-11-30", "2025-02-01 00:00:01") == ["2024-11", "2024-12", "2025-01", "2025-02"]


def _database(spark, monkeypatch):
    """A stand-in for the database: what a range read would return, and the ranges asked for."""
    table = spark.range(200).select(
        F.col("id").alias("booking_id"), (F.col("id") % 2 + 7).alias("listing_id"), F.lit(1).alias("user_id"),
        F.expr("timestamp_ntz'2025-01-31 23:00:00' + make_dt_interval(0, 0, 0, id * 30)").alias("booking_time"),
        F.lit("confirmed").alias("status"),
    )
    asked = []

    def read(s, url, name, columns, span):
        asked.append((span.start, span.end, span.options))
        inside = operators.in_range(F.col("booking_time"), *(F.lit(t).cast("timestamp_ntz") for t in (span.start, span.end)))
        return table.where(inside).select(*columns)

    monkeypatch.setattr(sources, "read_jdbc_range", read)
    return asked


def test_the_job_over_a_database(spark, tmp_path, monkeypatch):
    asked = _database(spark, monkeypatch)
    _listings(tmp_path / "l", "2025-01")
    _listings(tmp_path / "l", "2025-02", "$2")
    bounds = ["--start", "2025-01-31 23:59:10", "--end", "2025-02-01 00:01:30"]
    monkeypatch.setattr(cli, "get_spark", lambda name: spark)
    monkeypatch.setattr(type(spark), "stop", lambda self: None)
    cli.main([
        "bookings-from-database", "--url", "jdbc:x", "--listings_root", f"{tmp_path}/l",
        "--output_path", f"{tmp_path}/out", *bounds, "--option", "driver=d",
    ])
    assert asked == [("2025-01-31 23:59:00", "2025-02-01 00:01:00", {"driver": "d"})]
    out = "".join(p.read_text() for p in (tmp_path / "out").glob("part-*")).splitlines()
    assert sorted(x.split(",", 1)[1] for x in out) == ["7,A,$1,1", "7,A,$2,1"]


def test_catch_up_from_a_database(spark, tmp_path, monkeypatch):
    _database(spark, monkeypatch)
    _listings(tmp_path / "l", "2025-01")

    def run(start, end):
        plans.catch_up_from_database(spark, "jdbc:x", f"{tmp_path}/l", f"{tmp_path}/ledger", start, end)
        return _result(spark, tmp_path)

    assert len(run("2025-01-31 23:10:00", "2025-01-31 23:20:00")) == 10
    assert len(run("2025-01-31 23:00:00", "2025-02-01 00:10:00")) == 60  # the second month has no listings yet
    _listings(tmp_path / "l", "2025-02", "$2")
    rows = run("2025-01-31 23:00:00", "2025-02-01 00:10:00")
    assert len(rows) == 70 and {r[1:] for r in rows} == {("$1", 1), ("$2", 1)}


def test_review_scores_over_a_database(spark, tmp_path, monkeypatch):
    reviews = spark.range(130).select(
        F.col("id").alias("review_id"), F.lit(7).alias("listing_id"), (F.col("id") % 5).cast("float").alias("review_score"),
        F.lit("x").alias("review_comment"),
        F.expr("timestamp_ntz'2025-01-01 09:00:00' + make_dt_interval(0, 0, 0, id * 60)").alias("review_date"),
    )
    monkeypatch.setattr(sources, "read_jdbc_range", lambda s, url, name, columns, span: reviews.select(*columns))
    plans.review_scores_from_database(
        spark, "jdbc:x", f"{tmp_path}/out", "2025-01-01 09:00:00", "2025-01-01 09:02:30", driver="d"
    )
    out = sorted("".join(p.read_text() for p in (tmp_path / "out").glob("part-*")).splitlines())
    assert [x.rpartition(",")[2] for x in out] == ["2.0", "2.0"] and len(out) == 2


def test_holes_become_ranges(spark):
    minutes = spark.createDataFrame(
        [(datetime(2025, 1, 1, 9, m),) for m in (0, 1, 2, 7, 30, 31)], "minute timestamp_ntz"
    )
    times = spark.range(60).selectExpr("id", "timestamp_ntz'2025-01-01 09:00:59' + make_dt_interval(0, 0, id) AS at")
    inside = lambda most: [r.id for r in times.where(operators.in_minutes(F.col("at"), minutes, most)).orderBy("id").collect()]
    assert inside(32) == [0, 1, 2, 7, 30, 31]
    assert inside(2) == list(range(32))
    assert times.where(operators.in_minutes(F.col("at"), minutes.where("false"))).count() == 0


@pytest.mark.parametrize("asked", [240, 1])
def test_only_the_folders_of_the_range_are_read(spark, tmp_path, monkeypatch, asked):
    """Broken files in other folders do no harm, and no listing goes into them."""
    monkeypatch.setattr(sources.stamps, "ASKED", asked)
    for m in range(5):
        _minute(tmp_path / "in", f"2025-01-31_230{m}", m + 1)
    _minute(tmp_path / "in", "2025-01-31_2359", 1, text="not,the,header\n1,2,3\n")
    _listings(tmp_path / "l", "2025-01")
    minutes = sources.minutes_between("2025-01-31 23:02:00", "2025-01-31 23:04:00")
    folders = sources.minute_folders(spark, f"{tmp_path}/in", minutes)
    rows = sources.read_minute_csv(spark, folders, schemas.BOOKINGS, multi_line=False)
    assert sorted(f.split("/")[-2] for f in rows.inputFiles()) == ["2025-01-31_2302", "2025-01-31_2303"]
    plans.bookings_from_minute_files(
        spark, f"{tmp_path}/in", f"{tmp_path}/l", f"{tmp_path}/out", start="2025-01-31 23:02:00", end="2025-01-31 23:10:00"
    )
    out = "".join(p.read_text() for p in (tmp_path / "out").glob("part-*")).splitlines()
    assert sorted(x[-1] for x in out) == ["3", "4", "5"]
    plans.bookings_from_minute_files(
        spark, f"{tmp_path}/in", f"{tmp_path}/l", f"{tmp_path}/none", start="2025-01-31 10:00:00", end="2025-01-31 10:10:00"
    )
    assert not any(p.read_text() for p in (tmp_path / "none").glob("part-*"))


def test_options_of_the_command_line():
    parse = cli.parser().parse_args
    found = parse(["extract-orders", "--url", "u", "--raw_root", "r", "--day", "d", "--split", "T", "k", "1", "9"])
    assert found.split == [["T", "k", "1", "9"]]
    assert parse(["transform-orders", "--input_path", "i", "--output_path", "o", "--multi_line"]).multi_line
    stream = ["stream-bookings", "--bookings_root", "b", "--listings_root", "l", "--log", "g", "--checkpoint", "c"]
    assert parse([*stream, "--max_files", "5"]).max_files == 5
