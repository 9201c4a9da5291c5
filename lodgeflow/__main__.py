"""Command line: ``python -m lodgeflow <job> ...``, or this file with spark-submit."""

from __future__ import annotations

import argparse
import logging
from collections.abc import Callable, Sequence

from pyspark.sql import SparkSession

from lodgeflow import plans, schemas
from lodgeflow.functions import MINUTE_STAMPS
from lodgeflow.session import get_spark


#: Tables that come as CSV, by the name given on the command line.
TABLES = {
    "listings": schemas.LISTINGS,
    "reviews": schemas.REVIEWS,
    "bookings": schemas.BOOKINGS,
    "customer_reviews": schemas.CUSTOMER_REVIEWS,
    "order_lines": schemas.PRICED_ORDER_LINES,
}


def _popular(spark: SparkSession, a: argparse.Namespace) -> None:
    plans.popular_listings(spark, a.listings, a.reviews, a.output, header=not a.no_header, multi_line=not a.single_line)


def _bookings(spark: SparkSession, a: argparse.Namespace) -> None:
    plans.bookings_report(
        spark, a.listings_file, a.bookings_file, a.output_path, multi_line=not a.single_line
    )


def _bookings_db(spark: SparkSession, a: argparse.Namespace) -> None:
    plans.bookings_from_database(
        spark, a.url, a.listings_root, a.output_path, a.start, a.end, **dict(a.option)
    )


def _bookings_files(spark: SparkSession, a: argparse.Namespace) -> None:
    plans.bookings_from_minute_files(
        spark, a.bookings, a.listings_root, a.output_path, start=a.start, end=a.end, layout=a.layout
    )


def _catch_up_files(spark: SparkSession, a: argparse.Namespace) -> None:
    plans.catch_up_from_minute_files(spark, a.bookings, a.listings_root, a.ledger, a.start, a.end, layout=a.layout)


def _catch_up_db(spark: SparkSession, a: argparse.Namespace) -> None:
    plans.catch_up_from_database(spark, a.url, a.listings_root, a.ledger, a.start, a.end, **dict(a.option))


def _scores(spark: SparkSession, a: argparse.Namespace) -> None:
    plans.review_scores(spark, a.customer_reviews, a.output_path, multi_line=not a.single_line)


def _scores_db(spark: SparkSession, a: argparse.Namespace) -> None:
    plans.review_scores_from_database(
        spark, a.url, a.output_path, a.start, a.end, **dict(a.option)
    )


def _quality(spark: SparkSession, a: argparse.Namespace) -> None:
    plans.quality_report(spark, a.bookings, a.output_path)


def _spoilt(spark: SparkSession, a: argparse.Namespace) -> None:
    plans.spoilt_rows_report(spark, a.path, TABLES[a.table], a.output_path, multi_line=not a.single_line)


def _visits(spark: SparkSession, a: argparse.Namespace) -> None:
    plans.page_visits_report(spark, a.visits, a.output_path)


def _extract(spark: SparkSession, a: argparse.Namespace) -> None:
    splits = {table: (key, (int(low), int(high))) for table, key, low, high in a.split}
    plans.extract_order_lines(
        spark, a.url, a.raw_root, a.day, limit=a.limit, splits=splits, **dict(a.option)
    )


def _transform(spark: SparkSession, a: argparse.Namespace) -> None:
    plans.transform_orders(
        spark, a.input_path, a.output_path,
        currency=not a.no_currency, overwrite=a.overwrite, multi_line=a.multi_line,
    )


def _stream(spark: SparkSession, a: argparse.Namespace) -> None:
    plans.stream_bookings(
        spark, a.bookings_root, a.listings_root, a.log, a.checkpoint,
        delay=a.delay, every=a.every, max_files=a.max_files,
    ).awaitTermination()


def _arrived(spark: SparkSession, a: argparse.Namespace) -> None:
    plans.write_arrived_bookings(spark, a.log, a.output_path, fold_late=a.fold_late)


def _stream_quality(spark: SparkSession, a: argparse.Namespace) -> None:
    plans.stream_quality(
        spark, a.bookings_root, a.output_path, a.checkpoint, every=a.every, max_files=a.max_files
    ).awaitTermination()


def _stream_visits(spark: SparkSession, a: argparse.Namespace) -> None:
    plans.stream_page_visits(
        spark, a.visits_root, a.output_path, a.checkpoint, every=a.every, max_files=a.max_files
    ).awaitTermination()


def _option(text: str) -> tuple[str, str]:
    key, _, value = text.partition("=")
    return key, value


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="lodgeflow")
    jobs = top.add_subparsers(required=True)

    def job(name: str, run: Callable, *required: str) -> argparse.ArgumentParser:
        sub = jobs.add_parser(name)
        sub.set_defaults(run=run, job=name)
        for option in required:
            sub.add_argument(f"--{option}", required=True)
        return sub

    def database(name: str, run: Callable, *required: str) -> argparse.ArgumentParser:
        sub = job(name, run, "url", *required)
        sub.add_argument(
            "--option", type=_option, action="append", default=[], metavar="KEY=VALUE",
            help="JDBC option such as driver=..., repeatable",
        )
        return sub

    def csv_job(name: str, run: Callable, *required: str) -> argparse.ArgumentParser:
        sub = job(name, run, *required)
        sub.add_argument("--single_line", action="store_true", help="no field holds a newline: split large files")
        return sub

    csv_job("popular-listings", _popular, "listings", "reviews", "output").add_argument(
        "--no-header", action="store_true"
    )
    csv_job("bookings-per-listing", _bookings, "listings_file", "bookings_file", "output_path")
    files = job("bookings-from-minute-files", _bookings_files, "bookings", "listings_root", "output_path")
    for bound in ("start", "end"):
        files.add_argument(f"--{bound}", help="with both, read only the folders of these minutes below --bookings")
    late = job("catch-up-from-minute-files", _catch_up_files, "bookings", "listings_root", "ledger", "start", "end")
    for sub in (files, late):
        sub.add_argument("--layout", choices=sorted(MINUTE_STAMPS), default="underscore", help="stamp in the folders' names")
    database("catch-up-from-database", _catch_up_db, "listings_root", "ledger", "start", "end")
    database("bookings-from-database", _bookings_db, "listings_root", "output_path", "start", "end")
    csv_job("review-scores", _scores, "customer_reviews", "output_path")
    database("review-scores-from-database", _scores_db, "output_path", "start", "end")
    job("quality-report", _quality, "bookings", "output_path")
    csv_job("spoilt-rows", _spoilt, "path", "output_path").add_argument("--table", choices=sorted(TABLES), required=True)
    job("page-visits", _visits, "visits", "output_path")
    extract = database("extract-orders", _extract, "raw_root", "day")
    extract.add_argument("--limit", type=int, help="extract only the first rows")
    extract.add_argument(
        "--split", nargs=4, action="append", default=[], metavar=("TABLE", "KEY", "LOW", "HIGH"),
        help="read TABLE over many connections by its numeric KEY, repeatable",
    )
    transform = job("transform-orders", _transform, "input_path", "output_path")
    transform.add_argument("--no-currency", action="store_true")
    transform.add_argument("--multi_line", action="store_true", help="fields may hold newlines")
    transform.add_argument("--overwrite", choices=["static", "dynamic"], default="static")
    def stream(name: str, run: Callable, *required: str) -> argparse.ArgumentParser:
        sub = job(name, run, *required, "checkpoint")
        sub.add_argument("--every", help="trigger interval; without it, stop at the end of input")
        sub.add_argument("--max_files", type=int, help="most files of a micro-batch")
        return sub

    stream("stream-bookings", _stream, "bookings_root", "listings_root", "log").add_argument("--delay", default="1 hour")
    job("arrived-bookings", _arrived, "log", "output_path").add_argument(
        "--fold_late", action="store_true", help="count the late rows first"
    )
    stream("stream-quality", _stream_quality, "bookings_root", "output_path")
    stream("stream-page-visits", _stream_visits, "visits_root", "output_path")
    return top


def main(argv: Sequence[str] | None = None) -> None:
    args = parser().parse_args(argv)
    logging.basicConfig(level=logging.INFO)
    spark = get_spark(f"lodgeflow {args.job}")
    try:
        args.run(spark, args)
    finally:
        spark.stop()


if __name__ == "__main__":
    main()
