"""Jobs over wholesale orders."""

from __future__ import annotations

import logging

from pyspark.sql import SparkSession

from lodgeflow import operators, schemas, sinks, sources

log = logging.getLogger(__name__)


def extract_order_lines(
    spark: SparkSession,
    url: str,
    raw_root: str,
    day: str,
    *,
    limit: int | None = None,
    tables: tuple[str, str, str] = ("Sales.Orders", "Sales.OrderLines", "Sales.Customers"),
    splits: dict[str, tuple[str, tuple[int, int]]] | None = None,
    **options: str,
) -> str:
    """Land the order-line extract of a database as the raw CSV of ``day``.

    Each table is read once and landed as Parquet below ``raw_root/_tables``;
    the extract is joined from there, so all its parts see one state of the
    table and nothing is read twice. ``splits`` gives a table's numeric key and
    bounds, by which it is read over many connections. All rows are extracted
    unless ``limit`` asks for the first ones. Returns the path.
    """
    landed = []
    for name in tables:
        key, bounds = (splits or {}).get(name, (None, None))
        path = f"{raw_root.rstrip('/')}/_tables/day={day}/{name}"
        table = sources.read_jdbc_table(spark, url, name, key=key, bounds=bounds, **options)
        sinks.write_table(table, path, mode="overwrite")
        landed.append(sources.read_table(spark, path))
    orders, lines, customers = landed
    if limit is None:
        rows = operators.order_lines_extract(orders, lines, customers)
    else:
        rows = operators.top_order_lines(orders, lines, customers, limit)
    return sinks.write_raw(rows, raw_root, day)


def transform_orders(
    spark: SparkSession,
    input_path: str,
    output_path: str,
    *,
    currency: bool = True,
    overwrite: str = "static",
    multi_line: bool = False,
) -> None:
    """Order-line CSV to Parquet partitioned by order year and month.

    ``currency`` adds the cleaned unit price to the price's text; without it
    the price is read as a number. An error, which with lazy
    evaluation surfaces in the write, is logged and raised again.
    """
    log.info("reading %s", input_path)
    try:
        schema = schemas.ORDER_LINES if currency else schemas.PRICED_ORDER_LINES
        lines = sources.read_csv(spark, input_path, schema, multi_line=multi_line, **sources.FOREIGN)
        lines = sources.spread(lines, input_path)
        lines.printSchema()
        log.info("writing %s", output_path)
        sinks.write_partitioned(
            operators.clean_order_lines(lines, currency=currency),
            output_path,
            ["order_year", "order_month"],
            overwrite=overwrite,
        )
    except Exception:
        log.exception("transforming %s failed", input_path)
        raise
