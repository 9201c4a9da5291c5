"""The wholesale order-line extract and its cleaning."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodgeflow.functions.cleaning import clean_currency, order_month, order_year

EXTRACT = ["order_id", "order_date", "customer_name", "quantity", "unit_price"]


def _prepared(orders: DataFrame, lines: DataFrame, customers: DataFrame):
    return (
        orders.select(
            F.col("OrderID").alias("order_id"),
            F.col("OrderDate").alias("order_date"),
            F.col("CustomerID").alias("customer_id"),
        ),
        lines.select(
            F.col("OrderID").alias("order_id"),
            F.col("Quantity").alias("quantity"),
            F.col("UnitPrice").alias("unit_price"),
        ),
        customers.select(
            F.col("CustomerID").alias("customer_id"),
            F.col("CustomerName").alias("customer_name"),
        ),
    )


def _outer_joined(orders: DataFrame, lines: DataFrame, customers: DataFrame) -> DataFrame:
    """orders LEFT JOIN customers LEFT JOIN lines, as matched plus unmatched orders.

    Customers are joined first, on the few columns of an order, so the far
    larger lines are shuffled once only. An outer join cannot split an order
    that holds a large share of all lines: each part would report the orders
    it misses. Adaptive execution does split an inner join on either side, so
    the matched orders come from one, and the orders without lines are found
    against the distinct line keys, which map tasks reduce before shuffling.
    """
    matched = orders.join(customers, "customer_id", "left").join(lines, "order_id")
    unmatched = (
        orders.join(lines.select("order_id").distinct(), "order_id", "left_anti")
        .join(customers, "customer_id", "left")
        .withColumns({f: F.lit(None).cast(lines.schema[f].dataType) for f in ("quantity", "unit_price")})
    )
    return matched.select(*EXTRACT).unionByName(unmatched.select(*EXTRACT))


def order_lines_extract(orders: DataFrame, lines: DataFrame, customers: DataFrame) -> DataFrame:
    """One row per order line, and one with nulls for an order that has none.

    Takes ``Orders(OrderID, OrderDate, CustomerID)``, ``OrderLines(OrderID,
    Quantity, UnitPrice)`` and ``Customers(CustomerID, CustomerName)``.
    """
    return _outer_joined(*_prepared(orders, lines, customers))


def top_order_lines(
    orders: DataFrame, lines: DataFrame, customers: DataFrame, n: int = 100, *, ordered: bool = True
) -> DataFrame:
    """``n`` rows of :func:`order_lines_extract`.

    ``ordered`` gives the first ``n`` by all output columns, nulls last;
    otherwise any ``n``, as a plain limit does.

    Every order yields at least one row, so the first ``n`` rows come from the
    orders with the ``n`` smallest ids. Orders and lines are cut down to those
    ids while they are scanned, and the full extract is never built.
    """
    orders, lines, customers = _prepared(orders, lines, customers)
    if not ordered:
        return (
            orders.join(lines, "order_id", "left")
            .join(customers, "customer_id", "left")
            .select(*EXTRACT)
            .limit(n)
        )
    ids = (
        orders.orderBy(F.asc_nulls_last("order_id")).limit(n).select(F.col("order_id").alias("_id"))
    )
    first = F.col("order_id").eqNullSafe(F.col("_id"))
    return (
        _outer_joined(
            orders.join(ids, first, "left_semi"), lines.join(ids, first, "left_semi"), customers
        )
        .orderBy(*[F.asc_nulls_last(c) for c in EXTRACT])
        .limit(n)
    )


def clean_order_lines(lines: DataFrame, *, currency: bool = True) -> DataFrame:
    """Add ``order_year`` and ``order_month`` and, with ``currency``, ``total_amount_clean``.

    ``total_amount_clean`` is the cleaned unit price; quantity plays no part.
    """
    added = {
        "order_year": order_year(F.col("order_date")),
        "order_month": order_month(F.col("order_date")),
    }
    if currency:
        added = {"total_amount_clean": clean_currency(F.col("unit_price")), **added}
    return lines.withColumns(added)
