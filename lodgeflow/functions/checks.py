"""Row validity rules as column expressions."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    MapType,
    NumericType,
    StringType,
    VariantType,
)

# The columns that must be filled, in report order, and the statuses.
REQUIRED = ("booking_id", "listing_id", "user_id", "booking_time", "status")
VALID_STATUSES = ("confirmed", "pending", "cancelled")


@dataclass(frozen=True)
class Rule:
    """``message`` is reported for the rows where ``failed`` is true."""

    failed: Column
    message: Column


def is_missing(rows: DataFrame, name: str) -> Column:
    """True where column ``name`` is null or empty in the sense of its type.

    Empty are ``""``, the number 0, false, and containers without elements; the
    text ``"0"`` is a value. A VARIANT is judged by the type each row holds.
    """
    column, type_ = F.col(name), rows.schema[name].dataType
    if isinstance(type_, StringType):
        empty = column == ""
    elif isinstance(type_, NumericType):
        empty = column == 0
    elif isinstance(type_, BooleanType):
        empty = ~column
    elif isinstance(type_, ArrayType | MapType):
        empty = F.size(column) == 0
    elif isinstance(type_, VariantType):
        is_text = F.schema_of_variant(column) == "STRING"
        number = F.when(~is_text, F.try_variant_get(column, "$", "double"))
        empty = (
            F.is_variant_null(column)
            | F.to_json(column).isin('""', "false", "[]", "{}")
            | F.coalesce(number == 0, F.lit(False))
        )
    else:
        empty = F.lit(False)
    return column.isNull() | empty


def booking_rules(
    rows: DataFrame,
    required: Iterable[str] = REQUIRED,
    valid_statuses: Iterable[str] = VALID_STATUSES,
    status: str = "status",
) -> list[Rule]:
    """Missing-value rules in the order given, then the status rule.

    The status match is exact; an empty status is missing, not invalid.
    """
    rules = [Rule(is_missing(rows, c), F.lit(f"Missing {c}")) for c in required]
    text = F.col(status)
    if isinstance(rows.schema[status].dataType, VariantType):
        text = F.coalesce(F.try_variant_get(text, "$", "string"), F.to_json(text))
    invalid = ~is_missing(rows, status) & ~text.isin(*valid_statuses)
    return [*rules, Rule(invalid, F.concat(F.lit("Invalid status: "), text))]


def anomaly_messages(rules: Iterable[Rule]) -> Column:
    """The messages of all failed rules of a row, in rule order."""
    return F.array_compact(F.array(*[F.when(r.failed, r.message) for r in rules]))
