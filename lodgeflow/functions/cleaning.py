"""Text to numbers, and calendar parts. Bad text gives null, never an error."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def clean_currency(amount: Column) -> Column:
    """``"$1,234.00"`` -> 1234.0: every dollar sign and comma goes, then DOUBLE."""
    return F.regexp_replace(amount.cast("string"), "[$,]", "").try_cast("double")


def to_score(score: Column) -> Column:
    """A review score as a 32-bit float."""
    return score.try_cast("float")


def order_year(day: Column) -> Column:
    return F.year(day)


def order_month(day: Column) -> Column:
    return F.month(day)
