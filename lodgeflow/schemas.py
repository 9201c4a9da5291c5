"""One explicit schema per table, so that no read needs an inference pass."""

from pyspark.sql.types import (
    ArrayType,
    DateType,
    DoubleType,
    FloatType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
    VariantType,
)


def _struct(**columns) -> StructType:
    return StructType([StructField(name, type_()) for name, type_ in columns.items()])


LISTINGS = _struct(id=LongType, name=StringType, price=StringType)
REVIEWS = _struct(id=LongType, listing_id=LongType)
BOOKINGS = _struct(
    booking_id=LongType,
    listing_id=LongType,
    user_id=LongType,
    booking_time=TimestampNTZType,
    status=StringType,
)
CUSTOMER_REVIEWS = _struct(
    review_id=LongType,
    listing_id=LongType,
    review_score=FloatType,
    review_comment=StringType,
    review_date=TimestampNTZType,
)
PAGE_VISITS = _struct(id=LongType, name=StringType, price=LongType, page_visits=LongType)

# Any field may hold a number, a text or "": VARIANT keeps 0, "0" and "" apart.
DIRTY_BOOKINGS = _struct(
    booking_id=VariantType,
    listing_id=VariantType,
    user_id=VariantType,
    booking_time=VariantType,
    status=VariantType,
)

ORDERS = _struct(OrderID=IntegerType, OrderDate=DateType, CustomerID=IntegerType)
ORDER_LINES_SOURCE = _struct(OrderID=IntegerType, Quantity=IntegerType, UnitPrice=DoubleType)
CUSTOMERS = _struct(CustomerID=IntegerType, CustomerName=StringType)

# unit_price stays text on input: it may read "$1,234.00".
ORDER_LINES = _struct(
    order_id=IntegerType,
    order_date=DateType,
    customer_name=StringType,
    quantity=IntegerType,
    unit_price=StringType,
)

PRICED_ORDER_LINES = StructType([
    StructField(f.name, DoubleType()) if f.name == "unit_price" else f for f in ORDER_LINES.fields
])

ANOMALIES = StructType([
    StructField("batch_minute", TimestampNTZType()),
    StructField("row_index", LongType()),
    StructField("anomalies", ArrayType(StringType())),
])
