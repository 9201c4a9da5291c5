"""Row positions within a batch, without putting a batch into one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def _slot(column: str, bits: int):
    """Whole numbers by their upper bits, which keeps their order and cannot overflow."""
    return F.shiftright(F.col(column).cast("bigint"), bits)


def _rows_before(sizes: DataFrame, *group: str, order: str, size: str, name: str) -> DataFrame:
    earlier = Window.partitionBy(*group).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return sizes.withColumn(name, F.coalesce(F.sum(size).over(earlier), F.lit(0)))


def row_positions(
    rows: DataFrame, batch: str, key: str, name: str = "row_index", *, bits: int = 20
) -> DataFrame:
    """Add the 0-based position of each row in its ``batch``, in order of ``key``.

    ``key`` is a unique 64-bit whole number. Keys are cut into slots of
    2^bits and slots into blocks of 2^bits slots. A position is the row's
    number in its slot, plus the rows in earlier slots of its block, plus the
    rows in earlier blocks of its batch. So no window sees more than 2^bits
    rows or slots, or 2^(64 - 2 bits) blocks, however many rows one batch holds
    and however far apart its keys lie.
    """
    # Structs, because a null inside a struct equals itself in a join too.
    place = F.struct(F.col(batch).alias("batch"), _slot(key, bits).alias("slot"))
    placed = rows.withColumn("_place", place)

    sizes = (
        placed.groupBy("_place")
        .agg(F.count(F.lit(1)).alias("_rows"))
        .withColumn("_block", F.struct("_place.batch", _slot("_place.slot", bits).alias("block")))
    )
    blocks = _rows_before(
        sizes.groupBy("_block").agg(F.sum("_rows").alias("_in_block")),
        "_block.batch",
        order="_block.block",
        size="_in_block",
        name="_block_offset",
    )
    offsets = (
        _rows_before(sizes, "_block", order="_place.slot", size="_rows", name="_slot_offset")
        .join(blocks, "_block")
        .select("_place", (F.col("_slot_offset") + F.col("_block_offset")).alias("_offset"))
    )
    number = F.row_number().over(Window.partitionBy("_place").orderBy(key))
    return (
        placed.withColumn("_number", number)
        .join(offsets, "_place")
        .withColumn(name, (F.col("_offset") + F.col("_number") - 1).cast("bigint"))
        .drop("_place", "_number", "_offset")
    )
