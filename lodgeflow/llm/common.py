"""What the operators of this package share: table access, lineage cuts, Arrow maps."""

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema, to_arrow_type
from pyspark.sql.types import DataType, StructType

from lodgeflow.session import scratch_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def landed(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back.

    The files outlive lost executors, and what is read from them has no lineage.
    """
    path = scratch_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fresh(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have yet."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def utf8(column: str) -> Column:
    """A text column as UTF-8 bytes, null as no bytes."""
    return F.coalesce(F.col(column).cast("binary"), F.lit(b""))


def map_rows(df: DataFrame, rows: Callable[..., Iterator[tuple]], schema: str) -> DataFrame:
    """Apply ``rows(*columns)`` to the column lists of each Arrow batch.

    ``rows`` yields output tuples. A batch is cut into runs of about 4 MB, so
    that the output of long texts stays small.
    """
    names = [part.split()[0] for part in schema.split(", ")]

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            step = max(1, batch.num_rows * (4 << 20) // max(batch.nbytes, 1))
            for start in range(0, batch.num_rows, step):
                part = batch.slice(start, step)
                out = list(rows(*(c.to_pylist() for c in part.columns)))
                if out:
                    columns = [pa.array(c, t) for c, t in zip(zip(*out), types)]
                    yield pa.RecordBatch.from_arrays(columns, names)

    parsed = StructType.fromDDL(schema)
    types = [f.type for f in to_arrow_schema(parsed)]
    return df.mapInArrow(batches, parsed)


def per_row(function: Callable, kind: str) -> Callable[..., Column]:
    """``function`` of the values of a row as a column function, by Arrow batches.

    Binary columns arrive as bytes, structs as dicts. The column is marked as not
    deterministic, so that a filter on it does not make Spark compute it twice.
    """
    parsed = DataType.fromDDL(kind)
    arrow = to_arrow_type(parsed)

    def apply(*columns: pa.Array) -> pa.Array:
        parts = []
        for start in range(0, len(columns[0]), 256):  # few texts at a time are Python objects
            rows = zip(*(c.slice(start, 256).to_pylist() for c in columns))
            parts.append(pa.array([function(*row) for row in rows], arrow))
        return pa.concat_arrays(parts) if parts else pa.array([], arrow)

    return F.arrow_udf(apply, returnType=parsed).asNondeterministic()
