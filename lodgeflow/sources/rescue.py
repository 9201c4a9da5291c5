"""CSV rows that do not fit their schema, kept and counted instead of quietly blanked."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from lodgeflow.sources.files import QUOTED

#: What happened to a row; null for a sound one.
RESCUED = "struct<problem: string, record: string, bad: map<string, string>>"
_RECORD = "_corrupt_record"


def read_csv_rescued(
    spark: SparkSession,
    path: str | list[str],
    schema: StructType,
    *,
    header: bool = True,
    multi_line: bool = True,
    rescued: str = "_rescued",
    keep: tuple[str, ...] = (),
    **options: str,
) -> DataFrame:
    """As :func:`lodgeflow.sources.read_csv`, with a column ``rescued`` for what typing or a wrong number of fields would lose.

    It is null for a sound row, and otherwise holds the ``problem`` (``short``,
    ``surplus`` or ``bad text``), the whole ``record`` as it was read where the
    number of fields is wrong, and the text of each column whose value became
    null because it does not parse. Missing fields of a short row are null; the
    fields that are there keep their values. All in one pass over the files; the
    whole record is parsed, so other columns of a wide file are no longer free.
    """
    reader = {**QUOTED, "multiLine": multi_line, "header": header, "enforceSchema": False, **options}
    names = spark.read.options(**reader).csv(path).columns if header else schema.fieldNames()
    text = StructType([StructField(n, StringType()) for n in [*names, _RECORD]])
    raw = spark.read.options(**reader, columnNameOfCorruptRecord=_RECORD).schema(text).csv(path)
    lost = [f for f in schema.fields if not isinstance(f.dataType, StringType)]
    bad = F.map_filter(
        F.map_from_arrays(
            F.array(*[F.lit(f.name) for f in lost]),
            F.array(*[F.when(F.col(f.name).try_cast(f.dataType).isNull(), F.col(f.name)) for f in lost]),
        )
        if lost
        else F.create_map().cast("map<string, string>"),
        lambda _, value: value.isNotNull(),
    )
    problem = (
        F.when(F.col(_RECORD).isNull(), F.when(F.size(bad) > 0, "bad text"))
        .when(fields(F.col(_RECORD)) < len(names), "short")
        .when(fields(F.col(_RECORD)) > len(names), "surplus")
        .otherwise("bad text")
    )
    typed = [F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schema.fields]
    found = F.struct(problem.alias("problem"), F.col(_RECORD).alias("record"), bad.alias("bad"))
    return raw.select(*typed, F.when(problem.isNotNull(), found).alias(rescued), *keep)


def fields(record: Column) -> Column:
    """The number of fields of a CSV record: separators outside quotes, and one."""
    plain = F.regexp_replace(record, '"[^"]*"', "")
    return F.length(plain) - F.length(F.replace(plain, F.lit(","))) + 1


def rescued_counts(schema: StructType, rescued: str = "_rescued") -> dict[str, Column]:
    """Aggregates that count a table's rows, its rescued rows by problem, and the bad texts of each column.

    Give them to ``agg``, or as metrics to ``observe`` on the rows as they were
    read, so that a job's own pass counts them.
    """
    problem, bad = F.col(rescued)["problem"], F.col(rescued)["bad"]
    counts = {"n_rows": F.count(F.lit(1))}
    counts |= {f"n_{p.replace(' ', '_')}": F.count_if(problem == p) for p in ("short", "surplus", "bad text")}
    lost = [f.name for f in schema.fields if not isinstance(f.dataType, StringType)]
    counts |= {f"bad_{c}": F.count_if(F.map_contains_key(bad, c)) for c in lost}
    return counts
