"""From a time range to the folders that hold it, so that no other folder is listed or read."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from datetime import datetime, timedelta

from pyspark.sql import SparkSession

# The stamp layouts of folder names, as in functions.timestamps, for Python.
_LAYOUTS = {"underscore": "%Y-%m-%d_%H%M", "dashed": "%Y-%m-%d_%H-%M", "compact": "%Y%m%d_%H%M"}

#: For so many folders at most each is asked for by name; beyond, the root is listed once, one level deep.
ASKED = 240


def minutes_between(start: str, end: str) -> Iterator[datetime]:
    """The minutes of ``[start, end)``, both cut to the minute."""
    at, last = (datetime.fromisoformat(t).replace(second=0, microsecond=0) for t in (start, end))
    while at < last:
        yield at
        at += timedelta(minutes=1)


def months_between(start: str, end: str) -> list[str]:
    """The months (``yyyy-MM``) that ``[start, end)`` touches."""
    first, last = (datetime.fromisoformat(t) for t in (start, end))
    months, at = [], first.replace(day=1, hour=0, minute=0, second=0, microsecond=0)
    while at < last:
        months.append(at.strftime("%Y-%m"))
        at = (at + timedelta(days=32)).replace(day=1)
    return months


def minute_folders(
    spark: SparkSession, root: str, minutes: Iterable[datetime], layout: str = "underscore"
) -> list[str]:
    """The folders (or files) below ``root`` that are named after one of ``minutes``, as far as they exist.

    Give the result to any reader of this package, such as
    :func:`lodgeflow.sources.read_minute_csv`. Only these folders are listed for
    their files. The names are held on the driver, one per minute asked for.
    """
    wanted = [at.strftime(_LAYOUTS[layout]) for at in minutes]
    return existing_folders(spark, root, wanted)


def existing_folders(spark: SparkSession, root: str, names: list[str]) -> list[str]:
    """``root/name`` for each of ``names`` that exists."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    base = path(root)
    files = base.getFileSystem(spark._jsc.hadoopConfiguration())
    if len(names) <= ASKED:
        return [found.toString() for name in names if files.exists(found := path(base, name))]
    wanted, found = set(names), []
    if files.exists(base):
        listed = files.listStatusIterator(base)
        while listed.hasNext():
            at = listed.next().getPath()
            if at.getName() in wanted:
                found.append(at.toString())
    return sorted(found)
