"""Replace a target only once its successor is whole."""

from __future__ import annotations

from collections.abc import Callable
from uuid import uuid4

from pyspark.sql import SparkSession

#: Names of folders beside a target: a successor being written, and a predecessor while it is replaced.
_NEW, _OLD = "_new-", "_old-"


def replace(spark: SparkSession, path: str, write: Callable[[str], None]) -> None:
    """Call ``write`` with a fresh folder beside ``path``, then put that in the place of ``path``.

    Until ``write`` has returned, readers find the former result, and so they do
    if it fails: Spark's own overwrite deletes the target before the job begins.
    ``write`` may therefore also read ``path``. The new folder lies in the same
    parent, under a name that Spark's readers skip, so that putting it in place is
    a rename. If the process dies between the two renames, :func:`recover` or the
    next write completes the exchange. Readers that are open on the former files
    during the exchange may fail and must read again.
    """
    files = _Files(spark, path)
    recover(spark, path)
    token = uuid4().hex
    new = files.beside(f"{_NEW}{token}")
    try:
        write(new)
    except BaseException:
        files.delete(new)
        raise
    # The old folder's name tells which new one was whole when the exchange began.
    old = files.beside(f"{_OLD}{token}")
    if files.exists(path):
        files.rename(path, old)
    files.rename(new, path)
    files.delete(old)


def recover(spark: SparkSession, path: str) -> None:
    """Complete an exchange that the end of a process has cut short; otherwise change nothing."""
    files = _Files(spark, path)
    for old in files.named(_OLD):
        if not files.exists(path):
            new = old.replace(f".{_OLD}", f".{_NEW}")
            files.rename(new if files.exists(new) else old, path)
        files.delete(old)


class _Files:
    """The file system of ``path``, through Hadoop's interface, and the names beside it."""

    def __init__(self, spark: SparkSession, path: str):
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        whole = self._path(path)
        self._fs = whole.getFileSystem(spark._jsc.hadoopConfiguration())
        self._name, self._parent = whole.getName(), whole.getParent()

    def beside(self, suffix: str) -> str:
        # A leading underscore makes Spark's readers skip the folder.
        return self._path(self._parent, f"_{self._name}.{suffix}").toString()

    def named(self, suffix: str) -> list[str]:
        if not self._fs.exists(self._parent):
            return []
        head = f"_{self._name}.{suffix}"
        return [s.getPath().toString() for s in self._fs.listStatus(self._parent) if s.getPath().getName().startswith(head)]

    def exists(self, path: str) -> bool:
        return self._fs.exists(self._path(path))

    def rename(self, source: str, target: str) -> None:
        if not self._fs.rename(self._path(source), self._path(target)):
            raise OSError(f"cannot rename {source} to {target}")

    def delete(self, path: str) -> None:
        self._fs.delete(self._path(path), True)
