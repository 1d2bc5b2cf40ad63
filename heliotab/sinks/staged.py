"""Outputs that replace an earlier one only when they are complete.

A result is written beside its destination and takes its place by renaming.  A job that fails
leaves the earlier result as it was.  If the process ends between the two renames, the next
``replace`` or ``settle`` of the destination finishes or undoes the swap before anything else.
Renames are atomic in file systems like HDFS; in an object store without them they copy, and
readers should follow a table format instead.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import SparkSession

DONE = "_complete"  # written into the staged folder when its write has returned


class _Folder:
    """A destination in its file system, and the folders beside it that belong to swaps."""

    def __init__(self, spark: SparkSession, path: str):
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self.target = self._path(path.rstrip("/"))
        self.fs = self.target.getFileSystem(spark._jsc.hadoopConfiguration())
        self.target = self.fs.makeQualified(self.target)
        self.parent, self.name = self.target.getParent(), self.target.getName()

    def beside(self, kind: str, token: str):
        return self._path(self.parent, f".{self.name}.{kind}-{token}")

    def inside(self, folder, name: str):
        return self._path(folder, name)

    def listed(self, kind: str) -> list:
        if not self.fs.exists(self.parent):
            return []
        prefix = f".{self.name}.{kind}-"
        return [s.getPath() for s in self.fs.listStatus(self.parent) if s.getPath().getName().startswith(prefix)]

    def rename(self, source, target) -> None:
        if not self.fs.rename(source, target):
            raise OSError(f"cannot rename {source.toString()} to {target.toString()}")

    def drop(self, folder) -> None:
        self.fs.delete(folder, True)


def settle(spark: SparkSession, path: str) -> None:
    """Finish or undo a swap of ``path`` that was cut off; folders of abandoned writes stay aside.

    Without a result at ``path`` a complete staged one moves in, else the earlier one moves back.
    """
    folder = _Folder(spark, path)
    if not folder.fs.exists(folder.target):
        old = folder.listed("old")
        complete = [s for s in folder.listed("staged") if folder.fs.exists(folder.inside(s, DONE))]
        if old and complete:
            folder.rename(complete[0], folder.target)
        elif old:
            folder.rename(old[0], folder.target)
    if folder.fs.exists(folder.target):
        for old in folder.listed("old"):
            folder.drop(old)
        folder.fs.delete(folder.inside(folder.target, DONE), False)


def replace(spark: SparkSession, path: str, write: Callable[[str], None]) -> None:
    """Let ``write(folder)`` write a new result for ``path``, then swap it in.

    If ``write`` raises, what it wrote is deleted, the earlier result stays and the error is raised.
    One writer at a time may replace a destination.
    """
    settle(spark, path)
    folder, token = _Folder(spark, path), uuid.uuid4().hex
    staged, old = folder.beside("staged", token), folder.beside("old", token)
    try:
        write(staged.toString())
        folder.fs.create(folder.inside(staged, DONE), True).close()
    except BaseException:
        folder.drop(staged)
        raise
    if folder.fs.exists(folder.target):
        folder.rename(folder.target, old)
    folder.rename(staged, folder.target)
    settle(spark, path)
