"""Shared folder for written intermediate data and stream checkpoints."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def shared_root(spark: SparkSession) -> str:
    """Folder named by `spark.checkpoint.dir`; where it is unset, a folder below the warehouse, which is shared too.

    On a cluster the warehouse must not be a folder of the driver's machine; such a setting is refused.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
    if not spark.conf.get("spark.master", "local").startswith("local") and warehouse.startswith(("file:", "/")):
        raise ValueError("set spark.checkpoint.dir to a folder that all machines share")
    return warehouse + "/_sparkloom_work"


def application_folder(spark: SparkSession) -> str:
    """Parent of all folders that `new_folder` names in this application; delete it when its results are done with."""
    return f"{shared_root(spark)}/sparkloom-{spark.sparkContext.applicationId}"


def new_folder(spark: SparkSession, label: str) -> str:
    """Path of a fresh, not yet existing folder below the shared root, grouped by application."""
    path = f"{application_folder(spark)}/{label}-{uuid.uuid4().hex}"
    for notes in _NOTES:
        notes.append(path)
    return path


_NOTES: list[list[str]] = []


@contextmanager
def noted_folders() -> Iterator[list[str]]:
    """The paths that `new_folder` names within the block, for `remove_folders` once they are no longer read."""
    notes: list[str] = []
    _NOTES.append(notes)
    try:
        yield notes
    finally:
        _NOTES[:] = [other for other in _NOTES if other is not notes]


def remove_folders(spark: SparkSession, paths: list[str]) -> None:
    for path in paths:
        Store(spark, path).remove(path)


def written(frame: DataFrame, label: str) -> DataFrame:
    """Write the frame once to the shared folder and read it back. This runs a job at once.

    Later steps neither recompute it nor depend on the executors that made it, and Catalyst knows its
    real size when it chooses a join. The folder stays until `application_folder` is deleted.
    """
    path = new_folder(frame.sparkSession, label)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


@contextmanager
def passing(frame: DataFrame, label: str) -> Iterator[DataFrame]:
    """`written` for the length of a block: the folder is removed at its end, also after an error."""
    path = new_folder(frame.sparkSession, label)
    try:
        frame.write.parquet(path)
        yield frame.sparkSession.read.schema(frame.schema).parquet(path)
    finally:
        Store(frame.sparkSession, path).remove(path)


class Store:
    """The file system that Spark uses for a path: names, small texts, removal and renaming."""

    def __init__(self, spark: SparkSession, path: str):
        self._paths = spark.sparkContext._jvm.org.apache.hadoop.fs
        self._files = self._paths.Path(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        self._streams = spark.sparkContext._jvm.org.apache.commons.io.IOUtils

    def names(self, folder: str) -> list[str]:
        """Names in a folder, without hidden ones; none if there is no such folder."""
        path = self._paths.Path(folder)
        if not self._files.exists(path):
            return []
        found = [status.getPath().getName() for status in self._files.listStatus(path)]
        return sorted(name for name in found if name[0] not in "._")

    def text(self, path: str) -> str:
        stream = self._files.open(self._paths.Path(path))
        try:
            return self._streams.toString(stream, "UTF-8")
        finally:
            stream.close()

    def publish(self, path: str, text: str) -> None:
        """Write a small text so that it appears as a whole; fails where the path is taken."""
        target = self._paths.Path(path)
        hidden = self._paths.Path(target.getParent(), f".{uuid.uuid4().hex}")
        stream = self._files.create(hidden)
        stream.write(bytearray(text, "utf-8"))
        stream.close()
        if self._files.exists(target) or not self._files.rename(hidden, target):
            self._files.delete(hidden, False)
            raise FileExistsError(f"{path} was published by another writer")

    def remove(self, path: str) -> None:
        """Remove a file or folder, if it is there."""
        self._files.delete(self._paths.Path(path), True)
