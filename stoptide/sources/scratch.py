"""Paths in whatever store the session knows: the shared scratch folder, listings, whole-file reads and renames."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

#: Folders made for sessions that name none, by application.
_MADE: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``; where that is unset and one machine does all, one of this process."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if named:
        return named.rstrip("/")
    master, app = spark.sparkContext.master, spark.sparkContext.applicationId
    if not (master == "local" or master.startswith("local[")):
        raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
    return _MADE.setdefault(app, f"file://{tempfile.mkdtemp(prefix='stoptide-')}")


def new_folder(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing else uses."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


class Store:
    """Hadoop's view of a path's file system: few small files, listings and renames, all from the driver."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self._jvm, self._conf = spark._jvm, spark._jsc.hadoopConfiguration()
        self._fs = self._path(root).getFileSystem(self._conf)

    def _path(self, path: str):
        return self._jvm.org.apache.hadoop.fs.Path(path)

    def names(self, folder: str) -> list[str]:
        """The names in a folder, in order; none if there is no such folder."""
        path = self._path(folder)
        return sorted(x.getPath().getName() for x in self._fs.listStatus(path)) if self._fs.exists(path) else []

    def read(self, path: str) -> str:
        stream = self._fs.open(self._path(path))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def write(self, path: str, text: str) -> None:
        stream = self._fs.create(self._path(path), False)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()

    def rename(self, old: str, new: str) -> bool:
        """Whether ``old`` took the name ``new``; false if that exists already."""
        target = self._path(new)
        return not self._fs.exists(target) and self._fs.rename(self._path(old), target)

    def delete(self, path: str) -> None:
        self._fs.delete(self._path(path), True)

    def exists(self, path: str) -> bool:
        return self._fs.exists(self._path(path))
