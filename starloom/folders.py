"""Folder operations on any Hadoop file system."""

from __future__ import annotations

from pyspark.sql import SparkSession


class Folders:
    """Folder operations on whatever Hadoop file system a path names.  PySpark
    has no public API for them, so this is the one place that goes through the
    JVM gateway."""

    def __init__(self, path: str, spark: SparkSession | None = None):
        self._spark = spark or SparkSession.getActiveSession()
        self._jvm = self._spark._jvm
        self._conf = self._spark._jsc.hadoopConfiguration()
        self._fs = self._path(path).getFileSystem(self._conf)

    def _path(self, path: str):
        return self._jvm.org.apache.hadoop.fs.Path(path)

    def exists(self, path: str) -> bool:
        return bool(self._fs.exists(self._path(path)))

    def mkdirs(self, path: str) -> None:
        self._fs.mkdirs(self._path(path))

    def rename(self, src: str, dst: str) -> None:
        """Move ``src`` to ``dst``; an error if ``dst`` is there."""
        hadoop = self._jvm.org.apache.hadoop.fs
        none = self._spark.sparkContext._gateway.new_array(getattr(hadoop, "Options$Rename"), 0)
        at = self._fs.makeQualified(self._path(dst))
        hadoop.FileContext.getFileContext(at.toUri(), self._conf).rename(
            self._fs.makeQualified(self._path(src)), at, none)

    def delete(self, path: str) -> None:
        if self.exists(path):
            self._fs.delete(self._path(path), True)

    def names(self, path: str) -> dict[str, float]:
        """Entries of a folder and the time each was last changed."""
        if not self.exists(path):
            return {}
        return {s.getPath().getName(): s.getModificationTime() / 1000 for s in self._fs.listStatus(self._path(path))}

    def read(self, path: str) -> str:
        stream = self._fs.open(self._path(path))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def write(self, path: str, text: str) -> None:
        stream = self._fs.create(self._path(path), True)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
