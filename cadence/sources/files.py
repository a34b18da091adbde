"""Small metadata files in the shared folder, through the file system that Spark itself uses there.

Names and a few lines only: data goes through Spark's readers and writers.
"""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


class Files:
    """The file system that holds ``folder``."""

    def __init__(self, spark: SparkSession, folder: str):
        self._jvm = spark.sparkContext._jvm
        self._fs = self._path(folder).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _path(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(name)

    def exists(self, name: str) -> bool:
        return self._fs.exists(self._path(name))

    def names(self, folder: str) -> list[str]:
        """What lies in a folder, finished files only; nothing where there is no folder."""
        path = self._path(folder)
        if not self._fs.exists(path):
            return []
        found = [entry.getPath().getName() for entry in self._fs.listStatus(path)]
        return sorted(name for name in found if not name.startswith("_new-"))

    def put(self, folder: str, name: str, text: str = "") -> None:
        """Write a file that appears whole; one that is there already stays as it is."""
        target = f"{folder}/{name}"
        if self.exists(target):
            return
        draft = self._path(f"{folder}/_new-{uuid.uuid4().hex}")
        stream = self._fs.create(draft)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        if not self._fs.rename(draft, self._path(target)) and not self.exists(target):
            raise OSError(f"{target} could not be written")

    def read(self, name: str) -> str | None:
        path = self._path(name)
        if not self._fs.exists(path):
            return None
        stream = self._fs.open(path)
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def remove(self, name: str) -> None:
        """Remove a file, or a folder with what is in it."""
        self._fs.delete(self._path(name), True)
