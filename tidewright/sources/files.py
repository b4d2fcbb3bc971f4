"""Small files on whatever file system a path names, through Spark's Hadoop client."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


class Folder:
    """A folder on local disk, HDFS or an object store."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self._jvm = spark._jvm
        self.path = path
        conf = spark._jsc.hadoopConfiguration()
        self._fs = self._jvm.org.apache.hadoop.fs.Path(path).getFileSystem(conf)

    def _at(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)

    def names(self) -> list[str]:
        if not self._fs.exists(self._at("")):
            return []
        return sorted(s.getPath().getName() for s in self._fs.listStatus(self._at("")))

    def read_text(self, name: str) -> str:
        stream = self._fs.open(self._at(name))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def create_text(self, name: str, text: str) -> None:
        """Writes a new file that appears whole or not at all; an existing one is refused."""
        hidden = f".{uuid.uuid4().hex}"
        self._fs.mkdirs(self._at(""))
        stream = self._fs.create(self._at(hidden), False)
        try:
            stream.write(bytearray(text, "utf-8"))
        finally:
            stream.close()
        if self._fs.exists(self._at(name)) or not self._fs.rename(self._at(hidden), self._at(name)):
            self._fs.delete(self._at(hidden), False)
            raise FileExistsError(f"{self.path}/{name}")

    def remove(self, name: str) -> None:
        self._fs.delete(self._at(name), True)
