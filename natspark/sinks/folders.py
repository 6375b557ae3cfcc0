"""Small files and folders on the file system that the cluster shares."""

from __future__ import annotations

from pyspark.sql import SparkSession


class Folder:
    """A folder by its URI, through Hadoop's file system interface."""

    def __init__(self, spark: SparkSession, uri: str):
        self.spark, self.uri = spark, uri.rstrip("/")
        path = self._path("")
        self.fs = path.getFileSystem(spark._jsc.hadoopConfiguration())

    def _path(self, name: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.uri}/{name}" if name else self.uri)

    def make(self, name: str = "") -> None:
        self.fs.mkdirs(self._path(name))

    def names(self, name: str = "") -> list[str]:
        """Names in a folder, sorted; none if it isn't there."""
        path = self._path(name)
        return sorted(s.getPath().getName() for s in self.fs.listStatus(path)) if self.fs.exists(path) else []

    def read(self, name: str) -> str:
        stream = self.fs.open(self._path(name))
        try:
            return self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def publish(self, name: str, text: str) -> bool:
        """Write a file that readers see whole or not at all; False if the
        name is taken (another writer was first)."""
        import uuid

        draft, final = self._path(f"_{name}.{uuid.uuid4().hex}"), self._path(name)
        stream = self.fs.create(draft, True)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        if self.fs.exists(final) or not self.fs.rename(draft, final):
            self.fs.delete(draft, False)
            return False
        return True

    def delete(self, name: str) -> None:
        self.fs.delete(self._path(name), True)
