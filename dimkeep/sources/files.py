"""Small driver-side file operations on whatever file system the path names."""

from __future__ import annotations

from pyspark.sql import SparkSession


class Files:
    def __init__(self, spark: SparkSession, root: str):
        self._jvm = spark.sparkContext._jvm
        self.root = root.rstrip("/")
        self._fs = self._path("").getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _path(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}" if name else self.root)

    def names(self, folder: str) -> list[str]:
        path = self._path(folder)
        if not self._fs.exists(path):
            return []
        names = (s.getPath().getName() for s in self._fs.listStatus(path))
        # what a write is still at, or has left where it was stopped, does not count
        return sorted(n for n in names if not n.startswith((".", "_SUCCESS", "_temporary")))

    def read_text(self, name: str) -> str:
        stream = self._fs.open(self._path(name))
        try:
            return bytes(self._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode("utf-8")
        finally:
            stream.close()

    def write_text(self, name: str, text: str) -> None:
        """The file appears whole or not at all, and never replaces another."""
        final = self._path(name)
        draft = self._path(name + ".draft")
        stream = self._fs.create(draft, True)
        stream.write(bytearray(text.encode("utf-8")))
        stream.close()
        if self._fs.exists(final) or not self._fs.rename(draft, final):
            raise FileExistsError(f"{self.root}/{name}")

    def move(self, name: str, to: str) -> None:
        """The folder ``name`` takes the place of ``to``."""
        final = self._path(to)
        self._fs.delete(final, True)
        self._fs.mkdirs(final.getParent())
        if not self._fs.rename(self._path(name), final):
            raise FileNotFoundError(f"{self.root}/{name}")

    def remove(self, name: str) -> None:
        self._fs.delete(self._path(name), True)
