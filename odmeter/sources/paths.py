"""File-system calls on any store that Spark can reach."""

from __future__ import annotations

from collections.abc import Iterable

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


class Folder:
    """Existence, move and delete for whole directories or files."""

    def __init__(self, spark: SparkSession, root: str):
        self._jvm = spark.sparkContext._jvm
        self._path = self._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def exists(self, path: str) -> bool:
        return self._fs.exists(self._path(path))

    def names(self, path: str) -> list[str]:
        if not self.exists(path):
            return []
        return sorted(s.getPath().getName() for s in self._fs.listStatus(self._path(path)))

    def sizes(self, path: str) -> dict[str, int]:
        """Names and sizes of the data files directly in a folder."""
        if not self.exists(path):
            return {}
        found = [(s.getPath().getName(), s.getLen()) for s in self._fs.listStatus(self._path(path)) if s.isFile()]
        return {name: size for name, size in sorted(found) if name[0] not in "._"}

    def write(self, path: str, text: str) -> None:
        """A small text file, replaced if it exists."""
        out = self._fs.create(self._path(path), True)
        out.write(bytearray(text.encode()))
        out.close()

    def set_time(self, path: str, seconds: int) -> None:
        """Modification time of a file, where the store lets it be set."""
        self._fs.setTimes(self._path(path), seconds * 1000, -1)

    def read(self, path: str) -> str:
        source = self._fs.open(self._path(path))
        text = self._jvm.org.apache.commons.io.IOUtils.toString(source, "UTF-8")
        source.close()
        return text

    def move(self, source: str, target: str) -> None:
        self._fs.mkdirs(self._path(target).getParent())
        if self.exists(target) or not self._fs.rename(self._path(source), self._path(target)):
            raise OSError(f"could not move {source} to {target}")

    def delete(self, path: str) -> None:
        self._fs.delete(self._path(path), True)


def existing(spark: SparkSession, paths: Iterable[str]) -> list[str]:
    """Those of the paths that exist."""
    return [p for p in paths if Folder(spark, p).exists(p)]


def footer_rows(spark: SparkSession, path: str) -> int | None:
    """Rows of a Parquet file as its footer says; None for contents that are no Parquet.  A file that can't be opened raises."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    place = jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(conf).open(place).close()
    try:
        reader = jvm.org.apache.parquet.hadoop.ParquetFileReader.open(jvm.org.apache.parquet.hadoop.util.HadoopInputFile.fromPath(place, conf))
    except Py4JJavaError:
        return None
    try:
        return reader.getRecordCount()
    finally:
        reader.close()
