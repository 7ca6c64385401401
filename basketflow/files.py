"""File operations of the driver, on whatever file system a path names."""

from __future__ import annotations

from pyspark.sql import SparkSession


class Files:
    """The few operations needed; paths are those of one file system."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self._jvm = spark._jvm
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(path).getFileSystem(spark._jsc.hadoopConfiguration())

    def exists(self, path: str) -> bool:
        return self._fs.exists(self._path(path))

    def names(self, path: str) -> list[str]:
        """What lies directly in a folder; nothing if it is not there."""
        if not self.exists(path):
            return []
        return [found.getPath().getName() for found in self._fs.listStatus(self._path(path))]

    def below(self, path: str) -> list[str]:
        """Paths of all files in a folder and those below it, without scheme and host."""
        if not self.exists(path):
            return []
        found, out = self._fs.listFiles(self._path(path), True), []
        while found.hasNext():
            out.append(found.next().getPath().toUri().getPath())
        return out

    def size(self, path: str) -> int:
        return self._fs.getContentSummary(self._path(path)).getLength() if self.exists(path) else 0

    def modified(self, path: str) -> float:
        """When a file was last written, in seconds."""
        return self._fs.getFileStatus(self._path(path)).getModificationTime() / 1000

    def remove(self, path: str) -> None:
        self._fs.delete(self._path(path), True)

    def make(self, path: str) -> None:
        """A folder, if it is not there."""
        self._fs.mkdirs(self._path(path))

    def move(self, path: str, to: str) -> bool:
        """Give a file or folder another name; false if that did not work."""
        self._fs.mkdirs(self._path(to).getParent())
        return self._fs.rename(self._path(path), self._path(to))

    def read(self, path: str) -> str:
        stream = self._fs.open(self._path(path))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def halve(self, path: str) -> None:
        """Cut a file off in the middle, as a transfer that broke off would."""
        stream = self._fs.open(self._path(path))
        data = bytes(self._jvm.org.apache.commons.io.IOUtils.toByteArray(stream))
        stream.close()
        out = self._fs.create(self._path(path), True)
        out.write(bytearray(data[: len(data) // 2]))
        out.close()

    def write(self, path: str, text: str) -> None:
        stream = self._fs.create(self._path(path), True)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
