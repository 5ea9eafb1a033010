"""Small files and file moves in whatever store Spark writes to (Hadoop's file system interface)."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import SparkSession


class Store:
    """The store that holds ``root``. Paths are plain text, relative to it, with spaces and all; none is URI-encoded."""

    def __init__(self, spark: SparkSession, root: str):
        self._jvm = spark._jvm
        self.root = self._jvm.org.apache.hadoop.fs.Path(root.rstrip("/"))
        self._fs = self.root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def path(self, name: str = ""):
        return self._jvm.org.apache.hadoop.fs.Path(self.root, name) if name else self.root

    def full(self, name: str = "") -> str:
        return self.path(name).toString()

    def relative(self, path) -> str:
        """A file's name relative to the root."""
        base = self._fs.makeQualified(self.root).toUri().getPath().rstrip("/") + "/"
        return self._fs.makeQualified(path).toUri().getPath()[len(base) :]

    def exists(self, name: str = "") -> bool:
        return bool(self._fs.exists(self.path(name)))

    def names(self, name: str = "") -> list[str]:
        """Names of the files and folders in a folder; none if it isn't there."""
        if not self.exists(name):
            return []
        return sorted(s.getPath().getName() for s in self._fs.listStatus(self.path(name)))

    def files(self, name: str = "") -> Iterator[tuple[str, int]]:
        """Files below a folder, relative to it, with their sizes; without those that Spark ignores."""
        base = self._fs.makeQualified(self.path(name)).toUri().getPath().rstrip("/") + "/"
        found = self._fs.listFiles(self.path(name), True)
        while found.hasNext():
            status = found.next()
            relative = status.getPath().toUri().getPath()[len(base) :]
            if not relative.rsplit("/", 1)[-1].startswith(("_", ".")):
                yield relative, int(status.getLen())

    def move(self, source: str, target: str) -> None:
        """Move a file to where no file is; its folder is made."""
        to = self.path(target)
        self._fs.mkdirs(to.getParent())
        if not self._fs.rename(self.path(source), to):
            raise OSError(f"could not move {self.full(source)} to {self.full(target)}")

    def delete(self, name: str) -> bool:
        where = self.path(name)
        return bool(self._fs.exists(where) and self._fs.delete(where, True))

    def write_text(self, name: str, text: str) -> bool:
        """Write a new small file whole; returns False, and changes nothing, if the file is there already."""
        if self.exists(name):
            return False
        draft = self.path(f"{name}.{self._jvm.java.util.UUID.randomUUID().toString()}.tmp")
        out = self._fs.create(draft, False)
        try:
            out.write(bytearray(text.encode("utf-8")))
        finally:
            out.close()
        # A rename fails where a file is: of two writers one wins.
        done = bool(self._fs.rename(draft, self.path(name)))
        if not done:
            self._fs.delete(draft, False)
        return done

    def read_text(self, name: str) -> str:
        stream = self._fs.open(self.path(name))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()


def matching_files(spark: SparkSession, pattern: str, recursive: bool = False) -> Iterator[tuple[str, int, int]]:
    """Path, size and time of change of the files that a reader of ``pattern`` finds: a file, a folder or a glob."""
    where = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    fs = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for top in fs.globStatus(where) or []:
        below = fs.listFiles(top.getPath(), recursive) if top.isDirectory() else None
        statuses = iter(lambda: below.next() if below.hasNext() else None, None) if below else [top]
        for s in statuses:
            if s.isFile() and not s.getPath().getName().startswith(("_", ".")):
                yield s.getPath().toString(), int(s.getLen()), int(s.getModificationTime())
