"""Small files of a publication, through Hadoop's file systems so that any store which the cluster shares can hold them."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


class Folder:
    """A folder; names are relative to it. Only what publishing needs: few files, each small or copied as a stream."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._jvm, self._conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()

    def _at(self, name: str = ""):
        path = self._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)
        store = path.getFileSystem(self._conf)
        return store, store.makeQualified(path)

    def exists(self, name: str = "") -> bool:
        store, path = self._at(name)
        return store.exists(path)

    def names(self, name: str = "") -> list[str]:
        """What lies in a folder, in order of names; nothing if it isn't there."""
        store, path = self._at(name)
        return sorted(f.getPath().getName() for f in store.listStatus(path)) if store.exists(path) else []

    def read(self, name: str) -> str:
        store, path = self._at(name)
        stream = store.open(path)
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def create(self, name: str, content: str) -> bool:
        """Write a file that appears in full or not at all; False if it is there already, whoever wrote it."""
        return self._place(self._staged(content), name, overwrite=False)

    def replace(self, name: str, content: str) -> None:
        """The same in place of an older file; readers see the one or the other."""
        self._place(self._staged(content), name, overwrite=True)

    def _staged(self, content: str):
        store, path = self._at(f".staged/{uuid.uuid4().hex}")
        out = store.create(path, False)
        out.write(bytearray(content.encode()))
        out.close()
        return path

    def _place(self, staged, name: str, overwrite: bool) -> bool:
        store, path = self._at(name)
        store.mkdirs(path.getParent())
        fs = self._jvm.org.apache.hadoop.fs
        options = self.spark.sparkContext._gateway.new_array(fs.Options.Rename, int(overwrite))
        if overwrite:
            options[0] = fs.Options.Rename.OVERWRITE
        try:
            fs.FileContext.getFileContext(path.toUri(), self._conf).rename(staged, path, options)
        except Exception:
            if not overwrite and store.exists(path):
                store.delete(staged, False)
                return False
            raise
        return True

    def remove(self, name: str) -> None:
        store, path = self._at(name)
        store.delete(path, True)

    def move(self, old: str, new: str) -> None:
        """Give a file or folder another name that nothing has."""
        store, path = self._at(old)
        _, target = self._at(new)
        store.mkdirs(target.getParent())
        if not store.rename(path, target):
            raise OSError(f"{path} could not become {target}")

    def joined(self, parts: list[str], name: str, head: str, tail: str) -> None:
        """One file of head, the parts one after another as streams, and tail. The parts' lines begin with a comma each; the very
        first comma is left out."""
        store, path = self._at(name)
        store.mkdirs(path.getParent())
        out, first = store.create(path, True), True
        out.write(bytearray(head.encode()))
        for part in parts:
            source, where = self._at(part)
            stream = source.open(where)
            if first and stream.read() >= 0:  # the comma
                first = False
            self._jvm.org.apache.hadoop.io.IOUtils.copyBytes(stream, out, 1 << 16, False)
            stream.close()
        out.write(bytearray(tail.encode()))
        out.close()
