"""Small files through the Hadoop file system: whole or not at all, and never over another."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import SparkSession


class Files:
    """Small files below a root.

    A file is written beside its place under a hidden name and then given its
    name in one step that fails if the name is taken: a hard link on a local
    disk, elsewhere the file system's rename without overwriting. That step
    is atomic on local disks and on file systems with atomic rename (HDFS and
    its like); on an object store that copies to rename, let one driver at a
    time write a table.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.jvm, self.root = spark._jvm, root.rstrip("/")
        self.conf = spark._jsc.hadoopConfiguration()
        self.fs = self._path("").getFileSystem(self.conf)

    def _path(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}".rstrip("/"))

    def exists(self, name: str = "") -> bool:
        return self.fs.exists(self._path(name))

    def names(self, folder: str) -> list[str]:
        """Names in a folder, sorted; hidden ones are left out."""
        if not self.exists(folder):
            return []
        found = (s.getPath().getName() for s in self.fs.listStatus(self._path(folder)))
        return sorted(n for n in found if not n.startswith((".", "_")))

    def read(self, name: str) -> str:
        stream = self.fs.open(self._path(name))
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def put(self, name: str, text: str) -> bool:
        """Write a new file; False if there is one of that name."""
        folder, _, last = name.rpartition("/")
        draft, place = self._path(f"{folder}/.{last}-{uuid.uuid4().hex}"), self._path(name)
        stream = self.fs.create(draft, False)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        try:
            return self._publish(draft, place)
        finally:
            self.fs.delete(draft, False)

    def _publish(self, draft, place) -> bool:
        if self.fs.getUri().getScheme() == "file":
            try:
                os.link(draft.toUri().getPath(), place.toUri().getPath())
            except FileExistsError:
                return False
            return True
        context = self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(self.fs.getUri(), self.conf)
        rename = self.jvm.org.apache.hadoop.fs.Options.Rename
        options = self.jvm.java.lang.reflect.Array.newInstance(rename.NONE.getClass(), 1)
        options[0] = rename.NONE
        try:
            context.rename(draft, place, options)
        except Exception:  # the file system's own "already exists"; anything else is raised again
            if not self.fs.exists(place) or not self.fs.exists(draft):
                raise
            return False
        return True

    def size(self, name: str) -> int:
        """Bytes of a file, or of all files of a folder."""
        return self.fs.getContentSummary(self._path(name)).getLength()

    def delete(self, name: str) -> None:
        self.fs.delete(self._path(name), True)
