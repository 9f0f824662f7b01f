"""Listing, deleting and publishing files of the cluster's file systems, by the driver."""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


@dataclass(frozen=True)
class Entry:
    path: str
    is_dir: bool
    size: int
    modified_ms: int

    @property
    def name(self) -> str:
        return self.path.rstrip("/").rsplit("/", 1)[-1]


class Files:
    """The file systems that Spark's own readers and writers use. Needs a classic session: a remote one has no such access."""

    def __init__(self, spark: SparkSession):
        try:
            context = spark.sparkContext
        except Exception as error:
            raise RuntimeError("files can only be listed and deleted by a session that runs the driver") from error
        self._hadoop, self._conf = context._jvm.org.apache.hadoop.fs, context._jsc.hadoopConfiguration()
        self._options = context._gateway.new_array(self._hadoop.Options.Rename, 0)

    def _at(self, path: str):
        own = self._hadoop.Path(path)
        return own.getFileSystem(self._conf), own

    def exists(self, path: str) -> bool:
        system, own = self._at(path)
        return system.exists(own)

    def entries(self, path: str) -> list[Entry]:
        """What lies directly in a folder, by name; nothing where it doesn't exist."""
        system, own = self._at(path)
        if not system.exists(own):
            return []
        found = [Entry(s.getPath().toString(), s.isDirectory(), s.getLen(), s.getModificationTime()) for s in system.listStatus(own)]
        return sorted(found, key=lambda e: e.name)

    def delete(self, path: str) -> None:
        system, own = self._at(path)
        system.delete(own, True)

    def read(self, path: str) -> str:
        system, own = self._at(path)
        stream = system.open(own)
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def write_new(self, path: str, text: str) -> bool:
        """Put a whole file in place in one step; False, and no change, where there is one already."""
        folder, name = path.rsplit("/", 1)
        system, draft = self._at(f"{folder}/.{name}-{uuid.uuid4().hex}")
        stream = system.create(draft, False)
        try:
            stream.write(text.encode())
        finally:
            stream.close()
        try:
            context = self._hadoop.FileContext.getFileContext(draft.toUri(), self._conf)
            context.rename(context.makeQualified(draft), context.makeQualified(self._hadoop.Path(path)), self._options)
        except Py4JJavaError as error:
            system.delete(draft, False)
            if "FileAlreadyExists" in str(error.java_exception):
                return False
            raise
        return True
