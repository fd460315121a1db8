"""Small files on any file system that Spark reaches; a file appears whole or not at all."""

from __future__ import annotations

import contextlib
import os
from collections.abc import Iterator
from pathlib import Path

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


class Files:
    """Files below a folder. Local folders use links, others the file system's rename, which must be atomic and must
    refuse a target that exists, as HDFS does."""

    def __init__(self, spark: SparkSession, folder: str, local: bool = True):
        self.folder = str(folder).rstrip("/")
        self._jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
        root = self._jvm.org.apache.hadoop.fs.Path(self.folder)
        self._fs = root.getFileSystem(conf)
        self._fs.mkdirs(root)
        self._context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._fs.getUri(), conf)
        options = getattr(self._jvm.org.apache.hadoop.fs, "Options$Rename")
        self._no_options = spark.sparkContext._gateway.new_array(options, 0)
        self._local = Path(root.toUri().getPath()) if local and self._fs.getScheme() == "file" else None

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}"

    def _path(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(self.path(name))

    def _write(self, name: str, text: str) -> None:
        out = self._fs.create(self._path(name), True)
        out.write(bytearray(text.encode()))
        out.close()

    def create(self, name: str, text: str) -> bool:
        """Writes a file that isn't there yet; whether it did. Of writers at the same time one does."""
        draft = f"_draft-{os.urandom(8).hex()}"
        self._write(draft, text)
        try:
            return self._link(draft, name)
        finally:
            self.delete(draft)

    def _link(self, draft: str, name: str) -> bool:
        if self._local:
            try:
                os.link(self._local / draft, self._local / name)
                return True
            except FileExistsError:
                return False
        return self.move(draft, name)

    def replace(self, name: str, text: str) -> None:
        """Writes a file over what is there."""
        draft = f"_draft-{os.urandom(8).hex()}"
        self._write(draft, text)
        if self._local:
            os.replace(self._local / draft, self._local / name)
        else:
            self.delete(name)
            self.move(draft, name)

    def move(self, name: str, to: str) -> bool:
        """Renames a file; False if it isn't there or the target is."""
        try:
            self._context.rename(self._path(name), self._path(to), self._no_options)
            return True
        except Py4JJavaError as e:
            if "FileNotFound" in str(e.java_exception) or "FileAlreadyExists" in str(e.java_exception):
                return False
            raise

    def read(self, name: str) -> str | None:
        """The text of a file, None if it isn't there."""
        try:
            stream = self._fs.open(self._path(name))
        except Py4JJavaError as e:
            if "FileNotFound" in str(e.java_exception):
                return None
            raise
        with contextlib.closing(stream):
            return bytes(stream.readAllBytes()).decode()

    def names(self, below: str = "") -> Iterator[str]:
        """Names of what is below a folder, folders with a slash; none if it isn't there."""
        path = self._path(below) if below else self._jvm.org.apache.hadoop.fs.Path(self.folder)
        if self._fs.exists(path):
            for s in self._fs.listStatus(path):
                yield s.getPath().getName() + ("/" if s.isDirectory() else "")

    def delete(self, name: str) -> None:
        """Removes a file or a folder with all below it, if it is there."""
        self._fs.delete(self._path(name), True)
