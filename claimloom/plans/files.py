"""Small files that are there whole or not at all, on whatever file system the store lies."""

from __future__ import annotations

import contextlib
import os
import shutil
import uuid
from typing import Protocol

from pyspark.sql import SparkSession


class Files(Protocol):
    """Names are relative to the store's folder."""

    def read(self, name: str) -> str | None: ...

    def replace(self, name: str, text: str) -> None:
        """One step puts the text in the place of what was there."""

    def create(self, name: str, text: str) -> bool:
        """One step puts the text there if nothing is; of several that try, one succeeds."""

    def join(self, name: str, head: str, parts: list[str]) -> None:
        """One step puts a file there that has the head and then the files ``parts``, whose bytes are copied in pieces."""


class LocalFiles:
    """A folder of this machine: renames replace, hard links don't."""

    def __init__(self, root: str):
        self.root = root

    def _path(self, name: str) -> str:
        return os.path.join(self.root, name)

    def read(self, name: str) -> str | None:
        try:
            with open(self._path(name), encoding="utf-8") as f:
                return f.read()
        except FileNotFoundError:
            return None

    def _written(self, name: str, text: str) -> str:
        folder, base = os.path.split(self._path(name))
        os.makedirs(folder, exist_ok=True)
        path = os.path.join(folder, f".{base}.{uuid.uuid4().hex}.tmp")
        with open(path, "w", encoding="utf-8") as f:
            f.write(text)
            f.flush()
            os.fsync(f.fileno())
        return path

    def _settle(self, name: str) -> None:
        """The entry of the folder is on disk too."""
        at = os.open(os.path.dirname(self._path(name)), os.O_RDONLY)
        try:
            os.fsync(at)
        finally:
            os.close(at)

    def replace(self, name: str, text: str) -> None:
        os.replace(self._written(name, text), self._path(name))
        self._settle(name)

    def create(self, name: str, text: str) -> bool:
        path = self._written(name, text)
        try:
            os.link(path, self._path(name))
        except FileExistsError:
            return False
        finally:
            with contextlib.suppress(FileNotFoundError):
                os.remove(path)
        self._settle(name)
        return True


    def join(self, name: str, head: str, parts: list[str]) -> None:
        path = self._written(name, head)
        with open(path, "ab") as out:
            for part in parts:
                with open(self._path(part), "rb") as f:
                    shutil.copyfileobj(f, out)
            os.fsync(out.fileno())
        os.replace(path, self._path(name))
        self._settle(name)


class HadoopFiles:
    """Any file system whose renames are single steps, such as HDFS."""

    def __init__(self, spark: SparkSession, root: str):
        self.root, self._jvm, self._gateway = root, spark.sparkContext._jvm, spark.sparkContext._gateway
        conf = spark.sparkContext._jsc.hadoopConfiguration()
        at = self._path("")
        self._fs = at.getFileSystem(conf)
        self._context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._fs.getUri(), conf)

    def _path(self, name: str):
        return self._fs_path(f"{self.root}/{name}" if name else self.root)

    def _fs_path(self, path: str):
        return self._jvm.org.apache.hadoop.fs.Path(path)

    def read(self, name: str) -> str | None:
        if not self._fs.exists(self._path(name)):
            return None
        stream = self._fs.open(self._path(name))
        try:
            return bytes(self._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
        finally:
            stream.close()

    def _written(self, name: str, text: str):
        path = self._path(f"{name}.{uuid.uuid4().hex}.tmp")
        stream = self._fs.create(path, False)
        try:
            stream.write(bytearray(text.encode()))
            stream.hsync()
        finally:
            stream.close()
        return path

    def _move(self, source, name: str, how: str) -> None:
        kind = getattr(self._jvm.org.apache.hadoop.fs, "Options$Rename")
        options = self._gateway.new_array(kind, 1)
        options[0] = kind.valueOf(how)
        self._context.rename(source, self._path(name), options)

    def replace(self, name: str, text: str) -> None:
        self._move(self._written(name, text), name, "OVERWRITE")

    def create(self, name: str, text: str) -> bool:
        source = self._written(name, text)
        try:
            self._move(source, name, "NONE")
        except Exception as wrong:
            if "FileAlreadyExists" not in str(wrong) and not self._fs.exists(self._path(name)):
                raise
            self._fs.delete(source, False)
            return False
        return True

    def join(self, name: str, head: str, parts: list[str]) -> None:
        path = self._path(f"{name}.{uuid.uuid4().hex}.tmp")
        out = self._fs.create(path, False)
        try:
            out.write(bytearray(head.encode()))
            for part in parts:
                stream = self._fs.open(self._path(part))
                try:
                    self._jvm.org.apache.hadoop.io.IOUtils.copyBytes(stream, out, 1 << 16, False)
                finally:
                    stream.close()
            out.hsync()
        finally:
            out.close()
        self._move(path, name, "OVERWRITE")


def files_at(spark: SparkSession, root: str) -> Files:
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root)
    found = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if found.getScheme() == "file":
        return LocalFiles(found.makeQualified(at).toUri().getPath())
    return HadoopFiles(spark, root)
