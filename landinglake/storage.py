"""Folders and files on whatever file system Hadoop knows, and the shared scratch folder.

Only names and paths pass through here, never data.
"""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

# Store requests in flight when many files are deleted.
DELETE_THREADS = 16


class Storage:
    """The file system that holds ``path``."""

    def __init__(self, spark: SparkSession, path: str):
        self._jvm = spark._jvm
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(path).getFileSystem(spark._jsc.hadoopConfiguration())

    def exists(self, path: str) -> bool:
        return self._fs.exists(self._path(path))

    def make_folder(self, path: str) -> None:
        self._fs.mkdirs(self._path(path))

    def touch(self, path: str) -> None:
        self._fs.create(self._path(path), True).close()

    def create_exclusive(self, path: str, text: str) -> bool:
        """Create a small file unless there is one; of several callers one succeeds."""
        target = self._path(path)
        if self._fs.getUri().getScheme() == "file":
            # Hadoop's local file system looks first and creates then.
            if not self._jvm.java.io.File(target.toUri().getPath()).createNewFile():
                return False
            stream = self._fs.create(target, True)
        else:
            try:
                stream = self._fs.create(target, False)
            except Py4JJavaError:
                if self._fs.exists(target):
                    return False
                raise
        stream.write(bytearray(text.encode()))
        stream.close()
        return True

    def read_text(self, path: str) -> str:
        stream = self._fs.open(self._path(path))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def rename(self, source: str, target: str) -> None:
        if not self._fs.rename(self._path(source), self._path(target)):
            raise OSError(f"could not move {source} to {target}")

    def delete(self, path: str) -> bool:
        return self._fs.delete(self._path(path), True)

    def delete_all(self, paths: Iterable[str]) -> int:
        with ThreadPoolExecutor(DELETE_THREADS) as pool:
            return sum(pool.map(self.delete, paths))

    def delete_on_exit(self, path: str) -> None:
        self._fs.deleteOnExit(self._path(path))

    def qualified(self, path: str) -> str:
        """The path with scheme and from the root, as listings show it."""
        return self._fs.makeQualified(self._path(path)).toString()

    def glob(self, folder: str, *patterns: str) -> list[str]:
        """Entries below ``folder``, one pattern per level; the folder itself is taken as is."""
        literal = re.sub(r"([\[\]{}*?\\])", r"\\\1", folder)
        found = self._fs.globStatus(self._path(join_path(literal, *patterns)))
        return [status.getPath().toString() for status in found or []]

    def children(self, path: str) -> list[tuple[str, bool]]:
        """Visible entries of a folder as (path, is folder)."""
        if not self.exists(path):
            return []
        entries = [(s.getPath(), s.isDirectory()) for s in self._fs.listStatus(self._path(path))]
        return [(p.toString(), folder) for p, folder in entries
                if not p.getName().startswith(("_", "."))]


def base_name(path: str) -> str:
    return path.rstrip("/").rsplit("/", 1)[-1]


def join_path(*parts: str) -> str:
    head, *rest = parts
    return "/".join([head.rstrip("/"), *(part.strip("/") for part in rest)])


def scratch_root(spark: SparkSession) -> str:
    """The shared folder for intermediate tables.

    A cluster names it in ``spark.checkpoint.dir``. A folder of this machine is used only
    by a local session that names none.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="landinglake-")
    spark.conf.set("spark.checkpoint.dir", folder)
    Storage(spark, folder).delete_on_exit(folder)
    return folder


def fresh_folder(spark: SparkSession, label: str) -> str:
    """A new, not yet existing path below the scratch folder, removed when the JVM ends."""
    safe = re.sub(r"[^A-Za-z0-9-]+", "-", label)
    folder = join_path(scratch_root(spark), f"{safe}-{uuid.uuid4().hex}")
    storage = Storage(spark, folder)
    storage.make_folder(folder)
    storage.delete_on_exit(folder)
    return join_path(folder, "data")
