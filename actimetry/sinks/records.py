"""Small records (JSON objects) beside a table's files, each put in place by one rename.

A reader sees a record as it was or as it is, never half of it: the text goes to a hidden file first, and a rename in
the table's own file system puts it in place. ``replace=False`` makes the name itself the lock: of two writers one is told
that the name is taken. Records are metadata of a few kilobytes; rows stay in Parquet.
"""

from __future__ import annotations

import json
import time
import uuid

from pyspark.sql import SparkSession


class Records:
    def __init__(self, spark: SparkSession, root: str):
        self._jvm, self._gateway = spark._jvm, spark.sparkContext._gateway
        self._conf = spark._jsc.hadoopConfiguration()
        self.root = root.rstrip("/")

    def _path(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")

    def _fs(self, path):
        return path.getFileSystem(self._conf)

    def put(self, name: str, value: dict, replace: bool = True) -> bool:
        """Write ``value`` as ``name``. Without ``replace`` an existing record stays and the answer is False."""
        target = self._path(name)
        hidden = self._jvm.org.apache.hadoop.fs.Path(target.getParent(), f".{target.getName()}.{uuid.uuid4().hex}")
        fs = self._fs(target)
        out = fs.create(hidden, True)
        try:
            out.write(bytearray(json.dumps(value, sort_keys=True).encode()))
        finally:
            out.close()
        kind = getattr(self._jvm.org.apache.hadoop.fs, "Options$Rename")
        how = self._gateway.new_array(kind, 1)
        how[0] = kind.OVERWRITE if replace else kind.NONE
        context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), self._conf)
        try:
            context.rename(fs.makeQualified(hidden), fs.makeQualified(target), how)
            return True
        except Exception as e:  # noqa: BLE001 - the JVM's "already exists" is an answer, anything else an error
            fs.delete(hidden, False)
            if not replace and fs.exists(target):
                return False
            raise e

    def get(self, name: str) -> dict | None:
        path = self._path(name)
        fs = self._fs(path)
        if not fs.exists(path):
            return None
        stream = fs.open(path)
        try:
            return json.loads(self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def names(self, folder: str = "") -> list[str]:
        """Names in a folder of records, without those that are being written."""
        path = self._path(folder) if folder else self._jvm.org.apache.hadoop.fs.Path(self.root)
        fs = self._fs(path)
        if not fs.exists(path):
            return []
        return sorted(n for n in (s.getPath().getName() for s in fs.listStatus(path)) if not n.startswith("."))

    def age(self, name: str) -> float:
        """Seconds since a record or folder was last changed."""
        path = self._path(name)
        return time.time() - self._fs(path).getFileStatus(path).getModificationTime() / 1000

    def remove(self, name: str) -> bool:
        """Delete a record, or a folder with all that is in it."""
        path = self._path(name)
        return bool(self._fs(path).delete(path, True))
