"""Small versioned manifests in a shared folder, safe for several writers.

A manifest is a JSON document. Version n is a file of its own that is created if absent and
never changed: of two writers that start from the same version one creates the next, the
other is told so and starts again from what it finds. Readers take the highest version that
can be read; a file left half-written by a lost driver is passed over. Tables that a
manifest names are written before it is committed, so nobody sees parts of them.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

_NAME = re.compile(r"v(\d{10})\.json$")


class Manifest:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _path(self, name: str = ""):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}" if name else self.root)
        return path, path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def versions(self) -> list[int]:
        """Numbers of all versions, also of those that can't be read."""
        path, fs = self._path()
        if not fs.exists(path):
            return []
        found = (_NAME.search(s.getPath().getName()) for s in fs.listStatus(path))
        return sorted(int(m[1]) for m in found if m)

    def read(self, version: int) -> dict | None:
        path, fs = self._path(f"v{version:010d}.json")
        stream = fs.open(path)
        try:
            text = self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        try:
            return json.loads(text)
        except ValueError:
            return None

    def current(self) -> tuple[int, dict]:
        """(highest number in use, contents of the highest version that can be read)."""
        used = self.versions()
        for version in reversed(used):
            content = self.read(version)
            if content is not None:
                return used[-1], content
        return (used[-1] if used else 0), {}

    def _create(self, version: int, content: dict) -> bool:
        path, fs = self._path(f"v{version:010d}.json")
        try:
            out = fs.create(path, False)
        except Py4JJavaError as e:
            if "FileAlreadyExists" in str(e.java_exception):
                return False
            raise
        try:
            out.write(bytearray(json.dumps(content).encode()))
        finally:
            out.close()
        return True

    def update(self, change: Callable[[dict], dict | None]) -> dict:
        """Commit ``change(contents)`` as the next version; called again with the newer
        contents where another writer was first. None: nothing to commit."""
        while True:
            used, content = self.current()
            new = change(content)
            if new is None:
                return content
            if self._create(used + 1, new):
                return new
