"""Tables that are reloaded together: staged folders and one commit.

Every written table goes to a folder of its own under ``data``. A manifest names the folder of each table; manifests are
numbered and never changed. A commit adds the next manifest by a rename that fails if it exists, so all tables of a
reload become visible at once, a reader keeps the folders that it has opened, and a reload that fails leaves the version before.
Two commits at once do not lose each other: the later one is put on top of the earlier.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

ATTEMPTS = 100


class TableSet:
    def __init__(self, spark: SparkSession, root: str):
        self._spark = spark
        self.root = root.rstrip("/")
        self._jvm = spark.sparkContext._jvm

    # ---- files, on the driver: a few small manifests ------------------------------------------

    def _path(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")

    def _fs(self):
        return self._path("").getFileSystem(self._spark.sparkContext._jsc.hadoopConfiguration())

    def versions(self) -> list[int]:
        folder, fs = self._path("manifests"), self._fs()
        if not fs.exists(folder):
            return []
        names = [f.getPath().getName() for f in fs.listStatus(folder)]
        return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json") and n[:1].isdigit())

    def manifest(self, version: int | None = None) -> dict[str, dict]:
        """Folder (under the root) and schema of each table, of the newest version or the given one."""
        found = self.versions()
        if version is None and not found:
            return {}
        stream = self._fs().open(self._path(f"manifests/{found[-1] if version is None else version}.json"))
        try:
            return json.loads(bytes(self._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)))
        finally:
            stream.close()

    def _add_manifest(self, version: int, tables: dict[str, dict]) -> bool:
        """False if another commit has taken the number."""
        fs, staged = self._fs(), self._path(f"manifests/_staged-{uuid.uuid4().hex}")
        stream = fs.create(staged, False)
        try:
            stream.write(bytearray(json.dumps(tables).encode()))
        finally:
            stream.close()
        gateway = self._spark.sparkContext._gateway
        context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(
            fs.getUri(), self._spark.sparkContext._jsc.hadoopConfiguration())
        try:
            context.rename(staged, self._path(f"manifests/{version}.json"), gateway.new_array(self._jvm.org.apache.hadoop.fs.Options.Rename, 0))
        except Py4JJavaError as error:
            fs.delete(staged, False)
            if "FileAlreadyExists" in error.java_exception.getClass().getName():
                return False
            raise
        return True

    def commit(self, tables: dict[str, dict]) -> int:
        for _ in range(ATTEMPTS):
            found = self.versions()
            version = found[-1] + 1 if found else 1
            if self._add_manifest(version, {**self.manifest(found[-1] if found else None), **tables}):
                return version
        raise RuntimeError("too many commits at once")

    # ---- tables -------------------------------------------------------------------------------

    def open(self, entry: dict) -> DataFrame:
        schema = T.StructType.fromJson(entry["schema"])
        return self._spark.read.schema(schema).parquet(f"{self.root}/{entry['folder']}")

    def table(self, name: str, version: int | None = None) -> DataFrame:
        tables = self.manifest(version)
        if name not in tables:
            raise KeyError(f"no table {name}")
        return self.open(tables[name])

    def reload(self) -> Reload:
        return Reload(self)

    def vacuum(self, keep: int = 2) -> list[str]:
        """Deletes manifests before the last ``keep``, and folders that only those name. Not while older versions are read or a
        reload is on its way."""
        found, fs = self.versions(), self._fs()
        used = {entry["folder"] for v in found[-keep:] for entry in self.manifest(v).values()}
        gone = []
        for status in fs.listStatus(self._path("data")) if fs.exists(self._path("data")) else []:
            folder = f"data/{status.getPath().getName()}"
            if folder not in used:
                fs.delete(self._path(folder), True)
                gone.append(folder)
        for version in found[:-keep]:
            fs.delete(self._path(f"manifests/{version}.json"), False)
        return gone


class Reload:
    """Tables written one after the other, visible to others together when the block ends without an error."""

    def __init__(self, tables: TableSet):
        self._tables = tables
        self._written: dict[str, dict] = {}

    def write(self, name: str, rows: DataFrame, partition_by: Sequence[str] = ()) -> DataFrame:
        """Partition columns must come last. Returns the staged table."""
        folder = f"data/{name}-{uuid.uuid4().hex}"
        rows.write.mode("error").partitionBy(*partition_by).parquet(f"{self._tables.root}/{folder}")
        self._written[name] = {"folder": folder, "schema": rows.schema.jsonValue()}
        return self.table(name)

    def table(self, name: str) -> DataFrame:
        """The staged table if this reload has written it, else the visible one."""
        return self._tables.open(self._written[name]) if name in self._written else self._tables.table(name)

    def __enter__(self) -> Reload:
        return self

    def __exit__(self, kind, error, trace) -> None:
        if kind is None and self._written:
            self._tables.commit(self._written)
        elif kind is not None:
            for entry in self._written.values():
                self._tables._fs().delete(self._tables._path(entry["folder"]), True)
