"""A set of tables that is replaced as a whole.

Each load writes its tables into a folder of its own and switches the manifest
last, by one rename. Readers resolve table names through the manifest, so they
see all tables of one load or all of the next; a load that fails leaves the
set as it was. Any store with Hadoop's rename serves.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession

from arenaspark.sources.io import exists, write_table

MANIFEST = "_manifest.json"
Builder = DataFrame | Callable[[Callable[[str], DataFrame]], DataFrame]


class TableSet:
    """Tables under ``root``; see the module for how they are replaced."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    # ------------------------------------------------------------ reading
    def manifest(self) -> dict | None:
        """The current manifest: version, previous version, and path and rows of every table; None before a load."""
        path = f"{self.root}/{MANIFEST}"
        if not exists(self.spark, path):
            return None
        stream = self._fs(path).open(self._path(path))
        try:
            return json.loads(bytes(self.spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode())
        finally:
            stream.close()

    def tables(self) -> list[str]:
        return sorted((self.manifest() or {"tables": {}})["tables"])

    def rows(self) -> dict[str, int]:
        """Rows written per table by the current load."""
        return {k: v["rows"] for k, v in (self.manifest() or {"tables": {}})["tables"].items()}

    def read(self, name: str) -> DataFrame:
        found = (self.manifest() or {"tables": {}})["tables"].get(name)
        if found is None:
            raise KeyError(f"{self.root} has no table {name}")
        return self.spark.read.parquet(f"{self.root}/{found['path']}")

    # ------------------------------------------------------------ writing
    def load(self, tables: Mapping[str, Builder], partition_by: Mapping[str, list[str]] | None = None) -> dict[str, int]:
        """Replace the whole set by ``tables``; rows per table.

        A table is a frame, or a function of a reader of this load's earlier
        tables (facts read the written dimensions). On any error the new folder
        is removed and the manifest stays. The load before is kept for readers
        that still hold its files; older ones are removed.
        """
        old = self.manifest()
        version = f"load-{uuid.uuid4().hex}"
        written: dict[str, dict] = {}

        def staged(name: str) -> DataFrame:
            return self.spark.read.parquet(f"{self.root}/{written[name]['path']}")

        try:
            for name, table in tables.items():
                df = table(staged) if callable(table) else table
                path = f"{version}/{name}"
                rows = write_table(df, f"{self.root}/{path}", partition_by=(partition_by or {}).get(name))
                written[name] = {"path": path, "rows": rows}
            self._switch({"version": version, "previous": old["version"] if old else None, "tables": written})
        except BaseException:
            self._remove(version)
            raise
        for folder in self._versions() - {version, old["version"] if old else version}:
            self._remove(folder)
        return {k: v["rows"] for k, v in written.items()}

    def _switch(self, manifest: dict) -> None:
        fresh, target = f"{self.root}/_manifest-{uuid.uuid4().hex}", f"{self.root}/{MANIFEST}"
        out = self._fs(fresh).create(self._path(fresh))
        out.write(bytearray(json.dumps(manifest, indent=1).encode()))
        out.close()
        jvm = self.spark._jvm
        fs = jvm.org.apache.hadoop.fs
        rename = fs.Options.Rename
        how = self.spark.sparkContext._gateway.new_array(rename, 1)
        how[0] = rename.OVERWRITE
        fs.FileContext.getFileContext(self._path(target).toUri(), self.spark._jsc.hadoopConfiguration()).rename(
            self._path(fresh), self._path(target), how)

    def _versions(self) -> set[str]:
        names = {s.getPath().getName() for s in self._fs(self.root).listStatus(self._path(self.root))}
        return {n for n in names if n.startswith("load-")}

    def _remove(self, folder: str) -> None:
        path = f"{self.root}/{folder}"
        self._fs(path).delete(self._path(path), True)

    def _path(self, path: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(path)

    def _fs(self, path: str):
        return self._path(path).getFileSystem(self.spark._jsc.hadoopConfiguration())
