"""Snapshots of a stage table (S5, S7): readers never see a half-written table.

A write goes to a folder of its own and becomes visible by one small commit file, which names the folders of the snapshot
and, for a table partitioned by a column, the values that each folder holds. A commit file is created, never replaced:
of two writers on one version the second is told to start again. A write that fails leaves no commit, so the snapshot
before it stays; a reader keeps the files of the snapshot it opened. Commit files are as long as the list of partitions.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


class Snapshots:
    """The versions of one table under ``root``, a folder that all executors share."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root

    def _path(self, path: str):
        p = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), p

    def versions(self) -> list[int]:
        fs, p = self._path(f"{self.root}/commits")
        if not fs.exists(p):
            return []
        return sorted(int(f.getPath().getName().split(".")[0]) for f in fs.listStatus(p) if f.getPath().getName().endswith(".json"))

    def _manifest(self, version: int) -> list[dict]:
        return json.loads(self.spark.read.text(f"{self.root}/commits/{version:08d}.json", wholetext=True).first()[0])

    def _commit(self, version: int, entries: list[dict]) -> int:
        fs, p = self._path(f"{self.root}/commits/{version:08d}.json")
        out = fs.create(p, False)  # fails where the version exists
        out.write(bytearray(json.dumps(entries).encode()))
        out.close()
        return version

    def _written(self, df: DataFrame, column: str | None) -> dict:
        folder = f"data/{uuid.uuid4().hex}"
        writer = df.write if column is None else df.write.partitionBy(column)
        writer.parquet(f"{self.root}/{folder}")
        values = None
        if column is not None:
            # One row per partition.
            values = [r[0] for r in self.spark.read.parquet(f"{self.root}/{folder}").select(F.col(column).cast("string")).distinct().collect()]
        return {"folder": folder, "column": column, "values": values, "schema": df.schema.json()}

    def replace(self, df: DataFrame, partition_by: str | None = None) -> int:
        """A snapshot of ``df`` alone; returns its version."""
        entry = self._written(df, partition_by)
        return self._commit(max(self.versions(), default=0) + 1, [entry])

    def replace_partitions(self, df: DataFrame, partition_by: str) -> int:
        """The snapshot before, with the partitions that ``df`` has rows of taken from ``df``."""
        found = self.versions()
        before = self._manifest(found[-1]) if found else []
        if any(e["column"] != partition_by for e in before):
            raise ValueError(f"the table is not partitioned by {partition_by}")
        entry = self._written(df, partition_by)
        kept = [{**e, "values": [v for v in e["values"] if v not in entry["values"]]} for e in before]
        return self._commit(max(found, default=0) + 1, [e for e in kept if e["values"]] + [entry])

    def read(self, version: int | None = None) -> DataFrame:
        """The rows of a version (the newest if not given)."""
        from pyspark.sql.types import StructType
        found = self.versions()
        if not found:
            raise FileNotFoundError(f"no snapshot under {self.root}")
        out = None
        for e in self._manifest(found[-1] if version is None else version):
            schema = StructType.fromJson(json.loads(e["schema"]))
            part = self.spark.read.schema(schema).parquet(f"{self.root}/{e['folder']}").select(*schema.names)
            if e["column"] is not None:
                named = [v for v in e["values"] if v is not None]
                held = F.col(e["column"]).cast("string").isin(named)
                part = part.where(held | F.col(e["column"]).isNull() if None in e["values"] else held)
            out = part if out is None else out.unionByName(part)
        return out

    def drop_before(self, version: int) -> None:
        """Delete older versions and the folders that no later one names."""
        used = {e["folder"] for v in self.versions() if v >= version for e in self._manifest(v)}
        old = {e["folder"] for v in self.versions() if v < version for e in self._manifest(v)}
        for v in [v for v in self.versions() if v < version]:
            fs, p = self._path(f"{self.root}/commits/{v:08d}.json")
            fs.delete(p, False)
        for folder in old - used:
            fs, p = self._path(f"{self.root}/{folder}")
            fs.delete(p, True)
