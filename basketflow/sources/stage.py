"""Stage tables, CSV sinks and model persistence.

Stage tables are Parquet directories under the shared checkpoint folder; writing one and
reading it back also cuts the lineage of a long job, which is how later stages survive the
loss of an executor without recomputing the whole history.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from basketflow.session import short_shuffles, stage_path

DECISIONS_SCHEMA = T.StructType([
    T.StructField("order_id", T.LongType()),
    T.StructField("products", T.StringType()),
])


def save(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """Write a stage table (overwrite)."""
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def load(spark: SparkSession, path: str) -> DataFrame:
    """Read a stage table back by path."""
    return spark.read.parquet(path)


def drop(spark: SparkSession, path: str) -> None:
    """Delete a stage table."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


class Scratch:
    """Stage tables of one job of many steps, in a folder of its own: a table goes when the steps that read it are done, the
    shuffles behind it as soon as it is written."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = stage_path(spark, name, uuid.uuid4().hex[:12])
        self.turn = 0
        self.tables: list[tuple[DataFrame, str]] = []

    def keep(self, df: DataFrame, *more: DataFrame) -> DataFrame:
        """``df`` written and read back; ``more`` of the same columns is added to it, one write after the other."""
        self.turn += 1
        path = f"{self.root}/{self.turn}"
        with short_shuffles(self.spark):
            for part in (df, *more):
                part.write.mode("append").parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        self.tables.append((out, path))
        return out

    def drop(self, *dfs: DataFrame) -> None:
        """Delete tables of this folder; others are left alone."""
        for df, path in [t for t in self.tables if any(t[0] is df for df in dfs)]:
            drop(self.spark, path)
        self.tables = [t for t in self.tables if not any(t[0] is df for df in dfs)]

    def close(self) -> None:
        """Delete what is left, once nothing reads it."""
        drop(self.spark, self.root)
        self.tables = []


def write_csv(df: DataFrame, path: str) -> None:
    """CSV with a header (decisions, streaks, factors, baselines)."""
    df.write.mode("overwrite").option("header", True).csv(path)


def read_decisions_csv(spark: SparkSession, path: str) -> DataFrame:
    """Read a decision / truth CSV back with its declared schema."""
    return spark.read.schema(DECISIONS_SCHEMA).option("header", True).option("mode", "FAILFAST").csv(path)


def save_model(model, path: str) -> None:
    """Persist a fitted MLlib model or pipeline."""
    model.write().overwrite().save(path)
