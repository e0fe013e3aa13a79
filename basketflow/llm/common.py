"""Shared helpers: words, stage tables in the shared folder, row keys."""

from __future__ import annotations

import re
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from basketflow.session import checkpoint_dir, shuffle_partitions, stage_path

# A word is a maximal run of characters outside this set (space, tab to carriage return).
SPACES = r"[\x20\x09-\x0D]+"


def words(text: Column) -> Column:
    """The words of a text in order; a null text has none. (In Python: ``bytes.split()``.)"""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACES), "")


def text_digest(text: Column) -> Column:
    """64-bit digest that tells apart rows that share an id; a null text differs from an empty one."""
    return F.xxhash64(text, text.isNull())


def numbered(docs: DataFrame) -> DataFrame:
    """(_row, _n): each row as a struct, so that its columns may have any names, and a number of its own.

    The numbers hold only once written: a recomputed input may deal its rows out otherwise.
    """
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), F.monotonically_increasing_id().alias("_n"))


PLACE_BITS = 33  # of a row within its file


def place(df: DataFrame) -> Column:
    """A long that grows in the order in which the rows of ``df``, read from part files, were written.

    The scan packs splits of files by size, so the order of rows as read says nothing; the number of the part file and
    the row's index in it do. Where ``df`` is no plain file scan, rows are numbered as they come.
    """
    try:
        meta = df.metadataColumn("_metadata")
        df.select(meta)
    except AnalysisException:
        return F.monotonically_increasing_id()
    number = lambda pattern: F.coalesce(F.regexp_extract(meta["file_name"], pattern, 1).try_cast("long"), F.lit(0).cast("long"))
    part, more = number(r"^part-(\d{1,7})"), number(r"-c(\d{1,3})\.")
    return F.shiftleft(part * 1024 + more, PLACE_BITS) + meta["row_index"]


def _numbered_files(df: DataFrame) -> bool:
    """Whether ``df`` is a plain file scan and ``place`` tells all its files apart (by their names, on the driver)."""
    try:
        df.select(df.metadataColumn("_metadata"))
    except AnalysisException:
        return False
    seen = set()
    for name in (f.rsplit("/", 1)[-1] for f in df.inputFiles()):
        part, more = re.search(r"^part-(\d{1,7})", name), re.search(r"-c(\d{1,3})\.", name)
        number = (int(part[1]) if part else 0, int(more[1]) if more else 0)
        if number in seen:
            return False
        seen.add(number)
    return True


def keyed(docs: DataFrame, stages: Stages, table: str = "rows") -> DataFrame:
    """(_row, _n): each row as a struct and a number of its own that also holds when the rows are read again.

    The rows of a plain file scan are numbered by their place; anything else is written once with a number.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row")
    if _numbered_files(docs):
        return docs.select(row, place(docs).alias("_n"))
    return stages.write(numbered(docs), table)


class Stages:
    """Parquet stage tables of one run, in a fresh folder under the shared checkpoint folder.

    Writing a table and reading it back cuts the lineage: a lost executor costs only the tasks
    of the current step. Tables that nothing reads any more are dropped with ``drop``.
    """

    def __init__(self, spark: SparkSession, name: str):
        checkpoint_dir(spark)
        self.spark = spark
        self.root = stage_path(spark, "llm", f"{name}-{uuid.uuid4().hex[:12]}")

    def path(self, table: str) -> str:
        return f"{self.root}/{table}"

    def write(self, df: DataFrame, table: str) -> DataFrame:
        df.write.mode("overwrite").parquet(self.path(table))
        return self.spark.read.schema(df.schema).parquet(self.path(table))

    def drop(self, *tables: str) -> None:
        jvm = self.spark.sparkContext._jvm
        for table in tables:
            p = jvm.org.apache.hadoop.fs.Path(self.path(table))
            p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def partitions_for(spark: SparkSession, rows: int, rows_each: int) -> int:
    """Partitions so that each holds about ``rows_each`` rows, at least the session's shuffle count."""
    return max(shuffle_partitions(spark), -(-rows // rows_each))
