"""Snapshots: readers during a rewrite, failed writes, partitions, two writers."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from basketflow.sources.snapshots import Snapshots


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_a_reader_keeps_its_snapshot_and_a_failed_write_changes_nothing(spark, tmp_path):
    s = Snapshots(spark, str(tmp_path / "t"))
    with pytest.raises(FileNotFoundError):
        s.read()
    a, b = spark.createDataFrame([(1, "x"), (2, None)], "id long, v string"), spark.createDataFrame([(3, "y")], "id long, v string")
    assert s.replace(a) == 1
    reader = s.read()
    assert s.replace(b) == 2
    assert rows(reader) == rows(a) and rows(s.read()) == rows(b) and rows(s.read(1)) == rows(a)
    broken = b.withColumn("v", F.when(F.col("id") == 3, F.raise_error(F.lit("lost"))).otherwise(F.col("v")))
    with pytest.raises(Exception, match="lost"):
        s.replace(broken)
    assert s.versions() == [1, 2] and rows(s.read()) == rows(b)


def test_partitions_are_replaced_one_by_one(spark, tmp_path):
    s = Snapshots(spark, str(tmp_path / "t"))
    first = [("a", 1), ("a", 2), ("b", 3), (None, 4)]
    s.replace(spark.createDataFrame(first, "p string, n long"), "p")
    s.replace_partitions(spark.createDataFrame([("b", 30), ("c", 5)], "p string, n long"), "p")
    assert sorted(map(str, rows(s.read()))) == sorted(map(str, [("a", 1), ("a", 2), (None, 4), ("b", 30), ("c", 5)]))
    s.replace_partitions(spark.createDataFrame([(None, 40), ("a", 9)], "p string, n long"), "p")
    assert sorted(map(str, rows(s.read()))) == sorted(map(str, [("a", 9), (None, 40), ("b", 30), ("c", 5)]))
    assert sorted(map(str, rows(s.read(1)))) == sorted(map(str, first))
    with pytest.raises(ValueError):
        s.replace_partitions(spark.createDataFrame([(1, 40)], "n long, q long"), "q")
    s.drop_before(3)
    assert s.versions() == [3] and s.read().count() == 4


def test_the_second_writer_of_a_version_is_refused(spark, tmp_path, monkeypatch):
    s = Snapshots(spark, str(tmp_path / "t"))
    df = spark.createDataFrame([(1,)], "id long")
    s.replace(df)
    other = Snapshots(spark, str(tmp_path / "t"))
    monkeypatch.setattr(other, "versions", lambda: [])  # it looked before the first commit
    with pytest.raises(Exception):
        other.replace(spark.createDataFrame([(2,)], "id long"))
    assert rows(s.read()) == [(1,)]


def test_an_empty_table_is_a_snapshot(spark, tmp_path):
    s = Snapshots(spark, str(tmp_path / "t"))
    s.replace(spark.createDataFrame([], "id long, v string"))
    assert s.read().collect() == [] and s.read().columns == ["id", "v"]
