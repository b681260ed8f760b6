"""Committed tables: readers see whole versions, writers may be repeated, lost or late."""

import pytest
from pyspark.sql import functions as F

from lakeledger.sources import committed

ROW = "k int, v double, version int"


def rows(df):
    return sorted(tuple(r) for r in df.select("k", "v", "version").collect())


@pytest.fixture
def table(spark, tmp_path):
    path = str(tmp_path / "table")
    assert committed.read(spark, path) is None and committed.versions(spark, path) == []
    assert committed.append(spark.createDataFrame([(1, 1.0, 0), (2, 2.0, 0)], ROW), path, "a")
    assert committed.append(spark.createDataFrame([(2, 5.0, 1), (3, 3.0, 1)], ROW), path, "b")
    return path


def test_batches_once(spark, table):
    assert not committed.append(spark.createDataFrame([(9, 9.0, 9)], ROW), table, "a")
    assert committed.versions(spark, table) == [0, 1]
    assert rows(committed.read(spark, table)) == [(1, 1.0, 0), (2, 2.0, 0), (2, 5.0, 1), (3, 3.0, 1)]
    assert rows(committed.read(spark, table, 0)) == [(1, 1.0, 0), (2, 2.0, 0)]
    assert rows(committed.newest(committed.read(spark, table), ["k"])) == [(1, 1.0, 0), (2, 5.0, 1), (3, 3.0, 1)]


def test_writer_that_dies(spark, table, monkeypatch):
    """Data without a manifest are never seen, and the batch can be sent again."""
    with monkeypatch.context() as m:
        m.setattr(committed, "_commit", lambda *_: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            committed.append(spark.createDataFrame([(4, 4.0, 2)], ROW), table, "c")
    assert len(rows(committed.read(spark, table))) == 4
    assert committed.append(spark.createDataFrame([(4, 4.0, 2)], ROW), table, "c") and len(rows(committed.read(spark, table))) == 5


def test_two_writers(spark, table):
    now = committed.manifest(spark, table)
    committed.append(spark.createDataFrame([(4, 4.0, 2)], ROW), table, "c")
    with pytest.raises(RuntimeError, match="meanwhile"):
        committed._commit(spark, table, now | {"version": now["version"] + 1})
    assert len(rows(committed.read(spark, table))) == 5


def test_reading_while_compacting(spark, table):
    reader = committed.read(spark, table)
    committed.compact(spark, table, lambda df: committed.newest(df, ["k"]))
    committed.vacuum(spark, table, keep=2)
    assert len(rows(reader)) == 4 and len(rows(committed.read(spark, table))) == 3
    assert not committed.append(spark.createDataFrame([(9, 9.0, 9)], ROW), table, "b")  # ids outlive compaction
    committed.vacuum(spark, table, keep=1)
    assert committed.versions(spark, table) == [2] and len(rows(committed.read(spark, table))) == 3


def test_partitions(spark, tmp_path):
    path = str(tmp_path / "parts")
    for k in range(3):
        committed.append(spark.createDataFrame([(k, 1.0 * k, k)], ROW).withColumn("year", F.lit(2000 + k % 2)), path, by=["year"])
    assert sorted((r["k"], r["year"]) for r in committed.read(spark, path).collect()) == [(0, 2000), (1, 2001), (2, 2000)]
    committed.compact(spark, path, by=["year"])
    assert committed.read(spark, path).count() == 3 and len(committed.manifest(spark, path)["folders"]) == 1
