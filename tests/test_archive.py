"""The archive: only changed buckets move, the copy equals its source, faults are seen."""
import collections
import os

import pytest
from pyspark.sql import functions as F

from tierflow.sources import archive

SCHEMA = "k long, name string, v double"


def _rows(df):
    return collections.Counter(tuple(r) for r in df.collect())


def test_only_changed_buckets_are_copied(spark, tmpdir_path):
    rows = [(i, None if i % 7 == 0 else f"n{i % 30}", None if i % 5 == 0 else i / 3) for i in range(400)] + [(1, "twice", 0.5)] * 50
    df = spark.createDataFrame(rows, SCHEMA)
    first = archive.archive_table(df, tmpdir_path, buckets=16)
    assert (first["row_count"], first["column_count"], first["buckets_copied"], first["buckets_kept"]) == (450, 3, 16, 0)
    assert _rows(archive.read_archived(spark, tmpdir_path)) == collections.Counter(rows)
    again = archive.archive_table(df.repartition(5), tmpdir_path, buckets=16)
    assert (again["buckets_copied"], again["buckets_kept"], again["checksum"]) == (0, 16, first["checksum"])
    more = df.union(spark.createDataFrame([(1000, "new", 1.0)], SCHEMA))
    third = archive.archive_table(more, tmpdir_path, buckets=16)
    assert (third["buckets_copied"], third["buckets_kept"]) == (1, 15) and third["checksum"] != first["checksum"]
    assert _rows(archive.read_archived(spark, tmpdir_path)) == collections.Counter([*rows, (1000, "new", 1.0)])
    # rows go: buckets that empty leave the archive
    few = archive.archive_table(df.filter("k = 3"), tmpdir_path, buckets=16)
    assert (few["row_count"], few["buckets_copied"] + few["buckets_kept"]) == (1, 1)
    assert _rows(archive.read_archived(spark, tmpdir_path)) == collections.Counter(r for r in rows if r[0] == 3)
    # another schema copies everything
    wide = archive.archive_table(df.withColumn("w", F.lit(1)), tmpdir_path, buckets=16)
    assert (wide["column_count"], wide["buckets_kept"]) == (4, 0)
    assert archive.read_archived(spark, tmpdir_path).columns == ["k", "name", "v", "w"]


def test_nulls_count_by_place_and_empty_tables(spark, tmpdir_path):
    a = spark.createDataFrame([(None, "x", 1.0), (2, None, 1.0)], SCHEMA)
    b = spark.createDataFrame([(None, None, 1.0), (2, "x", 1.0)], SCHEMA)
    assert archive.table_digest(a).first() != archive.table_digest(b).first()
    one = spark.createDataFrame([(None, "x")], "a string, b string")
    other = spark.createDataFrame([("x", None)], "a string, b string")
    assert archive.table_digest(one).first().digest != archive.table_digest(other).first().digest
    got = archive.archive_layers({("gold", "none"): spark.createDataFrame([], SCHEMA)}, tmpdir_path).first()
    assert (got.row_count, got.status, got.buckets_copied) == (0, "EMPTY", 0)
    assert archive.read_archived(spark, f"{tmpdir_path}/gold/none").count() == 0
    with pytest.raises(FileNotFoundError):
        archive.read_archived(spark, f"{tmpdir_path}/gold/never")


def test_a_copy_that_differs_is_refused(spark, tmpdir_path):
    df = spark.createDataFrame([(i, "a", 1.0) for i in range(50)], SCHEMA)
    archive.archive_table(df, tmpdir_path, buckets=4)
    shaky = df.withColumn("v", F.udf(lambda: int.from_bytes(os.urandom(6)) / 7, "double").asNondeterministic()())  # each reading gives other values
    with pytest.raises(OSError, match="differ from their source"):
        archive.archive_table(shaky, tmpdir_path, buckets=4)
    assert _rows(archive.read_archived(spark, tmpdir_path)) == _rows(df)
