"""Rows with null keys or times, dates and headers in odd forms, and a store reopened with other settings."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tierflow.operators import scd2, validate
from tierflow.operators.ordered import ordered_scan
from tierflow.sources.files import read_user_profiles
from tierflow.streaming.profile_stream import SnapshotStore

T0 = dt.datetime(2024, 1, 1)


@pytest.mark.parametrize("block_seconds", [None, 3600])
def test_facts_without_user_or_time_stay(spark, block_seconds):
    facts = spark.createDataFrame([("U1", T0, 1), (None, T0, 2), ("U1", None, 3), ("U9", T0, 4), (None, None, 5)], "user_id string, ts timestamp_ntz, n int")
    dim = spark.createDataFrame([("U1", T0 - dt.timedelta(days=1), None, 77), (None, T0, None, 78)],
                                "user_id string, effective_start timestamp_ntz, effective_end timestamp_ntz, user_profile_key long")
    got = {r.n: r.user_profile_key for r in scd2.as_of_versions(facts, dim, block_seconds=block_seconds).collect()}
    assert got == {1: 77, 2: None, 3: None, 4: None, 5: None}


def test_null_order_values_have_a_block(spark):
    df = spark.createDataFrame([("a", None, 1), ("a", 5, 2), ("a", 3_000_000, 3)], "k string, o long, v int")
    got = {r.v: r.rn for r in ordered_scan(df, ["k"], ["o"], row_number="rn").collect()}
    assert got == {1: 1, 2: 2, 3: 3}


def test_dates_are_iso(spark):
    dates = ["1990-05-01", "1990", "1990-5", "1990-05-01T10:00", "1990-13-01", " 1990-05-01"]
    rows = [(i, "create", f"U{i}", "n", "male", d, 170.0, 150.0, 140.0) for i, d in enumerate(dates)]
    events = spark.createDataFrame(rows, "event_id long, event_type string, user_id string, user_name string, gender string, birth_date string, "
                                         "height_cm double, current_weight_lb double, target_weight_lb double")
    got = {r.event_id: r.is_valid for r in validate.validate_events(events.withColumn("ts", F.lit(T0)), "2024-01-01").collect()}
    assert [got[i] for i in range(1, 6)] == [False] * 5


def test_user_csv_by_header_name(spark, tmpdir_path):
    path = f"{tmpdir_path}/users"
    spark.createDataFrame([("U1", "1990-01-01", "150", "180", "n")], "user_id string, birth_date string, target_weight_lb string, current_weight_lb string, user_name string") \
        .write.option("header", True).csv(path)
    r = read_user_profiles(spark, path).first()
    assert (r.user_id, r.birth_date, r.target_weight_lb, r.current_weight_lb, r.gender, r.height_cm) == ("U1", dt.date(1990, 1, 1), 150.0, 180.0, None, None)


def test_a_store_keeps_its_bucket_count(spark, tmpdir_path):
    store = SnapshotStore(spark, f"{tmpdir_path}/s", 4)
    store.commit(0, "x", [], store.manifest())
    assert SnapshotStore(spark, f"{tmpdir_path}/s", 4).manifest()["buckets"] == 4
    with pytest.raises(ValueError):
        SnapshotStore(spark, f"{tmpdir_path}/s", 7).manifest()
