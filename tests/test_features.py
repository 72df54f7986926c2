"""Cleansing and feature expressions on edge cases."""
import datetime as dt

from pyspark.sql import functions as F

from tierflow.functions import cleanse, features


def test_clean_number_and_first_number(spark):
    df = spark.createDataFrame([(" 1,234 ",), ("n/a",), (".5",), ("",), ("12.75 oz",), (None,), ("\t7",)], "s string")
    out = df.select(cleanse.clean_number("s").alias("n"), cleanse.first_number("s").alias("f")).collect()
    # the numeric cast itself ignores surrounding whitespace, tabs included
    assert [r.n for r in out] == [1234.0, None, 0.5, None, None, None, 7.0]
    assert [r.f for r in out] == [1.0, None, 5.0, None, 12.75, None, 7.0]


def test_trim_keeps_tabs_and_names_normalised(spark):
    df = spark.createDataFrame([("\t A \t",)], "` Food Name-X` string")
    n = cleanse.normalise_columns(df)
    assert n.columns == ["food_name_x"]
    assert n.select(cleanse.clean_text("food_name_x")).first()[0] == "\t a \t"


def test_raw_to_bronze_dedups_and_skips_absent(spark):
    df = spark.createDataFrame([(" A ", "10,0"), ("a", "100"), ("A", "n/a")], "` Label` string, Calories string")
    b = cleanse.raw_to_bronze(df)
    assert sorted(b.collect(), key=str) == sorted([("a", 100.0), ("a", None)], key=str)


def test_bands_edges_and_nulls(spark):
    vals = [None, 0.0, 149.99, 150.0, 299.99, 300.0]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    got = [r[0] for r in df.select(features.band("x", 150, 300)).collect()]
    assert got == ["high", "low", "low", "medium", "medium", "high"]


def test_flags(spark):
    df = spark.createDataFrame([(10.0, 250.0, 5.0, 8.0), (9.9, 100.0, 4.9, 8.1), (None, None, None, None)],
                               "protein_g double, calories_kcal double, fiber_g double, sugar_g double")
    cols = features.band_and_flag_columns(set(df.columns))
    out = df.select(cols["is_high_protein_low_calorie"], cols["is_high_fiber"], cols["is_low_sugar"]).collect()
    assert [tuple(r) for r in out] == [(1, 1, 1), (0, 0, 0), (0, 0, 0)]


def test_goal_type_null_is_maintenance(spark):
    df = spark.createDataFrame([(200.0, 180.0), (150.0, 170.0), (160.0, 160.0), (None, 150.0)], "c double, t double")
    assert [r[0] for r in df.select(features.goal_type("c", "t")).collect()] == [
        "weight_loss", "weight_gain", "maintenance", "maintenance"]


def test_two_ages(spark):
    df = spark.createDataFrame([(dt.date(2000, 2, 29), dt.date(2001, 2, 28)),
                                (dt.date(2001, 1, 1), dt.date(2002, 1, 1)),
                                (dt.date(1990, 6, 30), dt.date(2025, 6, 30))], "b date, d date")
    out = df.select(features.age_calendar("b", F.col("d")).alias("cal"),
                    features.age_batch("b", F.col("d")).alias("batch")).collect()
    assert [r.cal for r in out] == [0, 1, 35]
    assert [r.batch for r in out] == [0, 0, 35]


def test_weight_delta_rounds_half_up(spark):
    df = spark.createDataFrame([(200.05, 100.0), (100.0, 100.05)], "c double, t double")
    assert [float(r[0]) for r in df.select(features.weight_delta("c", "t")).collect()] == [100.1, -0.1]


def test_ids(spark):
    df = spark.createDataFrame([("U001",), ("U1234",), ("X9",), ("U",)], "u string")
    out = df.select(cleanse.is_user_id("u"), cleanse.user_id_number("u")).collect()
    assert [tuple(r) for r in out] == [(True, 1), (True, 1234), (False, None), (False, None)]
    assert spark.range(3).select(cleanse.format_user_id(F.col("id") * 999)).collect()[2][0] == "U1998"
