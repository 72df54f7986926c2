"""Warehouse load semantics, ids, keys and the JDBC sink."""
import datetime as dt

from pyspark.sql import functions as F

from tierflow.operators import warehouse as wh
from tierflow.sources import warehouse_io as wio

RUN_TS = "2025-07-01 00:00:00"
FACT_SCHEMA = ("user_id string, food_name string, goal_type string, recommendation_score double, "
               "recommendation_rank int, recommendation_reason string")


def test_load_skips_existing_users_and_replaces_food(spark):
    dim = spark.createDataFrame([(1, "U1", 180.0, 170.0, "weight_loss", dt.datetime(2024, 1, 1), None, True, 3)],
                                "user_profile_key long, user_id string, current_weight_lb double, "
                                "target_weight_lb double, goal_type string, effective_start timestamp_ntz, "
                                "effective_end timestamp_ntz, is_current boolean, version_number int")
    fact = spark.createDataFrame([("U1", "old", "weight_loss", 1.0, 1, "r"), ("U2", "stale", "x", 1.0, 1, "r")],
                                 FACT_SCHEMA)
    gold_users = spark.createDataFrame([("U1", 150.0, 200.0, 190.0, "weight_loss"),
                                        ("U2", 160.0, 150.0, 170.0, "weight_gain")],
                                       "user_id string, height_cm double, current_weight_lb double, "
                                       "target_weight_lb double, goal_type string")
    gold_recs = spark.createDataFrame([("U1", "new", "weight_loss", 2.0, 1, "r"), ("U2", "new", "weight_gain", 2.0, 1, "r")],
                                      FACT_SCHEMA)
    silver = spark.createDataFrame([("apple", "1 g", 95.123)], "food_name string, serving_description string, "
                                                              "calories_kcal double")
    w = wh.load(dim, fact, silver, gold_users, gold_recs, RUN_TS)
    d = {r.user_id: r for r in w.dim_user.collect()}
    assert d["U1"].version_number == 3 and d["U2"].version_number == 1 and d["U2"].is_current
    assert str(d["U2"].effective_start) == RUN_TS
    assert sorted((r.user_id, r.food_name) for r in w.fact.collect()) == [("U1", "old"), ("U2", "new")]
    assert str(w.dim_food.first().calories_kcal) == "95.12"


def test_surrogate_key_is_deterministic(spark):
    df = spark.createDataFrame([("U1", 1), ("U1", 2), ("U2", 1)], "u string, v int")
    a = [r[0] for r in df.select(wh.surrogate_key("u", "v")).collect()]
    b = [r[0] for r in df.select(wh.surrogate_key("u", "v")).collect()]
    assert a == b and len(set(a)) == 3


def test_allocate_ids_contiguous_after_high_water(spark):
    ids = spark.createDataFrame([("U007",), ("U012",), ("bad",)], "user_id string")
    hw = wh.high_water_mark(wh.known_ids(ids))
    req = spark.range(0, 2500, 1, 7).select((F.col("id") * 3).alias("k")).repartition(5)
    out = wh.allocate_ids(req, ["k"], hw).collect()
    got = sorted((r.k, r.user_id) for r in out)
    assert [u for _, u in got] == [f"U{13 + i:03d}" for i in range(2500)]


def test_jdbc_append_replace_roundtrip(spark):
    t = wio.Target(table="DIM_FOOD", url="jdbc:derby:memory:tierflow_wh;create=true",
                   properties={"driver": "org.apache.derby.jdbc.EmbeddedDriver"}, num_partitions=2)
    df = spark.createDataFrame([("a", 1.5), ("b", 2.5)], "food_name string, kcal double")
    wio.replace(df, t)
    wio.append(df.limit(1), t)
    assert wio.read(spark, t).count() == 3
    wio.replace(df, t)
    assert sorted(r.FOOD_NAME if "FOOD_NAME" in r else r.food_name for r in wio.read(spark, t).collect()) == ["a", "b"]
    assert wio.existing_keys(spark, t, "food_name").count() == 2


def test_ids_beyond_64_bits_move_the_mark(spark):
    ids = spark.createDataFrame([("U005",), ("U99999999999999999999",), ("U" + "9" * 60,), ("V1",), (None,)], "user_id string")
    mark = wh.high_water_mark(wh.known_ids(ids))
    got = wh.allocate_ids(spark.createDataFrame([(1,), (2,)], "k long"), ["k"], mark).orderBy("k").collect()
    assert [r.user_id for r in got] == ["U100000000000000000000", "U100000000000000000001"]
    none = wh.allocate_ids(spark.createDataFrame([(1,)], "k long"), ["k"], wh.high_water_mark(ids.limit(0))).first()
    assert none.user_id == "U001"
