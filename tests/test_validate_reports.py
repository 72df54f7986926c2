"""Routing, payload validation messages, and the reporting views."""
import datetime as dt

from pyspark.sql import functions as F

from tierflow.constants import FIELD_MESSAGES as M
from tierflow.operators import validate
from tierflow.plans import reports
from tierflow.schemas import PROFILE_EVENT

T0 = dt.datetime(2024, 1, 1)


def test_routing_defaults_and_unknown(spark):
    rows = [(1, T0, None, "U1", "a", "male", "1990-01-01", 170.0, 180.0, 170.0),
            (2, T0, "view", "U1", None, None, None, None, None, None),
            (3, T0, "delete", None, None, None, None, None, None, None)]
    out = {r.event_id: r for r in validate.route_events(spark.createDataFrame(rows, PROFILE_EVENT)).collect()}
    assert (out[1].event_type, out[1].route) == ("create", "create")
    assert (out[2].route, out[2].reject_reason) == ("rejected", "unknown event_type: view")
    assert out[3].reject_reason == "missing user_id"


def test_field_messages_in_field_order(spark):
    rows = [(1, T0, "create", "U1", "", "robot", "1899-12-31", 0.0, 900.0, None),
            (2, T0, "update", "U1", None, None, None, None, 801.0, None),
            (3, T0, "update", "U1", None, None, "2030-01-01", None, None, None),
            (4, T0, "create", "U2", "b", "female", "1990-02-28", 300.0, 800.0, 0.5),
            (5, T0, "delete", "U2", None, None, None, None, None, None)]
    v = {r.event_id: r for r in validate.validate_events(spark.createDataFrame(rows, PROFILE_EVENT),
                                                         "2025-06-30").collect()}
    assert v[1].errors == "; ".join([M["user_name"], M["gender"], M["birth_date"], M["height_cm"],
                                     M["current_weight_lb"], M["target_weight_lb"]])
    assert v[2].errors == M["current_weight_lb"] and not v[2].is_valid
    assert v[3].errors == M["birth_date"]
    assert v[4].is_valid and v[5].is_valid and v[4].errors == ""


def _dim(spark):
    rows = [
        (1, "U1", "a", "male", None, 30, 170.0, 200.0, 180.0, "weight_loss", T0, T0 + dt.timedelta(1), False, 1),
        (2, "U1", "a", "male", None, 30, 170.0, 200.0, 180.0, "weight_loss", T0 + dt.timedelta(1), None, True, 2),
        (3, "U2", "b", "female", None, 40, 160.0, 150.0, 150.0, "maintenance", T0, T0 + dt.timedelta(2), False, 1),
        (4, "U2", "b", "female", None, 40, 160.0, 152.0, 150.0, "maintenance", T0 + dt.timedelta(2),
         T0 + dt.timedelta(3), False, 2),
        (5, "U2", "b", "female", None, 40, 160.0, 151.0, 150.0, "maintenance", T0 + dt.timedelta(3), None, True, 3),
        (6, "U3", "c", "other", None, 50, 150.0, None, 150.0, "weight_gain", T0, None, True, 1),
    ]
    schema = ("user_profile_key long, user_id string, user_name string, gender string, birth_date date, age int, "
              "height_cm double, current_weight_lb double, target_weight_lb double, goal_type string, "
              "effective_start timestamp_ntz, effective_end timestamp_ntz, is_current boolean, version_number int")
    return spark.createDataFrame(rows, schema)


def test_progress_status_branches(spark):
    h = {r.user_profile_key: r.progress_status for r in reports.progress_history(_dim(spark)).collect()}
    # Equal weight on a loss goal -> unchanged; U2 maintenance: further then closer; U3: null -> initial
    assert h == {1: "initial", 2: "unchanged", 3: "initial", 4: "not_improving", 5: "improving", 6: "initial"}


def test_user_history_counts_and_views(spark):
    dim = _dim(spark)
    uh = {(r.user_id, r.version_number): r.total_versions for r in reports.user_history(dim).collect()}
    assert uh[("U2", 3)] == 3 and uh[("U1", 1)] == 2
    assert [r.user_id for r in reports.list_users(dim).collect()] == ["U1", "U2", "U3"]
    gs = {r.user_id: r.weight_delta_lb for r in reports.goal_summary(dim).collect()}
    assert float(gs["U1"]) == 20.0 and gs["U3"] is None
    hits = {(r.term, r.user_id) for r in reports.search_users(dim, ["U2", "C"]).collect()}
    assert hits == {("u2", "U2"), ("c", "U3")}
    wj = reports.weight_journey(reports.progress_history(dim)).filter(F.col("user_id") == "U2").collect()
    assert {r.status_label for r in wj} == {"initial", "not improving", "improving"}
    assert {r.goal_label for r in wj} == {"Maintenance"}


def test_report_fans_out_and_best_serving(spark):
    dim = _dim(spark)
    fact = spark.createDataFrame([("U1", "apple", "weight_loss", 9.5, 1, "r"), ("U9", "apple", "x", 1.0, 1, "r")],
                                 "user_id string, food_name string, goal_type string, recommendation_score double, "
                                 "recommendation_rank int, recommendation_reason string")
    food_cols = reports.REPORT_FOOD_COLS
    foods = spark.createDataFrame(
        [("apple", "100 g", 50.0, 1.0, 2.0, 10.0, 0.5, 9.0, 1.0, "low", "low", 0, 0, 0),
         ("apple", "200 g", 100.0, 2.0, 4.0, 20.0, 1.0, 18.0, 2.0, "low", "low", 0, 0, 0)],
        "food_name string, serving_description string, calories_kcal double, protein_g double, fiber_g double, "
        "carbohydrates_g double, fat_g double, sugar_g double, sodium_mg double, calorie_band string, "
        "protein_band string, is_high_protein_low_calorie int, is_high_fiber int, is_low_sugar int")
    assert reports.recommendation_report(fact, dim, foods).count() == 2  # two servings, U9 not current
    best = reports.recommendation_report(fact, dim, foods, best_serving_only=True).collect()
    assert len(best) == 1 and best[0].calories_kcal == 50.0
    assert set(food_cols) <= set(best[0].asDict())


def test_bulk_search_equals_brute_force(spark):
    people = [("U001", "Anna Bell", True), ("U012", "bella", True), ("U112", None, True), (None, "ANNA", True), ("U112", None, True), ("U9", "gone bell", False), ("", "", True)]
    dim = spark.createDataFrame(people, "user_id string, user_name string, is_current boolean")
    terms = ["bell", "BELL", "a", "an", "", None, "u1", "112", "anna b", "zzz", "nna", "nosuchterm", "U001"]
    got = reports.search_users_by_terms(dim, spark.createDataFrame([(t,) for t in terms], "term string"))
    want = [(t, u, n) for t in {t.lower() for t in terms if t is not None} for u, n, now in people
            if now and (t in (u or "").lower() or t in (n or "").lower())]
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, want))
    assert reports.search_users_by_terms(dim, spark.createDataFrame([], "term string")).count() == 0
