"""Goal-factored top-k equals brute force over every (user, food) pair."""
import random

import pandas as pd
from pyspark.sql import functions as F

from tierflow.operators import recommend as rec

FOOD_COLS = ["food_name", "serving_description", "serving_size_value", "calories_kcal", "protein_g",
             "carbohydrates_g", "fat_g", "fiber_g", "sugar_g"]


def _score(goal, f):
    if goal == "weight_loss":
        s = f.protein_g * 2.5 + f.fiber_g * 2.0 - f.calories_kcal * 0.015 - f.sugar_g * 0.8 - f.fat_g * 0.2
    elif goal == "weight_gain":
        s = f.calories_kcal * 0.02 + f.protein_g * 2.0 + f.carbohydrates_g * 0.8 + f.fat_g * 0.5
    else:
        s = f.protein_g * 2.0 + f.fiber_g * 1.5 - f.sugar_g * 0.7 - abs(f.calories_kcal - 400) * 0.01
    return round(s, 2)


def brute_force(users, foods, k=10):
    rows = []
    for _, u in users.iterrows():
        cand = {}
        for _, f in foods.iterrows():
            s = _score(u.goal_type, f)
            key = (-s, f.serving_description, f.serving_size_value)
            if f.food_name not in cand or key < cand[f.food_name][0]:
                cand[f.food_name] = (key, s)
        ranked = sorted(cand.items(), key=lambda kv: (-kv[1][1], kv[0]))[:k]
        rows += [(u.user_id, name, s, i + 1) for i, (name, (_, s)) in enumerate(ranked)]
    return sorted(rows)


def test_goal_factored_equals_brute_force(spark):
    rnd = random.Random(5)
    foods = pd.DataFrame([
        {"food_name": f"food{rnd.randrange(25)}", "serving_description": f"{rnd.randrange(1, 4) * 50} g",
         "serving_size_value": float(rnd.randrange(1, 4) * 50), "calories_kcal": float(rnd.randrange(0, 800, 20)),
         "protein_g": float(rnd.randrange(40)), "carbohydrates_g": float(rnd.randrange(60)),
         "fat_g": float(rnd.randrange(30)), "fiber_g": float(rnd.randrange(12)), "sugar_g": float(rnd.randrange(25))}
        for _ in range(120)])
    users = pd.DataFrame([{"user_id": f"U{i:03d}", "goal_type": rnd.choice(["weight_loss", "weight_gain",
                                                                            "maintenance"])} for i in range(30)])
    sf, su = spark.createDataFrame(foods), spark.createDataFrame(users)
    got = rec.recommend(su, sf).select("user_id", "food_name", "recommendation_score", "recommendation_rank")
    assert sorted(tuple(r) for r in got.collect()) == brute_force(users, foods)


def test_plan_broadcasts_only_the_bounded_ranking(spark):
    foods = spark.createDataFrame([("a", "1 g", 1.0, 100.0, 10.0, 10.0, 1.0, 5.0, 1.0)],
                                  ",".join(f"{c} {'string' if c in ('food_name', 'serving_description') else 'double'}"
                                           for c in FOOD_COLS))
    goals = F.element_at(F.array(F.lit("weight_loss"), F.lit("weight_gain"), F.lit("maintenance")),
                         (F.col("id") % 3 + 1).cast("int"))
    users = spark.range(100).select(F.format_string("U%03d", "id").alias("user_id"), goals.alias("goal_type"))
    plan = rec.recommend(users, foods)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_recommend_changed_replaces_by_key(spark):
    foods = spark.createDataFrame([("a", "1 g", 1.0, 100.0, 10.0, 10.0, 1.0, 5.0, 1.0),
                                   ("b", "1 g", 1.0, 900.0, 1.0, 50.0, 20.0, 0.0, 20.0)],
                                  ",".join(f"{c} {'string' if c in ('food_name', 'serving_description') else 'double'}"
                                           for c in FOOD_COLS))
    fact = spark.createDataFrame([("U1", "x", "weight_loss", 1.0, 1, "r"), ("U2", "x", "weight_loss", 1.0, 1, "r")],
                                 "user_id string, food_name string, goal_type string, recommendation_score double, "
                                 "recommendation_rank int, recommendation_reason string")
    changed = spark.createDataFrame([("U1", "weight_gain"), ("U3", None)], "user_id string, goal_type string")
    out = rec.recommend_changed(fact, changed, foods).collect()
    assert {(r.user_id, r.food_name, r.recommendation_rank) for r in out} == {
        ("U2", "x", 1), ("U1", "b", 1), ("U1", "a", 2)}
