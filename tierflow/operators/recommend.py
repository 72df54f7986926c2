"""Scoring and top-k recommendation.

The score of a (user, food) pair reads only the food's nutrients and the
user's goal, so the ranking is computed once per *goal*: foods are scored
for the three goals (a generator, 3 rows per food), reduced to the best
serving per (goal, food) with a map-side-combined aggregate, cut to the top
``k`` per goal (``WindowGroupLimit`` keeps only ``k`` rows per goal per
partition before the shuffle), and joined to the users. The ranked table has
at most ``len(GOALS) * k`` rows — a proven bound — so it is broadcast; the
user side never moves. This replaces the user x food cross join
(O(U*F) pairs) with O(3F + k*U) work and gives the same rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tierflow.constants import FACT_REC_COLUMNS, GOALS, NUTRIENT_COLUMNS, TOP_K
from tierflow.functions.features import reason, score_for


def candidate_scores(foods: DataFrame, goals: list[str] | None = None) -> DataFrame:
    """Every food serving scored for every goal (J1 re-aimed, R1-R4, C16)."""
    goals = goals or GOALS
    entries = [F.struct(F.lit(g).alias("goal_type"),
                        score_for(F.lit(g)).alias("recommendation_score"),
                        reason(F.lit(g)).alias("recommendation_reason")) for g in goals]
    return foods.select("*", F.explode(F.array(*entries)).alias("__g")).select(
        F.col("__g.goal_type").alias("goal_type"), *foods.columns,
        F.col("__g.recommendation_score").alias("recommendation_score"),
        F.col("__g.recommendation_reason").alias("recommendation_reason"))


def _best_first(score: Column, *ties: Column) -> Column:
    """Sort key for min_by: non-null scores first, higher first, then ties ascending."""
    return F.struct(score.isNull(), -score, *ties)


def best_serving(scored: DataFrame, group: list[str] | None = None) -> DataFrame:
    """Keep the highest-scoring serving per (group, food_name).

    Tie-break: serving description, serving size, then the nutrients, so that
    the winner's columns are determined. An aggregate
    (``min_by`` on a sort key) rather than a window, so duplicates of a hot
    food are combined map-side before the shuffle.
    """
    group = group or ["goal_type"]
    keys = group + ["food_name"]
    others = [c for c in scored.columns if c not in keys]
    sort_key = _best_first(F.col("recommendation_score"), F.col("serving_description"),
                           F.col("serving_size_value"),
                           *[F.col(c) for c in NUTRIENT_COLUMNS if c in scored.columns])
    best = scored.groupBy(*keys).agg(F.min_by(F.struct(*others), sort_key).alias("__b"))
    return best.select(*keys, *[F.col(f"__b.{c}").alias(c) for c in others])


def rank_top_k(df: DataFrame, group: list[str], k: int = TOP_K,
               rank_col: str = "recommendation_rank") -> DataFrame:
    """``row_number`` by score desc (nulls last), food name; keep rank <= k."""
    w = Window.partitionBy(*group).orderBy(F.col("recommendation_score").desc_nulls_last(),
                                           F.col("food_name").asc())
    return df.withColumn(rank_col, F.row_number().over(w)).filter(F.col(rank_col) <= k)


def top_k_by_goal(foods: DataFrame, k: int = TOP_K) -> DataFrame:
    """Ranked top-k foods per goal: at most ``len(GOALS) * k`` rows."""
    return rank_top_k(best_serving(candidate_scores(foods)), ["goal_type"], k)


def spread(users: DataFrame) -> DataFrame:
    """Users dealt over the shuffle width, for what works on all their recommendations: a
    small users file is read by few tasks, which would each hold ``k`` rows a user."""
    return users.repartition(int(users.sparkSession.conf.get("spark.sql.shuffle.partitions")), "user_id")


def recommend(users: DataFrame, foods: DataFrame | None, k: int = TOP_K,
              user_cols: list[str] | None = None, top: DataFrame | None = None) -> DataFrame:
    """Top-k foods per user via goal factoring.

    ``users`` needs ``user_id`` and ``goal_type``. The broadcast side is the
    per-goal ranking, bounded by ``len(GOALS) * k`` rows whatever the data size;
    pass it as ``top`` when it is already computed (e.g. once per stream).
    """
    user_cols = user_cols or ["user_id", "goal_type"]
    top = top if top is not None else top_k_by_goal(foods, k)
    u = users.select(*user_cols)
    return u.join(F.broadcast(top), "goal_type", "inner")


def fact_rows(recs: DataFrame) -> DataFrame:
    """Warehouse fact projection of recommendations."""
    return recs.select(*FACT_REC_COLUMNS)


def recommend_changed(fact: DataFrame | None, changed_users: DataFrame, foods: DataFrame | None,
                      k: int = TOP_K, top: DataFrame | None = None) -> DataFrame:
    """Rebuild the fact rows of changed users, keep everyone else's.

    ``changed_users`` has (user_id, goal_type) of users whose current profile
    changed (goal null = user deleted). Replace-by-key is ``left_anti`` +
    ``union`` — no per-user loop.
    """
    live = changed_users.filter(F.col("goal_type").isNotNull())
    fresh = fact_rows(recommend(live, foods, k, top=top))
    if fact is None:
        return fresh
    kept = fact.join(changed_users.select("user_id"), "user_id", "left_anti")
    return kept.select(*FACT_REC_COLUMNS).unionByName(fresh)
