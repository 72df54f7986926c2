"""Batch layers raw -> bronze -> silver -> gold as lazily composed frames.

``layers(spark, sf_dir)`` builds the whole chain over the driver tables; the
``run_batch`` function materialises it with data-quality gates and atomic
publication (see ``sources.files.publish``).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tierflow.constants import BAND_VALUES, RAW_FOOD_COLUMNS
from tierflow.functions.cleanse import normalise_columns, raw_to_bronze
from tierflow.functions.features import bronze_to_silver, user_features
from tierflow.operators import quality as dq
from tierflow.operators.ordered import materialize
from tierflow.operators.recommend import recommend, spread, top_k_by_goal
from tierflow.sources import adapters, files


@dataclass
class Layers:
    raw: DataFrame
    bronze: DataFrame
    silver: DataFrame
    users: DataFrame
    recommendations: DataFrame


def silver_foods(spark: SparkSession, sf_dir: str, dirty: bool = False) -> DataFrame:
    part = adapters.table(spark, sf_dir, "part")
    raw = adapters.dirty_raw_foods(part) if dirty else adapters.raw_foods(part)
    return bronze_to_silver(raw_to_bronze(raw))


def enriched_users(spark: SparkSession, sf_dir: str, as_of: str = adapters.AS_OF) -> DataFrame:
    return user_features(adapters.users(adapters.table(spark, sf_dir, "customer")), as_of)


def layers(spark: SparkSession, sf_dir: str, as_of: str = adapters.AS_OF, dirty: bool = False) -> Layers:
    part = adapters.table(spark, sf_dir, "part")
    raw = adapters.dirty_raw_foods(part) if dirty else adapters.raw_foods(part)
    bronze = raw_to_bronze(raw)
    silver = bronze_to_silver(bronze)
    users = enriched_users(spark, sf_dir, as_of)
    recs = recommend(users, silver)
    return Layers(raw, bronze, silver, users, recs)


# --------------------------------------------------------------------------- batch run with gates


def _gate(df: DataFrame, checks, stage: str, reports: list, fail: bool, fingerprints: bool = False) -> None:
    rep = dq.run_checks(df, checks, stage, fingerprints=fingerprints)
    reports.append(rep)
    dq.gate(rep, fail_on_error=fail)


def run_batch(spark: SparkSession, raw_foods: DataFrame, raw_users: DataFrame, out_root: str,
              as_of: str = adapters.AS_OF, fail_on_error: bool = True) -> dict:
    """raw -> bronze -> silver -> gold with the stage gates of the modelled jobs
    (each compiled to one aggregate pass), atomic publication of every layer
    and row counters collected with ``observe`` during the writes (A7).

    Returns {"versions": {layer: version}, "counters": {...}, "report": DataFrame}.
    Each layer is read back from its published version before the next stage,
    so a failed stage never sees (or leaves) a half-written layer.
    """
    reports: list[DataFrame] = []
    versions, counters = {}, {}
    # column presence is checked on the normalised header names (C1), so a
    # padded or upper-case header does not fail the gate
    _gate(normalise_columns(raw_foods), [dq.row_count(1, "raw"), dq.columns_exist(RAW_FOOD_COLUMNS, "raw")],
          "raw_schema_check", reports, fail_on_error)

    bronze = raw_to_bronze(raw_foods)
    _gate(bronze, [dq.row_count(1, "bronze"), dq.not_null("label", "bronze")], "bronze_post_transform",
          reports, fail_on_error)
    obs = Observation("bronze")
    versions["bronze"] = files.publish(bronze.observe(obs, F.count(F.lit(1)).alias("rows")),
                                       f"{out_root}/bronze/food_nutrition")
    counters["bronze_rows"] = obs.get["rows"]
    bronze = files.read_published(spark, f"{out_root}/bronze/food_nutrition")

    _gate(bronze, [dq.row_count(1, "bronze_input"),
                   dq.no_fully_null_rows(["label", "calories", "protein", "carbohydrates", "fats", "fiber",
                                          "sugars", "sodium"], "bronze_input"),
                   dq.is_numeric_type("calories", "bronze_input"), dq.is_numeric_type("protein", "bronze_input")],
          "bronze_incoming_check", reports, fail_on_error)
    silver = bronze_to_silver(bronze)
    _gate(silver, [dq.row_count(1, "silver"), dq.not_null("food_name", "silver"),
                   dq.positive("calories_kcal", "silver")]
          + [dq.non_negative(c, "silver") for c in ("protein_g", "carbohydrates_g", "fat_g", "fiber_g", "sugar_g")]
          + [dq.categorical(c, BAND_VALUES, "silver") for c in ("calorie_band", "protein_band", "carb_band",
                                                                  "fat_band")],
          "silver_post_transform", reports, fail_on_error)
    obs = Observation("silver")
    versions["silver"] = files.publish(silver.observe(obs, F.count(F.lit(1)).alias("rows")),
                                       f"{out_root}/silver/food_nutrition_clean")
    counters["silver_rows"] = obs.get["rows"]
    silver = files.read_published(spark, f"{out_root}/silver/food_nutrition_clean")

    users = user_features(raw_users, as_of)
    _gate(users, [dq.row_count(1, "users"), dq.not_null("user_id", "users"), dq.unique("user_id", "users")],
          "user_input_check", reports, fail_on_error, fingerprints=True)
    recs = recommend(spread(users), None, top=materialize(top_k_by_goal(silver)))  # ranked once for the gate and the publication
    _gate(recs, [dq.row_count(1, "gold_recs"), dq.not_null("recommendation_score", "gold_recs"),
                 dq.value_range("recommendation_rank", 1, 10, "gold_recs"),
                 dq.unique(["user_id", "recommendation_rank"], "gold_recs"),
                 dq.unique(["user_id", "food_name"], "gold_recs")],
          "gold_recommendations_check", reports, fail_on_error, fingerprints=True)
    # both gold tables are published under one version: users and their
    # recommendations switch together
    obs_u, obs_r = Observation("gold_users"), Observation("gold_recs")
    gold_version = files.publish(users.observe(obs_u, F.count(F.lit(1)).alias("rows")),
                                 f"{out_root}/gold/user_profiles_enriched")
    files.publish(recs.observe(obs_r, F.count(F.lit(1)).alias("rows")), f"{out_root}/gold/food_recommendations",
                  version=gold_version)
    versions["gold"] = gold_version
    counters["gold_user_rows"] = obs_u.get["rows"]
    counters["gold_recommendation_rows"] = obs_r.get["rows"]
    report = reports[0]
    for r in reports[1:]:
        report = report.unionByName(r)
    return {"versions": versions, "counters": counters, "report": report}
