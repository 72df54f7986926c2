"""Registered queries: name -> (spark, sf_dir) -> DataFrame, plus their oracle SQL.

Every query reads the driver tables of ``sf_dir`` (whole tables) through the
adapters, so its work grows with the data.
"""

from __future__ import annotations

import uuid as _uuid
from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierflow.constants import BAND_VALUES, FACT_REC_COLUMNS
from tierflow.functions import cleanse, features
from tierflow.functions.cleanse import to_warehouse_decimal
from tierflow.operators import quality as dq
from tierflow.operators import recommend as rec
from tierflow.operators import scd2, validate
from tierflow.operators import warehouse as wh
from tierflow.operators.ordered import materialize
from tierflow.plans import medallion, reports, warehouse_load
from tierflow.plans import oracle as O
from tierflow.schemas import PROFILE_EVENT
from tierflow.session import shared_dir
from tierflow.sources import adapters, archive
from tierflow.sources import events as envelope
from tierflow.streaming import profile_stream

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn
    return deco


# --------------------------------------------------------------------------- foods

@register("raw_to_bronze", O.with_(O.DIRTY_FOODS, O.BRONZE) + " SELECT * FROM bronze")
def q_raw_to_bronze(spark, sf_dir):
    """C1-C4 on the dirty food rows (messy headers, padding, commas, n/a, duplicates)."""
    part = adapters.table(spark, sf_dir, "part")
    return cleanse.raw_to_bronze(adapters.dirty_raw_foods(part))


@register("first_number", O.with_(O.DIRTY_FOODS) + r"""
 SELECT weight AS serving_text,
        TRY_CAST(NULLIF(regexp_extract(weight, '([0-9]+(\.[0-9]+)?)', 1), '') AS DOUBLE) AS serving_size_value,
        TRY_CAST(NULLIF(regexp_extract(calories, '([0-9]+(\.[0-9]+)?)', 1), '') AS DOUBLE) AS calories_first_number,
        TRY_CAST(NULLIF(regexp_extract(protein, '([0-9]+(\.[0-9]+)?)', 1), '') AS DOUBLE) AS protein_first_number
 FROM raw_foods""")
def q_first_number(spark, sf_dir):
    """C5 on raw text: '1,000' -> 1, 'n/a' -> null."""
    raw = cleanse.normalise_columns(adapters.dirty_raw_foods(adapters.table(spark, sf_dir, "part")))
    return raw.select(F.col("weight").alias("serving_text"),
                      cleanse.first_number("weight").alias("serving_size_value"),
                      cleanse.first_number("calories").alias("calories_first_number"),
                      cleanse.first_number("protein").alias("protein_first_number"))


@register("bands_flags", O.with_(*O.FOODS_CHAIN) + """
 SELECT food_name, serving_description, calorie_band, protein_band, carb_band, fat_band,
        is_high_protein_low_calorie, is_high_fiber, is_low_sugar FROM silver""")
def q_bands_flags(spark, sf_dir):
    """C10-C11."""
    return medallion.silver_foods(spark, sf_dir).select(
        "food_name", "serving_description", "calorie_band", "protein_band", "carb_band", "fat_band",
        "is_high_protein_low_calorie", "is_high_fiber", "is_low_sugar")


@register("silver_foods", O.with_(*O.FOODS_CHAIN) + " SELECT * FROM silver")
def q_silver_foods(spark, sf_dir):
    """The silver layer."""
    return medallion.silver_foods(spark, sf_dir)


@register("silver_from_dirty", O.with_(O.DIRTY_FOODS, O.BRONZE, O.SILVER) + " SELECT * FROM silver")
def q_silver_from_dirty(spark, sf_dir):
    """C1-C11 end to end from the dirty raw rows."""
    return medallion.silver_foods(spark, sf_dir, dirty=True)


# --------------------------------------------------------------------------- users

@register("goal_type", O.with_(O.USERS) + """
 SELECT user_id, current_weight_lb, target_weight_lb, goal_type FROM enriched""")
def q_goal_type(spark, sf_dir):
    """C12."""
    u = adapters.users(adapters.table(spark, sf_dir, "customer"))
    return u.select("user_id", "current_weight_lb", "target_weight_lb",
                    features.goal_type().alias("goal_type"))


@register("age_batch", O.with_(O.USERS) + " SELECT user_id, birth_date, age FROM enriched")
def q_age_batch(spark, sf_dir):
    """C13 with a fixed as-of date."""
    u = adapters.users(adapters.table(spark, sf_dir, "customer"))
    return u.select("user_id", "birth_date", features.age_batch("birth_date", adapters.AS_OF).alias("age"))


@register("age_calendar", O.with_(O.USERS) + f"""
 SELECT user_id, birth_date,
        CAST(year({O.AS_OF}) - year(birth_date)
             - CASE WHEN month({O.AS_OF}) < month(birth_date)
                      OR (month({O.AS_OF}) = month(birth_date) AND day({O.AS_OF}) < day(birth_date))
                    THEN 1 ELSE 0 END AS INTEGER) AS age
 FROM users""")
def q_age_calendar(spark, sf_dir):
    """C14 with a fixed as-of date."""
    u = adapters.users(adapters.table(spark, sf_dir, "customer"))
    return u.select("user_id", "birth_date", features.age_calendar("birth_date", adapters.AS_OF).alias("age"))


# --------------------------------------------------------------------------- scoring

@register("candidate_scores", O.with_(*O.FOODS_CHAIN, O.GOALS_CTE, O.CAND_BY_GOAL) + """
 SELECT goal_type, food_name, serving_description, recommendation_score, recommendation_reason FROM cand""")
def q_candidate_scores(spark, sf_dir):
    """R1-R4 + C16: every serving scored for every goal."""
    return rec.candidate_scores(medallion.silver_foods(spark, sf_dir)).select(
        "goal_type", "food_name", "serving_description", "recommendation_score", "recommendation_reason")


@register("best_serving", O.with_(*O.FOODS_CHAIN, O.GOALS_CTE, O.CAND_BY_GOAL, O.BEST_BY_GOAL) + """
 SELECT goal_type, food_name, serving_description, recommendation_score FROM best""")
def q_best_serving(spark, sf_dir):
    """Best serving per (goal, food)."""
    return rec.best_serving(rec.candidate_scores(medallion.silver_foods(spark, sf_dir))).select(
        "goal_type", "food_name", "serving_description", "recommendation_score")


@register("top10_by_goal", O.with_(*O.FOODS_CHAIN, O.USERS, O.TOP_USERS) + " SELECT * FROM top_u")
def q_top10_by_goal(spark, sf_dir):
    """Top 10 foods for every user (goal-factored; oracle is the cross join)."""
    return top10(spark, sf_dir)


def top10(spark, sf_dir):
    users = medallion.enriched_users(spark, sf_dir)
    foods = medallion.silver_foods(spark, sf_dir)
    return rec.recommend(users, foods).select(
        "user_id", "goal_type", "food_name", "serving_description", "recommendation_score",
        "recommendation_reason", "recommendation_rank")


@register("goal_topk_table", O.with_(*O.FOODS_CHAIN, O.GOALS_CTE, O.CAND_BY_GOAL, O.BEST_BY_GOAL) + """
 SELECT * FROM (
   SELECT goal_type, food_name, recommendation_score,
          CAST(row_number() OVER (PARTITION BY goal_type ORDER BY recommendation_score DESC NULLS LAST, food_name)
               AS INTEGER) AS recommendation_rank
   FROM best) WHERE recommendation_rank <= 10""")
def q_goal_topk_table(spark, sf_dir):
    """W2-W3 per goal: the broadcast side of the recommendation join."""
    return rec.top_k_by_goal(medallion.silver_foods(spark, sf_dir)).select(
        "goal_type", "food_name", "recommendation_score", "recommendation_rank")


# --------------------------------------------------------------------------- events, SCD2



def profile_events(spark, sf_dir):
    return adapters.profile_events(adapters.table(spark, sf_dir, "events"))


def event_log(spark, sf_dir):
    """The profile events as a log table would hold them: the adapter output
    (string formatting, JSON extraction) is materialised once, so the fold's
    repeated reads are plain scans as they would be on a stored log."""
    return materialize(profile_events(spark, sf_dir))


def dimension(spark, sf_dir, strict=False):
    """The event-built dimension, materialised once (it feeds several joins)."""
    return materialize(scd2.fold(event_log(spark, sf_dir), adapters.AS_OF, strict=strict))


@register("route_events", O.with_(O.EVENTS, O.VALIDATED) + """
 SELECT event_id, user_id, event_type, route, reject_reason FROM routed""")
def q_route_events(spark, sf_dir):
    """Routing with missing type = create, unknown types to rejects."""
    return validate.route_events(profile_events(spark, sf_dir)).select(
        "event_id", "user_id", "event_type", "route", "reject_reason")


@register("validate_profiles", O.with_(O.EVENTS, O.VALIDATED) + """
 SELECT event_id, user_id, event_type, route, errors, is_valid FROM validated""")
def q_validate_profiles(spark, sf_dir):
    """Payload rules and field messages for create (required) / update (optional)."""
    return validate.validate_events(profile_events(spark, sf_dir), adapters.AS_OF).select(
        "event_id", "user_id", "event_type", "route", "errors", "is_valid")


@register("patch_merge", O.with_(O.EVENTS, O.VALIDATED, O.FOLD) + """
 SELECT event_id, user_id, event_type, ts, user_name, gender, birth_date, height_cm,
        current_weight_lb, target_weight_lb FROM merged WHERE event_type = 'update'""")
def q_patch_merge(spark, sf_dir):
    """Accepted update patches completed with the state they patch."""
    return scd2.merge_patches(event_log(spark, sf_dir), adapters.AS_OF)


@register("scd2_fold", O.with_(O.EVENTS, O.VALIDATED, O.FOLD) + " SELECT * FROM dim")
def q_scd2_fold(spark, sf_dir):
    """The SCD2 dimension from the whole event log (update of unknown user upserts)."""
    return scd2.fold(event_log(spark, sf_dir), adapters.AS_OF)


@register("scd2_fold_strict", O.with_(O.EVENTS, O.VALIDATED, O.FOLD_STRICT) + " SELECT * FROM dim")
def q_scd2_fold_strict(spark, sf_dir):
    """E2-E6 strict: updates before a create are refused."""
    return scd2.fold(event_log(spark, sf_dir), adapters.AS_OF, strict=True)


@register("reject_unknown_users", O.with_(O.EVENTS, O.VALIDATED) + """,
ok AS (SELECT * FROM validated WHERE route IN ('create', 'update', 'delete') AND is_valid),
s AS (SELECT *, SUM(CASE WHEN event_type = 'delete' THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY event_id
          ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - CASE WHEN event_type = 'delete' THEN 1 ELSE 0 END AS seg
      FROM ok),
e AS (SELECT *, EXISTS (SELECT 1 FROM s c WHERE c.user_id = s.user_id AND c.seg = s.seg AND c.event_type = 'create'
                         AND c.event_id < s.event_id) AS user_exists FROM s)
SELECT event_id, user_id, event_type, 'user not found' AS reject_reason FROM e
WHERE event_type IN ('update', 'delete') AND NOT user_exists""")
def q_reject_unknown_users(spark, sf_dir):
    """Updates / deletes of users that do not exist at that point."""
    return scd2.unknown_user_rejects(event_log(spark, sf_dir), adapters.AS_OF)


@register("point_in_time", O.with_(O.EVENTS, O.VALIDATED, O.FOLD) + """
 SELECT * FROM dim WHERE effective_start <= TIMESTAMP '2024-01-28 00:00:00'
   AND (effective_end IS NULL OR effective_end > TIMESTAMP '2024-01-28 00:00:00')""")
def q_point_in_time(spark, sf_dir):
    """The version of each user valid at a given instant."""
    return scd2.point_in_time(dimension(spark, sf_dir), "2024-01-28 00:00:00")


@register("range_join_events_versions", O.with_(O.EVENTS, O.VALIDATED, O.FOLD) + """
 SELECT e.event_id, e.user_id, e.ts, e.value, d.user_profile_key
 FROM (SELECT event_id, printf('U%03d', user_id) AS user_id, CAST(ts AS TIMESTAMP) AS ts, value FROM events) e
 LEFT JOIN dim d ON d.user_id = e.user_id AND d.effective_start <= e.ts
   AND (d.effective_end IS NULL OR d.effective_end > e.ts)""")
def q_range_join(spark, sf_dir):
    """J7 generalised: every raw event tagged with the profile version valid at its time."""
    ev = adapters.table(spark, sf_dir, "events").select(
        "event_id", cleanse.format_user_id("user_id").alias("user_id"),
        F.col("ts").cast("timestamp_ntz").alias("ts"), "value")
    return scd2.as_of_versions(ev, dimension(spark, sf_dir), "ts").select(
        "event_id", "user_id", "ts", "value", "user_profile_key")


@register("backfill_history", O.with_(O.USERS) + f""",
cur AS (SELECT user_id, user_name, gender, birth_date, age, height_cm, target_weight_lb, current_weight_lb,
               {O.RUN_TS} AS effective_start, 1 AS is_cur, CAST(NULL AS BIGINT) AS src FROM enriched),
hist AS (SELECT c.user_id, c.user_name, c.gender, c.birth_date, c.age, c.height_cm, c.target_weight_lb,
                {O.D(100)} + o.o_orderkey % 200 AS current_weight_lb, CAST(o.o_orderdate AS TIMESTAMP) AS effective_start,
                0 AS is_cur, o.o_orderkey AS src
         FROM orders o JOIN cur c ON c.user_id = printf('U%03d', o.o_custkey)),
allv AS (SELECT * FROM cur UNION ALL SELECT * FROM hist)
SELECT user_id, user_name, gender, birth_date, age, height_cm, target_weight_lb, current_weight_lb,
       CASE WHEN target_weight_lb < current_weight_lb THEN 'weight_loss'
            WHEN target_weight_lb > current_weight_lb THEN 'weight_gain' ELSE 'maintenance' END AS goal_type,
       effective_start,
       lead(effective_start) OVER w AS effective_end,
       lead(effective_start) OVER w IS NULL AS is_current,
       CAST(row_number() OVER w AS INTEGER) AS version_number
FROM allv WINDOW w AS (PARTITION BY user_id ORDER BY effective_start, is_cur, src NULLS LAST)""")
def q_backfill_history(spark, sf_dir):
    """Version chain rebuilt from older weight readings plus the current profile."""
    cur = medallion.enriched_users(spark, sf_dir).withColumn(
        "effective_start", F.lit(adapters.RUN_TS).cast("timestamp_ntz"))
    readings = adapters.weight_readings(adapters.table(spark, sf_dir, "orders"))
    return scd2.backfill_history(cur, readings)


@register("dq_scd2_invariants", O.with_(O.EVENTS, O.VALIDATED, O.FOLD) + """,
chk AS (SELECT user_id, is_current, effective_end, version_number,
               lead(effective_start) OVER (PARTITION BY user_id ORDER BY version_number) AS nxt,
               row_number() OVER (PARTITION BY user_id ORDER BY version_number) AS pos FROM dim)
SELECT user_id, CAST(SUM(CAST(is_current AS INTEGER)) AS BIGINT) AS current_rows, COUNT(*) AS versions,
       CAST(SUM(CASE WHEN nxt IS NOT NULL AND effective_end IS DISTINCT FROM nxt THEN 1 ELSE 0 END) AS BIGINT) AS chain_gaps,
       CAST(SUM(CASE WHEN pos <> version_number THEN 1 ELSE 0 END) AS BIGINT) AS numbering_holes
FROM chk GROUP BY user_id
HAVING SUM(CAST(is_current AS INTEGER)) > 1 OR SUM(CASE WHEN nxt IS NOT NULL AND effective_end IS DISTINCT FROM nxt
       THEN 1 ELSE 0 END) > 0 OR SUM(CASE WHEN pos <> version_number THEN 1 ELSE 0 END) > 0""")
def q_dq_scd2_invariants(spark, sf_dir):
    """Users breaking at-most-one-current / contiguity / numbering (expected empty)."""
    return scd2.invariant_violations(dimension(spark, sf_dir))


@register("dq_scd2_broken", O.with_(O.USERS, O.EVENTS, O.VALIDATED, O.FOLD) + f""",
two AS (SELECT user_id, user_profile_key, effective_start, effective_end, is_current, version_number FROM dim
        UNION ALL SELECT user_id, NULL, {O.RUN_TS}, NULL, TRUE, 1 FROM enriched),
chk AS (SELECT *, lead(effective_start) OVER w AS nxt, row_number() OVER w AS pos FROM two
        WINDOW w AS (PARTITION BY user_id ORDER BY version_number, effective_start, user_profile_key))
SELECT user_id, CAST(SUM(CAST(is_current AS INTEGER)) AS BIGINT) AS current_rows, COUNT(*) AS versions,
       CAST(SUM(CASE WHEN nxt IS NOT NULL AND effective_end IS DISTINCT FROM nxt THEN 1 ELSE 0 END) AS BIGINT) AS chain_gaps,
       CAST(SUM(CASE WHEN pos IS DISTINCT FROM version_number THEN 1 ELSE 0 END) AS BIGINT) AS numbering_holes
FROM chk GROUP BY user_id
HAVING SUM(CAST(is_current AS INTEGER)) > 1 OR SUM(CASE WHEN nxt IS NOT NULL AND effective_end IS DISTINCT FROM nxt
       THEN 1 ELSE 0 END) > 0 OR SUM(CASE WHEN pos IS DISTINCT FROM version_number THEN 1 ELSE 0 END) > 0""")
def q_dq_scd2_broken(spark, sf_dir):
    """E17 on a dimension that is broken: the batch users appended to the event-built one without the loader's check."""
    columns = ["user_id", "user_profile_key", "effective_start", "effective_end", "is_current", "version_number"]
    users = medallion.enriched_users(spark, sf_dir).select(
        "user_id", F.lit(None).cast("long").alias("user_profile_key"), F.lit(adapters.RUN_TS).cast("timestamp_ntz").alias("effective_start"),
        F.lit(None).cast("timestamp_ntz").alias("effective_end"), F.lit(True).alias("is_current"), F.lit(1).alias("version_number"))
    return scd2.invariant_violations(dimension(spark, sf_dir).select(columns).union(users))


@register("dq_orphan_facts", O.with_(*O.FOODS_CHAIN, O.USERS, O.EVENTS, O.VALIDATED, O.FOLD, O.TOP_USERS) + """
 SELECT 'warehouse_pre_load_check' AS stage, 'referential_integrity' AS "check", 'user_id' AS "column",
        CASE WHEN n = 0 THEN 'PASS' ELSE 'FAIL' END AS status, CAST(n AS BIGINT) AS observed,
        'fk=user_id -> pk=user_id orphans=' || n AS detail
 FROM (SELECT COUNT(*) AS n FROM top_u f LEFT JOIN (SELECT DISTINCT user_id FROM dim) d ON f.user_id = d.user_id
       WHERE d.user_id IS NULL)""")
def q_dq_orphan_facts(spark, sf_dir):
    """D14 / J6 where there are orphans: recommendations of batch users against the event-built dimension, before the load."""
    return dq.referential_report(medallion.layers(spark, sf_dir).recommendations, dimension(spark, sf_dir), "user_id", "user_id", "warehouse_pre_load_check")


@register("dq_users_awaiting_recs", O.with_(O.USERS, O.EVENTS, O.VALIDATED, O.FOLD) + """
 SELECT user_id, user_name FROM enriched e WHERE NOT EXISTS (SELECT 1 FROM dim d WHERE d.is_current AND d.user_id = e.user_id)""")
def q_dq_users_awaiting_recs(spark, sf_dir):
    """D15 where there are such users: batch users against the recommendations of the stream's current users."""
    top = rec.top_k_by_goal(medallion.silver_foods(spark, sf_dir))
    streamed = rec.fact_rows(rec.recommend(scd2.current_rows(dimension(spark, sf_dir)).select("user_id", "goal_type"), None, top=top))
    return dq.users_without_recommendations(medallion.enriched_users(spark, sf_dir).select("user_id", "user_name"), streamed)


# --------------------------------------------------------------------------- warehouse, reports, DQ



class WarehouseState:
    """(dim_user, dim_food, fact): event-built dimension + batch load of new
    users. Each table is built on first use only, so a query over the
    dimension never computes the fact; the lineage is cut once, after the
    fold (the expensive part), which both tables read."""

    def __init__(self, spark, sf_dir):
        self.spark, self.sf_dir = spark, sf_dir

    @cached_property
    def _silver(self):
        return medallion.silver_foods(self.spark, self.sf_dir)

    @cached_property
    def dim_events(self):
        """The dimension folded from the event log (before the batch load)."""
        return dimension(self.spark, self.sf_dir)

    def _load(self, top):
        silver = self._silver
        dim_ev = self.dim_events
        gold_users = medallion.enriched_users(self.spark, self.sf_dir)
        gold_recs = rec.recommend(gold_users, silver, top=top)
        cur = scd2.current_rows(dim_ev).select("user_id", "goal_type")
        fact_ev = rec.fact_rows(rec.recommend(cur, silver, top=top))
        return wh.load(dim_ev, fact_ev, silver, gold_users, gold_recs, adapters.RUN_TS)

    @cached_property
    def dim_user(self):
        # the dimension side of the load does not read the recommendations; it is
        # the materialised fold plus the stamped new users (cheap to re-read, so
        # not written a second time)
        w = self._load(rec.top_k_by_goal(self._silver))
        return to_warehouse_decimal(w.dim_user, ["height_cm", "current_weight_lb", "target_weight_lb"])

    @cached_property
    def dim_food(self):
        return wh.dim_food(self._silver)

    @cached_property
    def fact(self):
        top = materialize(rec.top_k_by_goal(self._silver))  # bounded (3 x 10 rows), ranked once for both loads
        # materialised: the report fans it out, and joins plan on its measured size
        return materialize(to_warehouse_decimal(self._load(top).fact, ["recommendation_score"]))


def warehouse_state(spark, sf_dir) -> WarehouseState:
    return WarehouseState(spark, sf_dir)


DIM_OUT = ["user_id", "user_name", "gender", "birth_date", "age", "height_cm", "current_weight_lb",
           "target_weight_lb", "goal_type", "effective_start", "effective_end", "is_current", "version_number"]


@register("decimal_boundary", O.with_(*O.FOODS_CHAIN, O.USERS, O.EVENTS, O.VALIDATED, O.FOLD,
                                      O.WAREHOUSE) + " SELECT * FROM wfood")
def q_decimal_boundary(spark, sf_dir):
    """Warehouse food rows with DECIMAL(10,2) numbers."""
    return wh.dim_food(medallion.silver_foods(spark, sf_dir))


@register("load_dim_user", O.with_(*O.WAREHOUSE_CHAIN) + " SELECT * FROM wdim")
def q_load_dim_user(spark, sf_dir):
    """Dimension after the batch load (existing users skipped, new ones stamped)."""
    return warehouse_state(spark, sf_dir).dim_user.select(*DIM_OUT)


@register("load_fact", O.with_(*O.WAREHOUSE_CHAIN) + " SELECT * FROM wfact")
def q_load_fact(spark, sf_dir):
    """Fact after the batch load (new users' recommendations appended)."""
    return warehouse_state(spark, sf_dir).fact.select(*FACT_REC_COLUMNS)


@register("recommend_changed_users", O.with_(*O.FOODS_CHAIN, O.USERS, O.TOP_USERS, O.EVENTS, O.VALIDATED,
                                             O.FOLD) + f""",
changed AS (SELECT DISTINCT user_id FROM ok),
cur_ev AS (SELECT user_id, goal_type FROM dim WHERE is_current),
{O.top_sql('cur_ev', 'fresh')}
SELECT user_id, food_name, goal_type, recommendation_score, recommendation_rank, recommendation_reason
FROM top_u t WHERE NOT EXISTS (SELECT 1 FROM changed c WHERE c.user_id = t.user_id)
UNION ALL
SELECT user_id, food_name, goal_type, recommendation_score, recommendation_rank, recommendation_reason FROM fresh""")
def q_recommend_changed_users(spark, sf_dir):
    """Users touched by events get fresh recommendations for their current goal
    (deleted users lose theirs); everyone else keeps the batch rows."""
    silver = medallion.silver_foods(spark, sf_dir)
    batch = rec.fact_rows(rec.recommend(medallion.enriched_users(spark, sf_dir), silver))
    ev = validate.validate_events(profile_events(spark, sf_dir), adapters.AS_OF)
    touched = ev.filter(F.col("route").isin("create", "update", "delete") & F.col("is_valid")).select(
        "user_id").distinct()
    cur = scd2.current_rows(dimension(spark, sf_dir)).select("user_id", "goal_type")
    changed = touched.join(cur, "user_id", "left")
    return rec.recommend_changed(batch, changed, silver)


@register("report", O.with_(*O.WAREHOUSE_CHAIN, O.REPORT) + " SELECT * FROM report")
def q_report(spark, sf_dir):
    """V1 (J2 + J3): flat recommendation report; fans out over servings like the modelled view."""
    w = warehouse_state(spark, sf_dir)
    dim_user, dim_food, fact = w.dim_user, w.dim_food, w.fact
    return reports.recommendation_report(fact, dim_user, dim_food)


@register("report_best_serving", O.with_(*O.WAREHOUSE_CHAIN) + """,
fbest AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY food_name ORDER BY serving_description,
    calories_kcal, protein_g, carbohydrates_g, fat_g, fiber_g, sugar_g, sodium_mg) AS rn
                         FROM wfood) WHERE rn = 1)
SELECT u.user_id, u.user_name, u.gender, u.age, u.goal_type, u.height_cm, u.current_weight_lb,
       u.target_weight_lb, r.food_name, r.recommendation_score, r.recommendation_rank, r.recommendation_reason,
       f.calories_kcal, f.protein_g, f.fiber_g, f.carbohydrates_g, f.fat_g, f.sugar_g, f.calorie_band,
       f.protein_band, f.is_high_protein_low_calorie, f.is_high_fiber, f.is_low_sugar
FROM wfact r JOIN wdim u ON r.user_id = u.user_id AND u.is_current LEFT JOIN fbest f ON r.food_name = f.food_name""")
def q_report_best_serving(spark, sf_dir):
    """V1 option: one report row per recommendation (first serving of each food)."""
    w = warehouse_state(spark, sf_dir)
    dim_user, dim_food, fact = w.dim_user, w.dim_food, w.fact
    return reports.recommendation_report(fact, dim_user, dim_food, best_serving_only=True)


@register("goal_summary", O.with_(*O.WAREHOUSE_CHAIN) + """
 SELECT user_id, user_name, gender, age, goal_type, height_cm, current_weight_lb, target_weight_lb,
        CAST(ROUND(current_weight_lb - target_weight_lb, 1) AS DECIMAL(10,1)) AS weight_delta_lb
 FROM wdim WHERE is_current""")
def q_goal_summary(spark, sf_dir):
    """V2 (C15, J9)."""
    return reports.goal_summary(warehouse_state(spark, sf_dir).dim_user)


@register("food_profile", O.with_(*O.WAREHOUSE_CHAIN) + """
 SELECT food_name, calories_kcal, protein_g, carbohydrates_g, fat_g, fiber_g, sugar_g, sodium_mg, calorie_band,
        protein_band, carb_band, fat_band, is_high_protein_low_calorie, is_high_fiber, is_low_sugar FROM wfood""")
def q_food_profile(spark, sf_dir):
    """V3."""
    return reports.food_profile(warehouse_state(spark, sf_dir).dim_food)


HIST_COLS = ["user_id", "user_name", "gender", "age", "goal_type", "height_cm", "current_weight_lb",
             "target_weight_lb", "weight_delta_lb", "changed_at", "effective_end", "is_current", "version_number",
             "progress_status"]


@register("progress_history", O.with_(*O.WAREHOUSE_CHAIN, O.HISTORY) + f" SELECT {', '.join(HIST_COLS)} FROM hist")
def q_progress_history(spark, sf_dir):
    """V4 (W4, W5, C15): progress status per version."""
    return reports.progress_history(warehouse_state(spark, sf_dir).dim_user).select(*HIST_COLS)


@register("user_history", O.with_(*O.WAREHOUSE_CHAIN, O.HISTORY) + """
 SELECT user_id, user_name, gender, age, height_cm, current_weight_lb, target_weight_lb, goal_type, weight_delta_lb,
        changed_at, changed_at AS effective_start, effective_end, is_current, version_number, progress_status,
        total_versions FROM hist""")
def q_user_history(spark, sf_dir):
    """V7 (+ A6): history rows with the user's version count."""
    return reports.user_history(warehouse_state(spark, sf_dir).dim_user)


@register("list_users", O.with_(*O.WAREHOUSE_CHAIN) + """
 SELECT user_id, user_name, goal_type FROM wdim WHERE is_current ORDER BY user_id""")
def q_list_users(spark, sf_dir):
    """V5."""
    return reports.list_users(warehouse_state(spark, sf_dir).dim_user)


@register("current_profile", O.with_(*O.WAREHOUSE_CHAIN) + """
 SELECT user_id, user_name, gender, birth_date, age, height_cm, current_weight_lb, target_weight_lb, goal_type,
        effective_start, version_number FROM wdim WHERE is_current""")
def q_current_profile(spark, sf_dir):
    """V6."""
    return reports.current_profile(warehouse_state(spark, sf_dir).dim_user)


@register("recs_for_users", O.with_(*O.WAREHOUSE_CHAIN) + """
 SELECT user_id, food_name, goal_type, recommendation_score, recommendation_rank, recommendation_reason
 FROM wfact WHERE user_id IN (SELECT user_id FROM dim WHERE is_current AND goal_type = 'weight_gain')
 ORDER BY user_id, recommendation_rank""")
def q_recs_for_users(spark, sf_dir):
    """Recommendations of a user set (here: event-built users aiming to gain)."""
    w = warehouse_state(spark, sf_dir)
    fact = w.fact
    sel = scd2.current_rows(w.dim_events).filter(F.col("goal_type") == "weight_gain")
    return reports.recs_for_users(fact, sel)


@register("weight_journey", O.with_(*O.WAREHOUSE_CHAIN, O.HISTORY) + """
 SELECT user_id, version_number, CAST(changed_at AS DATE) AS date, current_weight_lb AS actual_lb,
        target_weight_lb AS target_lb, weight_delta_lb AS gap_lb, progress_status,
        replace(progress_status, '_', ' ') AS status_label,
        CASE goal_type WHEN 'weight_loss' THEN 'Weight Loss' WHEN 'weight_gain' THEN 'Weight Gain'
             WHEN 'maintenance' THEN 'Maintenance' ELSE goal_type END AS goal_label
 FROM hist""")
def q_weight_journey(spark, sf_dir):
    """V9 (C20): chart series."""
    return reports.weight_journey(reports.progress_history(warehouse_state(spark, sf_dir).dim_user))


SEARCH_TERMS = ["u01", "#000000", "user_4"]


@register("search_users", O.with_(*O.WAREHOUSE_CHAIN) + f""",
terms AS (SELECT * FROM (VALUES {', '.join(f"('{t}')" for t in SEARCH_TERMS)}) t(term))
 SELECT t.term, u.user_id, u.user_name FROM wdim u, terms t
 WHERE u.is_current AND (contains(lower(u.user_id), t.term) OR contains(lower(coalesce(u.user_name, '')), t.term))""")
def q_search_users(spark, sf_dir):
    """Case-insensitive substring search on id or name for a list of terms."""
    return reports.search_users(warehouse_state(spark, sf_dir).dim_user, SEARCH_TERMS)


SEARCH_TABLE = """
terms AS (SELECT right('0000' || o_orderkey, 5) AS term FROM orders
          UNION ALL SELECT CAST(n_nationkey AS VARCHAR) FROM nation
          UNION ALL SELECT 'USER_' || n_nationkey FROM nation)"""


@register("search_users_bulk", O.with_(*O.WAREHOUSE_CHAIN, SEARCH_TABLE) + """
 SELECT t.term, u.user_id, u.user_name FROM wdim u, (SELECT DISTINCT lower(term) AS term FROM terms) t
 WHERE u.is_current AND (contains(lower(u.user_id), t.term) OR contains(lower(coalesce(u.user_name, '')), t.term))""")
def q_search_users_bulk(spark, sf_dir):
    """A table of terms (one per order, and short and long ones per nation) through trigram postings."""
    keys = adapters.table(spark, sf_dir, "orders").select(F.expr("right(concat('0000', o_orderkey), 5)").alias("term"))
    nations = adapters.table(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("string").alias("k"))
    terms = keys.union(nations).union(nations.select(F.concat(F.lit("USER_"), "k")))
    return reports.search_users_by_terms(warehouse_state(spark, sf_dir).dim_user, terms)


@register("top_foods_by_goal", O.with_(*O.WAREHOUSE_CHAIN) + """
 SELECT goal_type, food_name, COUNT(*) AS n_users, MIN(recommendation_rank) AS best_rank,
        CAST(SUM(recommendation_score) AS DECIMAL(20,2)) AS sum_score, replace(food_name, '_', ' ') AS food_label
 FROM wfact GROUP BY goal_type, food_name""")
def q_top_foods_by_goal(spark, sf_dir):
    """A8."""
    return reports.top_foods_by_goal(warehouse_state(spark, sf_dir).fact)


@register("rank_distribution", O.with_(*O.WAREHOUSE_CHAIN, O.REPORT) + """
 SELECT recommendation_rank, COUNT(*) AS n_rows, CAST(SUM(recommendation_score) AS DECIMAL(20,2)) AS sum_score
 FROM report GROUP BY recommendation_rank""")
def q_rank_distribution(spark, sf_dir):
    """A8 over V1."""
    w = warehouse_state(spark, sf_dir)
    dim_user, dim_food, fact = w.dim_user, w.dim_food, w.fact
    return reports.rank_distribution(reports.report_counts(fact, dim_user, dim_food))


@register("score_distribution", O.with_(*O.WAREHOUSE_CHAIN) + """
 SELECT goal_type, floor(recommendation_score / 10.0) * 10.0 AS bucket_lo, COUNT(*) AS n_rows
 FROM wfact GROUP BY 1, 2""")
def q_score_distribution(spark, sf_dir):
    """A8."""
    return reports.score_distribution(warehouse_state(spark, sf_dir).fact)


@register("flag_kpis", O.with_(*O.WAREHOUSE_CHAIN, O.REPORT) + """
 SELECT goal_type, COUNT(*) AS n_rows,
        CAST(SUM(is_high_protein_low_calorie) AS BIGINT) AS n_high_protein_low_calorie,
        CAST(SUM(is_high_fiber) AS BIGINT) AS n_high_fiber, CAST(SUM(is_low_sugar) AS BIGINT) AS n_low_sugar
 FROM report GROUP BY goal_type""")
def q_flag_kpis(spark, sf_dir):
    """A8 over V1."""
    w = warehouse_state(spark, sf_dir)
    dim_user, dim_food, fact = w.dim_user, w.dim_food, w.fact
    return reports.flag_kpis(reports.report_counts(fact, dim_user, dim_food))


SILVER_CHECKS = [
    ("row_count", None, 1, "silver"),
    ("not_null", "food_name", None, "silver"),
    ("positive", "calories_kcal", None, "silver"),
    ("non_negative", "protein_g", None, "silver"),
    ("non_negative", "carbohydrates_g", None, "silver"),
    ("non_negative", "fat_g", None, "silver"),
    ("non_negative", "fiber_g", None, "silver"),
    ("non_negative", "sugar_g", None, "silver"),
    ("categorical", "calorie_band", BAND_VALUES, "silver"),
    ("categorical", "protein_band", BAND_VALUES, "silver"),
    ("categorical", "carb_band", BAND_VALUES, "silver"),
    ("categorical", "fat_band", BAND_VALUES, "silver"),
    ("not_null", "protein_g", None, "silver"),
    ("unique", ("food_name", "serving_description"), None, "silver"),
]

GOLD_CHECKS = [
    ("row_count", None, 1, "gold_recs"),
    ("not_null", "recommendation_score", None, "gold_recs"),
    ("value_range", "recommendation_rank", (1, 10), "gold_recs"),
    ("unique", ("user_id", "recommendation_rank"), None, "gold_recs"),
    ("unique", ("user_id", "food_name"), None, "gold_recs"),
]


def _checks(spec):
    out = []
    for kind, col, arg, label in spec:
        if kind == "row_count":
            out.append(dq.row_count(arg, label))
        elif kind == "value_range":
            out.append(dq.value_range(col, arg[0], arg[1], label))
        elif kind == "categorical":
            out.append(dq.categorical(col, arg, label))
        elif kind == "unique":
            out.append(dq.unique(col, label))
        else:
            out.append(getattr(dq, kind)(col, label))
    return out


@register("dq_report", O.with_(O.DIRTY_FOODS, O.BRONZE, O.SILVER) + " "
          + O.dq_sql("silver_post_transform", "silver", SILVER_CHECKS))
def q_dq_report(spark, sf_dir):
    """The silver gate over the cleansed dirty foods, one aggregate pass."""
    return dq.run_checks(medallion.silver_foods(spark, sf_dir, dirty=True), _checks(SILVER_CHECKS),
                         "silver_post_transform")


@register("dq_gold_report", O.with_(*O.FOODS_CHAIN, O.USERS, O.TOP_USERS) + " "
          + O.dq_sql("gold_recommendations_check", "top_u", GOLD_CHECKS))
def q_dq_gold_report(spark, sf_dir):
    """The gold gate over all users' top-10."""
    top = materialize(rec.top_k_by_goal(medallion.silver_foods(spark, sf_dir)))  # bounded (3 x 10 rows), ranked once for all checks
    recs = rec.fact_rows(rec.recommend(rec.spread(medallion.enriched_users(spark, sf_dir)), None, top=top))
    return dq.run_checks(recs, _checks(GOLD_CHECKS), "gold_recommendations_check", fingerprints=True)


@register("dq_referential", O.with_(*O.WAREHOUSE_CHAIN) + """
 SELECT 'warehouse_post_load_check' AS stage, 'referential_integrity' AS "check", 'user_id' AS "column",
        CASE WHEN n = 0 THEN 'PASS' ELSE 'FAIL' END AS status, CAST(n AS BIGINT) AS observed,
        'fk=user_id -> pk=user_id orphans=' || n AS detail
 FROM (SELECT COUNT(*) AS n FROM wfact f LEFT JOIN (SELECT DISTINCT user_id FROM wdim) d ON f.user_id = d.user_id
       WHERE d.user_id IS NULL)""")
def q_dq_referential(spark, sf_dir):
    """Fact rows without a dimension row (orphans)."""
    w = warehouse_state(spark, sf_dir)
    dim_user, fact = w.dim_user, w.fact
    return dq.referential_report(fact, dim_user, "user_id", "user_id", "warehouse_post_load_check")


@register("dq_users_without_recs", O.with_(*O.WAREHOUSE_CHAIN) + """
 SELECT user_id, user_name FROM wdim d WHERE is_current AND NOT EXISTS (SELECT 1 FROM wfact f WHERE f.user_id = d.user_id)""")
def q_dq_users_without_recs(spark, sf_dir):
    """D15 in bulk: current users with no recommendation."""
    w = warehouse_state(spark, sf_dir)
    dim_user, fact = w.dim_user, w.fact
    return dq.users_without_recommendations(scd2.current_rows(dim_user).select("user_id", "user_name"), fact)


@register("dataset_profile", O.with_(O.DIRTY_FOODS) + """,
n AS (SELECT COUNT(*) AS row_count FROM raw_foods)
SELECT ordinal, column_name, data_type, row_count, 9 AS column_count, null_count FROM (
  SELECT 1 AS ordinal, 'label' AS column_name, 'string' AS data_type, COUNT(*) FILTER (WHERE label IS NULL) AS null_count FROM raw_foods
  UNION ALL SELECT 2, 'weight', 'string', COUNT(*) FILTER (WHERE weight IS NULL) FROM raw_foods
  UNION ALL SELECT 3, 'calories', 'string', COUNT(*) FILTER (WHERE calories IS NULL) FROM raw_foods
  UNION ALL SELECT 4, 'protein', 'string', COUNT(*) FILTER (WHERE protein IS NULL) FROM raw_foods
  UNION ALL SELECT 5, 'carbohydrates', 'string', COUNT(*) FILTER (WHERE carbohydrates IS NULL) FROM raw_foods
  UNION ALL SELECT 6, 'fats', 'string', COUNT(*) FILTER (WHERE fats IS NULL) FROM raw_foods
  UNION ALL SELECT 7, 'fiber', 'string', COUNT(*) FILTER (WHERE fiber IS NULL) FROM raw_foods
  UNION ALL SELECT 8, 'sugars', 'string', COUNT(*) FILTER (WHERE sugars IS NULL) FROM raw_foods
  UNION ALL SELECT 9, 'sodium', 'string', COUNT(*) FILTER (WHERE sodium IS NULL) FROM raw_foods
) c, n""")
def q_dataset_profile(spark, sf_dir):
    """Shape, types and null counts of the raw food rows in one pass."""
    raw = cleanse.normalise_columns(adapters.dirty_raw_foods(adapters.table(spark, sf_dir, "part")))
    return cleanse.dataset_profile(raw)


@register("next_ids", O.with_(*O.FOODS_CHAIN, O.USERS, O.EVENTS, O.VALIDATED, O.FOLD) + """,
ids AS (SELECT user_id FROM dim WHERE regexp_matches(user_id, '^U[0-9]+$')
        UNION SELECT user_id FROM ev WHERE regexp_matches(user_id, '^U[0-9]+$')),
hw AS (SELECT coalesce(max(CAST(substr(user_id, 2) AS BIGINT)), 0) AS high_water FROM ids),
req AS (SELECT c_custkey, c_name FROM customer c
        WHERE NOT EXISTS (SELECT 1 FROM ids WHERE ids.user_id = printf('U%03d', c.c_custkey)))
SELECT c_custkey, c_name, printf('U%03d', high_water + row_number() OVER (ORDER BY c_custkey)) AS user_id
FROM req, hw""")
def q_next_ids(spark, sf_dir):
    """E14 (J11, A5, C17, C18): ids for new profile requests past the high-water mark."""
    ev = profile_events(spark, sf_dir)
    # the id set is read twice (high-water mark, anti join): materialise it, not the dimension
    ids = materialize(wh.known_ids(scd2.fold(event_log(spark, sf_dir), adapters.AS_OF), ev))
    customers = adapters.table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    requests = customers.join(ids, cleanse.format_user_id("c_custkey") == ids["user_id"], "left_anti")
    return wh.allocate_ids(requests, ["c_custkey"], wh.high_water_mark(ids)).select("c_custkey", "c_name", "user_id")


# --------------------------------------------------------------------------- streaming, codecs, archive



def run_event_stream(spark, sf_dir, root=None, max_files_per_trigger=None, source_dir=None):
    """Drive the profile stream over the events table to completion; returns the store."""
    root = root or shared_dir(spark, "profile_stream", _uuid.uuid4().hex[:10])
    src = source_dir or sf_dir
    glob = None if source_dir else "events.parquet"
    raw = envelope.read_event_files(spark, src, spark.read.parquet(f"{sf_dir}/events.parquet").schema, glob,
                                    max_files_per_trigger)
    stream = adapters.profile_events(raw)
    store = profile_stream.SnapshotStore(spark, f"{root}/state")
    q = profile_stream.start(stream, store, medallion.silver_foods(spark, sf_dir), adapters.AS_OF,
                             f"{root}/checkpoint")
    q.awaitTermination()
    return store


@register("stream_scd2_final", O.with_(O.EVENTS, O.VALIDATED, O.FOLD) + " SELECT * FROM dim")
def q_stream_scd2_final(spark, sf_dir):
    """S9 / E6 / R6 streaming: foreachBatch fold of the event stream; final dimension
    (must equal the one-shot fold)."""
    store = run_event_stream(spark, sf_dir)
    return store.read("dim").select(*scd2.DIM_COLUMNS)


@register("stream_fact_final", O.with_(*O.FOODS_CHAIN, O.EVENTS, O.VALIDATED, O.FOLD) + f""",
cur_ev AS (SELECT user_id, goal_type FROM dim WHERE is_current),
{O.top_sql('cur_ev', 'fresh')}
SELECT user_id, food_name, goal_type, recommendation_score, recommendation_rank, recommendation_reason FROM fresh""")
def q_stream_fact_final(spark, sf_dir):
    """R6 streaming: recommendations kept current by the event stream."""
    store = run_event_stream(spark, sf_dir)
    return store.read("fact").select(*FACT_REC_COLUMNS)


def _records(spark, sf_dir):
    """Profile events as a topic holds them: JSON without id and time; every 50th
    event is followed by a record that is no JSON object."""
    ev = profile_events(spark, sf_dir)
    place = [F.pmod(F.xxhash64("user_id"), F.lit(4)).cast("int").alias("partition"), F.col("event_id").alias("offset"), F.col("ts").cast("timestamp").alias("timestamp")]
    good = ev.select(F.to_json(F.struct(*[c for c in ev.columns if c not in ("event_id", "ts")])).alias("value"), *place)
    bad = ev.filter("event_id % 50 = 0").select(F.concat(F.lit("{broken "), F.col("event_id").cast("string")).alias("value"), F.lit(9).alias("partition"), *place[1:])
    return good.unionByName(bad)


#: Order in which fifths of the topic arrive.
ARRIVAL = (1, 0, 3, 2, 4)


def run_topic_stream(spark, sf_dir, root=None, load=False):
    """The topic's records in five batches, out of order, each with a tenth of the one
    before delivered again; returns the store. ``load``: after a batch load of the users."""
    root = root or shared_dir(spark, "topic_stream", _uuid.uuid4().hex[:10])
    records = materialize(_records(spark, sf_dir).repartition("offset"))  # as they lie in the file, a batch would be in one or two tasks
    last = records.agg(F.max("offset")).first()[0] or 0  # one number
    store = profile_stream.SnapshotStore(spark, f"{root}/state", buckets=4)
    foods = medallion.silver_foods(spark, sf_dir)
    if load:
        users = medallion.enriched_users(spark, sf_dir)
        warehouse_load.load(store, foods, users, rec.recommend(users, foods), adapters.RUN_TS)
    fifth = F.floor(F.col("offset") * 5 / (last + 1))
    for at, part in enumerate(ARRIVAL):
        again = (fifth == ARRIVAL[at - 1]) & (F.col("offset") % 10 == 3) if at else F.lit(False)
        records.filter((fifth == part) | again).write.mode("append").parquet(f"{root}/topic")
        q = profile_stream.start_topic(envelope.read_record_files(spark, f"{root}/topic"), store, foods, adapters.AS_OF, f"{root}/checkpoint")
        q.awaitTermination()
    return store


@register("stream_json_events", O.with_(O.EVENTS, O.VALIDATED, O.FOLD) + f" SELECT {', '.join(DIM_OUT)} FROM dim")
def q_stream_json_events(spark, sf_dir):
    """Topic records without id or time, out of order and redelivered, to the same dimension."""
    return run_topic_stream(spark, sf_dir).read("dim").select(*DIM_OUT)


@register("fold_rejects", O.with_(O.EVENTS, O.VALIDATED, O.FOLD, O.OUTCOMES) + O.REFUSED)
def q_fold_rejects(spark, sf_dir):
    """Valid events that the fold refuses, with the reason."""
    out = scd2.event_outcomes(event_log(spark, sf_dir), adapters.AS_OF).filter("outcome not in ('accepted', 'erased')")
    return out.select("event_id", "user_id", "event_type", F.col("outcome").alias("reason"))


@register("stream_refused", O.with_(O.EVENTS, O.VALIDATED, O.FOLD, O.OUTCOMES) + O.REFUSED)
def q_stream_refused(spark, sf_dir):
    """E13 / E15 in the stream: the refused events it keeps, out of order and with redeliveries."""
    place = F.col("event_id").bitwiseAND(F.lit((1 << envelope.OFFSET_BITS) - 1))
    return run_topic_stream(spark, sf_dir).read("refused").select(place.alias("event_id"), "user_id", "event_type", "reason")


@register("stream_after_load", O.with_(*O.FOODS_CHAIN, O.USERS, O.EVENTS, O.VALIDATED, O.LOADED, O.FOLD.replace("FROM validated", "FROM loaded_and_events")) + f"""
 SELECT {', '.join('CASE WHEN user_profile_key = -1 THEN b.age ELSE d.age END AS age' if c == 'age' else f'd.{c}' for c in DIM_OUT)}
 FROM dim d LEFT JOIN enriched b USING (user_id)""")
def q_stream_after_load(spark, sf_dir):
    """A batch load, then the event stream on the same dimension."""
    return run_topic_stream(spark, sf_dir, load=True).read("dim").select(*DIM_OUT)


@register("warehouse_run", O.with_(*O.FOODS_CHAIN, O.USERS, O.TOP_USERS) + """
 SELECT t.user_id, t.food_name, t.goal_type, t.recommendation_score, t.recommendation_rank, t.recommendation_reason,
   e.current_weight_lb, 1 AS version_number, (SELECT count(*) FROM silver) AS dim_food_rows FROM top_u t JOIN enriched e USING (user_id)""")
def q_warehouse_run(spark, sf_dir):
    """Raw files to the warehouse with all gates; the loaded facts with their users."""
    root = shared_dir(spark, "warehouse_run", _uuid.uuid4().hex[:10])
    medallion.run_batch(spark, adapters.raw_foods(adapters.table(spark, sf_dir, "part")), adapters.users(adapters.table(spark, sf_dir, "customer")), f"{root}/lake")
    store = profile_stream.SnapshotStore(spark, f"{root}/warehouse")
    warehouse_load.load_published(spark, f"{root}/lake", store, adapters.RUN_TS)
    foods = store.read("food").agg(F.count(F.lit(1)).alias("dim_food_rows"))
    users = store.read("dim").filter("is_current").select("user_id", "current_weight_lb", "version_number")
    return store.read("fact").select(*FACT_REC_COLUMNS).join(users, "user_id").join(F.broadcast(foods), F.lit(True))


#: Tables of the store that hold rows of users.
HELD = ("dim", "fact", "log", "refused", "rejected", "hw")


def _held_rows(store, away):
    """(table_name, n): rows of the users ``away`` in any file of the store's tables.

    Merge joins: a column of a compressed file is some hundred times larger than its share of
    the file's bytes, by which Spark would send every file's users to the driver."""
    out = None
    for t in HELD:
        rows = store.files(t).withColumnRenamed("last_delete_id", "mark").join(away.hint("merge"), "user_id")
        if "event_id" in rows.columns:  # what a user sent after the delete is not erased by it
            rows = rows.filter("event_id <= last_delete_id")
        one = rows.agg(F.count(F.lit(1)).alias("n")).select(F.lit(t).alias("table_name"), "n")
        out = one if out is None else out.unionByName(one)
    return out


@register("erased_files", O.with_(O.EVENTS, O.VALIDATED, O.FOLD) + """,
away AS (SELECT user_id FROM ok GROUP BY user_id HAVING max(event_id) = max(CASE WHEN event_type = 'delete' THEN event_id END))
SELECT t.table_name, (SELECT count(*) FROM away) > 0 AS found_before, 0 AS rows_left, (SELECT count(*) FROM dim) AS dim_rows
FROM (VALUES ('dim'), ('fact'), ('log'), ('refused'), ('rejected'), ('hw')) t(table_name)""")
def q_erased_files(spark, sf_dir):
    """E4 on disk: rows of deleted users in any file of the store, before and after the purge."""
    store = run_topic_stream(spark, sf_dir)
    away = materialize(store.read("hw").filter("hw_event_id = last_delete_id").select("user_id", "last_delete_id"))
    before = materialize(_held_rows(store, away)).agg(F.max(F.col("n") > 0).alias("found_before"))
    store.purge()
    sizes = before.join(store.read("dim").agg(F.count(F.lit(1)).alias("dim_rows")), F.lit(True))  # one row each
    return materialize(_held_rows(store, away)).select("table_name", F.col("n").alias("rows_left")).join(F.broadcast(sizes), F.lit(True))


@register("stream_dedup", """
SELECT event_id, CAST(ts AS TIMESTAMP) AS ts, user_id, event_type, value
FROM (SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY ts) AS rn FROM events) WHERE rn = 1""")
def q_stream_dedup(spark, sf_dir):
    """Streaming dedup of replayed deliveries by event id within a watermark."""
    root = shared_dir(spark, "dedup", _uuid.uuid4().hex[:10])
    raw = envelope.read_event_files(spark, sf_dir, spark.read.parquet(f"{sf_dir}/events.parquet").schema,
                                    "events.parquet")
    out = profile_stream.dedup_events(raw.select("event_id", F.col("ts").cast("timestamp_ntz").alias("ts"),
                                                 "user_id", "event_type", "value"))
    q = (out.writeStream.format("parquet").option("path", f"{root}/out")
         .option("checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.parquet(f"{root}/out")


@register("json_roundtrip", O.with_(O.EVENTS) + """
 SELECT event_id, ts, event_type, user_id, user_name, gender, birth_date, height_cm, current_weight_lb,
        target_weight_lb, FALSE AS malformed FROM ev""")
def q_json_roundtrip(spark, sf_dir):
    """Events encoded to the JSON envelope (keyed by user) and decoded back."""
    enc = envelope.encode(profile_events(spark, sf_dir))
    dec = envelope.decode(enc)
    return dec.select(*[f.name for f in PROFILE_EVENT.fields], "malformed")


def archived_tables(spark, sf_dir) -> dict[tuple[str, str], DataFrame]:
    lay = medallion.layers(spark, sf_dir)
    top = materialize(rec.top_k_by_goal(lay.silver))  # bounded (3 x 10 rows), ranked once for all passes over the table
    recs = rec.fact_rows(rec.recommend(rec.spread(lay.users), None, top=top))
    return {("bronze", "food_nutrition"): lay.bronze, ("silver", "food_nutrition_clean"): lay.silver,
            ("gold", "user_profiles_enriched"): lay.users, ("gold", "user_food_recommendations"): recs}


ARCHIVED = """
archived AS (SELECT * FROM (VALUES ('bronze', 'food_nutrition', (SELECT COUNT(*) FROM bronze), 9),
                                   ('silver', 'food_nutrition_clean', (SELECT COUNT(*) FROM silver), 17),
                                   ('gold', 'user_profiles_enriched', (SELECT COUNT(*) FROM enriched), 9),
                                   ('gold', 'user_food_recommendations', (SELECT COUNT(*) FROM top_u), 6))
             t(layer, table_name, row_count, column_count))"""


@register("archive_manifest", O.with_(*O.FOODS_CHAIN, O.USERS, O.TOP_USERS, ARCHIVED) + " SELECT *, 'OK' AS status FROM archived")
def q_archive_manifest(spark, sf_dir):
    """All four layer tables copied to an archive location, manifest built from the copies."""
    root = shared_dir(spark, "archive", _uuid.uuid4().hex[:10])
    return archive.archive_layers(archived_tables(spark, sf_dir), root).select("layer", "table_name", "row_count", "column_count", "status")


@register("archive_rerun", O.with_(*O.FOODS_CHAIN, O.USERS, O.TOP_USERS, ARCHIVED) + """
 SELECT layer, table_name, row_count, column_count, TRUE AS same_checksum, TRUE AS same_rows, CAST(0 AS INTEGER) AS buckets_copied FROM archived""")
def q_archive_rerun(spark, sf_dir):
    """S12 again on unchanged layers: no bucket is copied, the checksum is the first run's, and the
    archive's rows, read back and digested anew, give it too."""
    root = shared_dir(spark, "archive", _uuid.uuid4().hex[:10])
    tables = archived_tables(spark, sf_dir)
    first = archive.archive_layers(tables, root).select("layer", "table_name", F.col("checksum").alias("first"))
    again = archive.archive_layers(tables, root)
    held = None
    for layer, name in tables:
        one = archive.table_digest(archive.read_archived(spark, f"{root}/{layer}/{name}")).select(
            F.lit(layer).alias("layer"), F.lit(name).alias("table_name"), F.col("digest").alias("held"))
        held = one if held is None else held.unionByName(one)
    return (again.join(first, ["layer", "table_name"]).join(held, ["layer", "table_name"])
            .select("layer", "table_name", "row_count", "column_count", (F.col("checksum") == F.col("first")).alias("same_checksum"),
                    (F.col("checksum") == F.col("held")).alias("same_rows"), "buckets_copied"))
