"""Reporting views and roll-ups.

Each view is a function of warehouse frames; ``register_views`` exposes them
as temp views for SQL users.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tierflow.functions.features import display_name, goal_label, weight_delta
from tierflow.operators.ordered import materialize, ordered_scan
from tierflow.operators.scd2 import current_rows

REPORT_USER_COLS = ["user_id", "user_name", "gender", "age", "goal_type", "height_cm",
                    "current_weight_lb", "target_weight_lb"]
REPORT_REC_COLS = ["food_name", "recommendation_score", "recommendation_rank", "recommendation_reason"]
REPORT_FOOD_COLS = ["calories_kcal", "protein_g", "fiber_g", "carbohydrates_g", "fat_g", "sugar_g",
                    "calorie_band", "protein_band", "is_high_protein_low_calorie", "is_high_fiber",
                    "is_low_sugar"]


def recommendation_report(fact: DataFrame, dim_user: DataFrame, dim_food: DataFrame,
                          best_serving_only: bool = False) -> DataFrame:
    """V1: fact JOIN current users (J2) LEFT JOIN foods on name.

    As in the modelled view the food join is on the name alone, so a food
    with n servings yields n report rows (option ``best_serving_only`` keeps
    one serving per food — the first by description, then nutrients — so
    there is one report row per recommendation).
    The food side is first reduced to the names that occur in the fact
    (semi join against a distinct projection). The report's rows of a food are
    its recommendations times its servings, and few foods are recommended:
    joined on the name they would be as many tasks, so both sides are cut to
    cells (``_by_cells``).
    """
    users = current_rows(dim_user).select(*REPORT_USER_COLS)
    width = int(fact.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    r = fact.select("user_id", *REPORT_REC_COLS)
    tie = ["serving_description", "calories_kcal", "protein_g", "carbohydrates_g", "fat_g", "fiber_g",
           "sugar_g", "sodium_mg"]
    foods = dim_food.select("food_name", *REPORT_FOOD_COLS,
                            *([c for c in tie if c not in REPORT_FOOD_COLS] if best_serving_only else []))
    foods = foods.join(fact.select("food_name").distinct(), "food_name", "left_semi")
    if best_serving_only:
        w_key = F.struct(*[F.col(c) for c in tie])
        foods = (foods.groupBy("food_name")
                 .agg(F.min_by(F.struct(*REPORT_FOOD_COLS), w_key).alias("__f"))
                 .select("food_name", *[F.col(f"__f.{c}").alias(c) for c in REPORT_FOOD_COLS]))
        joined = r.join(users, "user_id", "inner").join(foods, "food_name", "left")
    else:
        joined = _by_cells(r.join(users, "user_id", "inner"), materialize(foods), "food_name", width)
    return joined.select(*REPORT_USER_COLS, *REPORT_REC_COLS, *REPORT_FOOD_COLS)


#: Rows of the right side in a cell (what a merge join holds of a key without a sorter), and the least pairs worth one.
CELL_ROWS, CELL_PAIRS = 4096, 1 << 18


def _by_cells(left: DataFrame, right: DataFrame, key: str, width: int) -> DataFrame:
    """``left`` LEFT JOIN ``right`` on ``key`` where few keys have many rows on both sides.

    A key's pairs are cut to cells: its right rows are dealt to parts of about ``CELL_ROWS``
    by their place, its left rows by hash to as many parts as leave a cell an eighth of a
    task's share of all pairs. Each left row meets every right part once, so the
    pairs are those of the plain join. ``right`` is read more than once and has to be materialised.
    """
    n = left.groupBy(key).agg(F.count(F.lit(1)).alias("__n"))
    m = right.groupBy(key).agg(F.count(F.lit(1)).alias("__m"))
    sizes = materialize(m.join(n, key).withColumn("__cols", F.ceil(F.col("__m") / CELL_ROWS)))
    pairs = sizes.agg(F.sum(F.col("__n").cast("double") * F.col("__m"))).first()[0] or 0.0  # one number
    share = max(float(CELL_PAIRS), pairs / (8 * width))
    sizes = sizes.withColumn("__rows", F.ceil(F.col("__n") * (F.col("__m") / F.col("__cols")) / share)).select(key, "__rows", "__cols")
    row = F.pmod(F.xxhash64(*left.columns), F.coalesce("__rows", F.lit(1)))
    cut = left.join(sizes, key, "left").withColumns({"__row": row, "__col": F.explode(F.sequence(F.lit(0), F.coalesce("__cols", F.lit(1)) - 1))})
    dealt = right.withColumn("__place", F.monotonically_increasing_id()).join(sizes, key)
    dealt = dealt.withColumns({"__col": F.pmod(F.xxhash64("__place"), F.col("__cols")), "__row": F.explode(F.sequence(F.lit(0), F.col("__rows") - 1))})
    cell = [key, "__row", "__col"]
    return (cut.drop("__rows", "__cols").repartition(4 * width, *cell)
            .join(dealt.drop("__rows", "__cols", "__place"), cell, "left").drop("__row", "__col"))


def goal_summary(dim_user: DataFrame) -> DataFrame:
    """V2 (+ C15, J9)."""
    return current_rows(dim_user).select(
        "user_id", "user_name", "gender", "age", "goal_type", "height_cm", "current_weight_lb",
        "target_weight_lb", weight_delta().alias("weight_delta_lb"))


def food_profile(dim_food: DataFrame) -> DataFrame:
    """V3."""
    return dim_food.select("food_name", "calories_kcal", "protein_g", "carbohydrates_g", "fat_g", "fiber_g",
                           "sugar_g", "sodium_mg", "calorie_band", "protein_band", "carb_band", "fat_band",
                           "is_high_protein_low_calorie", "is_high_fiber", "is_low_sugar")


def progress_history(dim_user: DataFrame, with_counts: bool = False) -> DataFrame:
    """V4 (W4 + W5 + C15): one row per version with the progress status.

    ``LAG`` over (user ORDER BY version) runs as a blocked ordered scan, so a
    user with a huge history is spread over many tasks. Branch order:
    no previous weight -> initial; loss and lower -> improving; gain and
    higher -> improving; maintenance and closer to target -> improving;
    equal -> unchanged; otherwise not_improving (null current included).
    """
    ks = {"total_versions": F.lit(1)} if with_counts else None
    s = ordered_scan(dim_user, ["user_id"], ["version_number"],
                     lag={"__prev_cur": "current_weight_lb", "__prev_tgt": "target_weight_lb"}, key_sum=ks)
    cur, tgt = F.col("current_weight_lb"), F.col("target_weight_lb")
    pc, pt = F.col("__prev_cur"), F.col("__prev_tgt")
    g = F.col("goal_type")
    status = (F.when(pc.isNull(), "initial")
              .when((g == "weight_loss") & (cur < pc), "improving")
              .when((g == "weight_gain") & (cur > pc), "improving")
              .when((g == "maintenance") & (F.abs(cur - tgt) < F.abs(pc - pt)), "improving")
              .when(cur == pc, "unchanged")
              .otherwise("not_improving"))
    out = s.select(
        "user_profile_key", "user_id", "user_name", "gender", "age", "goal_type", "height_cm",
        "current_weight_lb", "target_weight_lb", weight_delta().alias("weight_delta_lb"),
        F.col("effective_start").alias("changed_at"), "effective_end", "is_current", "version_number",
        status.alias("progress_status"), *(["total_versions"] if with_counts else []))
    return out


def user_history(dim_user: DataFrame) -> DataFrame:
    """V7 (+ A6): V4 with the version count of the user; the start is also
    exposed as ``effective_start`` (the name the client reads)."""
    h = progress_history(dim_user, with_counts=True)
    return h.select("user_id", "user_name", "gender", "age", "height_cm", "current_weight_lb",
                    "target_weight_lb", "goal_type", "weight_delta_lb", "changed_at",
                    F.col("changed_at").alias("effective_start"), "effective_end", "is_current",
                    "version_number", "progress_status", F.col("total_versions").cast("long").alias("total_versions"))


def list_users(dim_user: DataFrame) -> DataFrame:
    """V5: current users by id."""
    return current_rows(dim_user).select("user_id", "user_name", "goal_type").orderBy("user_id")


def current_profile(dim_user: DataFrame) -> DataFrame:
    """V6."""
    return current_rows(dim_user).select("user_id", "user_name", "gender", "birth_date", "age", "height_cm",
                                         "current_weight_lb", "target_weight_lb", "goal_type",
                                         "effective_start", "version_number")


def recs_for_users(fact: DataFrame, users: DataFrame) -> DataFrame:
    """Recommendations of a set of users, ordered by user and rank."""
    return (fact.join(users.select("user_id").distinct(), "user_id", "left_semi")
            .select("user_id", "food_name", "goal_type", "recommendation_score", "recommendation_rank",
                    "recommendation_reason")
            .orderBy("user_id", "recommendation_rank"))


def weight_journey(history: DataFrame) -> DataFrame:
    """V9: chart series per user — date, actual, target, gap, status and labels."""
    return history.select(
        "user_id", "version_number", F.to_date("changed_at").alias("date"),
        F.col("current_weight_lb").alias("actual_lb"), F.col("target_weight_lb").alias("target_lb"),
        F.col("weight_delta_lb").alias("gap_lb"), "progress_status",
        display_name("progress_status").alias("status_label"), goal_label("goal_type").alias("goal_label"))


def search_users(dim_user: DataFrame, terms: list[str]) -> DataFrame:
    """J10 in bulk: (term, user) pairs where the term occurs, case-insensitively,
    in the id or the name of a current user. ``terms`` is a query parameter
    list; each user is expanded to the terms that hit only."""
    name, ident = F.lower(F.coalesce("user_name", F.lit(""))), F.lower(F.coalesce("user_id", F.lit("")))
    hits = F.filter(F.array(*[F.lit(x.lower()) for x in terms]), lambda t: ident.contains(t) | name.contains(t))
    return current_rows(dim_user).select(F.explode(hits).alias("term"), "user_id", "user_name")


GRAM = 3


def _grams(text: Column, size: int) -> Column:
    """Every substring of ``size`` characters, repeats included."""
    places = F.sequence(F.lit(1), F.length(text) - size + 1)
    return F.when(F.length(text) >= size, F.transform(places, lambda i: F.substr(text, i, F.lit(size)))).otherwise(F.array().cast("array<string>"))


def search_users_by_terms(dim_user: DataFrame, terms: DataFrame) -> DataFrame:
    """J10 in bulk with the terms in a table (column ``term``): (term, user) pairs
    where the term occurs, case-insensitively, in the id or the name of a current user.

    Every user is posted under the distinct trigrams of id and name (and, for terms
    shorter than that, under the shorter substrings and the empty one); only
    postings that some term holds are kept. A term looks up the one of its
    trigrams with the fewest users, and each hit is verified on the text. No plan
    literal and no task depends on the number of terms. Null terms find nothing,
    the empty term finds everybody, repeated terms count once; a null id or name
    holds no text.
    """
    name, ident = F.lower(F.coalesce("user_name", F.lit(""))), F.lower(F.coalesce("user_id", F.lit("")))
    wanted = terms.select(F.lower("term").alias("term")).filter("term is not null").distinct()
    own = F.when(F.length("term") >= GRAM, F.array_distinct(_grams(F.col("term"), GRAM))).otherwise(F.array("term"))
    by_gram = wanted.select("term", F.explode(own).alias("gram"))
    posted = F.array_distinct(F.concat(F.array(F.lit("")), *[_grams(c, n) for c in (ident, name) for n in range(1, GRAM + 1)]))
    # dealt before they are posted: a task would read again all postings of the users that one task of a few had
    users = current_rows(dim_user).select("user_id", "user_name").repartition(int(dim_user.sparkSession.conf.get("spark.sql.shuffle.partitions")), "user_id", "user_name")
    postings = (users.select("user_id", "user_name", F.explode(posted).alias("gram"))
                .join(by_gram.select("gram").distinct(), "gram", "left_semi"))
    held = postings.groupBy("gram").agg(F.count(F.lit(1)).alias("users"))
    rarest = (by_gram.join(held, "gram", "left")
              .groupBy("term").agg(F.min_by("gram", F.struct(F.coalesce("users", F.lit(0)), "gram")).alias("gram")))
    return (rarest.join(postings, "gram").filter(F.contains(ident, F.col("term")) | F.contains(name, F.col("term")))
            .select("term", "user_id", "user_name"))


# ---------------------------------------------------------------- A8 roll-ups

FLAGS = ["is_high_protein_low_calorie", "is_high_fiber", "is_low_sugar"]


def report_counts(fact: DataFrame, dim_user: DataFrame, dim_food: DataFrame) -> DataFrame:
    """The report (V1) before its fan-out: one row per recommendation of a
    current user, with ``report_rows`` (how many servings it is joined to, 1 if
    none) and the sums of the flags over them. Foods are counted per name
    first, so roll-ups never build the report's rows."""
    users = current_rows(dim_user).select("user_id", "goal_type")
    foods = dim_food.groupBy("food_name").agg(F.count(F.lit(1)).alias("__n"), *[F.sum(c).alias(c) for c in FLAGS])
    joined = fact.drop("goal_type").join(users, "user_id").join(foods, "food_name", "left")
    return joined.withColumn("report_rows", F.coalesce("__n", F.lit(1))).drop("__n")


def rank_distribution(counts: DataFrame) -> DataFrame:
    """Rows and score total of the report per rank (mean = sum_score / n_rows), from ``report_counts``."""
    return counts.groupBy("recommendation_rank").agg(
        F.sum("report_rows").alias("n_rows"),
        F.sum(F.col("recommendation_score") * F.col("report_rows")).cast("decimal(20,2)").alias("sum_score"))


def top_foods_by_goal(fact: DataFrame) -> DataFrame:
    """How often each food is recommended per goal, best rank, score total."""
    return fact.groupBy("goal_type", "food_name").agg(
        F.count(F.lit(1)).alias("n_users"),
        F.min("recommendation_rank").alias("best_rank"),
        F.sum("recommendation_score").cast("decimal(20,2)").alias("sum_score"),
    ).withColumn("food_label", display_name("food_name"))


def score_distribution(fact: DataFrame, width: float = 10.0) -> DataFrame:
    """Histogram of scores in fixed-width buckets per goal."""
    b = (F.floor(F.col("recommendation_score") / F.lit(width)) * F.lit(width)).alias("bucket_lo")
    return fact.groupBy("goal_type", b).agg(F.count(F.lit(1)).alias("n_rows"))


def flag_kpis(counts: DataFrame) -> DataFrame:
    """Rows of the report with each nutrition flag, per goal (exact counts;
    shares are count / n_rows), from ``report_counts``."""
    return counts.groupBy("goal_type").agg(
        F.sum("report_rows").alias("n_rows"),
        F.sum("is_high_protein_low_calorie").cast("long").alias("n_high_protein_low_calorie"),
        F.sum("is_high_fiber").cast("long").alias("n_high_fiber"),
        F.sum("is_low_sugar").cast("long").alias("n_low_sugar"))


def register_views(spark: SparkSession, fact: DataFrame, dim_user: DataFrame, dim_food: DataFrame) -> None:
    """Expose the four warehouse views by their usual names."""
    recommendation_report(fact, dim_user, dim_food).createOrReplaceTempView("vw_recommendation_report")
    goal_summary(dim_user).createOrReplaceTempView("vw_user_goal_summary")
    food_profile(dim_food).createOrReplaceTempView("vw_food_nutrition_profile")
    progress_history(dim_user).createOrReplaceTempView("vw_user_progress_history")
