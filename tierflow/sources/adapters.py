"""Domain frames derived from the driver's parquet tables.

The shipped inputs of the modelled system (a food CSV, a user CSV and a
profile-event topic) are not part of the test data, so every query derives
them from the given tables with deterministic column expressions. Each
adapter is a narrow projection over one scan (column pruning reaches the
parquet reader), so its cost grows linearly with the table.

* foods  <- ``part``      (name, serving, nutrients from the part key)
* users  <- ``customer``  (weights, birth date, gender from the customer key)
* events <- ``events``    (create / update / delete profile events)
* history <- ``orders``   (older weight readings for history backfill)
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierflow.constants import VALID_GENDERS
from tierflow.functions.cleanse import format_user_id

AS_OF = "2025-06-30"
RUN_TS = "2025-07-01 00:00:00"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _s(c):
    return c.cast("string")


def raw_foods(part: DataFrame) -> DataFrame:
    """All-string raw food rows (the CSV shape, header already parsed)."""
    k = F.col("p_partkey")
    kcal = F.col("p_size") * 20
    return part.select(
        F.col("p_name").alias("label"),
        F.concat(_s(F.col("p_size") * 10), F.lit(" g")).alias("weight"),
        _s(kcal).alias("calories"),
        _s(k % 40).alias("protein"),
        _s(k % 60).alias("carbohydrates"),
        _s(k % 30).alias("fats"),
        _s(k % 12).alias("fiber"),
        _s(k % 25).alias("sugars"),
        _s(F.col("p_retailprice")).alias("sodium"),
    )


def dirty_raw_foods(part: DataFrame) -> DataFrame:
    """Raw rows with messy headers, padded upper-case text, thousands commas,
    ``n/a`` every 97th key and exact duplicate rows (every 5th key twice)."""
    k = F.col("p_partkey")
    kcal = F.col("p_size") * 20
    kcal_txt = F.when(kcal >= 1000, F.concat(_s(F.floor(kcal / 1000)), F.lit(","),
                                             F.lpad(_s(kcal % 1000), 3, "0"))).otherwise(_s(kcal))
    na = (k % 97) == 0
    rows = part.select(
        F.concat(F.lit("  "), F.upper("p_name"), F.lit(" ")).alias(" Label"),
        F.concat(F.lit(" "), _s(F.col("p_size") * 10), F.lit(" G ")).alias("WEIGHT"),
        F.concat(F.lit(" "), kcal_txt).alias("Calories "),
        F.when(na, F.lit("n/a")).otherwise(_s(k % 40)).alias("Protein"),
        _s(k % 60).alias("Carbohydrates"),
        _s(k % 30).alias("Fats"),
        F.when(na, F.lit("")).otherwise(_s(k % 12)).alias("Fiber"),
        _s(k % 25).alias("Sugars"),
        _s(F.col("p_retailprice")).alias("Sodium"),
        k.alias("__k"),
    )
    return rows.unionAll(rows.filter((F.col("__k") % 5) == 0)).drop("__k")


def users(customer: DataFrame) -> DataFrame:
    """User profiles (the user CSV shape, typed)."""
    ck = F.col("c_custkey")
    genders = F.array(*[F.lit(g) for g in VALID_GENDERS])
    return customer.select(
        format_user_id(ck).alias("user_id"),
        F.col("c_name").alias("user_name"),
        F.element_at(genders, (ck % 4 + 1).cast("int")).alias("gender"),
        F.date_add(F.lit("1950-01-01").cast("date"), (ck % 18000).cast("int")).alias("birth_date"),
        (F.lit(150.0) + ck % 50).alias("height_cm"),
        (F.lit(120.0) + ck % 120).alias("current_weight_lb"),
        (F.lit(120.0) + (ck * 7) % 120).alias("target_weight_lb"),
    )


EVENT_TYPE_MAP = {"signup": "create", "click": "update", "purchase": "update", "error": "delete"}


def profile_events(events: DataFrame) -> DataFrame:
    """Profile events (the topic's JSON envelope as columns).

    signup -> create, click / purchase -> update, error -> delete, anything
    else keeps its name (unknown type, rejected by routing). Updates carry a
    partial patch (some fields null); some creates are invalid (missing
    weight, empty name, unknown gender, birth date before 1900, zero height).
    """
    e = F.col("event_id")
    u = F.col("user_id")
    et = F.col("event_type")
    mapped = F.coalesce(*[F.when(et == k, F.lit(v)) for k, v in EVENT_TYPE_MAP.items()], et)
    is_upd = mapped == "update"
    is_del = mapped == "delete"
    genders = F.array(*[F.lit(g) for g in VALID_GENDERS])

    def payload(expr, upd_null):
        return F.when(is_del, F.lit(None)).when(is_upd & upd_null, F.lit(None)).otherwise(expr)

    name = F.when((e % 41) == 0, F.lit("")).otherwise(F.concat(F.lit("user_"), _s(u)))
    gender = F.when((e % 17) == 0, F.lit("unknown")).otherwise(F.element_at(genders, (u % 4 + 1).cast("int")))
    birth = F.when((e % 29) == 0, F.lit("1899-12-31")).otherwise(
        _s(F.date_add(F.lit("1940-01-01").cast("date"), ((u * 97) % 25000).cast("int"))))
    height = F.when((e % 61) == 0, F.lit(0.0)).otherwise(F.lit(150.0) + u % 50)
    current = F.when((e % 53) == 0, F.lit(None).cast("double")).otherwise(F.col("value") + F.lit(60.0))
    target = F.lit(100.0) + F.get_json_object("props", "$.k").cast("double") * 2
    return events.select(
        e.alias("event_id"),
        F.col("ts").cast("timestamp_ntz").alias("ts"),
        mapped.alias("event_type"),
        format_user_id(u).alias("user_id"),
        payload(name, (e % 2) == 0).alias("user_name"),
        payload(gender, (e % 3) == 0).alias("gender"),
        payload(birth, (e % 4) == 0).alias("birth_date"),
        payload(height, (e % 3) == 1).alias("height_cm"),
        payload(current, (e % 7) == 0).alias("current_weight_lb"),
        payload(target, (e % 5) == 0).alias("target_weight_lb"),
    )


def weight_readings(orders: DataFrame) -> DataFrame:
    """Older weight readings per user (one per order), for history backfill."""
    return orders.select(
        format_user_id(F.col("o_custkey")).alias("user_id"),
        F.col("o_orderkey").alias("reading_id"),
        F.col("o_orderdate").cast("timestamp_ntz").alias("effective_start"),
        (F.lit(100.0) + F.col("o_orderkey") % 200).alias("current_weight_lb"),
    )
