"""Derived features as column expressions."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierflow.constants import (BANDS, GAIN_WEIGHTS, GOAL_LABELS, HIGH_FIBER_MIN,
                                HIGH_PROTEIN_MIN, LOSS_WEIGHTS, LOW_CALORIE_MAX,
                                LOW_SUGAR_MAX, MAINTENANCE_KCAL_CENTER,
                                MAINTENANCE_KCAL_PENALTY, MAINTENANCE_WEIGHTS, REASONS,
                                SCORE_DECIMALS)
from tierflow.functions.cleanse import bronze_text_and_serving


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def band(c: Column | str, lo: float, hi: float) -> Column:
    """``< lo`` low, ``< hi`` medium, else high (null falls to high)."""
    x = _c(c)
    return F.when(x < lo, "low").when((x >= lo) & (x < hi), "medium").otherwise("high")


def flag(cond: Column) -> Column:
    """C11: 1 when the condition holds, else 0 (null -> 0)."""
    return F.when(cond, F.lit(1)).otherwise(F.lit(0))


def band_and_flag_columns(present: set[str]) -> dict[str, Column]:
    """C10-C11 for the columns that exist."""
    out: dict[str, Column] = {}
    for name, (src, lo, hi) in BANDS.items():
        if src in present:
            out[name] = band(src, lo, hi)
    if {"protein_g", "calories_kcal"} <= present:
        out["is_high_protein_low_calorie"] = flag(
            (F.col("protein_g") >= HIGH_PROTEIN_MIN) & (F.col("calories_kcal") <= LOW_CALORIE_MAX))
    if "fiber_g" in present:
        out["is_high_fiber"] = flag(F.col("fiber_g") >= HIGH_FIBER_MIN)
    if "sugar_g" in present:
        out["is_low_sugar"] = flag(F.col("sugar_g") <= LOW_SUGAR_MAX)
    return out


def bronze_to_silver(bronze: DataFrame) -> DataFrame:
    """C4-C11: distinct, text + serving size, business names, bands and flags.

    One projection for all derived columns (no withColumn chain).
    """
    df = bronze_text_and_serving(bronze.dropDuplicates())
    return df.withColumns(band_and_flag_columns(set(df.columns)))


def goal_type(current: Column | str = "current_weight_lb",
              target: Column | str = "target_weight_lb") -> Column:
    """Target below current -> loss; above -> gain; else (incl. null) maintenance."""
    cur, tgt = _c(current), _c(target)
    return (F.when(tgt < cur, "weight_loss").when(tgt > cur, "weight_gain")
            .otherwise("maintenance"))


def _date(as_of) -> Column:
    if isinstance(as_of, Column):
        return as_of
    if isinstance(as_of, (_dt.date, _dt.datetime)):
        as_of = as_of.isoformat()[:10]
    return F.lit(as_of).cast("date")


def age_batch(birth: Column | str, as_of) -> Column:
    """``floor(datediff(as_of, birth) / 365.25)`` as int."""
    return F.floor(F.datediff(_date(as_of), _c(birth)) / F.lit(365.25)).cast("int")


def age_calendar(birth: Column | str, as_of) -> Column:
    """C14: year difference minus one before the birthday (month, day) is reached."""
    b, d = _c(birth), _date(as_of)
    before = (F.month(d) < F.month(b)) | ((F.month(d) == F.month(b)) & (F.dayofmonth(d) < F.dayofmonth(b)))
    return (F.year(d) - F.year(b) - before.cast("int")).cast("int")


def weight_delta(current: Column | str = "current_weight_lb",
                 target: Column | str = "target_weight_lb") -> Column:
    """``round(current - target, 1)`` on warehouse decimals."""
    cur = _c(current).cast("decimal(10,2)")
    tgt = _c(target).cast("decimal(10,2)")
    return F.round(cur - tgt, 1).cast("decimal(10,1)")


def reason(goal: Column | str = "goal_type") -> Column:
    """Literal reason text per goal."""
    g = _c(goal)
    return (F.when(g == "weight_loss", REASONS["weight_loss"])
            .when(g == "weight_gain", REASONS["weight_gain"])
            .otherwise(REASONS["maintenance"]))


def display_name(c: Column | str) -> Column:
    """C20: underscores shown as spaces."""
    return F.regexp_replace(_c(c), "_", " ")


def goal_label(goal: Column | str = "goal_type") -> Column:
    """C20: human label of a goal (map lookup, unknown -> the raw value)."""
    m = F.create_map(*[x for k, v in GOAL_LABELS.items() for x in (F.lit(k), F.lit(v))])
    return F.coalesce(m[_c(goal)], _c(goal))


def _weighted(weights: dict[str, float]) -> Column:
    expr = None
    for col, w in weights.items():
        term = F.col(col) * F.lit(abs(w))
        if expr is None:
            expr = term if w >= 0 else -term
        else:
            expr = expr + term if w >= 0 else expr - term
    return expr


def loss_score() -> Column:
    """R1."""
    return _weighted(LOSS_WEIGHTS)


def gain_score() -> Column:
    """R2."""
    return _weighted(GAIN_WEIGHTS)


def maintenance_score() -> Column:
    """R3."""
    return (_weighted(MAINTENANCE_WEIGHTS)
            - F.abs(F.col("calories_kcal") - F.lit(MAINTENANCE_KCAL_CENTER)) * F.lit(MAINTENANCE_KCAL_PENALTY))


def score_for(goal: Column | str = "goal_type") -> Column:
    """Goal-dependent score rounded (HALF_UP) to two decimals."""
    g = _c(goal)
    raw = (F.when(g == "weight_loss", loss_score())
           .when(g == "weight_gain", gain_score())
           .otherwise(maintenance_score()))
    return F.round(raw, SCORE_DECIMALS)


def user_features(users: DataFrame, as_of) -> DataFrame:
    """Batch enrichment of user profiles: typed weights, age (C13), goal."""
    present = set(users.columns)
    exprs = {c: F.col(c).try_cast("double") for c in ("height_cm", "current_weight_lb", "target_weight_lb")
             if c in present}
    df = users.withColumns(exprs)
    extra = {}
    if "birth_date" in present:
        bd = F.col("birth_date").try_cast("date")
        extra["birth_date"] = bd
        extra["age"] = age_batch(bd, as_of)
    extra["goal_type"] = goal_type()
    return df.withColumns(extra)
