"""Event routing and payload validation.

Validation is a rule table compiled into one projection: each rule yields
its field message or null, ``concat_ws`` keeps the non-null ones in field
order. Accepted and rejected rows are split by a filter — no row leaves the
executors, and poison records go to a reject (dead-letter) frame instead of
stopping the stream.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierflow.constants import (BIRTH_YEAR_MIN, DEFAULT_EVENT_TYPE, EVENT_TYPES, FIELD_MESSAGES,
                                HEIGHT_MAX, NAME_MAX_LEN, VALID_GENDERS, WEIGHT_MAX)

PAYLOAD_FIELDS = ["user_name", "gender", "birth_date", "height_cm", "current_weight_lb",
                  "target_weight_lb"]


def _as_of(as_of) -> Column:
    if isinstance(as_of, Column):
        return as_of
    if isinstance(as_of, (_dt.date, _dt.datetime)):
        as_of = as_of.isoformat()[:10]
    return F.lit(as_of).cast("date")


def normalised_type(c: Column | str = "event_type") -> Column:
    """A missing type means create."""
    col = F.col(c) if isinstance(c, str) else c
    return F.coalesce(col, F.lit(DEFAULT_EVENT_TYPE))


def route_events(events: DataFrame) -> DataFrame:
    """Route each event to create / update / delete or to rejects.

    Adds ``event_type`` (defaulted), ``route`` and ``reject_reason``. Decoded
    records that are ``malformed`` are rejects too.
    """
    t = normalised_type()
    missing_user = F.col("user_id").isNull()
    known = t.isin(EVENT_TYPES)
    broken = F.col("malformed") if "malformed" in events.columns else F.lit(False)
    route = F.when(broken | missing_user | ~known, F.lit("rejected")).otherwise(t)
    why = (F.when(broken, F.lit("malformed record")).when(missing_user, F.lit("missing user_id"))
           .when(~known, F.concat(F.lit("unknown event_type: "), t)))
    return events.withColumns({"event_type": t, "route": route, "reject_reason": why})


#: Dates are written YYYY-MM-DD; a cast alone would also take a year or a timestamp.
ISO_DATE = "^[0-9]{4}-[0-9]{2}-[0-9]{2}$"


def field_errors(required: Column | bool, as_of) -> list[Column]:
    """One message-or-null per payload field, in field order.

    ``required`` may be a boolean column (create rows) or a literal.
    """
    req = F.lit(required) if isinstance(required, bool) else required
    d = _as_of(as_of)

    def rule(field: str, bad_value: Column) -> Column:
        c = F.col(field)
        bad = F.when(c.isNull(), req).otherwise(F.coalesce(bad_value, F.lit(True)))
        return F.when(bad, F.lit(FIELD_MESSAGES[field]))

    name = F.col("user_name")
    birth = F.col("birth_date").cast("string").try_cast("date")
    return [
        rule("user_name", (F.length(name) < 1) | (F.length(name) > NAME_MAX_LEN)),
        rule("gender", ~F.col("gender").isin(VALID_GENDERS)),
        rule("birth_date", ~F.col("birth_date").cast("string").rlike(ISO_DATE) | birth.isNull() | (birth >= d) | (F.year(birth) < BIRTH_YEAR_MIN)),
        rule("height_cm", (F.col("height_cm") <= 0) | (F.col("height_cm") > HEIGHT_MAX)),
        rule("current_weight_lb", (F.col("current_weight_lb") <= 0) | (F.col("current_weight_lb") > WEIGHT_MAX)),
        rule("target_weight_lb", (F.col("target_weight_lb") <= 0) | (F.col("target_weight_lb") > WEIGHT_MAX)),
    ]


def validate_events(events: DataFrame, as_of) -> DataFrame:
    """E10-E12 on routed events: creates need every field, updates only valid
    supplied fields, deletes carry no payload. Adds ``errors`` ('' when valid)
    and ``is_valid``."""
    routed = events if "route" in events.columns else route_events(events)
    is_payload = F.col("route").isin("create", "update")
    errs = F.concat_ws("; ", *field_errors(F.col("route") == "create", as_of))
    errors = (F.when(F.col("route") == "rejected", F.col("reject_reason"))
              .when(is_payload, errs).otherwise(F.lit("")))
    return routed.withColumn("errors", errors).withColumn("is_valid", F.col("errors") == "")
