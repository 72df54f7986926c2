"""Type-2 slowly changing user dimension from the profile event log (E2-E9,
E13, E16, E17, J7-J9).

The sequential consumer rules (create inserts version 1; update expires the
current version and inserts max+1; delete erases every version; a second
create is refused; an update of an unknown user upserts, or is refused in
strict mode) are evaluated for the whole log at once, with no per-event
state:

1. the last delete of each user (an aggregate): everything up to it was
   erased (E4), so only the last segment is kept;
2. the first profile-opening event of that segment (an aggregate) decides
   acceptance: the opener, then updates; later creates are refused;
3. one ordered scan over accepted events: last supplied value of every
   payload field (patch merge, E9), version = position (+ base version), end
   of validity = start of the next version (E5), current = no next version.

The scan is keyed by user and blocked by event id (``operators.ordered``), so
a user holding a third of the log is spread over many tasks; the aggregates
combine map-side. An existing dimension (``base``) is folded in by prepending
its current row as the first event of the user.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierflow.functions.features import age_calendar, goal_type
from tierflow.operators.ordered import DEFAULT_BLOCK_SIZE, materialize, ordered_scan, time_block
from tierflow.operators.validate import PAYLOAD_FIELDS, validate_events

DIM_COLUMNS = ["user_profile_key", "user_id", "user_name", "gender", "birth_date", "age",
               "height_cm", "current_weight_lb", "target_weight_lb", "goal_type",
               "effective_start", "effective_end", "is_current", "version_number"]

BASE_EVENT_ID = -1


def _base_as_events(base: DataFrame) -> DataFrame:
    """Current base rows as pseudo-events that sort before every real event."""
    cur = base.filter(F.col("is_current"))
    return cur.select(
        F.lit(BASE_EVENT_ID).cast("long").alias("event_id"),
        F.col("effective_start").alias("ts"),
        F.lit("base").alias("event_type"),
        "user_id",
        *[F.col(c).cast("string").alias(c) if c == "birth_date" else F.col(c) for c in PAYLOAD_FIELDS],
        F.col("user_profile_key").alias("base_key"),
        F.col("version_number").alias("base_version"),
        F.col("age").alias("base_age"),
    )


def _valid_events(events: DataFrame, as_of, validated: bool) -> DataFrame:
    v = events if validated else validate_events(events, as_of)
    v = v.filter(F.col("route").isin("create", "update", "delete") & F.col("is_valid"))
    return v.select("event_id", "ts", "event_type", "user_id", *PAYLOAD_FIELDS,
                    F.lit(None).cast("long").alias("base_key"), F.lit(None).cast("int").alias("base_version"), F.lit(None).cast("int").alias("base_age"))


def accepted_versions(events: DataFrame, as_of, *, strict: bool = False, base: DataFrame | None = None,
                      validated: bool = False, checkpoint: bool = False,
                      block_size: int = DEFAULT_BLOCK_SIZE) -> DataFrame:
    """Steps 1-3 of the fold: the accepted events of each user's last segment
    with merged payload (E9), version position, base offset and end of validity.

    Acceptance: the first *opening* event of the last segment opens the
    profile — a create, or (non-strict) an update that carries both weights
    (upsert); later creates are refused; updates after it are accepted. A
    patch is merged against the state it updates: every payload field is the
    last value supplied by an accepted event (the modelled API merges with the
    current row).

    The last delete and the first opener of each user are plain aggregates
    (partially aggregated map-side, so a hot user costs one row per map task)
    joined back on the user — AQE broadcasts them when their measured size
    allows and splits a hot user's partition otherwise. Only the accepted
    events go through the ordered scan. The plan reads the events a few times
    (aggregates, rows and block summary; identical exchanges are reused),
    which for a columnar log is cheaper than writing a copy; pass
    ``checkpoint=True`` when deriving the events is expensive (their
    validated form is then materialised once).
    """
    v = _valid_events(events, as_of, validated)
    if base is not None:
        touched = v.select("user_id").distinct()
        v = v.unionByName(_base_as_events(base.join(touched, "user_id", "left_semi")))
    if checkpoint:
        v = materialize(v)
    is_del = F.col("event_type") == "delete"
    last_del = v.filter(is_del).groupBy("user_id").agg(F.max("event_id").alias("__last_del"))
    last = (v.join(last_del, "user_id", "left")
            .filter(~is_del & (F.col("__last_del").isNull() | (F.col("event_id") > F.col("__last_del"))))
            .drop("__last_del"))
    opens = F.col("event_type").isin("create", "base")
    if not strict:
        opens = opens | ((F.col("event_type") == "update") & F.col("current_weight_lb").isNotNull()
                         & F.col("target_weight_lb").isNotNull())
    first_open = last.filter(opens).groupBy("user_id").agg(F.min("event_id").alias("__first"))
    acc = (last.join(first_open, "user_id", "inner")
           .filter((F.col("event_id") == F.col("__first"))
                   | ((F.col("event_type") == "update") & (F.col("event_id") > F.col("__first"))))
           .drop("__first"))
    base_off = F.coalesce(F.col("base_version").cast("long") - 1, F.lit(0))
    c = ordered_scan(acc, ["user_id"], ["event_id"], block_size=block_size, row_number="__v",
                     lead={"effective_end": "ts"}, key_sum={"__base_off": base_off},
                     carry={f"__m_{f}": F.col(f) for f in PAYLOAD_FIELDS})
    return c.withColumns({f: F.col(f"__m_{f}") for f in PAYLOAD_FIELDS}).drop(
        *[f"__m_{f}" for f in PAYLOAD_FIELDS])


def event_outcomes(events: DataFrame, as_of, *, strict: bool = False, base: DataFrame | None = None,
                   validated: bool = False, deleted: DataFrame | None = None) -> DataFrame:
    """What becomes of every valid event: event_id, ts, event_type, user_id, outcome.

    ``accepted``; ``erased`` (before the user's last delete, E4); ``user exists``
    (a create of an open profile); ``user not found`` (an update before any profile was
    opened); ``user deleted`` (an update after a delete, before a new profile). The
    last delete and the first opening event of each user are aggregates, as in
    the fold, so both agree. Users with a row in ``base`` are open from the start; those in
    ``deleted`` (user_id) were deleted before the first event. Events without a position can't be ordered: ``no position``.
    """
    v = _valid_events(events, as_of, validated).select("event_id", "ts", "event_type", "user_id", "current_weight_lb", "target_weight_lb")
    is_del, eid = F.col("event_type") == "delete", F.col("event_id")
    opens = F.col("event_type") == "create"
    if not strict:
        opens = opens | ((F.col("event_type") == "update") & F.col("current_weight_lb").isNotNull() & F.col("target_weight_lb").isNotNull())
    last_del = v.filter(is_del).groupBy("user_id").agg(F.max("event_id").alias("__last_del"))
    seen = v.join(last_del, "user_id", "left")
    openers = seen.filter(opens & (F.col("__last_del").isNull() | (eid > F.col("__last_del")))).select("user_id", "event_id")
    if base is not None:
        known = base.filter("is_current").select("user_id", F.lit(BASE_EVENT_ID).cast("long").alias("event_id"))
        openers = openers.unionByName(known.join(last_del, "user_id", "left_anti"))
    first = openers.groupBy("user_id").agg(F.min("event_id").alias("__first"))
    after = F.coalesce(eid > F.col("__first"), F.lit(False))
    before = F.col("__last_del").isNotNull()
    if deleted is not None:
        seen = seen.join(deleted.select("user_id", F.lit(True).alias("__gone")), "user_id", "left")
        before = before | F.col("__gone").isNotNull()
    outcome = (F.when(eid.isNull(), "no position").when(eid < F.col("__last_del"), "erased").when(is_del | (eid == F.col("__first")), "accepted")
               .when(after, F.when(F.col("event_type") == "update", "accepted").otherwise("user exists"))
               .when(before, "user deleted").otherwise("user not found"))
    return seen.join(first, "user_id", "left").select("event_id", "ts", "event_type", "user_id", outcome.alias("outcome"))


def merge_patches(events: DataFrame, as_of, strict: bool = False, checkpoint: bool = False) -> DataFrame:
    """Accepted updates completed with the state they patch."""
    acc = accepted_versions(events, as_of, strict=strict, checkpoint=checkpoint)
    return acc.filter(F.col("event_type") == "update").select(
        "event_id", "user_id", "event_type", "ts", *PAYLOAD_FIELDS)


def fold(events: DataFrame, as_of, *, strict: bool = False, base: DataFrame | None = None,
         validated: bool = False, checkpoint: bool = False, block_size: int = DEFAULT_BLOCK_SIZE) -> DataFrame:
    """The dimension rows produced by replaying ``events`` in event-id order.

    ``events``: event_id, ts, event_type, user_id and the payload fields
    (``schemas.PROFILE_EVENT``). With ``base`` (an existing dimension) the
    result is the complete new dimension: untouched users keep their rows,
    users with a delete in ``events`` lose their old rows, other touched users
    keep their history and get their current row expired.

    ``checkpoint``: see ``accepted_versions``.
    """
    s = accepted_versions(events, as_of, strict=strict, base=base, validated=validated, checkpoint=checkpoint,
                          block_size=block_size)
    birth = F.col("birth_date").cast("string").try_cast("date")
    dim = s.select(
        F.coalesce(F.col("base_key"), F.col("event_id")).alias("user_profile_key"),
        "user_id", "user_name", "gender", birth.alias("birth_date"),
        F.when(F.col("base_key").isNotNull(), F.col("base_age")).otherwise(age_calendar(birth, as_of)).alias("age"),
        "height_cm", "current_weight_lb", "target_weight_lb",
        goal_type().alias("goal_type"),
        F.col("ts").alias("effective_start"),
        F.col("effective_end"),
        F.col("effective_end").isNull().alias("is_current"),
        (F.col("__v") + F.col("__base_off")).cast("int").alias("version_number"),
    )
    if base is None:
        return dim
    v = _valid_events(events, as_of, validated)
    touched = v.select("user_id").distinct()
    base = base.select(*DIM_COLUMNS)
    erased = v.filter(F.col("event_type") == "delete").select("user_id").distinct()
    untouched = base.join(touched, "user_id", "left_anti")
    history = (base.filter(~F.col("is_current"))
               .join(touched, "user_id", "left_semi")
               .join(erased, "user_id", "left_anti"))
    return untouched.unionByName(history).unionByName(dim)


def unknown_user_rejects(events: DataFrame, as_of) -> DataFrame:
    """Updates and deletes of a user that does not exist at that point
    (what the API's existence gate refuses).

    A user exists after a (valid) create until the next delete. An update
    sees the user if the last create-or-delete before it is a create (carried
    forward); a delete sees the user if the create-or-delete right before it
    is a create (``lag`` over those rows). Two independent ordered scans, no
    chaining.
    """
    v = _valid_events(events, as_of, validated=False)
    state = F.when(F.col("event_type").isin("create", "delete"), F.col("event_type"))
    upd = ordered_scan(v, ["user_id"], ["event_id"], carry={"__state": state}).filter(
        (F.col("event_type") == "update") & ~F.coalesce(F.col("__state") == "create", F.lit(False)))
    dels = ordered_scan(v.filter(F.col("event_type").isin("create", "delete")), ["user_id"], ["event_id"],
                        lag={"__prev": "event_type"}).filter(
        (F.col("event_type") == "delete") & ~F.coalesce(F.col("__prev") == "create", F.lit(False)))
    cols = ["event_id", "user_id", "event_type", F.lit("user not found").alias("reject_reason")]
    return upd.select(*cols).unionByName(dels.select(*cols))


def point_in_time(dim: DataFrame, at: Column | str) -> DataFrame:
    """The version of every user valid at ``at`` (start <= at < end, or open)."""
    t = F.lit(at).cast("timestamp_ntz") if isinstance(at, str) else at
    return dim.filter((F.col("effective_start") <= t)
                      & (F.col("effective_end").isNull() | (F.col("effective_end") > t)))


def current_rows(dim: DataFrame) -> DataFrame:
    """J9."""
    return dim.filter(F.col("is_current"))


def as_of_versions(facts: DataFrame, dim: DataFrame, ts_col: str = "ts",
                   block_seconds: int | None = None) -> DataFrame:
    """J7 generalised: attach to every fact row the version valid at its time.

    Versions of a user are contiguous, so the valid version is the last one
    that started at or before the fact's time (and is still open or ends
    after it). Facts and version starts are merged into one ordered stream
    per user and the last version key is carried forward — linear work, no
    pairing of every fact with every version of its user. A hot user is cut
    into blocks at edges from a quantile sketch of that user's times, so it is
    spread over many tasks whatever its time profile, and the facts are scanned
    again instead of copied; ``block_seconds`` switches to fixed
    time buckets instead (bounded per user and bucket).
    """
    # a fact without user or time has no version; it stays, with a null key
    known = F.col("user_id").isNotNull() & F.col(ts_col).isNotNull()
    f = facts.filter(known).select("*", F.col(ts_col).alias("__t"), F.lit(1).alias("__side"),
                     F.lit(None).cast("long").alias("__tie"),
                     F.lit(None).cast("struct<k:bigint,end:timestamp_ntz>").alias("__ver"))
    vcols = dim.filter("user_id is not null").select("user_id", F.col("effective_start").alias("__t"), F.lit(0).alias("__side"),
                       F.col("user_profile_key").alias("__tie"),
                       F.struct(F.col("user_profile_key").alias("k"),
                                F.col("effective_end").alias("end")).alias("__ver"))
    fact_cols = [c for c in facts.columns if c != "user_id"]
    vcols = vcols.withColumns({c: F.lit(None).cast(facts.schema[c].dataType) for c in fact_cols})
    both = f.unionByName(vcols)
    # facts never carry a value, so ties among them need no order; versions tie on their key
    blocks = "sketch" if block_seconds is None else time_block("__t", block_seconds)
    s = ordered_scan(both, ["user_id"], ["__t", "__side", "__tie"], block=blocks, carry={"__cur": "__ver"})
    valid = F.col("__cur").isNotNull() & (F.col("__cur.end").isNull() | (F.col("__cur.end") > F.col("__t")))
    return (s.filter(F.col("__side") == 1)
            .select("user_id", *fact_cols, F.when(valid, F.col("__cur.k")).alias("user_profile_key"))
            .unionByName(facts.filter(~known).select("user_id", *fact_cols, F.lit(None).cast("long").alias("user_profile_key"))))


def backfill_history(current: DataFrame, readings: DataFrame, block_seconds: int | None = None) -> DataFrame:
    """Rebuild the version chain from older readings plus the current row.

    ``current``: one dimension row per user; ``readings``: user_id, reading_id,
    effective_start, current_weight_lb. Every reading becomes an expired version
    carrying the current row's other fields; versions are renumbered by start,
    each ends where the next starts (ordered scan, hot users cut at edges from a sketch).
    """
    attrs = [c for c in current.columns if c not in
             ("current_weight_lb", "effective_start", "effective_end", "is_current", "version_number",
              "user_profile_key", "goal_type")]
    hist = readings.join(current.select(*attrs), "user_id", "inner")
    hist = hist.select(*attrs, "current_weight_lb", "effective_start",
                       F.col("reading_id").alias("__src"), F.lit(0).alias("__cur"))
    cur = current.select(*attrs, "current_weight_lb", "effective_start",
                         F.lit(None).cast("long").alias("__src"), F.lit(1).alias("__cur"))
    both = hist.unionByName(cur)
    blocks = "sketch" if block_seconds is None else time_block("effective_start", block_seconds)
    s = ordered_scan(both, ["user_id"], ["effective_start", "__cur", "__src"], block=blocks,
                     row_number="__v", lead={"effective_end": "effective_start"})
    return s.select(*attrs, "current_weight_lb", goal_type().alias("goal_type"), "effective_start",
                    "effective_end", F.col("effective_end").isNull().alias("is_current"),
                    F.col("__v").cast("int").alias("version_number"))


def invariant_violations(dim: DataFrame) -> DataFrame:
    """E17 per user: current-row count, versions, gaps in the chain, numbering holes.
    Rows without a user are one chain of their own, reported under a null user."""
    named = dim.withColumns({"__known": F.col("user_id").isNotNull(), "user_id": F.coalesce("user_id", F.lit(""))})
    s = ordered_scan(named, ["user_id", "__known"], ["version_number", "effective_start", "user_profile_key"], lead={"__next_start": "effective_start"},
                     row_number="__pos")
    per_row = s.select(
        F.when(F.col("__known"), F.col("user_id")).alias("user_id"),
        F.col("is_current").cast("int").alias("cur"),
        (F.col("__next_start").isNotNull() & ~F.col("effective_end").eqNullSafe(F.col("__next_start")))
        .cast("int").alias("gap"),
        (~F.col("__pos").eqNullSafe(F.col("version_number").cast("long"))).cast("int").alias("hole"),
    )
    return (per_row.groupBy("user_id")
            .agg(F.sum("cur").alias("current_rows"), F.count(F.lit(1)).alias("versions"),
                 F.sum("gap").alias("chain_gaps"), F.sum("hole").alias("numbering_holes"))
            .filter((F.col("current_rows") > 1) | (F.col("chain_gaps") > 0) | (F.col("numbering_holes") > 0)))
