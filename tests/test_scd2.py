"""SCD2 fold against a sequential model of the consumer rules."""
import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tierflow.operators import scd2
from tierflow.plans import reports
from tierflow.schemas import PROFILE_EVENT

AS_OF = "2025-06-30"
FIELDS = ["user_name", "gender", "birth_date", "height_cm", "current_weight_lb", "target_weight_lb"]
T0 = dt.datetime(2024, 1, 1)


def random_log(n_users=60, max_events=12, seed=7):
    rnd = random.Random(seed)
    rows, eid = [], 0
    for u in range(n_users):
        uid = f"U{u:03d}"
        for _ in range(rnd.randrange(1, max_events)):
            eid += rnd.randrange(1, 4)
            t = rnd.choices(["create", "update", "delete", None, "bogus"], [4, 6, 1, 0.5, 0.3])[0]
            full = t in ("create", None)

            def pick(vals, allow_null):
                return None if allow_null and rnd.random() < 0.35 else rnd.choice(vals)

            if t == "delete":
                payload = [None] * 6
            else:
                payload = [pick([f"name{u}", f"alt{u}"], not full), pick(["male", "female", "other"], not full),
                           pick(["1980-05-01", "1999-02-28"], not full), pick([160.0, 175.5], not full),
                           pick([150.0, 180.0, 200.0], True), pick([150.0, 170.0, 200.0], True)]
            rows.append((eid, T0 + dt.timedelta(minutes=eid), t, uid, *payload))
    return rows


def model(rows, strict):
    """Sequential replay: create inserts (refused when the user exists), update
    merges the patch over the current row (unknown user: upsert unless strict),
    delete erases every version."""
    dims = {}
    for eid, ts, t, uid, *payload in sorted(rows):
        t = t or "create"
        p = dict(zip(FIELDS, payload))
        if t == "delete":
            dims.pop(uid, None)
            continue
        if t not in ("create", "update"):
            continue
        versions = dims.get(uid, [])
        exists = bool(versions)
        if t == "create":
            if exists or p["current_weight_lb"] is None or p["target_weight_lb"] is None:
                continue
            new = p
        else:
            if exists:
                new = {f: p[f] if p[f] is not None else versions[-1]["state"][f] for f in FIELDS}
            elif strict or p["current_weight_lb"] is None or p["target_weight_lb"] is None:
                continue
            else:
                new = p
        if versions:
            versions[-1]["end"] = ts
        versions.append({"key": eid, "start": ts, "end": None, "state": new})
        dims[uid] = versions
    out = set()
    for uid, versions in dims.items():
        for i, v in enumerate(versions, 1):
            s = v["state"]
            out.add((v["key"], uid, i, v["start"], v["end"], s["current_weight_lb"], s["target_weight_lb"],
                     s["user_name"], s["height_cm"]))
    return out


def as_set(df):
    return {(r.user_profile_key, r.user_id, r.version_number, r.effective_start, r.effective_end,
             r.current_weight_lb, r.target_weight_lb, r.user_name, r.height_cm) for r in df.collect()}


@pytest.mark.parametrize("strict", [False, True])
def test_fold_matches_sequential_model(spark, strict):
    rows = random_log()
    ev = spark.createDataFrame(rows, PROFILE_EVENT)
    got = scd2.fold(ev, AS_OF, strict=strict)
    assert as_set(got) == model(rows, strict)
    cur = got.groupBy("user_id").agg(F.sum(F.col("is_current").cast("int")).alias("c"))
    assert cur.filter("c <> 1").count() == 0
    assert scd2.invariant_violations(got).count() == 0


def test_hot_user_spread_over_blocks(spark):
    """A user holding a third of the log, tiny blocks: same result as the model."""
    rows = random_log(n_users=20, max_events=8, seed=21)
    rnd = random.Random(2)
    eid = max(r[0] for r in rows)
    hot = []
    for i in range(len(rows) // 2):
        eid += 1
        t = "create" if i == 0 else rnd.choice(["update", "update", "update", "delete", "create"])
        payload = [None] * 6 if t == "delete" else ["hot", "male", "1980-05-01", 170.0,
                                                     float(rnd.randrange(150, 250)), 180.0]
        hot.append((eid, T0 + dt.timedelta(minutes=eid), t, "UHOT", *payload))
    rows += hot
    got = scd2.fold(spark.createDataFrame(rows, PROFILE_EVENT), AS_OF, block_size=4)
    assert as_set(got) == model(rows, False)


def test_incremental_batches_equal_one_shot(spark):
    rows = random_log(seed=11)
    ev = spark.createDataFrame(rows, PROFILE_EVENT)
    one_shot = as_set(scd2.fold(ev, AS_OF))
    ids = sorted(r[0] for r in rows)
    cuts = [ids[len(ids) // 5], ids[len(ids) // 2], ids[(4 * len(ids)) // 5]]
    dim = None
    lo = -1
    for hi in cuts + [ids[-1]]:
        batch = ev.filter((F.col("event_id") > lo) & (F.col("event_id") <= hi))
        dim = scd2.fold(batch, AS_OF) if dim is None else scd2.fold(batch, AS_OF, base=dim)
        dim = spark.createDataFrame(dim.collect(), dim.schema)  # state read back between batches
        lo = hi
    assert as_set(dim) == one_shot


def test_golden_progress_timeline(spark):
    """One loss-goal user, six versions: initial, improving, not_improving, improving x3."""
    weights = [220.0, 215.0, 218.0, 211.0, 205.0, 199.0]
    rows = [(i + 1, T0 + dt.timedelta(days=30 * i), "create" if i == 0 else "update", "U004",
             "Maria", "female", "1990-03-22", 163.0, w, 160.0) for i, w in enumerate(weights)]
    dim = scd2.fold(spark.createDataFrame(rows, PROFILE_EVENT), AS_OF)
    h = reports.progress_history(dim).orderBy("version_number").collect()
    assert [r.progress_status for r in h] == ["initial", "improving", "not_improving", "improving",
                                               "improving", "improving"]
    assert [float(r.weight_delta_lb) for r in h] == [60.0, 55.0, 58.0, 51.0, 45.0, 39.0]
    assert h[-1].is_current and not h[0].is_current and h[0].effective_end == h[1].changed_at


def test_point_in_time_and_as_of_join(spark):
    rows = [(1, T0, "create", "U1", "a", "male", "1990-01-01", 170.0, 200.0, 180.0),
            (5, T0 + dt.timedelta(days=10), "update", "U1", None, None, None, None, 195.0, None),
            (9, T0 + dt.timedelta(days=20), "update", "U1", None, None, None, None, 190.0, None)]
    dim = scd2.fold(spark.createDataFrame(rows, PROFILE_EVENT), AS_OF)
    at = scd2.point_in_time(dim, "2024-01-15 00:00:00").collect()
    assert [(r.version_number, r.current_weight_lb) for r in at] == [(2, 195.0)]
    facts = spark.createDataFrame([("U1", T0 - dt.timedelta(days=1), 1), ("U1", T0 + dt.timedelta(days=12), 2),
                                   ("U1", T0 + dt.timedelta(days=25), 3), ("U2", T0, 4)],
                                  "user_id string, ts timestamp_ntz, n int")
    got = {r.n: r.user_profile_key for r in scd2.as_of_versions(facts, dim, "ts").collect()}
    assert got == {1: None, 2: 5, 3: 9, 4: None}


def test_unknown_user_rejects(spark):
    rows = [(1, T0, "update", "U1", None, None, None, None, 150.0, 150.0),
            (2, T0, "create", "U1", "a", "male", "1990-01-01", 170.0, 200.0, 180.0),
            (3, T0, "delete", "U1", None, None, None, None, None, None),
            (4, T0, "delete", "U1", None, None, None, None, None, None),
            (5, T0, "update", "U1", None, None, None, None, 150.0, None)]
    got = sorted(r.event_id for r in scd2.unknown_user_rejects(spark.createDataFrame(rows, PROFILE_EVENT),
                                                               AS_OF).collect())
    assert got == [1, 4, 5]


def test_backfill_history(spark):
    cur = spark.createDataFrame([("U1", "a", 160.0, 199.0, dt.datetime(2026, 4, 1))],
                                "user_id string, user_name string, target_weight_lb double, "
                                "current_weight_lb double, effective_start timestamp_ntz")
    readings = spark.createDataFrame([("U1", 2, dt.datetime(2025, 11, 28), 215.0),
                                      ("U1", 1, dt.datetime(2025, 11, 1), 220.0)],
                                     "user_id string, reading_id long, effective_start timestamp_ntz, "
                                     "current_weight_lb double")
    out = scd2.backfill_history(cur, readings).orderBy("version_number").collect()
    assert [(r.version_number, r.current_weight_lb, r.is_current) for r in out] == [
        (1, 220.0, False), (2, 215.0, False), (3, 199.0, True)]
    assert out[0].effective_end == out[1].effective_start


def test_invariants_keep_rows_without_user(spark):
    dim = spark.createDataFrame([(None, 1, "2024-01-01", None, True, 1), (None, 2, "2024-02-01", None, True, 2), ("", 3, "2024-01-01", None, True, 1), ("u", 4, "2024-01-01", None, True, None)],
                                "user_id string, user_profile_key long, effective_start string, effective_end string, is_current boolean, version_number int")
    dim = dim.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("effective_start", "effective_end")})
    assert {tuple(r) for r in scd2.invariant_violations(dim).collect()} == {(None, 2, 2, 1, 0), ("u", 1, 1, 0, 1)}
