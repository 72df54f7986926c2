"""Streaming = batch: the event stream in several micro-batches gives the
one-shot fold; a replayed batch id changes nothing."""
import time

from pyspark.sql import functions as F

from tierflow.operators import scd2, validate
from tierflow.plans import medallion, registry
from tierflow.sources import adapters
from tierflow.streaming import profile_stream as ps

from data_dirs import SF001


def _as_set(df):
    return set(tuple(r) for r in df.select(*scd2.DIM_COLUMNS).collect())


def test_micro_batches_equal_one_shot(spark, tmpdir_path):
    raw = adapters.table(spark, SF001, "events")
    src = tmpdir_path + "/events_split"
    # four files, the third one holding the oldest events (out-of-order arrival)
    for lo in (250, 500, 0, 750):
        raw.filter((F.col("event_id") >= lo) & (F.col("event_id") < lo + 250)).coalesce(1).write.mode(
            "append").parquet(src)
        time.sleep(1.1)
    store = registry.run_event_stream(spark, SF001, root=tmpdir_path + "/run", max_files_per_trigger=1,
                                      source_dir=src)
    assert store.manifest()["batch"] == 3
    one_shot = scd2.fold(registry.profile_events(spark, SF001), adapters.AS_OF)
    assert _as_set(store.read("dim")) == _as_set(one_shot)

    # replaying an already committed batch is a no-op
    before = store.manifest()
    foods = medallion.silver_foods(spark, SF001)
    assert ps.apply_batch(store, adapters.profile_events(raw), 0, foods, adapters.AS_OF) is False
    assert store.manifest() == before


def test_dedup_and_log_compaction(spark):
    log = spark.createDataFrame([(1, "U1", "create"), (2, "U1", "delete"), (3, "U1", "create"), (4, "U2", "create")],
                                "event_id long, user_id string, event_type string")
    assert sorted(r.event_id for r in ps.compact_event_log(log).collect()) == [2, 3, 4]


def test_log_segments_append_and_compact(spark, tmpdir_path, monkeypatch):
    """The log grows by one segment per batch and bucket; a bucket is
    rewritten (erased events dropped) once it reaches the segment limit; the
    logical log is the same either way."""
    monkeypatch.setattr(ps, "LOG_SEGMENTS_MAX", 3)
    events = registry.profile_events(spark, SF001)
    foods = medallion.silver_foods(spark, SF001)
    store = ps.SnapshotStore(spark, tmpdir_path + "/seg", buckets=4)
    cuts = [0, 300, 500, 700, 900, 10 ** 9]
    for i, (lo, hi) in enumerate(zip(cuts, cuts[1:])):
        batch = events.filter((F.col("event_id") >= lo) & (F.col("event_id") < hi))
        assert ps.apply_batch(store, batch, i, foods, adapters.AS_OF)
    segs = store.manifest()["tables"]["log"]
    # five batches, each touching every bucket: without compaction each bucket would hold five segments
    assert segs and all(1 <= len(v) <= 2 for v in segs.values())
    ok = validate.validate_events(events, adapters.AS_OF)
    ok = ok.filter(F.col("is_valid") & F.col("route").isin("create", "update", "delete"))
    want = {(r.user_id, r.event_id) for r in ps.compact_event_log(ok).select("user_id", "event_id").collect()}
    got = {(r.user_id, r.event_id) for r in store.read_log().select("user_id", "event_id").collect()}
    assert got == want
    hw = {r.user_id: r.hw_event_id for r in store.read("hw").collect()}
    assert hw == {r.user_id: r.m for r in ok.groupBy("user_id").agg(F.max("event_id").alias("m")).collect()}
    assert _as_set(store.read("dim")) == _as_set(scd2.fold(events, adapters.AS_OF))


def test_out_of_order_batches_with_compaction(spark, tmpdir_path, monkeypatch):
    """Batches arriving out of event order (late users re-folded from the log)
    while buckets are being compacted still give the one-shot fold."""
    monkeypatch.setattr(ps, "LOG_SEGMENTS_MAX", 2)
    events = registry.profile_events(spark, SF001)
    foods = medallion.silver_foods(spark, SF001)
    store = ps.SnapshotStore(spark, tmpdir_path + "/ooo", buckets=3)
    slices = [(400, 700), (0, 400), (850, 10 ** 9), (700, 850)]
    for i, (lo, hi) in enumerate(slices):
        batch = events.filter((F.col("event_id") >= lo) & (F.col("event_id") < hi))
        assert ps.apply_batch(store, batch, i, foods, adapters.AS_OF)
    assert _as_set(store.read("dim")) == _as_set(scd2.fold(events, adapters.AS_OF))


def test_compaction_matches_sequential_model_with_hot_user(spark):
    """Erasure on read equals a sequential model (each delete clears the
    user's earlier events) on a random log where one user holds a third of it."""
    import random

    rnd = random.Random(7)
    rows = []
    for eid in range(1, 1501):
        user = "U1" if eid % 3 == 0 else f"U{rnd.randint(2, 60)}"
        rows.append((eid, user, rnd.choice(["create", "update", "update", "delete"])))
    kept: dict[str, list[int]] = {}
    for eid, user, kind in rows:
        if kind == "delete":
            kept[user] = []
        kept.setdefault(user, []).append(eid)
    want = sorted(e for ids in kept.values() for e in ids)
    log = spark.createDataFrame(rows, "event_id long, user_id string, event_type string")
    assert sorted(r.event_id for r in ps.compact_event_log(log).collect()) == want
