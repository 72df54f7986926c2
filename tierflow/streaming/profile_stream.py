"""Event-driven profile maintenance with Structured Streaming (S9-S11, E1-E6,
E15, R6).

``readStream`` (file or broker source) -> envelope decode -> ``foreachBatch``:
each micro-batch is validated (rejects go to a dead-letter path), folded into
the SCD2 dimension together with the *touched users' current rows only*, the
touched users' recommendations are rebuilt for their new goal, and the
dimension and fact are published together.

State layout: ``streaming.store`` — change rows in hash buckets behind numbered
commits. A micro-batch writes only the rows of the users it touches:

* ``dim``: the expired row and the new versions of each touched user; a user whose
  batch holds a delete gets an ``erase`` row before them (E4);
* ``fact``: the ranked foods of each touched user for the new goal (R6);
* ``log``: the accepted events (S11); ``hw``: newest event and last delete of each
  touched user, so that late data are noticed without reading the log;
* ``rejected``: events that validation refuses (E10-E12, E15) and records that are no
  JSON object; ``refused``: valid events that the fold refuses (E13).

A replayed batch id (restart after a crash) is skipped; a crash before the
commit leaves the previous state untouched and the batch is run again into
the same directory. Compaction and physical erasure are jobs of their own
(``SnapshotStore.compact``, ``SnapshotStore.purge``).

On a table format with MERGE, the same per-batch fold output feeds MERGE on
the touched users instead.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierflow.constants import FACT_REC_COLUMNS
from tierflow.operators import recommend as rec
from tierflow.operators.ordered import materialize
from tierflow.operators.scd2 import DIM_COLUMNS, current_rows, event_outcomes, fold
from tierflow.operators.validate import validate_events
from tierflow.sources import events as envelope
from tierflow.streaming.store import BUCKETS, LOG_SCHEMA, REFOLDED, SCHEMAS, SnapshotStore, bucket_of, compact_event_log

__all__ = ["BUCKETS", "LOG_SEGMENTS_MAX", "SnapshotStore", "apply_batch", "bucket_of", "compact_event_log", "dedup_events", "start"]

#: A bucket is compacted, after the batch, when it has as many segments.
LOG_SEGMENTS_MAX = 16


def _changes(table: str, rows: DataFrame, seq: int, op: str = "row") -> DataFrame:
    """Rows, or users that are reset, as change rows."""
    if op != "row":
        rows = rows.select("user_id", *(F.lit(None).cast(f.dataType).alias(f.name) for f in SCHEMAS[table].fields if f.name != "user_id"))
    return rows.select(*(f.name for f in SCHEMAS[table].fields)).withColumns({"op": F.lit(op), "seq": F.lit(seq).cast("long")})


def apply_batch(store: SnapshotStore, events: DataFrame, batch_id: int, foods: DataFrame | None, as_of,
                strict: bool = False, top: DataFrame | None = None, notes: dict | None = None) -> bool:
    """Fold one micro-batch of profile events into the store. Returns False
    when the batch was already committed (replay).

    Late data: a user whose batch holds an event that is not newer than the user's
    newest known one is folded anew from the event log plus the batch (and the row that a
    batch load gave the user), so neither the order of arrival nor a repeated
    delivery changes the result; other users are folded on top of their
    current rows. Events from before a user's last delete are erased already and are dropped.

    The writes of the tables run as concurrent Spark jobs.
    """
    manifest = store.manifest()
    if batch_id <= manifest["batch"]:
        return False
    version, seq = f"b{batch_id:010d}", manifest["commit"] + 1
    v = validate_events(events, as_of).persist()
    pool, keep = ThreadPoolExecutor(max_workers=6), materialize  # what is read several times below
    try:
        valid = F.col("is_valid") & F.col("route").isin("create", "update", "delete")
        users = v.select("user_id", F.xxhash64("user_id").alias("user_hash")).distinct()
        # bounded by the bucket count, so reading it on the driver is cheap
        found = v.groupBy(bucket_of("user_id", store.buckets)).agg(F.count_if(valid), F.count_if(~valid)).collect()
        touched = sorted(r[0] for r in found)
        any_bad = any(r[2] for r in found)
        side = [pool.submit(store.write_index, users, version)] if touched else []
        marks = store.read("hw", touched, manifest, users.select("user_id")).drop("user_id")
        ok = v.filter(valid).select(*[f.name for f in LOG_SCHEMA.fields], F.xxhash64("user_id").alias("user_hash")).join(marks, "user_hash", "left")
        ok = keep(ok.filter("last_delete_id is null or event_id > last_delete_id").dropDuplicates(["user_id", "event_id"]))
        per_user = keep(_per_user(ok))
        any_ok, any_late, any_erased, any_loaded = (*per_user.agg(F.count(F.lit(1)) > 0, F.coalesce(F.bool_or("late"), F.lit(False)), F.count("last_delete_id") > 0).first(),
                                                    bool(manifest["tables"].get("loaded")))
        ok = ok.drop("user_hash", "hw_event_id", "last_delete_id")
        erased = per_user.filter("last_delete_id is not null").select("user_id")
        gone = per_user.filter("late and last_delete_id is null").select("user_id")

        def change(table, rows):
            out = _changes(table, rows, seq)
            if any_erased:
                out = out.unionByName(_changes(table, erased, seq, "erase"))
            return out.unionByName(_changes(table, gone, seq, "refold")) if any_late and table in REFOLDED else out

        if any_bad or any_erased:
            deletes = marks.select("user_hash", "last_delete_id").unionByName(per_user.select("user_hash", "last_delete_id"))
            deletes = deletes.groupBy("user_hash").agg(F.max("last_delete_id").alias("gone"))
            bad = v.filter(~valid).withColumn("user_hash", F.xxhash64("user_id")).join(deletes, "user_hash", "left").filter("gone is null or event_id > gone")
            raw = F.col("raw_value") if "raw_value" in v.columns else F.lit(None).cast("string")
            bad = bad.select("event_id", "ts", "event_type", "user_id", F.col("errors").alias("reason"), raw.alias("raw_value"))
            side.append(pool.submit(store.write, "rejected", change("rejected", bad), version))
        if any_ok:
            side.append(pool.submit(store.write, "log", ok, version))
            side.append(pool.submit(store.write, "hw", per_user, version))
            if any_erased and any_loaded:
                side.append(pool.submit(store.write, "loaded", _changes("loaded", erased, seq, "erase"), version))
            touched_users = per_user.select("user_id")
            base = current_rows(store.read("dim", touched, manifest, touched_users))
            part = ok
            if any_late:  # their whole log on the row that a load gave them, the others' batch on their current rows
                late = per_user.filter("late").select("user_id")
                known = store.read_log(touched, manifest, late).unionByName(ok.join(late, "user_id", "left_semi")).dropDuplicates(["user_id", "event_id"])
                part = keep(ok.join(late, "user_id", "left_anti").unionByName(known))
                base = base.join(late, "user_id", "left_anti").unionByName(store.read("loaded", touched, manifest, late))
            base = keep(base)
            new_dim = fold(part, as_of, strict=strict, base=base, validated=True).select(*DIM_COLUMNS)
            deleted = per_user.filter("was_deleted").select("user_id")
            refused = event_outcomes(part, as_of, strict=strict, base=base, validated=True, deleted=deleted).filter("outcome not in ('accepted', 'erased')")
            reasons = refused.select("event_id", "ts", "event_type", "user_id", F.col("outcome").alias("reason"), F.lit(None).cast("string").alias("raw_value"))
            side.append(pool.submit(store.write, "refused", change("refused", reasons), version))
            new_dim = materialize(new_dim)
            side.append(pool.submit(store.write, "dim", change("dim", new_dim), version))
            changed = touched_users.join(current_rows(new_dim).select("user_id", "goal_type"), "user_id")
            fresh = rec.recommend(changed, foods, top=top).select(*FACT_REC_COLUMNS)
            # ranks that a user no longer has, and those of users without a profile, go with the reset
            store.write("fact", _changes("fact", fresh, seq).unionByName(_changes("fact", touched_users, seq, "refold")), version)
        for f in side:
            f.result()
        store.commit(batch_id, version, touched, manifest, notes=notes)
    finally:
        pool.shutdown(wait=True)
        v.unpersist()
    store.compact(LOG_SEGMENTS_MAX)
    return True


def _per_user(ok: DataFrame) -> DataFrame:
    """Newest event, last delete and lateness of each user of a batch; ``ok`` has
    the user's marks from before (hw_event_id, last_delete_id)."""
    return ok.groupBy("user_id", "user_hash").agg(
        F.max("event_id").alias("newest"), F.max(F.when(F.col("event_type") == "delete", F.col("event_id"))).alias("deleted"),
        (F.min("event_id") <= F.max("hw_event_id")).alias("late"), F.max("last_delete_id").isNotNull().alias("was_deleted")).select(
        "user_hash", "user_id", F.col("newest").alias("hw_event_id"), F.col("deleted").alias("last_delete_id"), F.coalesce("late", F.lit(False)).alias("late"), "was_deleted")


def start(stream: DataFrame, store: SnapshotStore, foods: DataFrame, as_of, checkpoint: str,
          strict: bool = False, available_now: bool = True, processing_time: str | None = None):
    """Run the profile stream; returns the ``StreamingQuery``.

    The per-goal ranking depends only on the foods, so it is computed once and
    materialised (at most ``len(GOALS) * k`` rows) for all micro-batches.
    """
    top = materialize(rec.top_k_by_goal(foods))

    def run(batch_df: DataFrame, batch_id: int) -> None:
        apply_batch(store, batch_df, batch_id, foods, as_of, strict, top=top)

    w = stream.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=processing_time or "5 seconds")
    return w.start()


def start_topic(records: DataFrame, store: SnapshotStore, foods: DataFrame, as_of, checkpoint: str,
                strict: bool = False, available_now: bool = True, processing_time: str | None = None):
    """The profile stream over records as a topic holds them (``events.topic_events``), or
    over lines of files (``events.read_line_files``; their positions go on from batch to
    batch, kept in the commits). Records that are no JSON object go to ``rejected``."""
    top = materialize(rec.top_k_by_goal(foods))

    def run(batch_df: DataFrame, batch_id: int) -> None:
        notes = None
        if "offset" not in batch_df.columns:
            first = store.manifest().get("position", 0)
            batch_df = materialize(envelope.line_records(batch_df, first))
            notes = {"position": first + batch_df.count()}
        apply_batch(store, envelope.topic_events(batch_df), batch_id, foods, as_of, strict, top=top, notes=notes)

    w = records.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=processing_time or "5 seconds")
    return w.start()


def dedup_events(stream: DataFrame, key: str = "event_id", ts: str = "ts", delay: str = "1 hour") -> DataFrame:
    """Replayed deliveries of the same event (same id) are dropped, with state
    bounded by the watermark (the modelled consumer had no such guard)."""
    return (stream.withColumn("__wts", F.col(ts).cast("timestamp"))
            .withWatermark("__wts", delay)
            .dropDuplicatesWithinWatermark([key])
            .drop("__wts"))
