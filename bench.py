"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is run to completion with the ``noop`` sink (every row computed,
nothing collected to the driver). Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tierflow.plans import registry  # noqa: E402
from tierflow.session import build_session  # noqa: E402

HEADLINE = ["top10_by_goal", "scd2_fold", "report", "dq_report", "progress_history", "range_join_events_versions",
            "backfill_history", "stream_scd2_final", "silver_from_dirty", "next_ids"]


def operational(spark, sf_dir: str) -> dict:
    """The two operational figures the modelled system documents: a full
    gated batch run raw -> gold (with atomic publication), and the latency
    from a few new profile events to visible recommendations (micro-batches
    folded into existing state; median of three)."""
    import uuid

    from pyspark.sql import functions as F

    from tierflow.plans import medallion
    from tierflow.session import shared_dir
    from tierflow.sources import adapters
    from tierflow.streaming import profile_stream as ps

    out = {}
    root = shared_dir(spark, "bench", uuid.uuid4().hex[:8])
    t0 = time.perf_counter()
    medallion.run_batch(spark, adapters.raw_foods(adapters.table(spark, sf_dir, "part")),
                        adapters.users(adapters.table(spark, sf_dir, "customer")), f"{root}/lake")
    out["batch_run"] = round(time.perf_counter() - t0, 3)

    events = registry.profile_events(spark, sf_dir)
    last_id = events.agg(F.max("event_id")).first()[0]
    foods = medallion.silver_foods(spark, sf_dir)
    store = ps.SnapshotStore(spark, f"{root}/state")
    from tierflow.operators.ordered import materialize
    from tierflow.operators.recommend import top_k_by_goal
    top = materialize(top_k_by_goal(foods))  # computed once per stream
    # state = everything but the last 15 events; then three micro-batches of 5
    # new events each, timed from arrival to the recommendations being readable
    ps.apply_batch(store, events.filter(F.col("event_id") <= last_id - 15), 0, foods, adapters.AS_OF, top=top)
    lat = []
    for i in range(3):
        lo, hi = last_id - 15 + 5 * i, last_id - 10 + 5 * i
        t0 = time.perf_counter()
        ps.apply_batch(store, events.filter((F.col("event_id") > lo) & (F.col("event_id") <= hi)), 1 + i, foods,
                       adapters.AS_OF, top=top)
        store.read("fact").write.format("noop").mode("overwrite").save()
        lat.append(time.perf_counter() - t0)
    out["event_latency"] = round(sorted(lat)[1], 3)  # median of three micro-batches
    return out


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    names = sys.argv[1:] or HEADLINE
    spark = build_session(f"local[{cpus}]", cpus, app_name="tierflow-bench")
    # warm-up on the smallest tables (JIT, codegen and class loading), so the
    # timed runs measure steady-state throughput at the target scale
    warm_dir = os.environ.get("BENCH_WARM_DIR", "/root/testdata/sf0.001")
    if os.path.isdir(warm_dir):
        for name in names:
            registry.QUERIES[name](spark, warm_dir).write.format("noop").mode("overwrite").save()
    times = {}
    for name in names:
        t0 = time.perf_counter()
        registry.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
    if not sys.argv[1:]:
        times.update(operational(spark, sf_dir))
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": sf}))
    spark.stop()


if __name__ == "__main__":
    main()
