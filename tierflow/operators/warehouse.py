"""Star-schema load as a pure function, ids and keys (E7, E8, E14, E18, J4-J6,
J8, J11, S6-S8).

``load`` takes the current warehouse tables and the new gold layer and returns
the next warehouse tables; writing them is the sink's job (``sources.sinks``).
Semantics of the modelled loader: users already in the dimension are skipped
(their recommendations are left as they are), new users get an initial SCD2
stamp and their recommendations replace any stale rows, the food dimension is
truncated and reloaded.
"""

from __future__ import annotations

from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierflow.constants import (DIM_FOOD_COLUMNS, DIM_USER_BASE_COLUMNS, DIM_USER_EXTRA_COLUMNS,
                                FACT_REC_COLUMNS, NUTRIENT_COLUMNS, USER_ID_PATTERN)
from tierflow.functions.cleanse import format_user_id, select_available, to_warehouse_decimal, user_id_number


def surrogate_key(*cols) -> "F.Column":
    """Deterministic 64-bit key from the business key (and version)."""
    return F.xxhash64(*[F.col(c) if isinstance(c, str) else c for c in cols])


def initial_stamp(users: DataFrame, run_ts: str) -> DataFrame:
    """Batch users enter the dimension as version 1, current, open-ended."""
    present = set(users.columns)
    cols = DIM_USER_BASE_COLUMNS + [c for c in DIM_USER_EXTRA_COLUMNS if c in present]
    return users.select(
        surrogate_key("user_id", F.lit(1)).alias("user_profile_key"), *cols,
        F.lit(run_ts).cast("timestamp_ntz").alias("effective_start"),
        F.lit(None).cast("timestamp_ntz").alias("effective_end"),
        F.lit(True).alias("is_current"),
        F.lit(1).alias("version_number"),
    )


def dim_food(silver: DataFrame) -> DataFrame:
    """C8 + C9: warehouse food rows (present columns, DECIMAL(10,2) numbers)."""
    return to_warehouse_decimal(select_available(silver, DIM_FOOD_COLUMNS),
                                NUTRIENT_COLUMNS + ["serving_size_value"])


@dataclass
class Warehouse:
    dim_user: DataFrame
    dim_food: DataFrame
    fact: DataFrame
    new_users: DataFrame


def load(dim_user: DataFrame, fact: DataFrame, silver: DataFrame, gold_users: DataFrame,
         gold_recs: DataFrame, run_ts: str) -> Warehouse:
    """E8 = S6 + E7 + J4 + J5 + J8 + S7 + S8."""
    existing = dim_user.select("user_id").distinct()                       # S6
    new_users = gold_users.join(existing, "user_id", "left_anti")          # J4
    new_ids = new_users.select("user_id")
    new_recs = select_available(gold_recs, FACT_REC_COLUMNS).join(new_ids, "user_id", "left_semi")  # J5
    kept_fact = fact.join(new_ids, "user_id", "left_anti")                 # J8
    stamped = initial_stamp(new_users, run_ts)
    out_dim = dim_user.unionByName(stamped, allowMissingColumns=True)      # S7
    out_fact = kept_fact.unionByName(new_recs, allowMissingColumns=True)   # S7
    return Warehouse(out_dim, dim_food(silver), out_fact, new_users)       # S8: food replaced


def known_ids(*sources: DataFrame) -> DataFrame:
    """J11 + C17: distinct well-formed user ids over several tables."""
    out = None
    for s in sources:
        ids = s.select("user_id").filter(F.col("user_id").rlike(USER_ID_PATTERN))
        out = ids if out is None else out.unionByName(ids)
    return out.distinct()


def high_water_mark(ids: DataFrame) -> DataFrame:
    """A5: one-row frame with the largest id number (0 when none)."""
    return ids.agg(F.coalesce(F.max(user_id_number("user_id")), F.lit(0)).alias("high_water"))


def allocate_ids(requests: DataFrame, order_by: list[str], start: DataFrame,
                 id_col: str = "user_id") -> DataFrame:
    """Give every request the next free id, in ``order_by`` order.

    A distributed row index without a global window over the data: rows are
    range-sorted, each partition is counted (one row per partition), prefix
    offsets are computed over those counts (a table bounded by the partition
    count, hence broadcast), and each row's index is its partition offset
    plus its position inside the partition. ``start`` is the one-row
    high-water frame; its single number is read on the driver. The sorted
    input is checkpointed to the shared checkpoint folder first, so the count
    pass and the numbering pass see identical partitions even after a lost
    executor.
    """
    from pyspark.sql import Window

    from tierflow.operators.ordered import materialize

    high_water = int(start.first()["high_water"])
    ordered = materialize(requests.sort(*order_by)
                          .withColumn("__pid", F.spark_partition_id())
                          .withColumn("__mid", F.monotonically_increasing_id()))
    pos = F.col("__mid").bitwiseAND(F.lit((1 << 33) - 1))
    counts = ordered.groupBy("__pid").agg(F.count(F.lit(1)).alias("__n"))
    before = Window.orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("__pid", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__off"))
    numbered = ordered.join(F.broadcast(offsets), "__pid")
    idx = F.lit(Decimal(high_water)).cast("decimal(38,0)") + (F.col("__off") + pos + 1).cast("decimal(20,0)")
    return numbered.withColumn(id_col, format_user_id(idx)).drop("__pid", "__mid", "__off")
