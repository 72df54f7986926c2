"""Skew-safe ordered scans within a key (row number, running sum, lead, lag,
carry-forward) — the per-user windows the SCD2 fold and the history views
need.

A plain ``Window.partitionBy(user)`` puts every row of a user into one task;
if one user holds a third of the log, that task holds a third of the data.
Here each key is cut into *blocks* by a monotone function of the ordering
column (``event_id // block_size`` by default, so a block never holds more
than ``block_size`` rows of one key when ids are unique):

1. one window per ``(key, block)`` computes the local row number, running
   sums, lead / lag and last-non-null values (bounded groups, one shuffle);
2. a per-block summary (count, sums, first / last values) is aggregated from
   the same input with map-side partial aggregation, so it shuffles about one
   row per block and map task; it has one row per non-empty block;
3. a per-key window over the summary turns it into block offsets and the
   values that cross block edges (a hot key has ``rows / block_size`` summary
   rows, e.g. 33 k rows for 33 G events at the default block size);
4. the summary is joined back on ``(key, block)`` (AQE broadcasts it when its
   measured size allows, otherwise it is a co-partitioned sort-merge join).

Results equal the unblocked window for every row; the tests check that.

The input is read twice (rows and summary). Pass an input that is cheap to
recompute (a scan with projections) or a materialised one: chained scans
materialise in between with ``materialize`` (a reliable checkpoint in the
shared ``spark.checkpoint.dir``) so nothing before them is recomputed.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DEFAULT_BLOCK_SIZE = 1 << 20

_BLK = "__blk"
NULL_BLOCK = -(1 << 62)
_RN = "__rn"
_CNT = "__cnt"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ordered_scan(
    df: DataFrame,
    key: Sequence[str],
    order: Sequence[str] | str,
    *,
    block: Column | str | None = None,
    block_size: int = DEFAULT_BLOCK_SIZE,
    row_number: str | None = None,
    running_sum: Mapping[str, Column | str] | None = None,
    key_sum: Mapping[str, Column | str] | None = None,
    lead: Mapping[str, Column | str] | None = None,
    lag: Mapping[str, Column | str] | None = None,
    carry: Mapping[str, Column | str] | None = None,
    keep_block: bool = False,
) -> DataFrame:
    """Add ordered-within-key columns to ``df``.

    ``order`` must be unique within a key (add tie-breakers) and ``block`` a
    non-decreasing function of it; by default ``floor(order[0] / block_size)``
    (exact bound for unique integer ids). ``block="range"`` derives the blocks
    from a sampled range partitioning on (key, order): bounded blocks for any
    order type, at the price of one more shuffle and a checkpoint of the
    block assignment. ``block="sketch"`` (first ordering column a number, date or time) cuts the
    hot keys alone, at edges from a quantile sketch (``hot_key_edges``); the rows are
    read again instead of copied.

    * ``row_number``: 1-based position within the key.
    * ``running_sum``: {out: expr} — sum of expr over rows up to and including this one.
    * ``key_sum``: {out: expr} — sum of expr over the whole key.
    * ``lead`` / ``lag``: {out: expr} — expr on the next / previous row (null at the ends).
    * ``carry``: {out: expr} — last non-null expr at or before this row.

    Key columns must be non-null. With ``keep_block`` the block column
    ``__blk`` stays in the output and a later scan over the same key reuses it
    (same blocks, and the exchange is skipped when the partitioning survived).
    """
    key = list(key)
    order = [order] if isinstance(order, str) else list(order)
    running_sum, key_sum = dict(running_sum or {}), dict(key_sum or {})
    lead, lag, carry = dict(lead or {}), dict(lag or {}), dict(carry or {})
    src_cols = [c for c in df.columns if c != _BLK]
    inputs: dict[str, Column] = {}
    for prefix, spec in (("rs", running_sum), ("ks", key_sum), ("ld", lead), ("lg", lag), ("cy", carry)):
        for out, expr in spec.items():
            inputs[f"__in_{prefix}_{out}"] = _col(expr)
    reuse = _BLK in df.columns and block is None
    if isinstance(block, str) and block == "range":
        # data-adaptive blocks: range-partition by (key, order) — the sampled
        # bounds split a hot key over many partitions — and use the partition
        # index, which is non-decreasing along (key, order), as the block. The
        # assignment depends on the sampled bounds, so it is materialised once:
        # rows and block summary must see the same blocks.
        width = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        d = materialize(df.repartitionByRange(width, *key, *order)
                        .withColumns({_BLK: F.spark_partition_id().cast("long"), **inputs}))
    elif isinstance(block, str) and block == "sketch":
        value = order_value(df, order[0])
        edges = hot_key_edges(df, key, value)
        place = F.size(F.filter("__edges", lambda e: e < F.col("__val"))).cast("long")
        placed = F.when(F.col("__val").isNull(), NULL_BLOCK).when(F.col("__edges").isNull(), 0).otherwise(place)
        d = (df.withColumn("__val", value).join(F.broadcast(edges), key, "left")
             .withColumns({_BLK: placed, **inputs}).drop("__val", "__edges"))
    else:
        if block is None and not reuse:
            block = F.floor(F.col(order[0]) / F.lit(block_size))
        # rows whose ordering value is null come first, in a block of their own
        d = df.withColumns(inputs if reuse else {_BLK: F.coalesce(block, F.lit(NULL_BLOCK)), **inputs})

    wl = Window.partitionBy(*key, _BLK).orderBy(*order)
    upto = wl.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local: dict[str, Column] = {_RN: F.row_number().over(wl)}
    for out in running_sum:
        local[f"__l_rs_{out}"] = F.sum(f"__in_rs_{out}").over(upto)
    for out in lead:
        local[f"__l_ld_{out}"] = F.lead(f"__in_ld_{out}").over(wl)
    for out in lag:
        local[f"__l_lg_{out}"] = F.lag(f"__in_lg_{out}").over(wl)
    for out in carry:
        local[f"__l_cy_{out}"] = F.last(f"__in_cy_{out}", ignorenulls=True).over(upto)
    windowed = d.withColumns(local)

    # per-block summary, aggregated from the input (partial aggregation map-side)
    # a single ordering column keeps the aggregation buffers fixed-width (hash
    # aggregation); several need a struct (sort-based partial aggregation)
    ord_struct = F.col(order[0]) if len(order) == 1 else F.struct(*[F.col(c) for c in order])
    aggs = [F.count(F.lit(1)).alias(_CNT)]
    for out in running_sum:
        aggs.append(F.sum(f"__in_rs_{out}").alias(f"__b_rs_{out}"))
    for out in key_sum:
        aggs.append(F.sum(f"__in_ks_{out}").alias(f"__b_ks_{out}"))
    for out in lead:
        aggs.append(F.min_by(f"__in_ld_{out}", ord_struct).alias(f"__b_ld_{out}"))
    for out in lag:
        aggs.append(F.max_by(f"__in_lg_{out}", ord_struct).alias(f"__b_lg_{out}"))
    for out in carry:
        c = F.col(f"__in_cy_{out}")
        aggs.append(F.max_by(c, F.when(c.isNotNull(), ord_struct)).alias(f"__b_cy_{out}"))
    summary = d.groupBy(*key, _BLK).agg(*aggs)

    ws = Window.partitionBy(*key).orderBy(_BLK)
    before = ws.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*key)
    sx: dict[str, Column] = {"__s_off": F.coalesce(F.sum(_CNT).over(before), F.lit(0))}
    for out in running_sum:
        sx[f"__s_rs_{out}"] = F.sum(f"__b_rs_{out}").over(before)
    for out in key_sum:
        sx[f"__s_ks_{out}"] = F.sum(f"__b_ks_{out}").over(whole)
    for out in lead:
        sx[f"__s_ld_{out}"] = F.lead(f"__b_ld_{out}").over(ws)
    for out in lag:
        sx[f"__s_lg_{out}"] = F.lag(f"__b_lg_{out}").over(ws)
    for out in carry:
        sx[f"__s_cy_{out}"] = F.last(f"__b_cy_{out}", ignorenulls=True).over(before)
    summary = summary.withColumns(sx).select(*key, _BLK, _CNT, *sx.keys())
    joined = windowed.join(summary, [*key, _BLK], "inner")

    outs: dict[str, Column] = {}
    if row_number:
        outs[row_number] = (F.col("__s_off") + F.col(_RN)).cast("long")
    for out in running_sum:
        outs[out] = F.coalesce(F.col(f"__s_rs_{out}") + F.col(f"__l_rs_{out}"), F.col(f"__l_rs_{out}"))
    for out in key_sum:
        outs[out] = F.col(f"__s_ks_{out}")
    for out in lead:
        outs[out] = F.when(F.col(_RN) == F.col(_CNT), F.col(f"__s_ld_{out}")).otherwise(F.col(f"__l_ld_{out}"))
    for out in lag:
        outs[out] = F.when(F.col(_RN) == 1, F.col(f"__s_lg_{out}")).otherwise(F.col(f"__l_lg_{out}"))
    for out in carry:
        outs[out] = F.coalesce(F.col(f"__l_cy_{out}"), F.col(f"__s_cy_{out}"))
    keep = [c for c in src_cols if c not in outs]
    extra = [_BLK] if keep_block else []
    return joined.select(*keep, *[v.alias(k) for k, v in outs.items()], *extra)


#: Most blocks of one key under ``block="sketch"``.
MAX_BLOCKS = 4096


def order_value(df: DataFrame, column: str) -> Column:
    """A number that orders like ``column`` (a number, date or time), not always strictly."""
    kind = df.schema[column].dataType.simpleString()
    if kind in ("date", "timestamp", "timestamp_ntz"):
        return F.unix_micros(F.col(column).cast("timestamp"))
    return F.col(column).cast("double")


def hot_key_edges(df: DataFrame, key: Sequence[str], value: Column) -> DataFrame:
    """(key, __edges): for the keys with more rows than a mean shuffle partition, the
    ascending inner edges that cut them into blocks of about that size (never more
    than ``MAX_BLOCKS``), from a quantile sketch of ``value`` over those keys' rows.

    There are fewer such keys than shuffle partitions, and about twice as many
    edges at most, whatever the table's size; counts and sketches are combined
    before they are shuffled. The result is materialised, as a sketch may differ from run to run. Rows of
    one key with one value share a block.
    """
    width = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    blocks = min(width, MAX_BLOCKS)
    total = df.count()
    hot = df.groupBy(*key).agg(F.count(F.lit(1)).alias("__n")).filter(F.col("__n") * F.lit(width) > F.lit(total))
    cuts = F.least(F.ceil(F.col("__n") * F.lit(width) / F.lit(max(total, 1))), F.lit(blocks)).cast("int")
    grid = [i / blocks for i in range(1, blocks)] or [0.5]
    rows = df.select(*key, value.alias("__val")).join(F.broadcast(hot), list(key))
    sketch = rows.groupBy(*key).agg(F.first("__n").alias("__n"), F.percentile_approx("__val", grid, 10 * blocks).alias("__q"))
    chosen = F.transform(F.sequence(F.lit(1), cuts - 1), lambda j: F.element_at("__q", F.greatest(F.floor(j * blocks / cuts), F.lit(1)).cast("int")))
    return materialize(sketch.filter((cuts > 1) & F.col("__q").isNotNull()).select(*key, F.array_distinct(chosen).alias("__edges")))


def time_block(ts: Column | str, width_seconds: int) -> Column:
    """Monotone block id for a timestamp ordering (``width_seconds`` wide)."""
    return F.floor(F.unix_micros(_col(ts).cast("timestamp")) / F.lit(width_seconds * 1_000_000))


def materialize(df: DataFrame) -> DataFrame:
    """Cut the lineage of an intermediate result: a reliable checkpoint in the
    shared checkpoint folder (never a machine-local one). Survives executor
    loss, keeps the output partitioning, and lets a frame that is read twice
    (rows + block summary) be computed once."""
    from tierflow.session import shared_dir

    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def row_index(df: DataFrame, order_by: Sequence[str], out: str) -> DataFrame:
    """``df`` with ``out``: the row's place (from 0, gapless) by ``order_by``, which has no
    ties. Rows are range-sorted, each partition is counted, the counts' running sums (one
    row a partition) give the places."""
    ordered = materialize(df.sort(*order_by).withColumns({"__pid": F.spark_partition_id(), "__mid": F.monotonically_increasing_id()}))
    counts = ordered.groupBy("__pid").agg(F.count(F.lit(1)).alias("__n"))
    before = Window.orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("__pid", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__off"))
    place = F.col("__off") + F.col("__mid").bitwiseAND(F.lit((1 << 33) - 1))
    return ordered.join(F.broadcast(offsets), "__pid").withColumn(out, place).drop("__pid", "__mid", "__off")
