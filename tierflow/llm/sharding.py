"""Resharding by minimum-cost flow: from the old shards' bytes and the new
shards' capacities, solve which bytes move so that the fewest move; give whole
blocks of documents to the flows; rewrite the files of the shards that change.

A block is the texts of one old shard with one text hash, so equal texts stay
together; a block larger than an eighth of a new shard's share is dealt
into pieces by a second hash of the text. Only a text whose own copies exceed a
shard's share (fewer such texts than shards can be) has its rows dealt one by one. The flow network and the table of blocks
have a size set by the parameters, not by the corpus.
"""

from __future__ import annotations

from collections import deque

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tierflow.llm.common import scratch, stage, width

SHARDS, OLD_SHARDS, BLOCKS, OVERHEAD = 40, 32, 256, 16
HEAVY, PIECE = 8, 16


def min_cost_flow(supply: list[int], capacity: list[int], cost) -> np.ndarray:
    """Flow (old, new) that carries all supply at the least total cost, by
    successive shortest augmenting paths. ``sum(capacity) >= sum(supply)``."""
    n, m = len(supply), len(capacity)
    flow = np.zeros((n, m), dtype=np.int64)
    left, room = list(map(int, supply)), list(map(int, capacity))
    while any(left):
        # shortest paths from all old shards with supply, over edges old->new and back along used ones
        dist, parent = {("o", i): 0 for i in range(n) if left[i]}, {}
        queue = deque(dist)
        while queue:
            side, x = node = queue.popleft()
            steps = [(("n", j), cost(x, j)) for j in range(m)] if side == "o" else [(("o", i), -cost(i, x)) for i in range(n) if flow[i, x]]
            for to, c in steps:
                if dist[node] + c < dist.get(to, 1 << 60):
                    dist[to] = dist[node] + c
                    parent[to] = node
                    queue.append(to)
        j = min((j for j in range(m) if room[j] and ("n", j) in dist), key=lambda j: dist["n", j])
        path, at = [], ("n", j)
        while at in parent:
            path.append((parent[at], at))
            at = parent[at]
        push = min([left[at[1]], room[j], *(int(flow[b[1], a[1]]) for a, b in path if a[0] == "n")])
        for a, b in path:
            if a[0] == "o":
                flow[a[1], b[1]] += push
            else:
                flow[b[1], a[1]] -= push
        left[at[1]] -= push
        room[j] -= push
    return flow


def place_blocks(blocks: list[tuple[int, int]], flow: np.ndarray, rounds: int = 20_000) -> list[int]:
    """New shard of each block (old shard, bytes): the largest blocks first, each
    to the flow of its old shard with most bytes left; then blocks go from the
    fullest to the emptiest shard while that evens them out."""
    quota = flow.astype(np.int64).copy()
    to = [0] * len(blocks)
    held = np.zeros(flow.shape[1], np.int64)
    of: list[set[int]] = [set() for _ in range(flow.shape[1])]
    for b in sorted(range(len(blocks)), key=lambda b: (-blocks[b][1], b)):
        old, size = blocks[b]
        j = int(np.argmax(quota[old]))
        quota[old, j] -= size
        held[j] += size
        to[b] = j
        of[j].add(b)
    for _ in range(rounds):
        hi, lo = int(held.argmax()), int(held.argmin())
        gap = int(held[hi] - held[lo])
        fit = [b for b in of[hi] if 0 < blocks[b][1] < gap]
        if not fit:
            break
        # of blocks that even out alike, one whose move brings it home, or does not take it from there
        b = min(fit, key=lambda b: (abs(2 * blocks[b][1] - gap), (blocks[b][0] != lo) - (blocks[b][0] != hi), b))
        of[hi].remove(b)
        of[lo].add(b)
        held[hi] -= blocks[b][1]
        held[lo] += blocks[b][1]
        to[b] = lo
    return to


def reshard(docs: DataFrame, old_shard: Column | None = None, old_shards: int = OLD_SHARDS, shards: int = SHARDS, id_col: str = "doc_id",
            text_col: str = "text", blocks: int = BLOCKS, out_path: str | None = None) -> DataFrame:
    """One row per row of ``docs``: id_col, size, text_crc32, law, shard, slot,
    grown_shard (null: the law is ``bytes``) and old_shard. The changed shards' rows
    are written as Parquet with id, text and slot to ``out_path`` (a new
    folder in the shared folder if none is given), one directory per shard, and read back; unchanged
    shards (no block comes or goes) are not rewritten.

    ``size`` is the text's UTF-8 bytes plus 16; slots run without gaps from 0 in
    each shard. A null text counts as empty but stays null in the files; null
    ids sort first. Equal texts share a shard unless they are too many bytes
    for one (see above); repeated rows and null ids are rows like others, and each takes a slot. Other columns are not carried. An empty
    table gives no rows.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col(text_col), F.lit(""))
    old = old_shard if old_shard is not None else F.pmod(F.crc32(text.cast("binary")), F.lit(old_shards))
    src = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), (F.octet_length(text) + OVERHEAD).cast("long").alias("size"),
                      F.crc32(text.cast("binary")).alias("text_crc32"), old.cast("int").alias("old"),
                      F.xxhash64(text).alias("text_hash"), F.xxhash64(F.lit(1), text).alias("text_hash2"))
    src = src.withColumn("block", F.pmod("text_hash", F.lit(blocks)).cast("int"))
    kept = src.drop("text")
    sums = [F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("rows")]
    coarse = [tuple(r) for r in kept.groupBy("old", "block").agg(*sums).collect()]  # old_shards * blocks rows at most
    total = sum(r[2] for r in coarse)
    share = max(1, total // shards)
    heavy = [(o, b, max(2, -(-n * PIECE // share))) for o, b, n, _ in coarse if n * HEAVY > share]  # at most shards * HEAVY rows
    split = F.broadcast(spark.createDataFrame(heavy, "old int, block int, pieces int"))
    fine = [(o, b, 0, n, k) for o, b, n, k in coarse if n * HEAVY <= share]
    dealt = src.join(split, ["old", "block"], "left").withColumn("piece", F.when(F.col("pieces").isNull(), 0).otherwise(F.pmod("text_hash2", "pieces")).cast("long"))
    if heavy:
        by_text = kept.join(split, ["old", "block"]).groupBy("old", "block", "text_hash", "text_hash2").agg(F.sum("size").alias("bytes"))
        wide = [tuple(r) for r in by_text.filter(F.col("bytes") > share).collect()]  # fewer than shards + 1 rows: each is above a share
        if wide:
            deal = [(h, g, (i + 1) << 32, -(-n * PIECE // share)) for i, (_, _, h, g, n) in enumerate(sorted(wide))]
            wide_texts = F.broadcast(spark.createDataFrame(deal, "text_hash long, text_hash2 long, base long, ways long"))
            # the rows' own numbers must not change between the two readings, so these rows are written down
            apart = stage(dealt.join(wide_texts, ["text_hash", "text_hash2"]).withColumn("nth", F.monotonically_increasing_id()), "wide")
            apart = apart.withColumn("piece", F.col("base") + F.pmod(F.xxhash64("nth"), F.col("ways"))).select(dealt.columns)
            dealt = dealt.join(wide_texts.select("text_hash", "text_hash2"), ["text_hash", "text_hash2"], "left_anti").select(dealt.columns).union(apart)
        fine += [tuple(r) for r in dealt.filter("pieces is not null").groupBy("old", "block", "piece").agg(*sums).collect()]
    fine.sort()
    supply = [sum(r[3] for r in fine if r[0] == i) for i in range(old_shards)]
    capacity = [total // shards + (j < total % shards) for j in range(shards)]
    to = place_blocks([(r[0], r[3]) for r in fine], min_cost_flow(supply, capacity, lambda i, j: int(i != j)))
    offset, table, changed = [0] * shards, [], {j for j in range(shards) if j >= old_shards}
    for r, j in zip(fine, to):
        table.append((r[0], r[1], r[2], j, offset[j]))
        offset[j] += r[4]
        if j != r[0]:
            changed |= {j, r[0]}
    plan = F.broadcast(spark.createDataFrame(table, "old int, block int, piece long, shard int, first long"))  # one row per block
    parts = max(1, -(-2 * width(spark) // shards))
    dealt = (dealt.join(plan, ["old", "block", "piece"])
             .withColumn("part", F.pmod(F.col("block") + F.col("piece"), F.lit(parts)).cast("int")))
    own = Window.partitionBy("shard", "part", "old", "block", "piece").orderBy(F.col("id").asc_nulls_first(), "text_crc32", "size")
    slots = dealt.repartition(width(spark), "shard", "part").withColumn("slot", F.col("first") + F.row_number().over(own) - 1)
    columns = ["id", "size", "text_crc32", "shard", "slot", "old"]
    moved = F.col("shard").isin(sorted(changed & set(range(shards))))
    path = out_path or scratch(spark, "shards")
    rows = slots.filter(moved).select("id", "text", "size", "text_crc32", "slot", "old", "shard")
    rows.write.partitionBy("shard").option("compression", "zstd").mode("overwrite").parquet(path)
    schema = rows.schema
    got = spark.read.schema(schema).parquet(path).select(columns)
    if len(changed & set(range(shards))) < shards:
        got = got.union(slots.filter(~moved).select(columns))
    return got.select(F.col("id").alias(id_col), "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                      F.lit(None).cast("int").alias("grown_shard"), F.col("old").alias("old_shard"))


def moved_bytes(placed: DataFrame, shards: int = SHARDS) -> DataFrame:
    """One row: total_bytes, moved_bytes (in another shard than before) and least_bytes (what any
    dealing into equal shards has to move, bytes taken as divisible)."""
    olds = placed.groupBy("old_shard").agg(F.sum("size").alias("bytes"), F.sum(F.when(F.col("shard") != F.col("old_shard"), F.col("size")).otherwise(0)).alias("moved"))
    total = F.sum("bytes").over(Window.partitionBy())  # a row an old shard
    capacity = F.when(F.col("old_shard") < shards, F.floor(total / shards) + (F.col("old_shard") < total % shards).cast("int")).otherwise(0)
    return (olds.withColumns({"least": F.greatest(F.col("bytes") - capacity, F.lit(0))})
            .agg(F.coalesce(F.sum("bytes"), F.lit(0)).alias("total_bytes"), F.coalesce(F.sum("moved"), F.lit(0)).alias("moved_bytes"),
                 F.coalesce(F.sum("least"), F.lit(0)).alias("least_bytes")))
