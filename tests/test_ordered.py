"""Blocked ordered scans equal plain per-key windows."""
import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from tierflow.operators import ordered
from tierflow.operators.ordered import ordered_scan, time_block


def _frame(spark, n_keys=7, n=600, seed=3, hot=True):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        # one hot key holds about a third of the rows
        k = "hot" if hot and rnd.random() < 0.34 else f"k{rnd.randrange(n_keys)}"
        v = None if rnd.random() < 0.3 else rnd.randrange(100)
        rows.append((k, i * 3 + rnd.randrange(3), v, float(rnd.randrange(5))))
    return spark.createDataFrame(rows, "k string, o long, v int, w double")


def test_blocked_scan_matches_window(spark):
    df = _frame(spark)
    got = ordered_scan(df, ["k"], ["o"], block_size=16, row_number="rn",
                       running_sum={"rs": "w"}, key_sum={"ks": "w"},
                       lead={"ld": "v"}, lag={"lg": "v"}, carry={"cy": "v"})
    w = Window.partitionBy("k").orderBy("o")
    exp = df.select("*", F.row_number().over(w).cast("long").alias("rn"),
                    F.sum("w").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("rs"),
                    F.sum("w").over(Window.partitionBy("k")).alias("ks"),
                    F.lead("v").over(w).alias("ld"), F.lag("v").over(w).alias("lg"),
                    F.last("v", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("cy"))
    cols = ["k", "o", "v", "w", "rn", "rs", "ks", "ld", "lg", "cy"]
    assert sorted(got.select(*cols).collect()) == sorted(exp.select(*cols).collect())


def test_hot_key_is_split_into_blocks(spark):
    df = _frame(spark)
    s = ordered_scan(df, ["k"], ["o"], block_size=16, row_number="rn", keep_block=True)
    blocks = s.filter(F.col("k") == "hot").select("__blk").distinct().count()
    assert blocks > 5
    biggest = s.groupBy("k", "__blk").count().agg(F.max("count")).first()[0]
    assert biggest <= 16


def test_time_blocks_and_struct_lead(spark):
    rows = [("u", f"2024-01-{d:02d} 0{h}:00:00", d * 10 + h) for d in range(1, 20) for h in range(3)]
    df = spark.createDataFrame(rows, "u string, t string, x int").withColumn("t", F.col("t").cast("timestamp_ntz"))
    got = ordered_scan(df, ["u"], ["t"], block=time_block("t", 3 * 86400), row_number="rn",
                       lead={"nx": F.struct("x", "t")})
    w = Window.partitionBy("u").orderBy("t")
    exp = df.select("*", F.row_number().over(w).cast("long").alias("rn"),
                    F.lead(F.struct("x", "t")).over(w).alias("nx"))
    assert sorted(got.collect()) == sorted(exp.select(*got.columns).collect())


def test_range_blocks_match_window(spark):
    df = _frame(spark, n=900, seed=9)
    got = ordered_scan(df, ["k"], ["o"], block="range", row_number="rn", lead={"ld": "v"},
                       carry={"cy": "v"}, keep_block=True)
    w = Window.partitionBy("k").orderBy("o")
    exp = df.select("*", F.row_number().over(w).cast("long").alias("rn"), F.lead("v").over(w).alias("ld"),
                    F.last("v", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("cy"))
    cols = ["k", "o", "v", "w", "rn", "ld", "cy"]
    assert sorted(got.select(*cols).collect()) == sorted(exp.select(*cols).collect())
    assert got.filter(F.col("k") == "hot").select("__blk").distinct().count() > 1


def test_sketched_blocks_cut_hot_keys_only(spark):
    rows = [("hot", i * i, i % 3) for i in range(3000)] + [(f"u{i % 500}", i, i % 5) for i in range(2000)] + [("null", None, 1), ("null", 4, 2)]
    df = spark.createDataFrame(rows, "k string, t long, x int").repartition(7)
    edges = {r.k: r["__edges"] for r in ordered.hot_key_edges(df, ["k"], ordered.order_value(df, "t")).collect()}
    assert list(edges) == ["hot"] and edges["hot"] == sorted(set(edges["hot"])) and 3 <= len(edges["hot"]) <= 8
    got = ordered.ordered_scan(df, ["k"], ["t", "x"], block="sketch", row_number="n", running_sum={"s": "x"}, lag={"before": "t"}, keep_block=True)
    blocks = {(r.k, r["__blk"]) for r in got.collect()}
    assert len([b for b in blocks if b[0] == "hot"]) == len(edges["hot"]) + 1 and len([b for b in blocks if b[0] == "u1"]) == 1
    w = Window.partitionBy("k").orderBy("t", "x")
    want = df.select("*", F.row_number().over(w).cast("long").alias("n"), F.sum("x").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("s"), F.lag("t").over(w).alias("before"))
    cols = ["k", "t", "x", "n", "s", "before"]
    # repeated (k, t, x) rows differ in nothing but their number, so both sides hold the same rows
    assert sorted(map(str, got.select(cols).collect())) == sorted(map(str, want.select(cols).collect()))
    same = spark.createDataFrame([("a", 5, 1)] * 40, "k string, t long, x int")  # one value: one block
    assert {r.n for r in ordered.ordered_scan(same, ["k"], ["t"], block="sketch", row_number="n").collect()} == set(range(1, 41))
    assert ordered.ordered_scan(df.limit(0), ["k"], ["t"], block="sketch", row_number="n").count() == 0
