"""Steps that a few tasks of a narrow scan, or a few hot names, must not hold alone."""

from decimal import Decimal

from pyspark.sql import functions as F

from tierflow.operators import quality as dq
from tierflow.operators import recommend as rec
from tierflow.plans import reports
from tierflow.sources import archive
from tierflow.streaming import store


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_distinct_keys_are_dealt_before_they_are_grouped(spark):
    rows = [(f"U{i}", i % 3) for i in range(50)] + [("U1", 1)] * 20 + [(None, 1)] * 2 + [(None, None)]
    df = spark.createDataFrame(rows, "a string, b int").coalesce(1)
    for nulls, want in ((True, 52), (False, 50)):
        got = dq.distinct_count(df, ["a", "b"], nulls, "n")
        assert got.first().n == want
    assert "REPARTITION_BY_NUM" in plan(got)  # not where they are read


def test_users_are_spread_before_they_get_their_foods(spark):
    users = spark.range(400).select(F.concat(F.lit("U"), "id").alias("user_id"), F.lit("weight_loss").alias("goal_type")).coalesce(1)
    top = spark.createDataFrame([("weight_loss", r) for r in range(10)], "goal_type string, recommendation_rank int")
    got = rec.recommend(rec.spread(users), None, top=top)
    assert got.count() == 4000 and got.select(F.spark_partition_id()).distinct().count() > 1


def test_newest_rows_are_dealt_by_key_before_they_are_grouped(spark):
    fields = [f.name for f in store.stored_schema("fact").fields]

    def row(user, rank, food, op, seq):
        own = {"user_id": user, "recommendation_rank": rank, "food_name": food, "op": op, "seq": seq}
        return tuple(own.get(f) for f in fields)
    rows = [row("a", 1, "old", "row", 1), row("a", 2, "gone", "row", 1), row("a", None, None, "refold", 2), row("a", 1, "new", "row", 2),
            row("b", 1, "x", "row", 1), row("b", 1, "y", "row", 3), row("c", 1, "z", "row", 1), row("c", None, None, "erase", 2), row(None, 1, "n", "row", 1)]
    got = store.newest(spark.createDataFrame(rows, store.stored_schema("fact")), "fact")
    assert {(r.user_id, r.food_name) for r in got.collect()} == {("a", "new"), ("b", "y"), (None, "n")}
    assert "REPARTITION_BY_NUM" in plan(got)


def test_searched_users_are_dealt_before_they_are_posted(spark):
    dim = spark.createDataFrame([(f"U{i:03d}", f"user_{i}", True) for i in range(30)] + [(None, "None", True), ("U999", None, False)],
                                "user_id string, user_name string, is_current boolean").coalesce(1)
    terms = spark.createDataFrame([("U00",), ("_2",), ("none",), (None,), ("zzz",)], "term string")
    got = reports.search_users_by_terms(dim, terms)
    want = {("u00", f"U{i:03d}") for i in range(10)} | {("_2", f"U{i:03d}") for i in (2, *range(20, 30))} | {("none", None)}
    assert {(r.term, r.user_id) for r in got.collect()} == want
    assert "REPARTITION_BY_NUM" in plan(got)


def test_a_name_with_many_rows_on_both_sides_is_cut_to_cells(spark, monkeypatch):
    monkeypatch.setattr(reports, "CELL_ROWS", 8)
    monkeypatch.setattr(reports, "CELL_PAIRS", 50)
    left = spark.createDataFrame([("hot", i) for i in range(120)] + [("few", 1), ("few", 1), ("none", 2), (None, 3)], "food_name string, u int")
    right = spark.createDataFrame([("hot", i % 30) for i in range(60)] + [("few", 7), ("other", 8), (None, 9)], "food_name string, f int")
    got = reports._by_cells(left, right, "food_name", 4)
    want = left.join(right, "food_name", "left")
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    per_task = [r["count"] for r in got.filter("food_name = 'hot'").groupBy(F.spark_partition_id()).count().collect()]
    assert sum(per_task) == 7200 and len(per_task) > 4 and max(per_task) < 3600  # on the name alone: one task


def test_archived_rows_are_hashed_once_and_summed_exactly(spark):
    values = [2**63 - 1] * 5 + [-2**63] * 3 + [-1, 0, 1, 2**32, -2**32 - 1]
    df = spark.createDataFrame([(v,) for v in values], "v long")
    assert df.agg(archive._exact_sum(F.col("v")).alias("s")).first().s == Decimal(sum(values))
    made = spark.range(300).select((F.col("id") % 100).cast("string").alias("a")).dropDuplicates().withColumn("b", F.upper("a"))
    source = archive._bucketed(made, 8)
    got = archive._of_buckets(source, [1, 5])
    assert sorted(map(str, got.collect())) == sorted(map(str, source.filter(F.col(archive.BUCKET).isin(1, 5)).select(*got.columns).collect()))
    assert "xxhash64" not in "".join(x for x in plan(got).split("\n") if "Filter" in x)  # not below the distinct
