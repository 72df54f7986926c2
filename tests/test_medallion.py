"""Batch run: gates, publication and counters."""
import pytest
from pyspark.sql import functions as F

from tierflow.plans import medallion
from tierflow.sources import adapters

from data_dirs import SF001


def test_run_batch_publishes_layers_and_counts(spark, tmpdir_path):
    part = adapters.table(spark, SF001, "part")
    raw = adapters.dirty_raw_foods(part)
    users = adapters.users(adapters.table(spark, SF001, "customer"))
    out = medallion.run_batch(spark, raw, users, tmpdir_path + "/lake")
    c = out["counters"]
    assert c["bronze_rows"] == part.count() and c["silver_rows"] == part.count()
    assert c["gold_recommendation_rows"] == 10 * users.count()
    rep = out["report"]
    assert rep.filter(F.col("status") == "FAIL").count() == 0
    assert rep.select("stage").distinct().count() == 6


def test_gate_stops_bad_silver(spark, tmpdir_path):
    bad = spark.createDataFrame([("x", "1 g", "-5", "1", "1", "1", "1", "1", "1")],
                                "label string, weight string, calories string, protein string, "
                                "carbohydrates string, fats string, fiber string, sugars string, sodium string")
    users = adapters.users(adapters.table(spark, SF001, "customer"))
    with pytest.raises(ValueError, match="silver_post_transform"):
        medallion.run_batch(spark, bad, users, tmpdir_path + "/lake")
