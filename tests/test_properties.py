"""Property tests (Hypothesis): column expressions against plain Python rules."""
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tierflow.functions import features

nums = st.one_of(st.none(), st.floats(min_value=-50, max_value=1000, allow_nan=False).map(lambda x: round(x, 2)))


def py_band(x, lo, hi):
    if x is None:
        return "high"
    return "low" if x < lo else ("medium" if x < hi else "high")


def py_goal(cur, tgt):
    if cur is None or tgt is None:
        return "maintenance"
    return "weight_loss" if tgt < cur else ("weight_gain" if tgt > cur else "maintenance")


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(nums, nums), min_size=1, max_size=60))
def test_band_and_goal_rules(spark, pairs):
    df = spark.createDataFrame(pairs, "a double, b double")
    out = df.select(features.band("a", 150, 300).alias("band"), features.goal_type("a", "b").alias("goal"),
                    features.flag((df.a >= 10) & (df.b <= 250)).alias("flag")).collect()
    for (a, b), r in zip(pairs, out):
        assert r.band == py_band(a, 150, 300)
        assert r.goal == py_goal(a, b)
        assert r.flag == (1 if a is not None and b is not None and a >= 10 and b <= 250 else 0)
