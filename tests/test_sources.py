"""Readers, atomic publish, JSON envelope."""
from pyspark.sql import functions as F

from tierflow.sources import events as envelope
from tierflow.sources import files


def test_csv_readers(spark, tmpdir_path):
    p = tmpdir_path + "/foods.csv"
    with open(p, "w") as f:
        f.write("Label,Weight,Calories\n Apple ,100 g,\"1,200\"\nPear,n/a,n/a\n")
    raw = files.read_raw_foods(spark, p)
    assert all(t == "string" for _, t in raw.dtypes)
    u = tmpdir_path + "/users.csv"
    with open(u, "w") as f:
        f.write("user_id,user_name,gender,birth_date,height_cm,current_weight_lb,target_weight_lb\n"
                "U001,A,male,1990-01-01,170,200,180\nU002,B,female,not-a-date,x,150,160\n")
    rows = files.read_user_profiles(spark, u).orderBy("user_id").collect()
    assert rows[0].height_cm == 170.0 and rows[1].birth_date is None and rows[1].height_cm is None


def test_publish_is_atomic_by_pointer(spark, tmpdir_path):
    root = tmpdir_path + "/layer"
    v1 = files.publish(spark.range(3), root, "one")
    assert files.read_published(spark, root).count() == 3
    files.publish(spark.range(5), root, "two")
    assert files.current_version(spark, root) == "two" and v1 == "one"
    assert files.read_published(spark, root).count() == 5
    cat = files.catalogue(spark, {"t_a": spark.range(2), "t_b": spark.range(4)}).collect()
    assert sorted((r.table_name, r.row_count) for r in cat) == [("t_a", 2), ("t_b", 4)]
    assert spark.sql("select count(*) from t_b").first()[0] == 4


def test_envelope_roundtrip_and_malformed(spark):
    ev = spark.createDataFrame([(1, "create", "U1", "a", 170.0), (2, "delete", "U1", None, None)],
                               "event_id long, event_type string, user_id string, user_name string, height_cm double")
    enc = envelope.encode(ev)
    assert enc.filter(F.col("value").contains("user_name")).count() == 1  # nulls omitted
    bad = spark.createDataFrame([("{not json",)], "value string")
    dec = envelope.decode(enc.select("value").unionByName(bad))
    rows = {r.event_id: r for r in dec.collect()}
    assert rows[1].user_name == "a" and rows[2].user_name is None
    assert dec.filter("malformed").count() == 1
