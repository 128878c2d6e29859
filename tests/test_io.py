import datetime as dt
import os
import tempfile

from recsmith.sources import io


def test_csv_round_trip_with_schema(spark):
    root = tempfile.mkdtemp(prefix="recsmith-io-")
    p = os.path.join(root, "interactions.csv")
    with open(p, "w") as f:
        f.write("user_id,item_id,interaction_type,rating,timestamp,session_id,device_type,duration_seconds\n")
        f.write("u1,i1,watch,4.5,2024-01-02T03:04:05,s1,mobile,120\n")
        f.write("u2,i2,view,,2024-01-03T00:00:00,s2,desktop,\n")
    t = io.load_tables(spark, p)
    rows = t["interactions"].orderBy("user_id").collect()
    assert rows[0].timestamp == dt.datetime(2024, 1, 2, 3, 4, 5) and rows[1].rating is None
    assert t["users"].count() == 0 and t["items"].columns[0] == "item_id"


def test_recommendations_round_trip(spark):
    root = tempfile.mkdtemp(prefix="recsmith-recs-")
    recs = spark.createDataFrame([("u1", 2, "b"), ("u1", 1, "a"), ("u2", 1, "c")],
                                 "user_id string, rank long, item_id string")
    io.save_recommendations(recs, os.path.join(root, "r"))
    back = io.load_recommendations(spark, os.path.join(root, "r"))
    assert sorted(back.collect()) == sorted(recs.collect())
    with open(os.path.join(root, "map.json"), "w") as f:
        f.write('{"u1": ["a", "b"], "u2": ["c"]}')
    assert sorted(io.load_recommendation_map(spark, os.path.join(root, "map.json")).collect()) == \
        sorted(recs.collect())


def test_log_append_and_metrics(spark):
    root = tempfile.mkdtemp(prefix="recsmith-log-")
    now = dt.datetime(2024, 1, 1)
    io.append_request_log(spark, os.path.join(root, "log"), [("u1", 10, 12.5, now)])
    io.append_request_log(spark, os.path.join(root, "log"), [("u2", 5, 30.0, now)])
    assert spark.read.parquet(os.path.join(root, "log")).count() == 2
    m = spark.createDataFrame([("recall", 10, 0.5)], "metric string, k long, value double")
    io.save_metrics(m, os.path.join(root, "m"))
    assert spark.read.json(os.path.join(root, "m", "json")).count() == 1


def test_corrupt_rows_are_counted(spark, tmp_path):
    (tmp_path / "i.csv").write_text("user_id,item_id,interaction_type,rating,timestamp,session_id,device_type,duration_seconds\n"
                                    "u1,i1,view,4.0,2024-01-01T00:00:00,s,,\nu1,i2,view,bad,2024-01-01T00:00:00,s,,\n")
    row = io.corrupt_rows(spark, str(tmp_path / "i.csv"), "interactions").first()
    assert (row.n_rows, row.n_corrupt) == (2, 1)
    assert io.read_table(spark, str(tmp_path / "i.csv"), "interactions").where("rating IS NULL").count() == 1


def test_materialized_tables_can_be_dropped(spark):
    from recsmith.session import drop_materialized, ensure_checkpoint_dir, materialize
    assert materialize(spark.range(5)).count() == 5
    folder = os.path.join(ensure_checkpoint_dir(spark).removeprefix("file:"), "tables", spark.sparkContext.applicationId)
    assert os.listdir(folder)
    drop_materialized(spark)
    assert not os.path.exists(folder)
