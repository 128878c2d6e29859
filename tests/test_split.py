import datetime as dt
import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from recsmith.operators import split

T0 = dt.datetime(2024, 1, 1)


def _rows(n, seed, ties=5):
    rnd = random.Random(seed)
    return [(i % 7, rnd.randrange(50), float(rnd.randrange(1, 6)),
             None if rnd.random() < 0.05 else T0 + dt.timedelta(hours=rnd.randrange(ties))) for i in range(n)]


SCHEMA = "user_id long, item_id long, rating double, timestamp timestamp"


def test_global_index_matches_row_number(spark):
    df = spark.createDataFrame(_rows(300, 1), SCHEMA)
    order = split.sort_key(df, "timestamp")
    for parts in (1, 3, 7):
        got = split.with_global_index(df, order, "idx", "n", parts)
        want = df.withColumn("idx", F.row_number().over(Window.orderBy(*order)) - 1)
        assert sorted(map(str, got.drop("n").collect())) == sorted(map(str, want.collect()))
        assert {r.n for r in got.select("n").distinct().collect()} == {300}


def _pandas_split(rows, ratio, min_test):
    key = lambda r: (r[3] is None, r[3] or T0, r[0], r[1], r[2])  # NULL time last, then all columns
    ordered = sorted(rows, key=key)
    k = min(max(int(len(rows) * ratio), min_test), len(rows))
    return ordered[:len(rows) - k], ordered[len(rows) - k:]


def test_temporal_split_band_and_sizes(spark):
    rows = _rows(400, 2, ties=3)  # heavy ties at the cut
    df = spark.createDataFrame(rows, SCHEMA)
    for ratio, min_test in ((0.2, 0), (0.2, 1), (0.0, 0), (0.0, 1), (0.5, 0)):
        train, test = split.temporal_split(df, ratio, min_test)
        want_train, want_test = _pandas_split(rows, ratio, min_test)
        assert sorted(map(str, map(tuple, test.collect()))) == sorted(map(str, want_test))
        assert sorted(map(str, map(tuple, train.collect()))) == sorted(map(str, want_train))


def test_split_tiny_tables(spark):
    rows = [(1, i, 1.0, T0 + dt.timedelta(minutes=i)) for i in range(5)]
    df = spark.createDataFrame(rows, SCHEMA)
    train, test = split.temporal_split(df, 0.2, 0)
    assert [r.item_id for r in test.collect()] == [4]
    train, test = split.temporal_split(df.limit(3), 0.2, 0)  # int(0.6) = 0: all rows train
    assert test.count() == 0 and train.count() == 3
    train, test = split.temporal_split(df.limit(3), 0.2, 1)
    assert test.count() == 1


def test_low_accuracy_still_exact(spark):
    rows = _rows(500, 3, ties=40)
    df = spark.createDataFrame(rows, SCHEMA)
    flagged = split.flag_temporal_split(df, 0.3, 0, accuracy=20)
    _, want_test = _pandas_split(rows, 0.3, 0)
    got = sorted(str(tuple(r[:4])) for r in flagged.where("is_test").collect())
    assert got == sorted(map(str, want_test))


def test_hash_split_is_stable(spark):
    df = spark.range(1000).withColumnRenamed("id", "user_id")
    a, b = split.hash_split(df, ["user_id"], 0.8)
    a2, _ = split.hash_split(df.repartition(7), ["user_id"], 0.8)
    assert a.count() + b.count() == 1000
    assert sorted(r[0] for r in a.collect()) == sorted(r[0] for r in a2.collect())


def test_random_split_is_seeded_and_complete(spark):
    df = spark.range(2000)
    a, b = split.random_split(df, 0.8, seed=42)
    a2, _ = split.random_split(df, 0.8, seed=42)
    assert a.count() + b.count() == 2000 and 1400 < a.count() < 1800
    assert sorted(r.id for r in a.collect()) == sorted(r.id for r in a2.collect())
