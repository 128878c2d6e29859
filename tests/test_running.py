import datetime as dt
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from recsmith.sources import published
from recsmith.streaming import running as R

T0 = dt.datetime(2024, 1, 1)
SCHEMA = "user_id long, item_id long, rating double, ts timestamp_ntz"


def _rows(part, n=60):
    """A third of all rows under user 1; odd rows beside them."""
    rows = [(1 if i % 3 == 0 else i % 7, i % 11, float(1 + (i * part) % 5), T0 + dt.timedelta(minutes=i + 100 * part)) for i in range(n)]
    return rows + [(None, 1, 2.0, T0), (8, None, None, None), rows[0]]


def _want(spark, parts, key, other):
    df = spark.createDataFrame([r for p in parts for r in _rows(p)], SCHEMA)
    out = df.groupBy(key).agg(F.count("rating").alias("n"), F.avg("rating").alias("m"), F.stddev_samp("rating").alias("s"), F.min("rating").alias("a"),
                              F.max("rating").alias("b"), F.min("ts").alias("f"), F.max("ts").alias("l"), F.count_distinct(F.col(other)).alias("p"))
    return _plain(out)


def _plain(df):
    return sorted((tuple(round(x, 9) if isinstance(x, float) else x for x in r) for r in df.collect()), key=str)


def _feed(spark, root, part):
    spark.createDataFrame(_rows(part), SCHEMA).coalesce(1).write.parquet(os.path.join(root, "in", f"p{part}"))


def _run(spark, root, key, other, every):
    stream = spark.readStream.schema(SCHEMA).parquet(os.path.join(root, "in", "*"))
    R.keep_running(stream, os.path.join(root, "out"), os.path.join(root, "ck"), key, "rating", "ts", other, every).awaitTermination()


@pytest.mark.parametrize("key,other", [("user_id", "item_id"), ("item_id", "user_id")])
def test_every_batch_counts_once(spark, key, other):
    root = tempfile.mkdtemp(prefix="recsmith-running-")
    out = os.path.join(root, "out")
    for part in range(5):
        _feed(spark, root, part)
        _run(spark, root, key, other, 2)
        assert _plain(R.read(spark, out, key)) == _want(spark, range(part + 1), key, other)
        assert len(published.names(spark, f"{out}/batches")) <= 3 and len(published.names(spark, f"{out}/base")) <= 2


@pytest.mark.parametrize("where", ["compaction", "publish", "after"])
def test_a_lost_batch_is_applied_once(spark, monkeypatch, where):
    """The writer is lost before the base, before the state, and after the state but before the stream's own record."""
    root = tempfile.mkdtemp(prefix="recsmith-lost-")
    out = os.path.join(root, "out")

    def apply(part):
        R.apply_batch(spark.createDataFrame(_rows(part), SCHEMA), part, out, "user_id", "rating", "ts", "item_id", 2)

    apply(0)
    before = R.read(spark, out, "user_id")

    def lost(*_, **__):
        raise RuntimeError("lost")

    if where == "after":
        apply(1)
    else:
        with monkeypatch.context() as m:
            m.setattr(*((R, "_merged") if where == "compaction" else (published, "publish")), lost)
            with pytest.raises(RuntimeError):
                apply(1)
        assert _plain(R.read(spark, out, "user_id")) == _want(spark, [0], "user_id", "item_id")  # what was written is not read
    apply(1)
    assert _plain(R.read(spark, out, "user_id")) == _want(spark, [0, 1], "user_id", "item_id")
    assert _plain(before) == _want(spark, [0], "user_id", "item_id")  # the former state's files are kept for one change
    apply(2)
    assert _plain(R.read(spark, out, "user_id")) == _want(spark, [0, 1, 2], "user_id", "item_id")
