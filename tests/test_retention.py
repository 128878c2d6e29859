import datetime as dt
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from recsmith.operators import retention as R
from recsmith.sources import published

T0 = dt.datetime(2024, 1, 1)
SCHEMA = "id long, ts timestamp_ntz, kept long"


def _at(hours):
    return T0 + dt.timedelta(hours=hours)


def _table(spark, rows, ts_type="timestamp_ntz"):
    root = os.path.join(tempfile.mkdtemp(prefix="recsmith-retention-"), "table")
    df = spark.createDataFrame(rows, SCHEMA).withColumn("ts", F.col("ts").cast(ts_type))
    R.create(spark, root, df.schema, "ts")
    R.write_days(df, root)
    return root


def _ids(spark, root):
    return sorted(r.id for r in R.read(spark, root).collect())


def _files(root):
    return sorted(os.path.relpath(os.path.join(d, f), root) for d, _, fs in os.walk(os.path.join(root, "rows"))
                  for f in fs if f.endswith(".parquet"))


HOURS = [0, 1, 23, 24, 25, 47, 48, 49, 72, 100]
ROWS = [(i, _at(h), 1) for i, h in enumerate(HOURS)]


@pytest.mark.parametrize("ts_type", ["timestamp_ntz", "timestamp"])
def test_old_days_are_gone(spark, ts_type):
    """Whole days go as folders, the day of the cut is rewritten, a row exactly at the cut stays, a repeat changes nothing."""
    root = _table(spark, ROWS + [(99, None, 1)], ts_type)
    assert _ids(spark, root) == list(range(10))  # a row without a time is not taken
    R.retain(spark, root, _at(25 + 24).isoformat(sep=" "), 1)
    assert _ids(spark, root) == [4, 5, 6, 7, 8, 9]
    files = _files(root)
    assert not any("2024-01-01" in f for f in files)
    assert {f.split("/")[2] for f in files if "2024-01-02" in f} == {"kept_version=1"}
    raw = spark.read.parquet(os.path.join(root, "rows"))
    assert sorted(r.id for r in raw.collect()) == [4, 5, 6, 7, 8, 9]  # nothing old lies there unread
    assert R.retain(spark, root, _at(25 + 24).isoformat(sep=" "), 1) == 0
    assert R.retain(spark, root, _at(24).isoformat(sep=" "), 1) == 0  # an earlier cut brings nothing back and takes nothing
    assert _files(root) == files and _ids(spark, root) == [4, 5, 6, 7, 8, 9]
    R.retain(spark, root, _at(1000).isoformat(sep=" "), 1)
    assert _ids(spark, root) == [] and R.read(spark, root).columns == ["id", "ts", "kept"]


def test_rows_that_come_after_a_cut(spark):
    root = _table(spark, ROWS)
    R.retain(spark, root, _at(49).isoformat(sep=" "), 1)
    late = spark.createDataFrame([(20, _at(24), 1), (21, _at(30), 1), (22, _at(200), 1)], SCHEMA)
    R.write_days(late, root)  # before the cut, on its day, and later
    assert _ids(spark, root) == [4, 5, 6, 7, 8, 9, 21, 22]
    R.retain(spark, root, _at(24 + 48.5).isoformat(sep=" "), 1)
    assert _ids(spark, root) == [7, 8, 9, 22]


def test_a_load_can_be_repeated(spark):
    root = _table(spark, ROWS)
    day = spark.createDataFrame([(30, _at(26), 1), (31, _at(27), 1)], SCHEMA)
    for _ in range(2):
        R.write_days(day, root, replace=True)
        assert _ids(spark, root) == [0, 1, 2, 6, 7, 8, 9, 30, 31]


def test_a_reader_sees_one_state(spark, monkeypatch):
    """Before the state is published a reader sees all rows; a lost run is finished by the next; a reader of the former state
    keeps its files with ``keep_states=2``."""
    root = _table(spark, ROWS)
    before = R.read(spark, root)

    def lost(*_):
        assert _ids(spark, root) == list(range(10))  # the rewritten day lies beside the old one
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(published, "publish", lost)
        with pytest.raises(RuntimeError):
            R.retain(spark, root, _at(49).isoformat(sep=" "), 1)
    assert _ids(spark, root) == list(range(10))
    assert R.retain(spark, root, _at(49).isoformat(sep=" "), 1, keep_states=2) == 0
    assert _ids(spark, root) == [4, 5, 6, 7, 8, 9]
    assert sorted(r.id for r in before.collect()) == list(range(10))
    assert R.sweep(spark, root) == 2  # the first day and the old version of the second
    assert _ids(spark, root) == [4, 5, 6, 7, 8, 9]


def test_a_number_is_published_once(spark):
    root = _table(spark, [])
    assert _ids(spark, root) == []
    with pytest.raises(RuntimeError):
        published.publish(spark, root, 0, {})


def test_a_read_lists_only_its_days(spark):
    root = _table(spark, ROWS)
    R.expire(spark, root, _at(49).isoformat(sep=" "), 1)
    files = R.read(spark, root).select(F.col("_metadata.file_path").alias("f")).distinct().collect()
    assert not any("2024-01-01" in r.f for r in files) and not any("2024-01-02/kept_version=0" in r.f for r in files)
