from pyspark.sql import functions as F

from recsmith import session
from recsmith.operators import features as FE


def _shuffle_files(spark):
    files = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().getAllFiles()
    return {files.apply(i).getName() for i in range(files.size()) if files.apply(i).getName().startswith("shuffle_")}


def test_a_stored_table_leaves_no_shuffle_files(spark):
    conf = spark.conf.get(session._DROP_SHUFFLES)
    before = _shuffle_files(spark)
    rows = spark.range(5000).withColumn("k", F.col("id") % 700)
    kept = session.materialize(rows.join(rows.groupBy("k").agg(F.max("id").alias("m")).hint("merge"), "k"))
    assert not _shuffle_files(spark) - before and spark.conf.get(session._DROP_SHUFFLES) == conf
    assert kept.count() == 5000 and kept.agg(F.sum(F.col("m") - F.col("id"))).first()[0] > 0


def test_passes_drop_what_the_one_before_has_stored(spark):
    """Of three passes over all rows only the last one's table stays, and the few busiest counts."""
    rows = spark.range(300).select((F.col("id") % 20).alias("user_id"), (F.col("id") % 13).alias("item_id"), (F.col("id") % 5).cast("double").alias("rating"),
                                   F.timestamp_seconds(F.col("id")).alias("timestamp"))
    with session.tables_made() as made:
        out = FE.statistics_as_of(rows)
    fs = spark._jvm.org.apache.hadoop.fs
    there = [p for p in made if fs.Path(p).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(fs.Path(p))]
    full = [p for p in there if spark.read.parquet(p).count() == 300 and "rating" in spark.read.parquet(p).columns]
    assert len(full) == 1 and len(there) < len(made)
    assert out.count() == 300 and out.agg(F.max("user_total_interactions")).first()[0] == 14


def test_tables_made_are_told_to_every_open_block(spark):
    with session.tables_made() as outer:
        a = session.materialize(spark.range(3))
        with session.tables_made() as inner:
            session.materialize(spark.range(4))
        with session.tables_made() as none:
            pass
    assert len(outer) == 2 and outer[1:] == inner and none == []
    session.drop_tables(spark, inner)
    assert a.count() == 3
