"""Running statistics of a key (users, items) kept as mergeable states, without a stream state store.

A micro-batch is reduced to one state a key (count, sums, bounds, a distinct sketch) and written into a folder of its own; readers merge
the folders of the published state.  Every ``compact_every`` batches all folders are merged into one base, and the state that names the base
takes their place at once, so a reader never scans more than the base and that many batches.  The stream is the table's one writer.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recsmith.sources import published

#: How two states of a key become one.
_MERGE = {"n": F.sum, "total": F.sum, "squares": F.sum, "low": F.min, "high": F.max, "first": F.min, "last": F.max,
          "partners": F.hll_union_agg}


def batch_states(rows: DataFrame, key: str, value: str, ts: str, other: str) -> DataFrame:
    """One state a key of these rows, combined on the map side.  Rows with a NULL key make a key of their own; NULL values, times and
    partners count for nothing."""
    v = F.col(value).cast("double")
    return rows.groupBy(key).agg(
        F.count(v).alias("n"), F.sum(v).alias("total"), F.sum(v * v).alias("squares"), F.min(v).alias("low"), F.max(v).alias("high"),
        F.min(ts).alias("first"), F.max(ts).alias("last"), F.hll_sketch_agg(F.col(other).cast("string")).alias("partners"))


def _merged(states: DataFrame, key: str) -> DataFrame:
    return states.groupBy(key).agg(*[how(c).alias(c) for c, how in _MERGE.items()])


def _stored(spark: SparkSession, root: str, state: dict) -> DataFrame:
    schema = T.StructType.fromJson(state["schema"])
    batches = spark.read.schema(T.StructType([*schema.fields, T.StructField("batch", T.LongType())])).parquet(f"{root}/batches")
    newer = batches.where((F.col("batch") > state["upto"]) & (F.col("batch") <= state["applied"])).drop("batch")
    return newer if state["base"] is None else spark.read.schema(schema).parquet(f"{root}/{state['base']}").unionByName(newer)


def apply_batch(rows: DataFrame, batch_id: int, root: str, key: str, value: str, ts: str, other: str, compact_every: int = 16) -> None:
    """Add one micro-batch.  A batch that comes again after it was published is left out; one that was lost before is written anew.

    Folders that neither this state nor the one before it holds are deleted, so a reader may go on over one change of state."""
    spark = rows.sparkSession
    known = published.states(spark, root)
    number, state = known[-1] if known else (-1, {"base": None, "upto": -1, "applied": -1})
    if batch_id <= state["applied"]:
        return
    new = batch_states(rows, key, value, ts, other)
    new.write.mode("overwrite").parquet(f"{root}/batches/batch={batch_id}")
    state = state | {"schema": T.StructType([T.StructField(f.name, f.dataType) for f in new.schema]).jsonValue(), "applied": batch_id}
    if batch_id - state["upto"] >= compact_every:
        base = f"base/{batch_id}"
        _merged(_stored(spark, root, state), key).write.mode("overwrite").parquet(f"{root}/{base}")
        state = state | {"base": base, "upto": batch_id}
    published.publish(spark, root, number + 1, state)
    held = [s for _, s in published.states(spark, root, 2)]
    for name in published.names(spark, f"{root}/batches"):
        if name.startswith("batch=") and int(name.removeprefix("batch=")) <= min(s["upto"] for s in held):
            published.delete(spark, f"{root}/batches/{name}")
    for name in published.names(spark, f"{root}/base"):
        if f"base/{name}" not in {s["base"] for s in held}:
            published.delete(spark, f"{root}/base/{name}")
    published.forget(spark, root, 2)


def keep_running(stream: DataFrame, root: str, checkpoint: str, key: str, value: str, ts: str, other: str, compact_every: int = 16,
                 trigger_once: bool = True):
    """The stream that keeps the table: start it again from its checkpoint after a loss."""
    def step(rows: DataFrame, batch_id: int) -> None:
        apply_batch(rows, batch_id, root, key, value, ts, other, compact_every)

    writer = stream.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if trigger_once else writer).start()


def read(spark: SparkSession, root: str, key: str) -> DataFrame:
    """Statistics of every key in the newest state (A1 / A2 columns); ``partners`` is the sketch's estimate."""
    (_, state), = published.states(spark, root)
    s = _merged(_stored(spark, root, state), key)
    spread = F.greatest(F.col("squares") - F.col("total") * F.col("total") / F.col("n"), F.lit(0.0)) / (F.col("n") - 1)
    return s.select(key, F.col("n").alias("rating_count"), F.when(F.col("n") > 0, F.col("total") / F.col("n")).alias("rating_mean"),
                    F.when(F.col("n") > 1, F.sqrt(spread)).alias("rating_std"), F.col("low").alias("rating_min"), F.col("high").alias("rating_max"),
                    F.col("first").alias("timestamp_min"), F.col("last").alias("timestamp_max"), F.hll_sketch_estimate("partners").alias("partners"))
