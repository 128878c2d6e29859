"""Tables kept by day, whose rows older than a term are deleted.

Rows lie in ``<root>/rows/kept_day=<UTC day>/kept_version=<n>``; the published state names the cut and the version that holds
the day of the cut.  Deletion rewrites that one day, publishes, and drops the folders of older days without reading them.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recsmith.operators.sequence import epoch_micros
from recsmith.sources import published

DAY, VERSION = "kept_day", "kept_version"
DAY_MICROS = 86_400_000_000


def _day(micros: Column) -> Column:
    return F.date_from_unix_date(((micros - F.pmod(micros, F.lit(DAY_MICROS))) / DAY_MICROS).cast("int"))


def _visible(state: dict) -> Column:
    """What a state holds, by partition columns alone."""
    if state["day"] is None:
        return F.col(VERSION) == 0
    day = F.lit(dt.date.fromisoformat(state["day"]))
    return ((F.col(DAY) > day) & (F.col(VERSION) == 0)) | ((F.col(DAY) == day) & (F.col(VERSION) == state["version"]))


def _rows(spark: SparkSession, root: str, state: dict) -> DataFrame:
    schema = T.StructType.fromJson(state["schema"]).add(DAY, T.DateType()).add(VERSION, T.IntegerType())
    return spark.read.schema(schema).parquet(f"{root}/rows").where(_visible(state))


def create(spark: SparkSession, root: str, schema: T.StructType, ts: str) -> None:
    """An empty table by the day of ``ts``; nothing happens where it exists."""
    if not published.states(spark, root):
        fs, place = published.file_system(spark, f"{root}/rows")
        fs.mkdirs(place)
        nullable = T.StructType([T.StructField(f.name, f.dataType) for f in schema])
        published.publish(spark, root, 0, {"schema": nullable.jsonValue(), "ts": ts, "cutoff": None, "day": None, "version": 0})


def write_days(df: DataFrame, root: str, replace: bool = False) -> None:
    """Add rows to their days, or with ``replace`` put them in the place of all rows of the days they hold, so that a load can
    be repeated.  Rows before the cut, and rows without a time, whose age nobody knows, are not taken.

    Rows are dealt by (day, time), so a day with a third of all rows is written by many tasks, and a task writes few days."""
    spark = df.sparkSession
    (_, state), = published.states(spark, root)
    micros = epoch_micros(df, state["ts"])
    kept = df.where(micros.isNotNull() if state["cutoff"] is None else micros >= state["cutoff"])
    version = F.lit(0) if state["day"] is None else F.when(F.col(DAY) == F.lit(dt.date.fromisoformat(state["day"])), state["version"]).otherwise(0)
    writer = (kept.withColumn(DAY, _day(micros)).withColumn(VERSION, version).repartitionByRange(DAY, state["ts"])
              .write.partitionBy(DAY, VERSION).mode("overwrite" if replace else "append"))
    writer.option("partitionOverwriteMode", "dynamic").parquet(f"{root}/rows")


def read(spark: SparkSession, root: str) -> DataFrame:
    """The rows of the newest state: only its folders are listed as input, whatever else lies there."""
    (_, state), = published.states(spark, root)
    return _rows(spark, root, state).drop(DAY, VERSION)


def expire(spark: SparkSession, root: str, as_of, days: int) -> bool:
    """Publish a state without the rows older than ``days`` before ``as_of``; False if the table is already cut there or later.

    Only the day of the cut is read and written, into a version of its own; a run that is lost before it publishes has changed nothing that
    is read, and the next one writes the same folder anew."""
    (number, state), = published.states(spark, root)
    ts_type = T.StructType.fromJson(state["schema"])[state["ts"]].dataType
    at = spark.range(1).select((F.lit(as_of).cast(ts_type) - F.make_interval(days=F.lit(days))).cast(ts_type).alias("at"))
    cutoff = at.select(epoch_micros(at, "at")).first()[0]
    if state["cutoff"] is not None and cutoff <= state["cutoff"]:
        return False
    day = dt.date(1970, 1, 1) + dt.timedelta(days=cutoff // DAY_MICROS)
    rows = _rows(spark, root, state).where(F.col(DAY) == F.lit(day))
    (rows.where(epoch_micros(rows, state["ts"]) >= cutoff).drop(DAY, VERSION)
     .write.mode("overwrite").parquet(f"{root}/rows/{DAY}={day}/{VERSION}={number + 1}"))
    published.publish(spark, root, number + 1, state | {"cutoff": cutoff, "day": day.isoformat(), "version": number + 1})
    return True


def sweep(spark: SparkSession, root: str, keep_states: int = 1) -> int:
    """Delete the folders that none of the newest ``keep_states`` states holds; returns how many.  Folders are listed, one a day, and no
    file is read.  A reader that began before the last cut needs 2: its files then stay until the next run."""
    held = [s for _, s in published.states(spark, root, keep_states)]
    gone = 0
    for folder in (n for n in published.names(spark, f"{root}/rows") if n.startswith(f"{DAY}=")):
        day = folder.removeprefix(f"{DAY}=")
        found = [n for n in published.names(spark, f"{root}/rows/{folder}") if n.startswith(f"{VERSION}=")]
        wanted = {f"{VERSION}={s['version'] if s['day'] == day else 0}" for s in held if s["day"] is None or day >= s["day"]}
        old = [n for n in found if n not in wanted]
        for name in ([""] if len(old) == len(found) else old):
            published.delete(spark, f"{root}/rows/{folder}/{name}".rstrip("/"))
        gone += len(old)
    published.forget(spark, root, keep_states)
    return gone


def retain(spark: SparkSession, root: str, as_of, days: int, keep_states: int = 1) -> int:
    """``expire``, then ``sweep``: also finishes what a lost run left."""
    expire(spark, root, as_of, days)
    return sweep(spark, root, keep_states)
