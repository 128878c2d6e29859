"""Session helpers.

Library functions never create a session; they take the caller's.  These
helpers exist for tests, the bench and the CLI-style plans.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app_name: str = "recsmith", extra: dict | None = None) -> SparkSession:
    """A local session for tests and the bench (never used on a cluster)."""
    builder = (SparkSession.builder.master(f"local[{cores}]").appName(app_name)
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
               .config("spark.driver.memory", os.environ.get("RECSMITH_DRIVER_MEMORY", "16g")))
    for k, v in {**DEFAULT_CONF, **(extra or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's checkpoint directory.

    On a cluster ``spark.checkpoint.dir`` names a shared folder and is used as
    is.  Only when it is unset (local tests) a scratch folder is created.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
        return conf_dir
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    local_dir = tempfile.mkdtemp(prefix="recsmith-ckpt-")
    sc.setCheckpointDir(local_dir)
    return local_dir


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def tables_folder(spark: SparkSession) -> str:
    """The folder of this application's stored tables and files; ``drop_materialized`` deletes it."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/tables/{spark.sparkContext.applicationId}"


#: Makes Spark delete the shuffle files of a query at its end; it keeps them until the driver's collector finds them unused otherwise.
_DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_made: list[list[str]] = []  # the open ``tables_made``


@contextmanager
def _shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    before = spark.conf.get(_DROP_SHUFFLES, "false")
    spark.conf.set(_DROP_SHUFFLES, "true")
    try:
        yield
    finally:
        spark.conf.set(_DROP_SHUFFLES, before)


@contextmanager
def tables_made() -> Iterator[list[str]]:
    """The paths of the tables materialized inside, for ``drop_tables`` once nothing reads them any more."""
    paths: list[str] = []
    _made.append(paths)
    try:
        yield paths
    finally:
        _made.pop()  # they are nested


def materialize(df):
    """Cut lineage of a table read by several later steps.

    The table is written as Parquet under the shared ``spark.checkpoint.dir``
    (never a machine-local folder on a cluster, never a local checkpoint) and read
    back, so later scans get column pruning and filter pushdown and a lost
    executor does not recompute the lineage.  Tables live in a folder of the application; the job that
    owns it drops them at its end by ``drop_materialized``.  The shuffle files of the write go with it: nothing else reads them.
    """
    path = f"{tables_folder(df.sparkSession)}/{uuid.uuid4().hex}"
    with _shuffles_dropped(df.sparkSession):
        df.write.mode("overwrite").parquet(path)
    for paths in _made:
        paths.append(path)
    return df.sparkSession.read.parquet(path)


def drop_materialized(spark: SparkSession) -> None:
    """Delete every table this application has materialized; results that still read them become invalid."""
    drop_tables(spark, [tables_folder(spark)])


def drop_tables(spark: SparkSession, paths: list[str]) -> None:
    for p in paths:
        path = spark._jvm.org.apache.hadoop.fs.Path(p)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
