"""A table's state as small numbered files, so that a reader sees one state and a writer changes all of it at once.

``<root>/state/00000007.json`` names what belongs to state 7.  It is written beside its place and renamed, so a reader finds a
whole file or none; the newest number holds.  A table has one writer at a time.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import SparkSession


def file_system(spark: SparkSession, path: str):
    """Hadoop's file system of a path, and the path."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), place


def names(spark: SparkSession, folder: str) -> list[str]:
    """The names in a folder, none if it is absent."""
    fs, place = file_system(spark, folder)
    return sorted(s.getPath().getName() for s in fs.listStatus(place)) if fs.exists(place) else []


def delete(spark: SparkSession, path: str) -> None:
    fs, place = file_system(spark, path)
    fs.delete(place, True)


def _numbers(spark: SparkSession, root: str) -> list[int]:
    return [int(n.removesuffix(".json")) for n in names(spark, f"{root}/state") if n.endswith(".json") and not n.startswith(("_", "."))]


def states(spark: SparkSession, root: str, newest: int = 1) -> list[tuple[int, dict]]:
    """The newest states, oldest first: ``(number, content)``."""
    return [(n, json.loads(spark.read.text(f"{root}/state/{n:08d}.json", wholetext=True).first()[0]))
            for n in _numbers(spark, root)[-newest:]]


def publish(spark: SparkSession, root: str, number: int, content: dict) -> None:
    """Make ``content`` state ``number``; refused if that number exists."""
    fs, place = file_system(spark, f"{root}/state/{number:08d}.json")
    _, beside = file_system(spark, f"{root}/state/_{uuid.uuid4().hex}")
    if fs.exists(place):
        raise RuntimeError(f"state {number} of {root} has been published by another writer")
    out = fs.create(beside)
    out.write(bytearray(json.dumps(content).encode()))
    out.close()
    if not fs.rename(beside, place):
        raise RuntimeError(f"state {number} of {root} could not be published")


def forget(spark: SparkSession, root: str, keep: int) -> None:
    """Delete the state files older than the newest ``keep``."""
    for n in _numbers(spark, root)[:-keep]:
        delete(spark, f"{root}/state/{n:08d}.json")
