"""Helpers shared by the training-data operators."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from recsmith.session import materialize

#: The white space that ends a word in every operator contract here: space and TAB..CR.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"

Query = Callable[[SparkSession, str], DataFrame]


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_or_empty(text: Column) -> Column:
    return F.coalesce(text, F.lit(""))


def training_row(doc_id: Column) -> Column:
    """True where labels may be learned from: crc32 of the id as text is not divisible by 5 (never for a NULL id)."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 != 0, F.lit(False))


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


def in_slices(batches: Iterator[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """Arrow batches cut into small ones: a worker turns few texts at a time into Python strings."""
    for b in batches:
        for at in range(0, len(b), rows):
            yield b.slice(at, rows)


_tables: dict[str, dict] = {}  # of this worker process, by operator


def worker_tables(owner: str) -> dict:
    """What the operator keeps in this worker process from task to task.  Workers serve every stage of an application, so what
    other operators have kept goes, and its memory returns to the system before this one takes its own."""
    others = [k for k in _tables if k != owner]
    if others:
        for k in others:
            del _tables[k]
        gc.collect()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc keeps freed memory otherwise
        if trim is not None:
            trim(0)
    return _tables.setdefault(owner, {})


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Components of an undirected graph: edges (a long, b long) -> (node, root), root the smallest id reachable.

    Alternating large-star and small-star steps: each is a grouped minimum (combined on the map side)
    and an equi-join, so a hub with a third of the edges is only ever reduced to one number.  Every round is
    written to the shared checkpoint folder, which cuts lineage.  Only nodes that have an edge are returned.
    Empty edges give an empty table; loops (a = b) and NULL ends are ignored; repeated edges are harmless.
    """
    cur = materialize(edges.where(F.col("a") != F.col("b"))
                      .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    seen = _fingerprint(cur)
    for _ in range(max_rounds):
        if seen[0] == 0:
            break
        both = cur.unionByName(cur.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
        large = (both.join(low, "u").where((F.col("v") > F.col("u")) & (F.col("v") != F.col("m")))
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        large = materialize(large)
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low, "u").where(F.col("v") != F.col("m"))
                 .select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(low.select("u", F.col("m").alias("v"))).distinct())
        cur = materialize(small)
        now = _fingerprint(cur)
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    roots = cur.groupBy("u").agg(F.min("v").alias("root")).select(F.col("u").alias("node"), "root")
    return roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())


def _fingerprint(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return row[0], row[1]
