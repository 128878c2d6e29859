"""Exact top-k inner products by descending length with rotated partial sums.

Vectors are dealt into slices by descending length.  All are rotated by the right singular vectors of the whole table (from the
summed Gram matrix), which puts most of an inner product into the first coordinates.  For a query, a slice can hold a
better score only if |query| * (longest of the slice) reaches the query's k-th best score so far; inside a slice a
vector survives only if its partial sum over the leading coordinates plus the product of the residual lengths (Cauchy-Schwarz)
reaches it.  Survivors are scored exactly in whole numbers, so the bounds only ever save work.

A first pass over the slice of the longest vectors gives each query its starting bar.  Then queries, in blocks, meet
the slices that can still matter.  Queries are spread over as many (block, slice) groups as needed; a group holds at
most a block of queries and a slice of vectors, whatever the table's size, and yields k rows a query.

Defined cases: vectors that are NULL or hold NULL or non-finite components take no part, as query or as candidate; vectors of
different lengths (dimensions) have no inner product and are not compared; rows with a NULL id take no part; rows that repeat
an id are candidates each, but never for a query with that id; an id that is queried by several rows keeps its best
rows over all of them; fewer than k candidates give as many rows; an empty table gives an empty result; further columns are
ignored.  Scores beyond the long range raise an error.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from recsmith.llm.common import read_table
from recsmith.operators.split import with_global_index
from recsmith.session import materialize

K, SCALE, QUERY_STEP = 5, 256, 50
SLICE, BLOCK, LEAD = 16384, 8192, 16
_EXACT = 2.0 ** 53


def scaled(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """vectors (vec_id, embedding, ..) -> vec_id, v array<double> of floor(scale * x), dim, norm; unusable rows go."""
    x = F.col("embedding")
    fine = F.col("vec_id").isNotNull() & x.isNotNull() & (F.size(x) > 0) & F.forall(
        x, lambda c: F.coalesce(~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))), F.lit(False)))
    v = F.transform(x, lambda c: F.floor(F.lit(float(scale)) * c.cast("double")).cast("double"))
    out = vectors.where(fine).select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v"))
    square = F.aggregate("v", F.lit(0.0), lambda s, c: s + c * c)
    return out.select("vec_id", "v", F.size("v").alias("dim"), F.sqrt(square).alias("norm"))


def _rows(column) -> np.ndarray:
    return np.stack(column.to_numpy()).astype(np.float64)


def rotations(rows: DataFrame) -> dict[int, np.ndarray]:
    """Right singular vectors by dimension, from one summed Gram matrix a dimension (dim squared numbers)."""
    def gram(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for b in batches:
            dims = np.asarray(b.column(1))
            for d in np.unique(dims):
                x = np.asarray(b.column(0).filter(pa.array(dims == d)).flatten(), np.float64).reshape(-1, d)
                sums[int(d)] = sums.get(int(d), 0) + x.T @ x
        yield pa.RecordBatch.from_pydict({"dim": pa.array(list(sums), pa.int32()),
                                          "gram": pa.array([g.tobytes() for g in sums.values()], pa.binary())})

    def add(pdf: pd.DataFrame) -> pd.DataFrame:
        total = sum(np.frombuffer(g) for g in pdf["gram"])
        return pd.DataFrame({"dim": [pdf["dim"].iloc[0]], "gram": [total.tobytes()]})

    parts = rows.select("v", "dim").mapInArrow(gram, "dim int, gram binary")
    some = parts.withColumn("s", F.spark_partition_id() % 16)  # partial sums meet in 16 groups a dimension, then in one
    parts = some.groupBy("dim", "s").applyInPandas(add, "dim int, gram binary").groupBy("dim").applyInPandas(add, "dim int, gram binary")
    out = {}
    for r in parts.toLocalIterator():
        g = np.frombuffer(r["gram"]).reshape(r["dim"], r["dim"])
        scale = np.abs(g).max() or 1.0
        out[r["dim"]] = np.linalg.eigh(g / scale)[1][:, ::-1].copy()
    return out


def _best(ids: np.ndarray, score: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k best by (score descending, id ascending)."""
    return np.lexsort((ids, -score))[:k]


def scan(q_ids, q, c_ids, c, bars, rotation: np.ndarray, k: int = K, lead: int = LEAD) -> list[tuple[int, int, int]]:
    """Queries against one slice (rows of c by descending length): (query, vector, score) of each query's k best that reach its bar."""
    lead = min(lead, c.shape[1])
    rc, rq = c @ rotation, q @ rotation
    tail_c, tail_q = np.linalg.norm(rc[:, lead:], axis=1), np.linalg.norm(rq[:, lead:], axis=1)
    norm_c, norm_q = np.linalg.norm(c, axis=1), np.linalg.norm(q, axis=1)
    slack = 1e-9 * (norm_c.max(initial=0) * norm_q + 1)  # for rounding in the bounds, which are sums of doubles
    whole = c.shape[1] * np.abs(c).max(initial=0) * np.abs(q).max(initial=0) < _EXACT
    out = []
    step = 1024
    for i in range(len(q)):
        bar, ids, got = bars[i], np.zeros(0, np.int64), np.zeros(0, np.float64 if whole else object)
        for lo in range(0, len(c), step):
            if norm_q[i] * norm_c[lo] + slack[i] < bar:
                break  # every later vector is shorter
            part = rc[lo:lo + step, :lead] @ rq[i, :lead]
            left = np.flatnonzero((part + tail_c[lo:lo + step] * tail_q[i] + slack[i] >= bar) & (c_ids[lo:lo + step] != q_ids[i])) + lo
            if not len(left):
                continue
            score = c[left] @ q[i] if whole else np.array([sum(int(a) * int(b) for a, b in zip(x, q[i])) for x in c[left]], object)
            ids, got = np.concatenate([ids, c_ids[left]]), np.concatenate([got, score])
            keep = _best(ids, got, k)
            ids, got = ids[keep], got[keep]
            if len(got) == k:
                bar = max(bar, float(got[-1]) - (0 if whole else abs(float(got[-1])) * 1e-9))
        out.extend((int(q_ids[i]), int(v), int(s)) for v, s in zip(ids, got))
    return out


def top_k(vectors: DataFrame, is_query, k: int = K, scale: int = SCALE) -> DataFrame:
    """vectors (vec_id, embedding, ..) -> query_id, rank, vec_id, score; ``is_query`` is a condition on vec_id."""
    rows = materialize(scaled(vectors, scale))
    turn = rotations(rows)
    ranked = with_global_index(rows, [F.col("dim").asc(), F.col("norm").desc(), F.col("vec_id").asc(), F.col("v").asc()], "pos")
    ranked = materialize(ranked.withColumn("slice", F.floor(F.col("pos") / SLICE)))
    slices = ranked.groupBy("dim", "slice").agg(F.max("norm").alias("longest"))
    first = slices.groupBy("dim").agg(F.min("slice").alias("slice"))
    queries = materialize(rows.where(is_query)).withColumn("bar", F.lit(float("-inf")))
    schema = "query_id long, vec_id long, score long"

    def meet(key: tuple, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if left.empty or right.empty:
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype("int64")
        right = right.sort_values(["c_norm", "c_id"], ascending=[False, True], kind="stable")
        rot = turn[int(key[0])]
        got = scan(left["vec_id"].to_numpy(), _rows(left["v"]), right["c_id"].to_numpy(), _rows(right["c_v"]),
                   left["bar"].to_numpy(), rot, k)
        return pd.DataFrame(got, columns=["query_id", "vec_id", "score"]).astype("int64")

    def search(asked: DataFrame, within: DataFrame) -> DataFrame:
        """asked (.., dim, block, slice): query rows for a slice; within: candidate rows (.., dim, slice), dealt to the blocks that ask."""
        wanted = asked.select(F.col("dim").alias("c_dim"), F.col("slice").alias("c_slice"), F.col("block").alias("c_block")).distinct()
        dealt = (within.select(F.col("dim").alias("c_dim"), F.col("slice").alias("c_slice"), F.col("vec_id").alias("c_id"),
                               F.col("v").alias("c_v"), F.col("norm").alias("c_norm")).join(wanted, ["c_dim", "c_slice"]))
        return (asked.groupBy("dim", "block", "slice")
                .cogroup(dealt.groupBy("c_dim", "c_block", "c_slice")).applyInPandas(meet, schema))

    n_blocks = max(1, -(-queries.count() // BLOCK))
    queries = queries.withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(n_blocks)).cast("int"))
    start = materialize(search(queries.join(first, "dim"), ranked.join(first, ["dim", "slice"], "left_semi")))
    nth = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    best = start.withColumn("rank", F.row_number().over(nth)).where(F.col("rank") <= k)
    bars = best.where(F.col("rank") == k).select(F.col("query_id").alias("vec_id"), F.col("score").cast("double").alias("_bar"))
    open_queries = materialize(queries.drop("bar").join(bars, "vec_id", "left")
                               .withColumn("bar", F.coalesce("_bar", F.lit(float("-inf")))).drop("_bar"))
    # Which later slices can still matter to a block, from the block's largest |query| and smallest bar per query:
    # slice and block tables hold one row per 16384 vectors and per 8192 queries.
    rest = slices.join(first.withColumnRenamed("slice", "first"), "dim").where(F.col("slice") != F.col("first")).drop("first")
    asked = (open_queries.join(rest, "dim").where(F.col("norm") * F.col("longest") * (1 + 1e-9) + 1 >= F.col("bar")).drop("longest"))
    more = search(asked, ranked.join(rest.select("dim", "slice"), ["dim", "slice"], "left_semi"))
    found = best.select("query_id", "vec_id", "score").unionByName(more)
    return (found.withColumn("rank", F.row_number().over(nth)).where(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))


def op9_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """query_id, rank, vec_id, score: the 5 highest for each row whose vec_id is divisible by 50."""
    return top_k(read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % QUERY_STEP == 0)


ORACLE = """
WITH e AS (SELECT vec_id, [floor(256::DOUBLE * x::DOUBLE)::BIGINT FOR x IN embedding] AS v FROM embeddings
           WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_sum([a[1] * a[2] FOR a IN [[q.v[i], c.v[i]] FOR i IN range(1, len(q.v) + 1)]])::BIGINT AS score
      FROM e q JOIN e c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id AND len(q.v) = len(c.v))
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score
FROM s QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) <= 5
"""
