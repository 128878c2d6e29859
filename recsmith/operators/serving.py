"""Serving lookups as batch queries.

The reference answers one id per HTTP request; here each lookup is a join or
a per-key window over all requested ids at once.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from recsmith.functions.columns import UNKNOWN
from recsmith.session import materialize

# The columns of a history entry.
HISTORY_COLUMNS = ["item_id", "rating", "timestamp", "interaction_type"]


def latest_history(interactions: DataFrame, limit: int = 20, users: DataFrame | None = None) -> DataFrame:
    """Each user's latest ``limit`` interactions, newest first.

    ``row_number() <= limit`` is planned as a WindowGroupLimit, so every task
    keeps at most ``limit`` rows per user before the shuffle, even for a user
    with a very large history.
    """
    df = interactions if users is None else interactions.join(users.select("user_id"), "user_id", "left_semi")
    others = [c for c in df.columns if c != "timestamp"]
    order = [F.col("timestamp").desc_nulls_last()] + [F.col(c).desc_nulls_last() for c in others]
    w = Window.partitionBy("user_id").orderBy(*order)
    return (df.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= limit)
              .select("user_id", *HISTORY_COLUMNS, F.col("rank").cast("long").alias("rank")))


def item_details(items: DataFrame, ids: DataFrame) -> DataFrame:
    """Catalogue rows for a set of requested ids (semi join, no row cap)."""
    return items.join(ids.select("item_id").distinct(), "item_id", "left_semi")


def enrich(recs: DataFrame, items: DataFrame, id_col: str = "item_id") -> DataFrame:
    """M9 + P18: attach title, genre, rating_avg and price with the reference's defaults for unknown items.

    A catalogue without ``rating_avg`` counts as one where it is missing."""
    rating = F.col("rating_avg") if "rating_avg" in items.columns else F.lit(None)
    meta = items.select(F.col("item_id").alias("_id"), "title", "genre", rating.cast("double").alias("rating_avg"), "price")
    return (recs.join(meta, F.col(id_col) == F.col("_id"), "left")
                .select(*recs.columns,
                        F.coalesce("title", F.lit(UNKNOWN)).alias("title"),
                        F.coalesce("genre", F.lit(UNKNOWN)).alias("genre"),
                        F.coalesce("rating_avg", F.lit(0.0)).alias("rating_avg"),
                        F.coalesce(F.col("price").cast("double"), F.lit(0.0)).alias("price")))


CODE_BITS = 32
#: Rows of a block where vectors meet all others; cosines held at a time; columns from which a row takes its bar.
MEET, HELD, BAR = 32768, 1 << 22, 2048
#: Neighbourhoods that one task takes at a time.
NODES = 1024
#: What a round of neighbourhoods costs an item, in cosines of the search among all pairs (measured, README): its rows are joined,
#: shuffled with their vectors and ranked again, where a cosine of a block is a few nanoseconds.
ROUND_COSINES = 400_000


def _bucketed(vectors: DataFrame, first: int, last: int, bucket_items: int, seed: int) -> DataFrame:
    """(id, vector, table, bucket) of the tables from ``first`` to before ``last``: per table the sign bits of random projections,
    as many as make buckets of about ``bucket_items``.

    A bucket that is still too full is split by two more bits at a time; items that agree in all bits are dealt
    into parts by a hash, another in each table, so no bucket grows with the table."""
    def codes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes: dict[int, list[np.ndarray]] = {}
        weight = 1 << np.arange(CODE_BITS - 1, -1, -1, dtype=np.int64)
        for b in batches:
            lengths = np.asarray(pc.list_value_length(b.column(1)))
            for d in np.unique(lengths):
                at = np.flatnonzero(lengths == d)
                x = np.asarray(b.column(1).take(pa.array(at)).flatten(), np.float64).reshape(-1, d)
                if d not in planes:
                    planes[d] = [np.random.default_rng([seed, int(d), t]).normal(size=(d, CODE_BITS)) for t in range(first, last)]
                value = np.stack([(x @ p > 0) @ weight for p in planes[d]], axis=1)
                yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(at)), b.column(1).take(pa.array(at)), pa.array(value.tolist(), pa.list_(pa.int64()))],
                                                 names=["id", "vector", "codes"])

    id_type = vectors.schema["id"].dataType.simpleString()
    coded = materialize(vectors.mapInArrow(codes, f"id {id_type}, vector array<double>, codes array<bigint>"))
    rows = coded.select("id", F.posexplode("codes").alias("table", "code"))
    n = coded.count()
    bits = max(0, math.ceil(math.log2(max(1.0, n / bucket_items))))
    placed = rows.withColumn("bits", F.lit(bits))
    prefix = F.floor(F.col("code") / F.pow(F.lit(2.0), F.lit(CODE_BITS) - F.col("bits"))).cast("long")
    while bits < CODE_BITS:
        full = (placed.groupBy("table", "bits", prefix.alias("p")).agg(F.count("*").alias("n")).where(F.col("n") > 4 * bucket_items)
                .where(F.col("bits") == bits).select(F.col("table").alias("_t"), F.col("p").alias("_p")))
        full = materialize(full)
        if full.isEmpty():
            break
        more = min(CODE_BITS, bits + 2)
        placed = (placed.withColumn("_x", prefix).join(full, (F.col("table") == F.col("_t")) & (F.col("_x") == F.col("_p")) & (F.col("bits") == bits), "left")
                  .withColumn("bits", F.when(F.col("_t").isNotNull(), F.lit(more)).otherwise(F.col("bits"))).drop("_t", "_p", "_x"))
        placed, bits = materialize(placed), more
    key = placed.withColumn("prefix", prefix).drop("code")
    sizes = key.groupBy(F.col("table").alias("_t"), F.col("bits").alias("_b"), F.col("prefix").alias("_p")).agg(F.count("*").alias("_n"))
    parts = F.ceil(F.col("_n") / (4 * bucket_items))
    key = key.join(sizes, (F.col("table") == F.col("_t")) & (F.col("bits") == F.col("_b")) & (F.col("prefix") == F.col("_p")))
    key = key.withColumn("part", F.pmod(F.xxhash64("id", "table"), parts)).select(F.col("id").alias("_id"), "table", "bits", "prefix", "part")
    return coded.select("id", "vector").join(key, F.col("id") == F.col("_id")).drop("_id")


def _nearest(x: np.ndarray, ids: np.ndarray, y: np.ndarray, others: np.ndarray, k: int) -> list[tuple]:
    """(ids, others, cosines) of the best ``k`` other ids of y for every row of x; equal cosines go by the order of y.
    ``others`` are sorted; an id of several rows counts once, with its best.

    A row's bar is its ``k``-th best among the first columns, so only what reaches it is sorted."""
    out = []
    strip = max(1, HELD // max(1, len(y)))
    begins = np.flatnonzero(np.concatenate([[True], others[1:] != others[:-1]]))
    repeated, others = len(begins) < len(others), others[begins]
    for lo in range(0, len(x), strip):
        sim, own = x[lo:lo + strip] @ y.T, ids[lo:lo + strip]
        if repeated:
            sim = np.maximum.reduceat(sim, begins, axis=1)
        first, last = np.searchsorted(others, own, "left"), np.searchsorted(others, own, "right")
        for row in np.flatnonzero(last > first):
            sim[row, first[row]:last[row]] = -np.inf
        some = sim[:, :max(BAR, k)]
        bar = np.partition(some, some.shape[1] - k, axis=1)[:, some.shape[1] - k] if some.shape[1] > k else np.full(len(sim), -np.inf)
        row, at = np.divmod(np.flatnonzero(sim >= bar[:, None]), len(others))
        value = sim[row, at]
        real = value > -np.inf
        row, at, value = row[real], at[real], value[real]
        order = np.lexsort((at, -value, row))
        row, at, value = row[order], at[order], value[order]
        begin = np.searchsorted(row, np.arange(len(sim)))
        best = np.arange(len(row)) - begin[row] < k
        out.append((own[row[best]], others[at[best]], value[best]))
    return out


def _as_frame(found: list[tuple], names: list[str]) -> pd.DataFrame:
    if not found:
        return pd.DataFrame({n: [] for n in names})
    return pd.DataFrame({n: np.concatenate(c) for n, c in zip(names, zip(*found))})


def _against_all(asked: DataFrame, clean: DataFrame, k: int, names: list[str], schema: str) -> DataFrame:
    """Exact: for every row of asked (id, vector) its best ``k`` of each block of clean; blocks meet in pairs."""
    few, many = (max(1, math.ceil(d.count() / MEET)) for d in (asked, clean))

    def dealt(d: DataFrame, own: str, n: int, other: str, m: int, asks: bool) -> DataFrame:
        return (d.select("id", "vector", F.pmod(F.xxhash64("id"), F.lit(n)).cast("int").alias(own), F.lit(asks).alias("asks"))
                 .withColumn(other, F.explode(F.sequence(F.lit(0), F.lit(m - 1)))).select("i", "j", "asks", "id", "vector"))

    def meet(pdf: pd.DataFrame) -> pd.DataFrame:
        found = []
        for _, same in pdf.groupby(pdf["vector"].map(len)):  # only vectors of one length compare
            left, right = same[same["asks"]], same[~same["asks"]].sort_values("id")
            if len(left) and len(right):
                found += _nearest(np.stack(left["vector"].to_numpy()), left["id"].to_numpy(),
                                  np.stack(right["vector"].to_numpy()), right["id"].to_numpy(), k)
        return _as_frame(found, names)

    both = dealt(asked, "i", few, "j", many, True).unionByName(dealt(clean, "j", many, "i", few, False))
    return both.groupBy("i", "j").applyInPandas(meet, schema)


def _neighbourhoods(lists: DataFrame, clean: DataFrame, k: int, names: list[str], schema: str) -> DataFrame:
    """The best ``k`` of every item among those that share a list with it: each item's list and the lists it stands in (at most
    ``k`` of them, the nearest), with the vectors, compared with each other.

    A neighbourhood holds at most 2 k + 1 items, so the work per item does not grow with the table."""
    id_col, other, sim = names
    near = Window.partitionBy(other).orderBy(F.col(sim).desc(), F.col(id_col))
    stands_in = lists.withColumn("_r", F.row_number().over(near)).where(F.col("_r") <= k).select(F.col(other).alias("node"), F.col(id_col).alias("member"))
    members = (lists.select(F.col(id_col).alias("node"), F.col(other).alias("member")).unionByName(stands_in)
               .unionByName(clean.select(F.col("id").alias("node"), F.col("id").alias("member"))).distinct())
    rows = members.join(clean, F.col("member") == F.col("id")).select("node", "member", "vector")
    batches = F.pmod(F.xxhash64("node"), F.lit(max(1, math.ceil(clean.count() / NODES)))).cast("int")

    def meet(pdf: pd.DataFrame) -> pd.DataFrame:
        found = []
        for _, same in pdf.groupby(pdf["vector"].map(len)):  # only vectors of one length compare
            same = same.sort_values(["node", "member"], kind="stable")
            x, ids, node = np.stack(same["vector"].to_numpy()), same["member"].to_numpy(), same["node"].to_numpy()
            cuts = [0, *(np.flatnonzero(node[1:] != node[:-1]) + 1).tolist(), len(node)]
            for lo, hi in zip(cuts, cuts[1:]):
                found += _nearest(x[lo:hi], ids[lo:hi], x[lo:hi], ids[lo:hi], k)
        return _as_frame(found, names)

    return rows.groupBy(batches.alias("_batch")).applyInPandas(meet, schema)


def similar_items(vectors: DataFrame, k: int = 10, id_col: str = "item_id", vec_col: str = "vector",
                  tables: int = 8, bucket_items: int = 512, seed: int = 42, items: DataFrame | None = None,
                  recall: float = 0.95, probes: int = 512, exact: bool = False) -> DataFrame:
    """M8: the ``k`` nearest neighbours of every item by cosine, optionally with the details of M9.

    A neighbour graph, begun in buckets and refined among neighbours of neighbours: items meet in the buckets of several
    random-projection tables, and each keeps its best 2 k there; then all that share a list meet, round after round, since a
    neighbour's neighbours are likely one's own.  Buckets and neighbourhoods have a fixed size, so the work per item does not grow
    with the table.  The lists of ``probes`` items, chosen by a hash, are also found exactly, and decide when to stop: at
    ``recall`` of them.  A round that gains less than a hundredth is followed by as many tables again.  Tables that would compare an
    item with as many others as there are, rounds that would cost in all what all pairs cost (``ROUND_COSINES`` an item each), or
    ``exact``, let all blocks meet all blocks instead, so no search costs more than about twice that of all pairs.
    Items whose lists stay short get theirs from the whole table, exactly.
    Items with a NULL or zero vector have no direction and no neighbours; neither have rows without an id.
    """
    unit = F.sqrt(F.aggregate(F.col(vec_col), F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))
    clean = (vectors.select(F.col(id_col).alias("id"), F.transform(F.col(vec_col), lambda x: x.cast("double")).alias("vector"), unit.alias("_n"))
             .where((F.col("_n") > 0) & F.col("id").isNotNull()).select("id", F.transform("vector", lambda x: x / F.col("_n")).alias("vector")))
    clean = materialize(clean)
    n = clean.count()
    id_type = vectors.schema[id_col].dataType.simpleString()
    names = [id_col, "similar_id", "similarity"]
    schema = f"{id_col} {id_type}, similar_id {id_type}, similarity double"
    wide = 2 * k

    def best(pdf: pd.DataFrame) -> pd.DataFrame:
        found = []
        for _, same in pdf.groupby(pdf["vector"].map(len)):  # only vectors of one length compare
            same = same.sort_values("id")
            x, ids = np.stack(same["vector"].to_numpy()), same["id"].to_numpy()
            found += _nearest(x, ids, x, ids, wide)
        return _as_frame(found, names)

    w = Window.partitionBy(id_col).orderBy(F.col("similarity").desc(), F.col("similar_id"))

    def kept(pairs: DataFrame, depth: int) -> DataFrame:
        one = pairs.groupBy(id_col, "similar_id").agg(F.max("similarity").alias("similarity"))
        return one.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= depth)

    def finished(lists: DataFrame) -> DataFrame:
        out = lists.select(id_col, F.col("rank").cast("long").alias("rank"), "similar_id", "similarity")
        return out if items is None else enrich(out, items, "similar_id")

    if exact or tables * bucket_items >= n:
        return finished(kept(_against_all(clean, clean, k, names, schema), k))
    probe = materialize(clean.orderBy(F.xxhash64("id", F.lit(seed)), "id").limit(probes))
    truth = kept(_against_all(probe, clean, k, names, schema), k).groupBy(id_col).agg(F.min("similarity").alias("_least"), F.count("*").alias("_all"))
    truth = materialize(truth.withColumnRenamed(id_col, "_probe"))
    wanted = truth.agg(F.sum("_all")).first()[0] or 0

    def share(lists: DataFrame) -> float:
        hits = (lists.where(F.col("rank") <= k).join(F.broadcast(truth), F.col(id_col) == F.col("_probe"))  # at most ``probes`` rows
                .where(F.col("similarity") >= F.col("_least") - 1e-9).count())
        return hits / max(1, wanted)

    first, done, more, held, rounds = None, 0, tables, 0.0, 0

    def spent(more_tables: int) -> int:
        return (done + more_tables) * bucket_items + rounds * ROUND_COSINES

    while first is None or held < recall:
        if spent(more) >= n:
            return finished(kept(_against_all(clean, clean, k, names, schema), k))
        met = materialize(_bucketed(clean, done, done + more, bucket_items, seed))
        found = met.groupBy("table", "bits", "prefix", "part").applyInPandas(best, schema)
        first = materialize(kept(found if first is None else first.drop("rank").unionByName(found), wide))
        done, more = done + more, done + more
        held, before = share(first), -1.0
        while held < recall and held > before + 0.01:
            rounds += 1
            if spent(0) >= n:
                return finished(kept(_against_all(clean, clean, k, names, schema), k))
            before = held
            closer = _neighbourhoods(first.drop("rank"), clean, wide, names, schema)
            first = materialize(kept(first.drop("rank").unionByName(closer), wide))
            held = share(first)
    first = first.where(F.col("rank") <= k)
    # too few partners in every bucket: meet the whole table; a length with few vectors has no more to give
    lengths = clean.groupBy(F.size("vector").alias("_d")).agg((F.count("*") - 1).alias("_others"))
    have = first.groupBy(F.col(id_col).alias("_s")).agg(F.max("rank").alias("_have"))
    short = (clean.join(have, F.col("id") == F.col("_s"), "left").join(lengths, F.size("vector") == F.col("_d"))
             .where(F.coalesce("_have", F.lit(0)) < F.least(F.lit(k), F.col("_others"))).select("id", "vector"))
    again = _against_all(materialize(short), clean, k, names, schema)
    return finished(kept(first.drop("rank").unionByName(again), k))
