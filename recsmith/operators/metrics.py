"""Offline evaluation.

Recommendations are a long table ``(user_id, rank, item_id)`` with ranks 1..n per
user.  Every metric is a join of that table with the test rows followed by
per-user aggregates and one global mean; no per-user scans, no driver loops.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from recsmith.functions.columns import UNKNOWN
from recsmith.session import materialize

DEFAULT_KS = (5, 10, 20)
RESULT_DECIMALS = 10


def _actual(test: DataFrame) -> DataFrame:
    return test.select("user_id", "item_id").distinct()


def _first_positions(recs: DataFrame) -> DataFrame:
    """Each distinct recommended item once, at its first position (set semantics)."""
    return recs.groupBy("user_id", "item_id").agg(F.min("rank").alias("first_rank"))


def last_ratings(test: DataFrame, time_col: str = "timestamp") -> DataFrame:
    """Relevance of (user, item): the rating of the pair's last test row in time order.

    Rows without time sort last (as pandas sorts), so they count as the latest.
    """
    others = [c for c in test.columns if c not in (time_col,)]
    key = F.struct(F.col(time_col).isNull().alias("_no_t"), F.col(time_col),
                   *[F.col(c) for c in others])
    return test.groupBy("user_id", "item_id").agg(F.max_by("rating", key).alias("rel"))


def per_user_hits(recs: DataFrame, test: DataFrame, ks=DEFAULT_KS) -> DataFrame:
    """Per recommended user: |actual|, and for each K the distinct top-K size and hits.

    Also the first hit position over the whole list (for MRR).
    """
    first = _first_positions(recs)
    actual = _actual(test)
    n_actual = actual.groupBy("user_id").agg(F.count(F.lit(1)).alias("n_actual"))
    hits = first.join(actual, ["user_id", "item_id"])
    hit_aggs = [F.count(F.when(F.col("first_rank") <= k, 1)).alias(f"hits_{k}") for k in ks]
    per_hit = hits.groupBy("user_id").agg(*hit_aggs, F.min("first_rank").alias("first_hit"))
    per_rec = first.groupBy("user_id").agg(
        *[F.count(F.when(F.col("first_rank") <= k, 1)).alias(f"n_rec_{k}") for k in ks])
    return (per_rec.join(n_actual, "user_id", "left").join(per_hit, "user_id", "left")
                   .fillna(0, subset=["n_actual"] + [f"hits_{k}" for k in ks]))


def recall_at_k(recs: DataFrame, test: DataFrame, k: int = 10) -> DataFrame:
    """Mean over recommended users that have test items of |top-K ∩ actual| / |actual|."""
    p = per_user_hits(recs, test, (k,))
    return p.where(F.col("n_actual") > 0).agg(
        F.coalesce(F.avg(F.col(f"hits_{k}") / F.col("n_actual")), F.lit(0.0)).alias("recall"))


def _ndcg_per_user(recs: DataFrame, rel: DataFrame, actual_users: DataFrame, k: int) -> DataFrame:
    top = recs.where(F.col("rank") <= k).join(actual_users, "user_id", "left_semi")
    gains = top.join(rel, ["user_id", "item_id"], "left").withColumn("g", F.coalesce("rel", F.lit(0.0)))
    ideal = Window.partitionBy("user_id").orderBy(F.col("g").desc())
    gains = gains.withColumn("ideal_pos", F.row_number().over(ideal))
    per = gains.groupBy("user_id").agg(
        F.sum(F.col("g") / F.log2(F.col("rank") + 1)).alias("dcg"),
        F.sum(F.col("g") / F.log2(F.col("ideal_pos") + 1)).alias("idcg"))
    return per.select("user_id", F.when(F.col("idcg") > 0, F.col("dcg") / F.col("idcg"))
                                    .otherwise(F.lit(0.0)).alias("ndcg"))


def ndcg_at_k(recs: DataFrame, test: DataFrame, k: int = 10) -> DataFrame:
    """Linear gain = test rating, discount log2(rank+1), ideal order over the list's own gains."""
    users = _actual(test).select("user_id").distinct()
    per = _ndcg_per_user(recs, last_ratings(test), users, k)
    return per.agg(F.coalesce(F.avg("ndcg"), F.lit(0.0)).alias("ndcg"))


def coverage(recs: DataFrame, items: DataFrame) -> DataFrame:
    """E5: distinct recommended items / catalogue size (0 for an empty catalogue)."""
    n_items = items.select(F.count(F.lit(1))).scalar()
    return recs.agg(F.coalesce(F.try_divide(F.count_distinct("item_id").cast("double"),
                                            n_items.cast("double")), F.lit(0.0)).alias("coverage"))


def _list_genres(recs: DataFrame, items: DataFrame) -> DataFrame:
    return recs.join(items.select("item_id", "genre"), "item_id", "left")


def genre_redundancy(recs: DataFrame, items: DataFrame) -> DataFrame:
    """Mean over lists of length >= 2 of ``1 - distinct genres / length`` (missing = 'Unknown')."""
    per = (_list_genres(recs, items).groupBy("user_id")
           .agg(F.count(F.lit(1)).alias("n"),
                F.count_distinct(F.coalesce("genre", F.lit(UNKNOWN))).alias("g")))
    return per.where(F.col("n") > 1).agg(
        F.coalesce(F.avg(1.0 - F.col("g") / F.col("n")), F.lit(0.0)).alias("genre_redundancy"))


def diversity(recs: DataFrame, items: DataFrame) -> DataFrame:
    """Mean over non-empty lists of ``distinct known genres / length``."""
    known = F.when(F.col("genre") != "", F.col("genre"))
    per = (_list_genres(recs, items).groupBy("user_id")
           .agg(F.count(F.lit(1)).alias("n"), F.count_distinct(known).alias("g")))
    return per.agg(F.coalesce(F.avg(F.col("g") / F.col("n")), F.lit(0.0)).alias("diversity"))


def novelty(recs: DataFrame, test: DataFrame) -> DataFrame:
    """Mean over all list entries of ``1 - n(item)/max n``, counts of test rows."""
    counts = test.groupBy("item_id").agg(F.count(F.lit(1)).alias("n"))
    max_n = counts.select(F.max("n")).scalar()
    nov = F.lit(1.0) - F.coalesce(F.col("n"), F.lit(0)) / max_n
    return (recs.join(counts, "item_id", "left").select(nov.alias("_nov"))
                .agg(F.coalesce(F.avg("_nov"), F.lit(0.0)).alias("novelty")))


def per_user_table(recs: DataFrame, test: DataFrame, items: DataFrame, ks=DEFAULT_KS) -> DataFrame:
    """One row per recommended user with every per-user quantity the suite needs.

    Nearly all lists hold the same few items, so what is known of an item is looked up once for each distinct recommended one, in
    a table that is broadcast where it is small, and no join key holds all users.  The lists then meet their users in one
    shuffle: they are bounded by K per user, so no window there holds more than a list's rows.
    """
    counts = materialize(test.groupBy("item_id").agg(F.count(F.lit(1)).alias("_n_item")))
    max_n = counts.select(F.max("_n_item")).scalar()
    used = materialize(recs.select("item_id").where(F.col("item_id").isNotNull()).distinct())
    about = materialize(used.join(items.select("item_id", "genre"), "item_id", "left").join(counts, "item_id", "left"))
    # a hit and a gain are of recommended items
    rel = last_ratings(test.join(used, "item_id", "left_semi")).withColumn("_met", F.lit(True))
    first = Window.partitionBy("user_id", "item_id").orderBy(F.col("rank").asc_nulls_last())
    rows = (recs.join(rel, ["user_id", "item_id"], "left").join(about, "item_id", "left").repartition("user_id")
                .withColumn("g", F.coalesce("rel", F.lit(0.0)))
                .withColumn("nov", F.lit(1.0) - F.coalesce(F.col("_n_item"), F.lit(0)) / max_n)
                .withColumn("_once", F.row_number().over(first) == 1)
                .withColumn("_opens", F.row_number().over(Window.partitionBy("user_id", "genre").orderBy("rank")) == 1))
    for k in ks:
        w = Window.partitionBy("user_id", F.col("rank") <= k).orderBy(F.col("g").desc())
        rows = rows.withColumn(f"_ip_{k}", F.row_number().over(w))
    aggs = []
    for k in ks:
        in_k = F.col("rank") <= k
        aggs += [F.count(F.when(in_k & F.col("_once"), 1)).alias(f"n_rec_{k}"),
                 F.count(F.when(in_k & F.col("_once") & F.col("_met"), 1)).alias(f"hits_{k}"),
                 F.sum(F.when(in_k, F.col("g") / F.log2(F.col("rank") + 1))).alias(f"dcg_{k}"),
                 F.sum(F.when(in_k, F.col("g") / F.log2(F.col(f"_ip_{k}") + 1))).alias(f"idcg_{k}")]
    # each genre is counted at its first row; a missing one counts as UNKNOWN, also where that is a genre of the list
    both = F.max(F.col("genre").isNull()) & F.coalesce(F.max(F.col("genre") == UNKNOWN), F.lit(False))
    per_list = rows.where(F.col("user_id").isNotNull()).groupBy("user_id").agg(
        *aggs, F.min(F.when(F.col("_met"), F.col("rank"))).alias("first_hit"), F.count(F.lit(1)).alias("n_list"),
        (F.count(F.when(F.col("_opens"), 1)) - both.cast("long")).alias("n_genres_unknown"),
        F.count(F.when(F.col("_opens") & (F.col("genre") != ""), 1)).alias("n_genres_known"),
        F.sum("nov").alias("novelty_sum"))
    n_actual = _actual(test).groupBy("user_id").agg(F.count(F.lit(1)).alias("n_actual"))
    out = per_list.join(n_actual, "user_id", "left").fillna(0, subset=["n_actual"])
    for k in ks:
        out = out.withColumn(f"ndcg_{k}", F.when(F.col(f"idcg_{k}") > 0, F.col(f"dcg_{k}") / F.col(f"idcg_{k}"))
                                           .otherwise(F.lit(0.0)))
    return out


def evaluation_suite(recs: DataFrame, test: DataFrame, items: DataFrame, ks=DEFAULT_KS) -> DataFrame:
    """Every metric as rows ``(metric, k, value)`` from one per-user table and one aggregate."""
    per = per_user_table(recs, test, items, ks)
    has_actual = F.col("n_actual") > 0

    def mean(expr, cond=None):
        return F.coalesce(F.avg(F.when(cond, expr) if cond is not None else expr), F.lit(0.0))

    aggs = []
    for k in ks:
        aggs += [mean(F.col(f"hits_{k}") / F.col("n_actual"), has_actual).alias(f"recall_{k}"),
                 mean(F.col(f"hits_{k}") / F.col(f"n_rec_{k}"), F.col(f"n_rec_{k}") > 0).alias(f"precision_{k}"),
                 mean(F.col(f"ndcg_{k}"), has_actual).alias(f"ndcg_{k}")]
    aggs += [mean(F.coalesce(1.0 / F.col("first_hit"), F.lit(0.0)), has_actual).alias("mrr"),
             mean(1.0 - F.col("n_genres_unknown") / F.col("n_list"), F.col("n_list") > 1).alias("genre_redundancy"),
             mean(F.col("n_genres_known") / F.col("n_list")).alias("diversity"),
             F.coalesce(F.sum("novelty_sum") / F.sum("n_list"), F.lit(0.0)).alias("novelty")]
    one_row = per.agg(*aggs).crossJoin(coverage(recs, items))
    entries = []
    for k in ks:
        entries += [f"'recall', {k}L, recall_{k}", f"'precision', {k}L, precision_{k}", f"'ndcg', {k}L, ndcg_{k}"]
    for m in ("mrr", "coverage", "genre_redundancy", "diversity", "novelty"):
        entries.append(f"'{m}', CAST(NULL AS BIGINT), {m}")
    long = one_row.selectExpr(f"stack({len(entries)}, {', '.join(entries)}) AS (metric, k, value)")
    return long.select("metric", "k", F.round("value", RESULT_DECIMALS).alias("value"))
