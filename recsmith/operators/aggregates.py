"""Grouped statistics (A1-A18, S9).  Partial aggregation happens map-side."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recsmith.functions.columns import round_half_even, safe_ratio, whole_days
from recsmith.operators.quantiles import values_at


def entity_stats(interactions: DataFrame, key: str, other: str, prefix: str, decimals: int = 3) -> DataFrame:
    """A1 / A2: rating mean/std/count/min/max, first/last time, distinct partners, and
    the derived activity days, filled std and frequency.  Means and stds are rounded
    half-even to ``decimals`` places before anything is derived from them."""
    r = round_half_even
    stats = interactions.groupBy(key).agg(
        r(F.avg("rating"), decimals).alias("rating_mean"),
        r(F.stddev_samp("rating"), decimals).alias("rating_std_raw"),
        F.count("rating").alias("rating_count"),
        r(F.min("rating"), decimals).alias("rating_min"),
        r(F.max("rating"), decimals).alias("rating_max"),
        F.min("timestamp").alias("timestamp_min"),
        F.max("timestamp").alias("timestamp_max"),
        F.count_distinct(other).alias(f"{other}_nunique"))
    days = whole_days("timestamp_min", "timestamp_max")
    unique_name = "unique_items_interacted" if other == "item_id" else "unique_users_interacted"
    return stats.select(
        key, "rating_mean", F.coalesce("rating_std_raw", F.lit(0.0)).alias("rating_std"), "rating_count",
        "rating_min", "rating_max", "timestamp_min", "timestamp_max", f"{other}_nunique",
        days.alias(f"{prefix}_activity_days"),
        F.col("rating_mean").alias("avg_rating"),
        F.col("rating_count").alias("total_interactions"),
        F.col(f"{other}_nunique").alias(unique_name),
        safe_ratio(F.col("rating_count"), days + 1).alias("interaction_frequency"))


def user_stats(interactions: DataFrame) -> DataFrame:
    return entity_stats(interactions, "user_id", "item_id", "user")


def item_stats(interactions: DataFrame) -> DataFrame:
    return entity_stats(interactions, "item_id", "user_id", "item")


def genre_preferences(interactions: DataFrame, items: DataFrame) -> DataFrame:
    """A4: per (user, genre) mean rating (3 places) and count of ratings; NULL genre dropped."""
    return (interactions.select("user_id", "item_id", "rating")
            .join(items.select("item_id", "genre"), "item_id", "left")
            .where(F.col("genre").isNotNull())
            .groupBy("user_id", "genre")
            .agg(round_half_even(F.avg("rating")).alias("genre_avg_rating"),
                 F.count("rating").alias("genre_interaction_count")))


def genre_preferences_wide(prefs: DataFrame, genres: list[str]) -> DataFrame:
    """A5: one ``genre_pref_<genre>`` column per genre, absent pairs 0."""
    wide = prefs.groupBy("user_id").pivot("genre", genres).agg(F.first("genre_avg_rating"))
    return wide.select("user_id", *[F.coalesce(F.col(g), F.lit(0.0)).alias(f"genre_pref_{g}") for g in genres])


def pair_stats(interactions: DataFrame) -> DataFrame:
    """Per (user, item): count, mean, sample std of ratings (3 places)."""
    return interactions.groupBy("user_id", "item_id").agg(
        F.count("rating").alias("user_item_interactions"),
        round_half_even(F.avg("rating")).alias("user_item_avg_rating"),
        round_half_even(F.stddev_samp("rating")).alias("user_item_rating_std"))


def ranking_entity_stats(interactions: DataFrame, key: str, other: str, prefix: str) -> DataFrame:
    """Count, mean, std (3 places) and distinct partners, for the ranking model."""
    return interactions.groupBy(key).agg(
        F.count("rating").alias(f"{prefix}_total_interactions"),
        round_half_even(F.avg("rating")).alias(f"{prefix}_avg_rating"),
        round_half_even(F.stddev_samp("rating")).alias(f"{prefix}_rating_std"),
        F.count_distinct(other).alias(f"{prefix}_unique_{'items' if other == 'item_id' else 'users'}"))


def item_interaction_counts(interactions: DataFrame, count_ratings: bool = False) -> DataFrame:
    """Interactions per item and the count divided by the largest count.

    ``count_ratings=True`` counts non-null ratings (local scorer), else rows (evaluator).
    """
    n = F.count("rating") if count_ratings else F.count(F.lit(1))
    counts = interactions.groupBy("item_id").agg(n.alias("n"))
    max_n = counts.select(F.max("n")).scalar()
    return counts.withColumn("normalized", F.col("n") / max_n)


def value_counts(df: DataFrame, col: str) -> DataFrame:
    """A10: count and share of each value, NULLs excluded (as pandas ``value_counts``)."""
    counts = df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("count"))
    total = counts.select(F.sum("count")).scalar()
    return counts.withColumn("share", F.col("count") / total)


def item_analysis(items: DataFrame, interactions: DataFrame) -> DataFrame:
    """Item statistics at 2 places joined to the catalogue, missing values 0."""
    stats = interactions.groupBy("item_id").agg(
        F.count("rating").alias("total_interactions"),
        round_half_even(F.avg("rating"), 2).alias("avg_rating"),
        round_half_even(F.stddev_samp("rating"), 2).alias("rating_std"),
        F.count_distinct("user_id").alias("unique_users"))
    out = items.join(stats, "item_id", "left")
    return out.fillna(0, subset=["total_interactions", "avg_rating", "rating_std", "unique_users"])


def between(low: Column, high: Column, frac: Column) -> Column:
    """Linear interpolation; the last value has none behind it."""
    return F.when(high.isNull() | (frac == 0), low).otherwise(low + frac * (high - low))


def linear_quantile(i: int, q: float) -> Column:
    """The ``q`` quantile from columns n, low<i>, high<i> of ``values_at``."""
    h = (F.col("n") - 1) * F.lit(float(q))
    return between(F.col(f"low{i}"), F.col(f"high{i}"), h - F.floor(h).cast("long"))


def exact_quantiles(df: DataFrame, col: str, probs: list[float]) -> DataFrame:
    """Exact linear-interpolation quantiles ((n-1)·q, as pandas ``describe``), by refinement (``quantiles.values_at``).

    Returns one row per probability: (q, value); value is NULL where the column has none.
    """
    found = values_at(df, [], col, probs)
    one = found.agg(*[F.max(c).alias(c) for c in found.columns])
    rows = [F.struct(F.lit(float(q)).alias("q"), linear_quantile(k, q).alias("value")) for k, q in enumerate(probs)]
    return one.select(F.explode(F.array(*rows)).alias("r")).select("r.q", "r.value")


def exclusive_quantile(df: DataFrame, col: str, i: int, cuts: int) -> DataFrame:
    """The i-th of ``cuts`` cut points by Python's ``statistics.quantiles`` (exclusive).

    j = i(m+1) // cuts clamped to 1..m-1, delta = i(m+1) - j·cuts,
    value = (x[j-1]·(cuts-delta) + x[j]·delta) / cuts  (1-based x, m values).
    """
    whole = F.lit(int(i)).cast("long")

    def cut(m: Column) -> Column:
        return F.least(F.greatest(F.floor(whole * (m + 1) / cuts), F.lit(1)), m - 1).cast("long")

    found = values_at(df, [], col, [i / cuts], lambda m, _: F.greatest(cut(m) - 1, F.lit(0)).cast("long"))
    one = found.agg(*[F.max(c).alias(c) for c in found.columns])
    m = F.col("n")
    delta = whole * (m + 1) - cut(m) * cuts
    val = F.when(m == 1, F.col("low0")).otherwise(
        (F.col("low0") * (F.lit(cuts) - delta) + F.col("high0") * delta) / F.lit(cuts))
    return one.select(val.alias("value"))


def numeric_summary(df: DataFrame, cols: list[str]) -> DataFrame:
    """Count, mean, sample std, min, 25/50/75 % (linear), max per column, long form.

    One aggregate over all columns and one refinement over (column, value)."""
    probs = {0.25: "25%", 0.5: "50%", 0.75: "75%"}
    stats = df.agg(*[F.array(F.count(c).cast("double"), F.avg(c), F.stddev_samp(c), F.min(c).cast("double"),
                             F.max(c).cast("double")).alias(f"s{i}") for i, c in enumerate(cols)])
    stats = stats.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"s{i}").alias("s"))
                                             for i, c in enumerate(cols)])).alias("r")).select("r.column", "r.s")
    long = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("v"))
                                         for c in cols])).alias("r")).select("r.column", "r.v")
    found = values_at(long, ["column"], "v", list(probs))
    names = ["count", "mean", "std", "min", "max"]
    out = [F.struct(F.lit(name).alias("statistic"), F.col("s")[i].alias("value")) for i, name in enumerate(names)]
    out += [F.struct(F.lit(name).alias("statistic"), linear_quantile(k, q).alias("value")) for k, (q, name) in enumerate(probs.items())]
    return (stats.join(found, "column", "left").select("column", F.explode(F.array(*out)).alias("r"))
            .select("column", "r.statistic", "r.value"))


def date_range(interactions: DataFrame, time_col: str = "timestamp") -> DataFrame:
    """First and last time and whole days between."""
    r = interactions.agg(F.min(time_col).alias("first_ts"), F.max(time_col).alias("last_ts"))
    return r.withColumn("total_days", whole_days("first_ts", "last_ts"))


def user_item_matrix(interactions: DataFrame, rating_threshold: float | None = None) -> DataFrame:
    """Sparse user-item matrix, duplicates averaged; optional positive filter."""
    df = interactions
    if rating_threshold is not None:
        df = df.where(F.col("rating") >= rating_threshold)
    return df.groupBy("user_id", "item_id").agg(F.avg("rating").alias("rating"))


def sparsity(interactions: DataFrame) -> DataFrame:
    """Share of zero cells of the dense matrix, without building it."""
    m = user_item_matrix(interactions)
    # one distinct count per aggregate: two in one would copy every row before the shuffle
    users, items = (interactions.select(F.count_distinct(c)).scalar() for c in ("user_id", "item_id"))
    return (m.agg(F.count(F.when(F.col("rating") != 0, 1)).alias("nonzero"))
            .select(users.alias("n_users"), items.alias("n_items"), "nonzero")
            .withColumn("sparsity", F.lit(1.0) - F.col("nonzero") / (F.col("n_users") * F.col("n_items"))))


def latency_summary(df: DataFrame, col: str = "latency_ms") -> DataFrame:
    """Mean and p95 (Python's exclusive quantile with 20 cuts) of latencies.

    The number of cut points depends on the row count (one scalar read)."""
    mean = df.agg(F.avg(col).alias("avg_latency_ms"), F.count(col).alias("n"))
    n = df.select(F.count(col)).first()[0]
    cuts = min(n, 20)  # the reference uses min(len, 20) cut points and keeps the last
    if cuts >= 2:
        p95 = exclusive_quantile(df, col, cuts - 1, cuts).select(F.col("value").alias("p95_latency_ms"))
    else:
        p95 = df.agg(F.max(col).cast("double").alias("p95_latency_ms"))
    return mean.crossJoin(p95).select("n", "avg_latency_ms", "p95_latency_ms")


def distinct_ids(df: DataFrame, col: str) -> DataFrame:
    """A17."""
    return df.select(col).distinct()


def histories_as_sets(interactions: DataFrame) -> DataFrame:
    """A18 as arrays.  Prefer the long (user, item) form for joins; one array per
    user holds that user's whole history in one row."""
    return interactions.groupBy("user_id").agg(F.array_sort(F.collect_set("item_id")).alias("items"))


def dataset_summary(interactions: DataFrame) -> DataFrame:
    """Rows, distinct users and items, mean rating (2 places), first and last time."""
    users, items = (interactions.select(F.count_distinct(c)).scalar() for c in ("user_id", "item_id"))
    one = interactions.agg(
        F.count(F.lit(1)).alias("total_interactions"), round_half_even(F.avg("rating"), 2).alias("avg_rating"),
        F.min("timestamp").alias("first_ts"), F.max("timestamp").alias("last_ts"))
    return one.select("total_interactions", users.alias("unique_users"), items.alias("unique_items"), "avg_rating", "first_ts", "last_ts")


def table_summary(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows and columns of each feature table, one row per table."""
    out = None
    for name, df in tables.items():
        row = df.agg(F.count(F.lit(1)).alias("rows")).select(
            F.lit(name).alias("table"), "rows", F.lit(len(df.columns)).cast("long").alias("columns"))
        out = row if out is None else out.unionByName(row)
    return out
