"""Registered queries for aggregates, features and serving-style batch lookups."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recsmith.operators import aggregates as A
from recsmith.operators import features as FE
from recsmith.operators import recommend as R
from recsmith.operators import serving as S
from recsmith.plans import local_chain
from recsmith.plans import oracle_sql as osql
from recsmith.plans.catalog import register
from recsmith.session import materialize
from recsmith.sources import fixtures
from recsmith.sources.fixtures import oracle

# The six genres of the fixture catalogue (p_type values), for the oracle's pivot.
FIXTURE_GENRES = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]
FLOAT_DECIMALS = 9


def rnd(expr: str, places: int = 3) -> str:
    """Oracle form of numpy rounding (scale, half-even, unscale)."""
    scale = f"CAST({10 ** places} AS DOUBLE)"
    return f"(round_even(({expr}) * {scale}, 0) / {scale})"


def _t(spark, sf_dir):
    return fixtures.tables(spark, sf_dir)


def _round_floats(df: DataFrame, cols: list[str], places: int = FLOAT_DECIMALS) -> DataFrame:
    """Fix the printed precision of values derived from floating sums (order-dependent bits)."""
    return df.select(*[F.round(c, places).alias(c) if c in cols else F.col(c) for c in df.columns])


DAYS = 'CAST(floor((epoch_us(max("timestamp")) - epoch_us(min("timestamp"))) / 86400000000) AS BIGINT)'


def _stats_sql(key: str, other: str, prefix: str, unique_name: str) -> str:
    return f"""
SELECT {key}, {rnd('avg(rating)')} AS rating_mean, coalesce({rnd('stddev_samp(rating)')}, 0.0) AS rating_std,
  count(rating) AS rating_count, {rnd('min(rating)')} AS rating_min, {rnd('max(rating)')} AS rating_max,
  min("timestamp") AS timestamp_min, max("timestamp") AS timestamp_max,
  count(DISTINCT {other}) AS {other}_nunique, {DAYS} AS {prefix}_activity_days,
  {rnd('avg(rating)')} AS avg_rating, count(rating) AS total_interactions,
  count(DISTINCT {other}) AS {unique_name}, count(rating) / ({DAYS} + 1) AS interaction_frequency
FROM interactions GROUP BY {key}"""


# ---- A1 / A2 ----------------------------------------------------------------

@register("user_stats", oracle(_stats_sql("user_id", "item_id", "user", "unique_items_interacted")))
def q_user_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A1 + P12-P14: per-user rating statistics and activity."""
    return A.user_stats(_t(spark, sf_dir)["interactions"])


_ITEM_FEATURES_SQL = oracle(f"""
SELECT f.*, CASE WHEN interaction_popularity >= 0.7 THEN
              CASE WHEN quality_score >= 0.7 THEN 'popular_high_quality' ELSE 'popular_mixed_quality' END
            WHEN quality_score >= 0.7 THEN 'niche_high_quality' ELSE 'niche_mixed_quality' END AS item_segment
FROM (
  SELECT i.item_id, i.title, i.genre, i.popularity_score, i.quality_score, i.price, i.language,
    dense_rank() OVER (ORDER BY i.item_id) - 1 AS item_id_encoded,
    dense_rank() OVER (ORDER BY coalesce(i.genre, 'Unknown')) - 1 AS genre_encoded,
    s.rating_mean, coalesce(s.rating_std, 0.0) AS rating_std, s.rating_count,
    s.rating_min, s.rating_max, s.timestamp_min, s.timestamp_max, s.user_id_nunique,
    coalesce(s.item_activity_days, 0) AS item_activity_days,
    coalesce(s.avg_rating, avg(s.avg_rating) OVER ()) AS avg_rating,
    coalesce(s.total_interactions, 0) AS total_interactions,
    coalesce(s.unique_users_interacted, 0) AS unique_users_interacted,
    coalesce(s.interaction_frequency, 0.0) AS interaction_frequency,
    coalesce(s.interaction_popularity, 0.0) AS interaction_popularity
  FROM items i LEFT JOIN (
    SELECT *, (CASE WHEN max(total_interactions) OVER () = min(total_interactions) OVER () THEN 0.0
                    ELSE (total_interactions - min(total_interactions) OVER ())
                         / (max(total_interactions) OVER () - min(total_interactions) OVER ()) END
             + CASE WHEN max(unique_users_interacted) OVER () = min(unique_users_interacted) OVER () THEN 0.0
                    ELSE (unique_users_interacted - min(unique_users_interacted) OVER ())
                         / (max(unique_users_interacted) OVER () - min(unique_users_interacted) OVER ()) END
            ) / 2.0 AS interaction_popularity
    FROM ({_stats_sql("item_id", "user_id", "item", "unique_users_interacted")})) s USING (item_id)) f""")


@register("item_features", _ITEM_FEATURES_SQL)
def q_item_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A2 + A3 + P5 + P7 + P11: item feature table."""
    t = _t(spark, sf_dir)
    return FE.item_features(t["items"], t["interactions"])


def _user_features_sql() -> str:
    piv = ",\n    ".join(
        f"coalesce(max(CASE WHEN genre = '{g}' THEN genre_avg_rating END), 0.0) AS genre_pref_{g}"
        for g in FIXTURE_GENRES)
    pref_cols = ", ".join(f"p.genre_pref_{g}" for g in FIXTURE_GENRES)
    return oracle(f"""
SELECT f.*, CASE WHEN total_interactions >= 50 THEN
                   CASE WHEN avg_rating >= 4.0 THEN 'high_activity_positive' ELSE 'high_activity_mixed' END
                 WHEN total_interactions >= 10 THEN
                   CASE WHEN avg_rating >= 4.0 THEN 'medium_activity_positive' ELSE 'medium_activity_mixed' END
                 ELSE 'low_activity' END AS user_segment
FROM (
  SELECT u.*, dense_rank() OVER (ORDER BY u.user_id) - 1 AS user_id_encoded,
    dense_rank() OVER (ORDER BY coalesce(u.gender, 'Unknown')) - 1 AS gender_encoded,
    dense_rank() OVER (ORDER BY coalesce(u.age_group, 'Unknown')) - 1 AS age_group_encoded,
    dense_rank() OVER (ORDER BY coalesce(u.location, 'Unknown')) - 1 AS location_encoded,
    {pref_cols},
    s.rating_mean, coalesce(s.rating_std, 0.0) AS rating_std, s.rating_count, s.rating_min, s.rating_max,
    s.timestamp_min, s.timestamp_max, s.item_id_nunique, coalesce(s.user_activity_days, 0) AS user_activity_days,
    coalesce(s.avg_rating, avg(s.avg_rating) OVER ()) AS avg_rating,
    coalesce(s.total_interactions, 0) AS total_interactions,
    coalesce(s.unique_items_interacted, 0) AS unique_items_interacted,
    coalesce(s.interaction_frequency, 0.0) AS interaction_frequency
  FROM users u
  LEFT JOIN (SELECT user_id, {piv}
             FROM (SELECT user_id, genre, {rnd('avg(rating)')} AS genre_avg_rating
                   FROM interactions JOIN items USING (item_id) WHERE genre IS NOT NULL GROUP BY user_id, genre)
             GROUP BY user_id) p USING (user_id)
  LEFT JOIN ({_stats_sql("user_id", "item_id", "user", "unique_items_interacted")}) s USING (user_id)) f""")


@register("user_features", _user_features_sql())
def q_user_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A1 + A4 + A5 + P4 + P5 + P10 + J3: user feature table."""
    t = _t(spark, sf_dir)
    return FE.user_features(t["users"], t["interactions"], t["items"], FIXTURE_GENRES)


_ORDER_ALL = '"timestamp" NULLS LAST, user_id, item_id, interaction_type, rating, session_id, line_number'

_INTERACTION_FEATURES_SQL = oracle(f"""
SELECT x.*,
  dense_rank() OVER (ORDER BY coalesce(age_group, 'Unknown')) - 1 AS age_group_encoded,
  dense_rank() OVER (ORDER BY coalesce(gender, 'Unknown')) - 1 AS gender_encoded,
  dense_rank() OVER (ORDER BY coalesce(location, 'Unknown')) - 1 AS location_encoded,
  dense_rank() OVER (ORDER BY coalesce(subscription_type, 'Unknown')) - 1 AS subscription_type_encoded,
  dense_rank() OVER (ORDER BY coalesce(genre, 'Unknown')) - 1 AS genre_encoded,
  round(CASE WHEN stddev_pop(rating) OVER () = 0 THEN rating - rating
        ELSE (rating - avg(rating) OVER ()) / stddev_pop(rating) OVER () END, {FLOAT_DECIMALS}) AS rating_normalized
FROM (
  SELECT i.*, CAST(hour(i."timestamp") AS INTEGER) AS hour, CAST(isodow(i."timestamp") - 1 AS INTEGER) AS day_of_week,
    CAST(month(i."timestamp") AS INTEGER) AS month,
    CAST(isodow(i."timestamp") IN (6, 7) AS INTEGER) AS is_weekend,
    CAST(hour(i."timestamp") BETWEEN 18 AND 23 AS INTEGER) AS is_evening,
    coalesce((epoch_us(i."timestamp") - epoch_us(lag(i."timestamp") OVER (PARTITION BY i.user_id ORDER BY {_ORDER_ALL})))
             / 1e6, 0.0) AS time_since_last,
    u.age_group, u.gender, u.location, u.subscription_type,
    it.genre, it.popularity_score, it.quality_score, it.price,
    CASE WHEN u.user_id IS NULL OR it.item_id IS NULL THEN 0.5
         ELSE CASE WHEN coalesce(list_contains(json_extract_string(u.preferred_genres, '$[*]'), it.genre), false)
                   THEN 1.0 ELSE 0.0 END * 0.5 + it.quality_score * 0.3 + it.popularity_score * 0.2
    END AS user_item_affinity
  FROM interactions i LEFT JOIN users u USING (user_id) LEFT JOIN items it USING (item_id)) x""")


@register("interaction_features", _INTERACTION_FEATURES_SQL)
def q_interaction_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P2 + P3 + W1 + J1 + P5 + P9 + P6: interaction feature table."""
    t = _t(spark, sf_dir)
    out = FE.interaction_features(t["interactions"], t["users"], t["items"])
    return _round_floats(out, ["rating_normalized"])


def _ranking_sql() -> str:
    r = rnd
    return oracle(f"""
SELECT b.*,
  CAST(b.user_total_interactions AS DOUBLE) / max(b.user_total_interactions) OVER () AS user_popularity,
  CAST(b.item_total_interactions AS DOUBLE) / max(b.item_total_interactions) OVER () AS item_popularity,
  b.user_avg_rating / 5.0 AS user_quality, b.item_avg_rating / 5.0 AS item_quality,
  coalesce(CAST(b.user_unique_items AS DOUBLE) / nullif(b.user_total_interactions, 0), 0.0) AS user_diversity,
  coalesce(CAST(b.item_unique_users AS DOUBLE) / nullif(b.item_total_interactions, 0), 0.0) AS item_diversity
FROM (
  SELECT i.*, u.age_group, u.gender, u.location, u.preferred_genres, u.activity_level, u.subscription_type,
    it.title, it.genre, it.popularity_score, it.quality_score, it.price, it.language,
    CAST(hour(i."timestamp") AS INTEGER) AS hour, CAST(isodow(i."timestamp") - 1 AS INTEGER) AS day_of_week,
    CAST(month(i."timestamp") AS INTEGER) AS month, CAST(isodow(i."timestamp") IN (6, 7) AS INTEGER) AS is_weekend,
    CAST(hour(i."timestamp") BETWEEN 18 AND 23 AS INTEGER) AS is_evening,
    coalesce(ps.user_item_interactions, 0) AS user_item_interactions,
    coalesce(ps.user_item_avg_rating, 0.0) AS user_item_avg_rating,
    coalesce(ps.user_item_rating_std, 0.0) AS user_item_rating_std,
    coalesce(us.user_total_interactions, 0) AS user_total_interactions,
    coalesce(us.user_avg_rating, 0.0) AS user_avg_rating, coalesce(us.user_rating_std, 0.0) AS user_rating_std,
    coalesce(us.user_unique_items, 0) AS user_unique_items,
    coalesce(ist.item_total_interactions, 0) AS item_total_interactions,
    coalesce(ist.item_avg_rating, 0.0) AS item_avg_rating, coalesce(ist.item_rating_std, 0.0) AS item_rating_std,
    coalesce(ist.item_unique_users, 0) AS item_unique_users
  FROM interactions i LEFT JOIN users u USING (user_id) LEFT JOIN items it USING (item_id)
  LEFT JOIN (SELECT user_id, item_id, count(rating) AS user_item_interactions,
               {r('avg(rating)')} AS user_item_avg_rating, {r('stddev_samp(rating)')} AS user_item_rating_std
             FROM interactions GROUP BY user_id, item_id) ps USING (user_id, item_id)
  LEFT JOIN (SELECT user_id, count(rating) AS user_total_interactions, {r('avg(rating)')} AS user_avg_rating,
               {r('stddev_samp(rating)')} AS user_rating_std, count(DISTINCT item_id) AS user_unique_items
             FROM interactions GROUP BY user_id) us USING (user_id)
  LEFT JOIN (SELECT item_id, count(rating) AS item_total_interactions, {r('avg(rating)')} AS item_avg_rating,
               {r('stddev_samp(rating)')} AS item_rating_std, count(DISTINCT user_id) AS item_unique_users
             FROM interactions GROUP BY item_id) ist USING (item_id)) b""")


@register("ranking_features", _ranking_sql())
def q_ranking_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J2 + A6-A8 + J8 + P2/P3 + P12 + P4: features of the rating regressor."""
    t = _t(spark, sf_dir)
    # the mapped interactions stand for a stored table, which the statistics read again: write the mapping (a join) once
    return FE.ranking_features(materialize(t["interactions"]), t["users"], t["items"])


# ---- M14: the same statistics as of each row --------------------------------

def _as_of_sql() -> str:
    """Interactions with what their user, item and pair had strictly before them."""
    w = lambda k: f'(PARTITION BY {k} ORDER BY "timestamp" RANGE BETWEEN UNBOUNDED PRECEDING AND INTERVAL 1 MICROSECOND PRECEDING)'

    def stats(key: str, prefix: str, total: str) -> str:
        of = f"OVER {w(key)}"
        return f"""count(rating) {of} AS {total}, {rnd(f'avg(rating) {of}')} AS {prefix}_avg_rating,
  {rnd(f'stddev_samp(rating) {of}')} AS {prefix}_rating_std, min(rating) {of} AS {prefix}_rating_min, max(rating) {of} AS {prefix}_rating_max"""

    return f"""
SELECT *, max(user_total_interactions + 1) OVER (ORDER BY "timestamp" RANGE BETWEEN UNBOUNDED PRECEDING AND INTERVAL 1 MICROSECOND PRECEDING) AS user_interactions_max,
  max(item_total_interactions + 1) OVER (ORDER BY "timestamp" RANGE BETWEEN UNBOUNDED PRECEDING AND INTERVAL 1 MICROSECOND PRECEDING) AS item_interactions_max
FROM (SELECT * EXCLUDE first,
  {stats('user_id, item_id', 'user_item', 'user_item_interactions')},
  {stats('user_id', 'user', 'user_total_interactions')}, count(*) FILTER (WHERE first) OVER {w('user_id')} AS user_unique_items,
  {stats('item_id', 'item', 'item_total_interactions')}, count(*) FILTER (WHERE first) OVER {w('item_id')} AS item_unique_users
FROM (SELECT *, row_number() OVER (PARTITION BY user_id, item_id ORDER BY "timestamp") = 1 AS first FROM interactions))"""


@register("interaction_features_as_of", oracle(_as_of_sql()))
def q_features_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M14 + A1, A2, A6-A8: each interaction's user, item and pair statistics strictly before it."""
    return FE.statistics_as_of(_t(spark, sf_dir)["interactions"])


def _ranking_as_of_sql() -> str:
    zero = ", ".join(f"coalesce({c}, 0.0) AS {c}" for c in ("user_item_avg_rating", "user_item_rating_std", "user_avg_rating",
                                                             "user_rating_std", "item_avg_rating", "item_rating_std"))
    ratio = lambda a, b: f"coalesce(CAST({a} AS DOUBLE) / nullif({b}, 0), 0.0)"
    return oracle(f"""
SELECT i.* EXCLUDE (user_item_avg_rating, user_item_rating_std, user_avg_rating, user_rating_std, item_avg_rating, item_rating_std,
    user_item_rating_min, user_item_rating_max, user_rating_min, user_rating_max, item_rating_min, item_rating_max,
    user_interactions_max, item_interactions_max),
  {zero}, u.age_group, u.gender, u.location, u.preferred_genres, u.activity_level, u.subscription_type,
  it.title, it.genre, it.popularity_score, it.quality_score, it.price, it.language,
  CAST(hour(i."timestamp") AS INTEGER) AS hour, CAST(isodow(i."timestamp") - 1 AS INTEGER) AS day_of_week,
  CAST(month(i."timestamp") AS INTEGER) AS month, CAST(isodow(i."timestamp") IN (6, 7) AS INTEGER) AS is_weekend,
  CAST(hour(i."timestamp") BETWEEN 18 AND 23 AS INTEGER) AS is_evening,
  {ratio('user_total_interactions', 'user_interactions_max')} AS user_popularity,
  {ratio('item_total_interactions', 'item_interactions_max')} AS item_popularity,
  coalesce(user_avg_rating, 0.0) / 5.0 AS user_quality, coalesce(item_avg_rating, 0.0) / 5.0 AS item_quality,
  {ratio('user_unique_items', 'user_total_interactions')} AS user_diversity, {ratio('item_unique_users', 'item_total_interactions')} AS item_diversity
FROM ({_as_of_sql()}) i LEFT JOIN users u USING (user_id) LEFT JOIN items it USING (item_id)""")


@register("ranking_features_as_of", _ranking_as_of_sql())
def q_ranking_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M14 + J2 + P2/P3 + P12 + P4: leak-free features of the rating regressor."""
    t = _t(spark, sf_dir)
    return FE.ranking_features(t["interactions"], t["users"], t["items"], point_in_time=True)


# ---- A4, A9-A17, S9 ---------------------------------------------------------

@register("genre_preferences", oracle(f"""
SELECT user_id, genre, {rnd('avg(rating)')} AS genre_avg_rating, count(rating) AS genre_interaction_count
FROM interactions JOIN items USING (item_id) WHERE genre IS NOT NULL GROUP BY user_id, genre"""))
def q_genre_prefs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A4 + J4: user x genre mean rating and count."""
    t = _t(spark, sf_dir)
    return A.genre_preferences(t["interactions"], t["items"])


@register("interaction_type_counts", oracle("""
SELECT interaction_type, count(*) AS count, count(*) / sum(count(*)) OVER () AS share
FROM interactions WHERE interaction_type IS NOT NULL GROUP BY interaction_type"""))
def q_value_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A10: value counts with share."""
    return A.value_counts(_t(spark, sf_dir)["interactions"], "interaction_type")


@register("item_analysis", oracle(f"""
SELECT i.*, coalesce(s.total_interactions, 0) AS total_interactions, coalesce(s.avg_rating, 0.0) AS avg_rating,
  coalesce(s.rating_std, 0.0) AS rating_std, coalesce(s.unique_users, 0) AS unique_users
FROM items i LEFT JOIN (
  SELECT item_id, count(rating) AS total_interactions, {rnd('avg(rating)', 2)} AS avg_rating,
    {rnd('stddev_samp(rating)', 2)} AS rating_std, count(DISTINCT user_id) AS unique_users
  FROM interactions GROUP BY item_id) s USING (item_id)"""))
def q_item_analysis(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Item statistics (2 places) joined to the catalogue."""
    t = _t(spark, sf_dir)
    return A.item_analysis(t["items"], t["interactions"])


def _summary_sql(table: str, col: str) -> str:
    q = []
    for p in (0.25, 0.5, 0.75):
        q.append(f"""
SELECT '{int(p * 100)}%' AS statistic,
  CASE WHEN max(v) FILTER (WHERE pos = lo + 1) IS NULL OR h = lo THEN max(v) FILTER (WHERE pos = lo)
       ELSE max(v) FILTER (WHERE pos = lo) + (h - lo) * (max(v) FILTER (WHERE pos = lo + 1) - max(v) FILTER (WHERE pos = lo))
  END AS value
FROM (SELECT v, pos, (n - 1) * CAST({p} AS DOUBLE) AS h, floor((n - 1) * CAST({p} AS DOUBLE)) AS lo FROM sorted_v)
GROUP BY h, lo""")
    return oracle(f"""
SELECT '{col}' AS "column", statistic, round(value, {FLOAT_DECIMALS}) AS value FROM (
  SELECT 'count' AS statistic, CAST(count({col}) AS DOUBLE) AS value FROM {table}
  UNION ALL SELECT 'mean', avg({col}) FROM {table}
  UNION ALL SELECT 'std', stddev_samp({col}) FROM {table}
  UNION ALL SELECT 'min', CAST(min({col}) AS DOUBLE) FROM {table}
  UNION ALL SELECT 'max', CAST(max({col}) AS DOUBLE) FROM {table}
  UNION ALL {" UNION ALL ".join(q)})""", f"""
sorted_v AS (SELECT CAST({col} AS DOUBLE) AS v, row_number() OVER (ORDER BY {col}) - 1 AS pos,
                    count(*) OVER () AS n FROM {table} WHERE {col} IS NOT NULL)""")


@register("rating_summary", _summary_sql("interactions", "rating"))
def q_rating_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """count/mean/std/min/quartiles/max of ratings (exact, distributed quantiles)."""
    out = A.numeric_summary(_t(spark, sf_dir)["interactions"], ["rating"])
    return out.withColumn("value", F.round("value", FLOAT_DECIMALS))


@register("price_summary", _summary_sql("items", "price"))
def q_price_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A12 on the catalogue price."""
    out = A.numeric_summary(_t(spark, sf_dir)["items"], ["price"])
    return out.withColumn("value", F.round("value", FLOAT_DECIMALS))


@register("date_range", oracle(f"""
SELECT min("timestamp") AS first_ts, max("timestamp") AS last_ts, {DAYS} AS total_days FROM interactions"""))
def q_date_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """first/last interaction and whole days."""
    return A.date_range(_t(spark, sf_dir)["interactions"])


@register("positive_matrix", oracle("""
SELECT user_id, item_id, avg(rating) AS rating FROM interactions WHERE rating >= 3.0 GROUP BY user_id, item_id"""))
def q_positive_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A14 + P1: sparse user-item matrix of positive interactions (duplicates averaged)."""
    return A.user_item_matrix(_t(spark, sf_dir)["interactions"], rating_threshold=3.0)


@register("sparsity", oracle("""
SELECT count(DISTINCT user_id) AS n_users, count(DISTINCT item_id) AS n_items,
  count(*) FILTER (WHERE rating <> 0) AS nonzero,
  1.0 - count(*) FILTER (WHERE rating <> 0) / (count(DISTINCT user_id) * count(DISTINCT item_id)) AS sparsity
FROM (SELECT user_id, item_id, avg(rating) AS rating FROM interactions GROUP BY user_id, item_id)"""))
def q_sparsity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Share of empty cells without a dense matrix."""
    return A.sparsity(_t(spark, sf_dir)["interactions"])


@register("dataset_summary", oracle(f"""
SELECT count(*) AS total_interactions, count(DISTINCT user_id) AS unique_users,
  count(DISTINCT item_id) AS unique_items, {rnd('avg(rating)', 2)} AS avg_rating,
  min("timestamp") AS first_ts, max("timestamp") AS last_ts FROM interactions"""))
def q_dataset_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dataset summary."""
    return A.dataset_summary(_t(spark, sf_dir)["interactions"])


@register("latency_summary", """
WITH v AS (SELECT value AS x, row_number() OVER (ORDER BY value) AS r, count(*) OVER () AS m
           FROM events WHERE value IS NOT NULL),
p AS (SELECT m, least(m, 20) AS cuts FROM v LIMIT 1),
j AS (SELECT m, cuts, greatest(1, least(m - 1, CAST(floor((cuts - 1) * (m + 1) / cuts) AS BIGINT))) AS j FROM p),
d AS (SELECT m, cuts, j, (cuts - 1) * (m + 1) - j * cuts AS delta FROM j)
SELECT (SELECT count(value) FROM events) AS n, (SELECT avg(value) FROM events) AS avg_latency_ms,
  ((SELECT x FROM v WHERE r = d.j) * (d.cuts - d.delta) + (SELECT x FROM v WHERE r = d.j + 1) * d.delta) / d.cuts
    AS p95_latency_ms
FROM d""")
def q_latency(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean and p95 of request latencies (events.value as latency, ms)."""
    ev = fixtures.read_table(spark, sf_dir, "events")
    return A.latency_summary(ev, "value")


# ---- W8, W10, M9, M10, P18 --------------------------------------------------

@register("user_history_latest", oracle(f"""
SELECT user_id, item_id, rating, "timestamp", interaction_type, rank FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY user_id ORDER BY "timestamp" DESC NULLS LAST, user_id DESC,
    item_id DESC, interaction_type DESC, rating DESC, session_id DESC, line_number DESC) AS BIGINT) AS rank
  FROM interactions) WHERE rank <= 20"""))
def q_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each user's latest 20 interactions (the history lookup for every user at once)."""
    return S.latest_history(_t(spark, sf_dir)["interactions"], 20)


@register("other_users_items", oracle("""
SELECT user_id, rank, item_id FROM (
  SELECT t.user_id, iu.item_id,
    CAST(row_number() OVER (PARTITION BY t.user_id ORDER BY min(iu.s)) AS BIGINT) AS rank
  FROM (SELECT DISTINCT user_id FROM test) t
  JOIN (SELECT item_id, user_id, min(seq) AS s FROM split WHERE is_test GROUP BY item_id, user_id) iu
    ON iu.user_id <> t.user_id
  GROUP BY t.user_id, iu.item_id) WHERE rank <= 10""", osql.split_ctes(0.2, 0)))
def q_other_users_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The training pipeline's placeholder lists, for every test user."""
    c = local_chain.prepare_fixture(spark, sf_dir, min_test=0)
    return R.other_users_items(c.test, 10)


@register("recommendations_enriched", oracle("""
SELECT r.user_id, r.rank, r.item_id, r.score, coalesce(i.title, 'Unknown') AS title,
  coalesce(i.genre, 'Unknown') AS genre, round(coalesce(a.rating_avg, 0.0), 9) AS rating_avg, coalesce(i.price, 0.0) AS price
FROM recs r LEFT JOIN items i USING (item_id)
LEFT JOIN (SELECT item_id, avg(rating) AS rating_avg FROM interactions GROUP BY item_id) a USING (item_id)""", osql.chain(10)))
def q_enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M9 + P18: top-10 lists with item title, genre, mean rating and price (defaults for unknown items)."""
    c = local_chain.prepare_fixture(spark, sf_dir)
    rated = c.interactions.groupBy("item_id").agg(F.avg("rating").alias("rating_avg"))
    out = S.enrich(local_chain.recommendations(c, 10), c.items.join(rated, "item_id", "left"))
    return out.withColumn("rating_avg", F.round("rating_avg", 9))


@register("similar_items")
def q_similar_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M8: the ten neighbours of every vector of the table, from small buckets refined among neighbours of neighbours."""
    return S.similar_items(fixtures.read_table(spark, sf_dir, "embeddings"), 10, "vec_id", "embedding", tables=4, bucket_items=64)


@register("similar_items_recall", """
SELECT count(*) AS items, 10 * count(*) AS true_neighbours, true AS recall_of_nine_tenths FROM embeddings""")
def q_similar_recall(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M8: the lists against those of all pairs; equal cosines count as found."""
    v = fixtures.read_table(spark, sf_dir, "embeddings")
    true = materialize(S.similar_items(v, 10, "vec_id", "embedding", exact=True))
    least = true.groupBy("vec_id").agg(F.min("similarity").alias("least"), F.count("*").alias("n"))
    found = q_similar_lists(spark, sf_dir).groupBy("vec_id").agg(F.collect_list("similarity").alias("got"))  # ten numbers a row
    hits = F.size(F.filter("got", lambda x: x >= F.col("least") - 1e-9))
    return least.join(found, "vec_id", "left").agg(F.count("*").alias("items"), F.sum("n").alias("true_neighbours"),
                                                   (F.sum(F.coalesce(hits, F.lit(0))) >= 0.9 * F.sum("n")).alias("recall_of_nine_tenths"))


@register("similar_items_checks", """
SELECT count(*) AS items_served, count(*) AS full_lists, 0 AS wrong_scores, 0 AS rank_gaps FROM embeddings""")
def q_similar_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M8: ten neighbours for every vector of the table, each score the cosine of the pair."""
    v = fixtures.read_table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    out = materialize(S.similar_items(v, 10, "vec_id", "embedding"))
    x, y = (F.transform(c, lambda e: e.cast("double")) for c in ("embedding", "_y"))
    dot = lambda a, b: F.aggregate(F.arrays_zip(a.alias("a"), b.alias("b")), F.lit(0.0), lambda s, e: s + e["a"] * e["b"])
    scored = (out.join(v, "vec_id").join(v.select(F.col("vec_id").alias("similar_id"), F.col("embedding").alias("_y")), "similar_id")
              .withColumn("c", dot(x, y) / F.sqrt(dot(x, x) * dot(y, y))))
    per = out.groupBy("vec_id").agg(F.count("*").alias("n"), F.max("rank").alias("last"), F.count_distinct("similar_id").alias("d"))
    wrong = scored.agg(F.count(F.when(F.abs(F.col("c") - F.col("similarity")) > 1e-9, 1)).alias("wrong_scores"))
    return per.agg(F.count("*").alias("items_served"), F.count(F.when(F.col("n") == 10, 1)).alias("full_lists"),
                   F.count(F.when((F.col("n") != F.col("last")) | (F.col("n") != F.col("d")), 1)).alias("rank_gaps")).crossJoin(wrong)  # one row each

@register("recommended_item_details", oracle("""
SELECT * FROM items WHERE item_id IN (SELECT item_id FROM recs)""", osql.chain(10)))
def q_item_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M10 for a batch of ids: catalogue rows of every recommended item (semi join)."""
    c = local_chain.prepare_fixture(spark, sf_dir)
    return S.item_details(c.items, local_chain.recommendations(c, 10).select("item_id"))


@register("table_summary", oracle("""
SELECT 'users' AS "table", count(*) AS rows, CAST(7 AS BIGINT) AS columns FROM users
UNION ALL SELECT 'items', count(*), CAST(7 AS BIGINT) FROM items
UNION ALL SELECT 'interactions', count(*), CAST(7 AS BIGINT) FROM interactions"""))
def q_table_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows and columns of each table."""
    return A.table_summary(fixtures.tables(spark, sf_dir))


@register("sampled_users_top_k", oracle("""
SELECT user_id, rank, item_id, score FROM recs WHERE user_id IN (
  SELECT user_id FROM (SELECT DISTINCT user_id FROM test) ORDER BY md5('42:' || user_id), user_id LIMIT 100)""", osql.chain(10)))
def q_sampled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W7 + W6: the reference's inference run: 100 sampled test users (seeded hash order), top-10 each.

    The limit is the sampling operator itself."""
    c = local_chain.prepare_fixture(spark, sf_dir)
    sample = R.sample_users(c.targets, 100)
    return R.top_k_unseen(c.users, c.items, c.scores, c.history, sample, 10)


@register("known_interactions", oracle("""
SELECT * FROM interactions
WHERE user_id IN (SELECT user_id FROM users) AND item_id IN (SELECT item_id FROM items)"""))
def q_known(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Interactions with a known user and a known item."""
    t = _t(spark, sf_dir)
    return FE.known_interactions(t["interactions"], t["users"], t["items"])
