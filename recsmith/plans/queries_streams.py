"""Registered stream forms (T1-T4, T6, T7, T8, T10, T13), deletion by age (T14) and source / sink round trips.

Streams run with ``availableNow`` over the events table into files, and the files are the result.  A window is final once the
watermark has passed its end, so the oracles hold the batch result of the closed windows.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recsmith.operators import aggregates as A
from recsmith.operators import encoders as E
from recsmith.operators import retention
from recsmith.plans import local_chain
from recsmith.plans import oracle_sql as osql
from recsmith.plans.catalog import register
from recsmith.plans.queries_monitoring import _SESSIONS_CTE
from recsmith.session import ensure_checkpoint_dir
from recsmith.sources import fixtures, io
from recsmith.sources.fixtures import oracle
from recsmith.streaming import monitoring as M
from recsmith.streaming import running


def _folder(spark: SparkSession) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/roundtrip/{uuid.uuid4().hex}"


def _event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = fixtures.read_table(spark, sf_dir, "events")
    raw = spark.readStream.schema(table.schema).parquet(f"{sf_dir.rstrip('/')}/events.parquet*")  # a file or a folder
    return raw.withColumn("ts", F.col("ts").cast("timestamp"))


def _run(spark: SparkSession, out: DataFrame) -> DataFrame:
    folder = _folder(spark)
    M.write_stream(out, f"{folder}/out", f"{folder}/checkpoint", trigger_once=True).awaitTermination()
    return spark.read.schema(out.schema).parquet(f"{folder}/out")


def _closed(window: str, delay: str, body: str) -> str:
    return f"""SELECT * FROM (SELECT time_bucket(INTERVAL {window}, ts) AS window_start,
  time_bucket(INTERVAL {window}, ts) + INTERVAL {window} AS window_end, {body} FROM events GROUP BY 1)
WHERE window_end <= (SELECT max(ts) FROM events) - INTERVAL {delay}"""


@register("stream_request_metrics", _closed("60 SECOND", "2 MINUTE", """count(*) AS n_requests, count(*) / 60 AS request_rate,
  avg(CASE WHEN event_type = 'error' THEN 1.0 ELSE 0.0 END) AS error_rate, round(avg(value), 9) AS mean_latency_ms,
  avg(CASE WHEN event_type = 'error' THEN 1.0 ELSE 0.0 END) > 0.05 AS error_alert, avg(value) > 1000.0 AS latency_alert,
  quantile_disc(value, 0.95) AS p95_latency_ms, quantile_disc(value, 0.95) > 500.0 AS p95_alert"""))
def q_stream_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T1-T4 on a stream, with all alert flags (a minute holds fewer values than the sketch keeps, so p95 is exact here)."""
    return _run(spark, M.stream_request_metrics(_event_stream(spark, sf_dir))).withColumn("mean_latency_ms", F.round("mean_latency_ms", 9))


@register("stream_click_through", _closed("3600 SECOND", "1 HOUR", """count(*) FILTER (WHERE event_type = 'click') AS clicks,
  count(*) FILTER (WHERE event_type = 'view') AS views,
  count(*) FILTER (WHERE event_type = 'click') / nullif(count(*) FILTER (WHERE event_type = 'view'), 0) AS ctr,
  count(*) FILTER (WHERE event_type = 'click') / nullif(count(*) FILTER (WHERE event_type = 'view'), 0) < 0.02 AS ctr_alert"""))
def q_stream_ctr(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T6 on a stream."""
    return _run(spark, M.stream_click_through(_event_stream(spark, sf_dir)))


@register("stream_active_users", _closed("86400 SECOND", "1 HOUR",
                                         "count(DISTINCT user_id) AS active_users, count(DISTINCT user_id) < 1000 AS alert"))
def q_stream_active(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T7 on a stream."""
    return _run(spark, M.stream_active_users(_event_stream(spark, sf_dir)))


_HOURLY = _closed("3600 SECOND", "1 HOUR", "avg(CASE WHEN event_type = 'error' THEN 1.0 ELSE 0.0 END) > 0.05 AS firing")


@register("stream_error_incidents", f"""
WITH w AS ({_HOURLY}), m AS (SELECT max(window_start) AS newest FROM w),
f AS (SELECT window_start, epoch(window_start) // 3600 - row_number() OVER (ORDER BY window_start) AS run FROM w WHERE firing),
r AS (SELECT min(window_start) AS s, max(window_start) + INTERVAL 1 HOUR AS e, count(*) AS n FROM f GROUP BY run HAVING count(*) >= 2),
i AS (SELECT *, sum(opens) OVER (ORDER BY s) AS inc FROM (SELECT *, CASE WHEN s - lag(e) OVER (ORDER BY s) < INTERVAL 3 HOUR THEN 0 ELSE 1 END AS opens FROM r))
SELECT 'error_rate' AS metric, 'alert' AS kind, s AS alert_start, e AS alert_end, n FROM r, m WHERE e <= newest
UNION ALL SELECT 'error_rate', 'incident', min(s), max(e), count(*) FROM i, m GROUP BY inc, newest HAVING max(e) + INTERVAL 3 HOUR <= newest""")
def q_stream_incidents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T8 on a stream: alerts (error rate over 5 % for 2 hourly windows) and incidents (closed after 3 quiet hours), from the files
    of the hourly metrics' own stream; event-time timers end what no later window ends."""
    folder = _folder(spark)
    hourly = M.stream_request_metrics(_event_stream(spark, sf_dir), "3600 seconds", "1 hour")
    M.write_stream(hourly, f"{folder}/hourly", f"{folder}/hourly_checkpoint", trigger_once=True).awaitTermination()
    windows = spark.readStream.schema(hourly.schema).parquet(f"{folder}/hourly")
    out = _run(spark, M.stream_sustained_alerts(windows, "error_alert", "error_rate", 3600, 2 * 3600, 3 * 3600))
    return out.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("alert_start", "alert_end")})


@register("stream_user_stats", """
SELECT user_id, count(value) AS rating_count, round(avg(value), 6) AS rating_mean, round(stddev_samp(value), 6) AS rating_std,
  min(value) AS rating_min, max(value) AS rating_max, min(ts) AS timestamp_min, max(ts) AS timestamp_max,
  count(DISTINCT event_type) AS partners FROM events GROUP BY user_id""")
def q_stream_user_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Running statistics per user from the stream (five event types: the distinct sketch is exact here)."""
    folder = _folder(spark)
    M.running_stats(_event_stream(spark, sf_dir), "user_id", "value", "ts", "event_type", f"{folder}/out", f"{folder}/checkpoint").awaitTermination()
    out = M.read_running_stats(spark, f"{folder}/out", "user_id")
    return (out.withColumn("rating_mean", F.round("rating_mean", 6)).withColumn("rating_std", F.round("rating_std", 6))
            .withColumn("timestamp_min", F.col("timestamp_min").cast("timestamp_ntz"))
            .withColumn("timestamp_max", F.col("timestamp_max").cast("timestamp_ntz")))


def _running_sql(key: str, other: str) -> str:
    return oracle(f"""
SELECT {key}, count(rating) AS rating_count, round(avg(rating), 6) AS rating_mean, round(stddev_samp(rating), 6) AS rating_std,
  CAST(min(rating) AS DOUBLE) AS rating_min, CAST(max(rating) AS DOUBLE) AS rating_max, min("timestamp") AS timestamp_min,
  max("timestamp") AS timestamp_max, count(DISTINCT {other}) AS partners FROM interactions GROUP BY {key}""")


def _running(spark: SparkSession, sf_dir: str, key: str, other: str) -> DataFrame:
    schema = fixtures.read_table(spark, sf_dir, "lineitem").schema
    lines = spark.readStream.schema(schema).parquet(f"{sf_dir.rstrip('/')}/lineitem.parquet*")
    stream = fixtures.interactions_of(lines, fixtures.read_table(spark, sf_dir, "orders"))
    folder = _folder(spark)
    running.keep_running(stream, f"{folder}/out", f"{folder}/checkpoint", key, "rating", "timestamp", other).awaitTermination()
    return running.read(spark, f"{folder}/out", key).withColumns({c: F.round(c, 6) for c in ("rating_mean", "rating_std")})


@register("running_user_stats", _running_sql("user_id", "item_id"))
def q_running_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A1 from mergeable states of a stream of interactions (at the test sizes the distinct sketch holds a user's items exactly)."""
    return _running(spark, sf_dir, "user_id", "item_id")


@register("running_item_stats", _running_sql("item_id", "user_id"))
def q_running_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T13, item side: A2 from mergeable states of a stream of interactions."""
    return _running(spark, sf_dir, "item_id", "user_id")


@register("stream_sessions", f"""WITH {_SESSIONS_CTE}
SELECT * FROM sess WHERE session_end <= (SELECT max(ts) FROM events) - INTERVAL 1 HOUR""")
def q_stream_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T10 on a stream: the sessions that have ended."""
    return _run(spark, M.stream_sessions(_event_stream(spark, sf_dir)))


@register("stream_engagement", f"""WITH {_SESSIONS_CTE}
SELECT * FROM (SELECT time_bucket(INTERVAL 1 DAY, session_end - INTERVAL 1 MICROSECOND) AS window_start,
  time_bucket(INTERVAL 1 DAY, session_end - INTERVAL 1 MICROSECOND) + INTERVAL 1 DAY AS window_end, count(*) AS n_sessions,
  round(avg((epoch_us(session_end) - epoch_us(session_start)) / 1e6), 6) AS mean_session_seconds, round(avg(n_events), 6) AS events_per_session,
  round(avg(CASE WHEN n_purchases > 0 THEN 1.0 ELSE 0.0 END), 6) AS session_conversion FROM sess GROUP BY 1)
WHERE window_end <= (SELECT max(ts) FROM events) - INTERVAL 1 HOUR""")
def q_stream_engagement(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T10 on a stream: engagement by the day in which sessions end."""
    out = _run(spark, M.stream_engagement(_event_stream(spark, sf_dir)))
    return out.withColumns({c: F.round(c, 6) for c in ("mean_session_seconds", "events_per_session", "session_conversion")})


# ---- deletion by age -----------------------------------------------------------

def _retained(spark: SparkSession, sf_dir: str) -> str:
    """The events as a table by day, cut twice; the second run is repeated and changes nothing."""
    root, events = _folder(spark), fixtures.read_table(spark, sf_dir, "events")
    retention.create(spark, root, events.schema, "ts")
    retention.write_days(events, root)
    for as_of in ("2025-01-08 00:00:00", "2025-01-15 09:30:00", "2025-01-15 09:30:00"):
        retention.retain(spark, root, as_of, M.RETENTION_DAYS)
    return root


@register("retained_events", "SELECT * FROM events WHERE ts >= TIMESTAMP '2025-01-15 09:30:00' - INTERVAL 365 DAY")
def q_retained(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the table holds after its old rows were deleted."""
    return retention.read(spark, _retained(spark, sf_dir))


@register("retained_days", """
SELECT CAST(ts AS DATE) AS kept_day, count(*) AS n FROM events WHERE ts >= TIMESTAMP '2025-01-15 09:30:00' - INTERVAL 365 DAY GROUP BY 1""")
def q_retained_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row that lies in the table's folders, by day, whatever its state says: no file of an older day is left."""
    stored = spark.read.parquet(f"{_retained(spark, sf_dir)}/rows")
    return stored.groupBy("kept_day").agg(F.count(F.lit(1)).alias("n"))


# ---- round trips ---------------------------------------------------------------

def _written_interactions(spark: SparkSession, sf_dir: str, folder: str) -> None:
    i = fixtures.interactions(spark, sf_dir)
    extra = {"device_type": F.lit(None).cast("string"), "duration_seconds": F.lit(None).cast("long")}
    (i.withColumns(extra).select(*[f.name for f in io.INTERACTIONS.fields])
     .write.option("header", True).csv(f"{folder}/interactions"))


@register("csv_interactions", oracle("""
SELECT CAST(user_id AS VARCHAR) AS user_id, CAST(item_id AS VARCHAR) AS item_id, interaction_type, rating, "timestamp",
  CAST(session_id AS VARCHAR) AS session_id, CAST(NULL AS VARCHAR) AS device_type, CAST(NULL AS BIGINT) AS duration_seconds FROM interactions"""))
def q_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Interactions written as CSV and read with the declared schema."""
    folder = _folder(spark)
    _written_interactions(spark, sf_dir, folder)
    out = io.read_table(spark, f"{folder}/interactions", "interactions")
    return out.withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz"))


@register("optional_tables", oracle("""
SELECT 'interactions' AS "table", count(*) AS rows, 8 AS columns, 0 AS corrupt FROM interactions
UNION ALL SELECT 'users', 0, 8, 0 UNION ALL SELECT 'items', 0, 11, 0"""))
def q_optional(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Absent optional tables are empty tables of their schema; no written row is corrupt."""
    folder = _folder(spark)
    _written_interactions(spark, sf_dir, folder)
    out = A.table_summary(io.load_tables(spark, f"{folder}/interactions"))
    bad = io.corrupt_rows(spark, f"{folder}/interactions", "interactions").select(F.col("n_corrupt")).scalar()
    return out.withColumn("corrupt", F.when(F.col("table") == "interactions", bad).otherwise(0))


@register("saved_features", oracle("""
SELECT user_id, genre, count(rating) AS genre_interaction_count FROM interactions JOIN items USING (item_id)
WHERE genre IS NOT NULL GROUP BY user_id, genre"""))
def q_saved_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S3: a feature table saved and read back."""
    folder, t = _folder(spark), fixtures.tables(spark, sf_dir)
    io.save_features({"genre_preferences": A.genre_preferences(t["interactions"], t["items"])}, folder)
    return spark.read.parquet(f"{folder}/genre_preferences").drop("genre_avg_rating")


@register("saved_encoder", oracle("""
SELECT item_id, dense_rank() OVER (ORDER BY genre) - 1 AS genre_encoded FROM items"""))
def q_saved_encoder(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A fitted encoder saved, read back and applied."""
    folder, items = _folder(spark), fixtures.items(spark, sf_dir)
    E.save_lookup(E.fit_label_encoder(items, "genre"), f"{folder}/genre")
    return E.apply_label_encoder(items, "genre", spark.read.parquet(f"{folder}/genre")).select("item_id", "genre_encoded")


@register("saved_recommendations", oracle("""
SELECT CAST(user_id AS VARCHAR) AS user_id, rank, item_id FROM recs""", osql.chain(10)))
def q_saved_recs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Recommendation lists saved per user and read back in long form."""
    folder = _folder(spark)
    io.save_recommendations(local_chain.recommendations(local_chain.prepare_fixture(spark, sf_dir), 10), folder)
    return io.load_recommendations(spark, folder, "bigint")


@register("saved_metrics", oracle("""
SELECT 'interactions' AS metric, CAST(count(*) AS DOUBLE) AS value FROM interactions
UNION ALL SELECT 'users', CAST(count(DISTINCT user_id) AS DOUBLE) FROM interactions"""))
def q_saved_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metric results saved as JSON and CSV; both agree."""
    folder, i = _folder(spark), fixtures.interactions(spark, sf_dir)
    long = A.dataset_summary(i).selectExpr("stack(2, 'interactions', double(total_interactions), 'users', double(unique_users)) AS (metric, value)")
    io.save_metrics(long, folder)
    schema = "metric string, value double"
    return spark.read.schema(schema).json(f"{folder}/json").intersect(spark.read.schema(schema).option("header", True).csv(f"{folder}/csv"))


@register("request_log", """
SELECT CAST(user_id AS VARCHAR) AS key, CAST(10 AS BIGINT) AS k, value AS processing_time_ms, ts AS "timestamp" FROM events""")
def q_request_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Request rows appended in two writes and read back."""
    folder = _folder(spark)
    rows = fixtures.read_table(spark, sf_dir, "events").select(
        "event_id", F.col("user_id").cast("string").alias("key"), F.lit(10).alias("k"), F.col("value").alias("processing_time_ms"),
        F.col("ts").alias("timestamp"))
    for part in (0, 1):
        io.append_request_log(spark, folder, rows.where(F.col("event_id") % 2 == part).drop("event_id"))
    return io.read_request_log(spark, folder).withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz"))
