"""Registered monitoring queries (T1-T12, T14) over the events table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recsmith.plans import local_chain
from recsmith.plans import oracle_sql as osql
from recsmith.plans.catalog import register
from recsmith.sources import fixtures
from recsmith.sources.fixtures import oracle
from recsmith.streaming import monitoring as M

D = 9  # printed precision of floating means


def _ev(spark, sf_dir):
    return fixtures.read_table(spark, sf_dir, "events")


@register("request_metrics_per_minute", """
SELECT time_bucket(INTERVAL 60 SECOND, ts) AS window_start,
  time_bucket(INTERVAL 60 SECOND, ts) + INTERVAL 60 SECOND AS window_end,
  count(*) AS n_requests, count(*) / 60 AS request_rate,
  avg(CASE WHEN event_type = 'error' THEN 1.0 ELSE 0.0 END) AS error_rate,
  round(avg(value), 9) AS mean_latency_ms,
  avg(CASE WHEN event_type = 'error' THEN 1.0 ELSE 0.0 END) > 0.05 AS error_alert,
  avg(value) > 1000.0 AS latency_alert
FROM events GROUP BY 1""")
def q_request_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T1 + T2 + T4: requests, rate, error rate, mean latency and alert flags per minute."""
    return M.request_metrics(_ev(spark, sf_dir)).withColumn("mean_latency_ms", F.round("mean_latency_ms", D))


@register("latency_percentiles_per_minute", """
SELECT time_bucket(INTERVAL 60 SECOND, ts) AS window_start,
  round(quantile_cont(value, 0.5), 9) AS p50_ms, round(quantile_cont(value, 0.95), 9) AS p95_ms,
  round(quantile_cont(value, 0.99), 9) AS p99_ms, quantile_cont(value, 0.95) > 500.0 AS p95_alert
FROM events WHERE value IS NOT NULL GROUP BY 1""")
def q_latency_pct(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T3 + T9: exact latency P50/P95/P99 per minute (distributed ranks)."""
    out = M.latency_percentiles(_ev(spark, sf_dir))
    return out.select("window_start", *[F.round(c, D).alias(c) for c in ("p50_ms", "p95_ms", "p99_ms")], "p95_alert")


@register("click_through_per_hour", """
SELECT time_bucket(INTERVAL 3600 SECOND, ts) AS window_start,
  time_bucket(INTERVAL 3600 SECOND, ts) + INTERVAL 3600 SECOND AS window_end,
  count(*) FILTER (WHERE event_type = 'click') AS clicks, count(*) FILTER (WHERE event_type = 'view') AS views,
  CAST(count(*) FILTER (WHERE event_type = 'click') AS DOUBLE)
    / nullif(count(*) FILTER (WHERE event_type = 'view'), 0) AS ctr,
  CAST(count(*) FILTER (WHERE event_type = 'click') AS DOUBLE)
    / nullif(count(*) FILTER (WHERE event_type = 'view'), 0) < 0.02 AS ctr_alert
FROM events GROUP BY 1""")
def q_ctr(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Click-through per hour and the low-CTR flag."""
    return M.click_through(_ev(spark, sf_dir))


@register("active_users_per_day", """
SELECT time_bucket(INTERVAL 86400 SECOND, ts) AS window_start,
  time_bucket(INTERVAL 86400 SECOND, ts) + INTERVAL 86400 SECOND AS window_end,
  count(DISTINCT user_id) AS active_users, count(DISTINCT user_id) < 1000 AS alert
FROM events GROUP BY 1""")
def q_active(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct active users per day and the low-activity flag."""
    return M.active_users(_ev(spark, sf_dir))


@register("error_alerts_hourly", """
WITH w AS (
  SELECT time_bucket(INTERVAL 3600 SECOND, ts) AS window_start,
    avg(CASE WHEN event_type = 'error' THEN 1.0 ELSE 0.0 END) > 0.05 AS firing
  FROM events GROUP BY 1),
f AS (SELECT window_start, CAST(epoch_us(window_start) // 3600000000 AS BIGINT) AS wno FROM w WHERE firing),
r AS (SELECT window_start, wno - (row_number() OVER (ORDER BY wno) - 1) AS run FROM f)
SELECT min(window_start) AS alert_start, max(window_start) + INTERVAL 3600 SECOND AS alert_end,
  count(*) AS n_windows
FROM r GROUP BY run HAVING count(*) >= 5""")
def q_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Error-rate alerts held for 5 consecutive hourly windows (gaps and islands)."""
    flags = M.request_metrics(_ev(spark, sf_dir), "3600 seconds")
    return M.sustained_alerts(flags, "error_alert", 3600, 5 * 3600)


_SESSIONS_CTE = """
s0 AS (SELECT user_id, ts, event_type,
         CASE WHEN lag(ts) OVER (PARTITION BY user_id ORDER BY ts) IS NULL
                OR ts > lag(ts) OVER (PARTITION BY user_id ORDER BY ts) + INTERVAL 30 MINUTE
              THEN 1 ELSE 0 END AS new_session
       FROM events),
s1 AS (SELECT *, sum(new_session) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS sid FROM s0),
sess AS (SELECT user_id, min(ts) AS session_start, max(ts) + INTERVAL 30 MINUTE AS session_end,
           count(*) AS n_events, count(*) FILTER (WHERE event_type = 'purchase') AS n_purchases
         FROM s1 GROUP BY user_id, sid)"""


@register("sessions", f"WITH {_SESSIONS_CTE} SELECT * FROM sess")
def q_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-user session windows (30-minute gap)."""
    return M.sessions(_ev(spark, sf_dir))


@register("engagement", f"""WITH {_SESSIONS_CTE}
SELECT count(*) AS n_sessions,
  round(avg((epoch_us(session_end) - epoch_us(session_start)) / 1e6), 9) AS mean_session_seconds,
  round(avg(n_events), 9) AS events_per_session,
  round(avg(CASE WHEN n_purchases > 0 THEN 1.0 ELSE 0.0 END), 9) AS session_conversion
FROM sess""")
def q_engagement(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Session count, length, depth and purchase conversion."""
    out = M.engagement(_ev(spark, sf_dir))
    return out.select("n_sessions", *[F.round(c, D).alias(c) for c in
                                      ("mean_session_seconds", "events_per_session", "session_conversion")])


@register("retention_cohorts", """
WITH d AS (SELECT DISTINCT user_id, CAST(ts AS DATE) AS day FROM events),
f AS (SELECT user_id, min(day) AS cohort_day FROM d GROUP BY user_id),
j AS (SELECT d.user_id, cohort_day, datediff('day', cohort_day, day) AS off FROM d JOIN f USING (user_id))
SELECT cohort_day, count(DISTINCT user_id) FILTER (WHERE off = 0) AS cohort_size,
  count(DISTINCT user_id) FILTER (WHERE off = 1) AS active_day_1,
  count(DISTINCT user_id) FILTER (WHERE off = 7) AS active_day_7,
  count(DISTINCT user_id) FILTER (WHERE off = 1) / count(DISTINCT user_id) FILTER (WHERE off = 0) AS retention_day_1,
  count(DISTINCT user_id) FILTER (WHERE off = 7) / count(DISTINCT user_id) FILTER (WHERE off = 0) AS retention_day_7
FROM j GROUP BY cohort_day""")
def q_retention(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Day-1 and day-7 retention by first-activity cohort."""
    return M.retention(_ev(spark, sf_dir))


@register("events_by_hour", """
SELECT CAST(hour(ts) AS INTEGER) AS hour, event_type, count(*) AS n FROM events GROUP BY 1, 2""")
def q_by_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event mix by hour of day."""
    return M.events_by_hour(_ev(spark, sf_dir))


@register("most_recommended_items", oracle("""
SELECT r.item_id, count(*) AS times_recommended, i.genre, count(*) / (SELECT count(*) FROM recs) AS share
FROM recs r LEFT JOIN items i USING (item_id) GROUP BY r.item_id, i.genre""", osql.chain(10)))
def q_most_recommended(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How often each item is recommended (top-10 lists of every test user)."""
    c = local_chain.prepare_fixture(spark, sf_dir)
    return M.most_recommended(local_chain.recommendations(c, 10), c.items)


@register("freshness", """
SELECT event_type, max(ts) AS latest,
  (epoch_us((SELECT max(ts) FROM events)) - epoch_us(max(ts))) / 1e6 AS age_seconds
FROM events GROUP BY event_type""")
def q_freshness(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Age of the newest event of each type at the newest event overall."""
    return M.freshness(_ev(spark, sf_dir))


@register("recent_events", """
SELECT * FROM events WHERE ts >= TIMESTAMP '2025-01-15 00:00:00' - INTERVAL 365 DAY""")
def q_recent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The retention filter (rows of the last 365 days before 2025-01-15)."""
    return M.retain_recent(_ev(spark, sf_dir), "2025-01-15 00:00:00")


_FIRING_HOURS = """
w AS (SELECT time_bucket(INTERVAL 3600 SECOND, ts) AS window_start,
        avg(CASE WHEN event_type = 'error' THEN 1.0 ELSE 0.0 END) AS error_rate
      FROM events GROUP BY 1),
f AS (SELECT window_start, CAST(epoch_us(window_start) // 3600000000 AS BIGINT) AS wno FROM w WHERE error_rate > {thr}),
r AS (SELECT window_start, wno - (row_number() OVER (ORDER BY wno) - 1) AS run FROM f)"""


@register("prediction_error_alerts_hourly", f"""
WITH {_FIRING_HOURS.format(thr=0.01)}
SELECT min(window_start) AS alert_start, max(window_start) + INTERVAL 3600 SECOND AS alert_end,
  count(*) AS n_windows
FROM r GROUP BY run HAVING count(*) >= 5""")
def q_pred_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T5: error rate above 1 % held for 5 consecutive hourly windows."""
    return M.error_rate_alerts(_ev(spark, sf_dir), 0.01, 3600, 5 * 3600)


@register("error_incidents_hourly", f"""
WITH {_FIRING_HOURS.format(thr=0.05)},
a AS (SELECT min(window_start) AS s, max(window_start) + INTERVAL 3600 SECOND AS e, count(*) AS n
      FROM r GROUP BY run HAVING count(*) >= 2),
o AS (SELECT *, CASE WHEN lag(e) OVER (ORDER BY s) IS NULL
                       OR epoch_us(s) - epoch_us(lag(e) OVER (ORDER BY s)) >= 10800000000 THEN 1 ELSE 0 END AS opens
      FROM a),
i AS (SELECT *, sum(opens) OVER (ORDER BY s ROWS UNBOUNDED PRECEDING) AS inc FROM o)
SELECT min(s) AS incident_start, max(e) AS incident_end, count(*) AS n_alerts FROM i GROUP BY inc""")
def q_incidents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T8 with auto-close: error alerts (2 firing hours) merged into incidents that close
    after 3 quiet hours."""
    flags = M.request_metrics(_ev(spark, sf_dir), "3600 seconds")
    return M.incidents(flags, "error_alert", 3600, 2 * 3600, 3 * 3600)


@register("recommendation_mix_by_location", oracle("""
SELECT location, genre, count(*) AS n, count(*) / sum(count(*)) OVER (PARTITION BY location) AS share
FROM recs r LEFT JOIN users u USING (user_id) LEFT JOIN items i USING (item_id)
GROUP BY location, genre""", osql.chain(10)))
def q_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Genre mix of the top-10 lists by user location."""
    c = local_chain.prepare_fixture(spark, sf_dir)
    return M.recommendation_mix(local_chain.recommendations(c, 10), c.users, c.items)
