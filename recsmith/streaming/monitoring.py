"""Monitoring (T1-T14): windowed rates, latencies, engagement and alerts.

Each metric has a batch form (exact, over a table) and, where the reference's
alert policies run continuously, a Structured Streaming form over a file
source with an event-time watermark.  Events are rows of
``(event_id, ts, user_id, event_type, value, props)``; ``value`` is the request
latency in ms and ``event_type = 'error'`` marks a failed request.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from recsmith.operators import sequence
from recsmith.operators.aggregates import linear_quantile
from recsmith.operators.quantiles import values_at
from recsmith.operators.split import with_global_index

EVENT_SCHEMA = T.StructType([
    T.StructField("event_id", T.LongType()),
    T.StructField("ts", T.TimestampType()),
    T.StructField("user_id", T.LongType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("value", T.DoubleType()),
    T.StructField("props", T.StringType()),
])

# Fixed alert levels of the reference's policies.
ERROR_RATE_MAX = 0.05
PREDICTION_ERROR_RATE_MAX = 0.01
LATENCY_P95_MAX_MS = 500.0
LATENCY_MEAN_MAX_MS = 1000.0
CTR_MIN = 0.02
ACTIVE_USERS_MIN = 1000
CONDITION_SECONDS = 300
AUTO_CLOSE_SECONDS = 1800
RETENTION_DAYS = 365


def _with_event_time(events: DataFrame, ts: str = "ts") -> DataFrame:
    if isinstance(events.schema[ts].dataType, T.TimestampType):
        return events  # a watermark stays with the column it was set on
    return events.withColumn(ts, F.col(ts).cast("timestamp"))


def _window_cols(w: str = "window"):
    # window bounds as wall-clock (zone-free) timestamps
    return [F.col(f"{w}.start").cast("timestamp_ntz").alias("window_start"),
            F.col(f"{w}.end").cast("timestamp_ntz").alias("window_end")]


def grouped_exact_quantiles(df: DataFrame, group_cols: list[str], value_col: str,
                            probs: list[float]) -> DataFrame:
    """Exact linear quantiles per group by refinement (``quantiles.values_at``): ``group_cols + [q, value]``."""
    found = values_at(df, group_cols, value_col, probs)
    rows = [F.struct(F.lit(float(p)).alias("q"), linear_quantile(k, p).alias("value")) for k, p in enumerate(probs)]
    return found.select(*group_cols, F.explode(F.array(*rows)).alias("_r")).select(*group_cols, "_r.q", "_r.value")


# ---- batch forms ------------------------------------------------------------

def request_metrics(events: DataFrame, window: str = "60 seconds") -> DataFrame:
    """Per window: requests, rate per second, error rate, mean latency, alert flags."""
    seconds = int(window.split()[0])
    e = _with_event_time(events)
    agg = e.groupBy(F.window("ts", window)).agg(
        F.count(F.lit(1)).alias("n_requests"),
        F.avg((F.col("event_type") == "error").cast("double")).alias("error_rate"),
        F.avg("value").alias("mean_latency_ms"))
    return agg.select(*_window_cols(), "n_requests", (F.col("n_requests") / seconds).alias("request_rate"),
                      "error_rate", "mean_latency_ms",
                      (F.col("error_rate") > ERROR_RATE_MAX).alias("error_alert"),
                      (F.col("mean_latency_ms") > LATENCY_MEAN_MAX_MS).alias("latency_alert"))


def latency_percentiles(events: DataFrame, window: str = "60 seconds",
                        probs=(0.5, 0.95, 0.99)) -> DataFrame:
    """Exact P50/P95/P99 latency per window and the p95 alert flag."""
    e = _with_event_time(events).withColumn("w", F.window("ts", window))
    e = e.select(F.col("w.start").cast("timestamp_ntz").alias("window_start"), "value")
    q = grouped_exact_quantiles(e, ["window_start"], "value", list(probs))
    names = {p: f"p{int(round(p * 100))}_ms" for p in probs}
    wide = q.groupBy("window_start").agg(*[F.max(F.when(F.col("q") == p, F.col("value"))).alias(n)
                                           for p, n in names.items()])
    if 0.95 in names:
        wide = wide.withColumn("p95_alert", F.col("p95_ms") > LATENCY_P95_MAX_MS)
    return wide


def click_through(events: DataFrame, window: str = "3600 seconds") -> DataFrame:
    """Clicks / views per window (NULL without views) and the low-CTR flag."""
    e = _with_event_time(events)
    agg = e.groupBy(F.window("ts", window)).agg(
        F.count(F.when(F.col("event_type") == "click", 1)).alias("clicks"),
        F.count(F.when(F.col("event_type") == "view", 1)).alias("views"))
    ctr = F.try_divide(F.col("clicks").cast("double"), F.col("views").cast("double"))
    return agg.select(*_window_cols(), "clicks", "views", ctr.alias("ctr"), (ctr < CTR_MIN).alias("ctr_alert"))


def active_users(events: DataFrame, window: str = "86400 seconds") -> DataFrame:
    """Distinct users per window (exact) and the low-activity flag."""
    e = _with_event_time(events)
    agg = e.groupBy(F.window("ts", window)).agg(F.count_distinct("user_id").alias("active_users"))
    return agg.select(*_window_cols(), "active_users", (F.col("active_users") < ACTIVE_USERS_MIN).alias("alert"))


def _firing_runs(flags: DataFrame, flag_col: str, window_seconds: int) -> DataFrame:
    """Firing windows with their run id (window number minus position among firing windows)
    and run length.  Positions come from the global index (no single-partition window)."""
    firing = (flags.where(F.col(flag_col))
                   .select("window_start",
                           F.floor(F.unix_micros(F.col("window_start").cast("timestamp")) / (window_seconds * 1_000_000))
                            .cast("long").alias("wno")))
    idx = with_global_index(firing, [F.col("wno").asc()], "pos")
    runs = idx.withColumn("run", F.col("wno") - F.col("pos"))
    sizes = runs.groupBy("run").agg(F.count(F.lit(1)).alias("n_windows"))
    return runs.join(sizes, "run")


def sustained_alerts(flags: DataFrame, flag_col: str, window_seconds: int = 60,
                     hold_seconds: int = CONDITION_SECONDS) -> DataFrame:
    """Runs of consecutive firing windows lasting at least ``hold_seconds``.

    Gaps-and-islands on the window number: a run's id is the window number minus
    the firing window's position among all firing windows.  Returns
    (alert_start, alert_end, n_windows).
    """
    need = max(1, hold_seconds // window_seconds)
    runs = _firing_runs(flags, flag_col, window_seconds).where(F.col("n_windows") >= need)
    agg = runs.groupBy("run").agg(F.min("window_start").alias("alert_start"),
                                  F.max("window_start").alias("last_window"),
                                  F.max("n_windows").alias("n_windows"))
    return agg.select("alert_start",
                      (F.col("last_window") + F.make_interval(secs=F.lit(window_seconds))).alias("alert_end"),
                      "n_windows")


def incidents(flags: DataFrame, flag_col: str, window_seconds: int = 60, hold_seconds: int = CONDITION_SECONDS,
              auto_close_seconds: int = AUTO_CLOSE_SECONDS) -> DataFrame:
    """T8 with auto-close: alerts (runs held for ``hold_seconds``) separated by less than
    ``auto_close_seconds`` of quiet belong to one incident.  Returns
    (incident_start, incident_end, n_alerts).

    The incidents are sessions over the alerting windows with a gap of
    auto-close + one window, computed by the range-partitioned session operator.
    """
    need = max(1, hold_seconds // window_seconds)
    wins = (_firing_runs(flags, flag_col, window_seconds).where(F.col("n_windows") >= need)
            .select(F.lit("alert").alias("_k"), F.col("window_start").cast("timestamp").alias("ws"), "run"))
    # a new incident iff quiet time (next start - previous end) >= auto-close,
    # i.e. window starts differ by more than auto-close + window - 1 microsecond
    s = sequence.sessions(wins, "_k", "ws", auto_close_seconds + window_seconds, gap_micros_adjust=-1)
    agg = s.groupBy("session_start").agg(F.max("ws").alias("_last"), F.count_distinct("run").alias("n_alerts"))
    return agg.select(F.col("session_start").cast("timestamp_ntz").alias("incident_start"),
                      (F.col("_last") + F.make_interval(secs=F.lit(window_seconds))).cast("timestamp_ntz")
                      .alias("incident_end"), "n_alerts")


def error_rate_alerts(events: DataFrame, threshold: float, window_seconds: int = 60,
                      hold_seconds: int = CONDITION_SECONDS) -> DataFrame:
    """Error rate above ``threshold`` held for ``hold_seconds`` (T5 uses 0.01)."""
    flags = request_metrics(events, f"{window_seconds} seconds")
    flags = flags.withColumn("_firing", F.col("error_rate") > threshold)
    return sustained_alerts(flags, "_firing", window_seconds, hold_seconds)


def sessions(events: DataFrame, gap: str = "30 minutes") -> DataFrame:
    """Per user sessions (``session_window`` semantics): start, end, events, purchases.

    Session starts come from the range-partitioned sequence operator, so one very
    active user is spread over many tasks; the per-session totals are then an
    ordinary grouped aggregate with map-side partial counts.
    """
    gap_seconds = int(interval_seconds(gap))
    e = _with_event_time(events).select("user_id", "ts", "event_type")
    s = sequence.sessions(e, "user_id", "ts", gap_seconds)
    agg = s.groupBy("user_id", "session_start").agg(
        F.max("ts").alias("_last"), F.count(F.lit(1)).alias("n_events"),
        F.count(F.when(F.col("event_type") == "purchase", 1)).alias("n_purchases"))
    return agg.select("user_id", F.col("session_start").cast("timestamp_ntz").alias("session_start"),
                      (F.col("_last") + F.make_interval(secs=F.lit(gap_seconds))).cast("timestamp_ntz")
                      .alias("session_end"), "n_events", "n_purchases")


def interval_seconds(text: str) -> int:
    """'30 minutes' -> 1800 (units: second(s), minute(s), hour(s), day(s))."""
    n, unit = text.split()
    mult = {"second": 1, "minute": 60, "hour": 3600, "day": 86400}[unit.rstrip("s")]
    return int(n) * mult


def engagement(events: DataFrame, gap: str = "30 minutes") -> DataFrame:
    """Sessions, mean session length (s), events per session, purchase conversion."""
    s = sessions(events, gap)
    length = F.unix_micros(F.col("session_end").cast("timestamp")) - F.unix_micros(F.col("session_start").cast("timestamp"))
    per = s.agg(F.count(F.lit(1)).alias("n_sessions"),
                F.avg(length / 1e6).alias("mean_session_seconds"),
                F.avg("n_events").alias("events_per_session"),
                F.avg((F.col("n_purchases") > 0).cast("double")).alias("session_conversion"))
    return per


def retention(events: DataFrame, days=(1, 7)) -> DataFrame:
    """Cohorts by first active day; share of the cohort active again N days later."""
    e = _with_event_time(events).select("user_id", F.to_date("ts").alias("day")).distinct()
    first = e.groupBy("user_id").agg(F.min("day").alias("cohort_day"))
    j = e.join(first, "user_id").withColumn("offset", F.datediff("day", "cohort_day"))
    # the rows are distinct per (user, day): plain counts
    aggs = [F.count(F.when(F.col("offset") == 0, F.col("user_id"))).alias("cohort_size")]
    aggs += [F.count(F.when(F.col("offset") == d, F.col("user_id"))).alias(f"active_day_{d}") for d in days]
    out = j.groupBy("cohort_day").agg(*aggs)
    for d in days:
        out = out.withColumn(f"retention_day_{d}", F.col(f"active_day_{d}") / F.col("cohort_size"))
    return out


def events_by_hour(events: DataFrame) -> DataFrame:
    """Event mix by hour of day."""
    e = _with_event_time(events)
    return e.groupBy(F.hour("ts").alias("hour"), "event_type").agg(F.count(F.lit(1)).alias("n"))


def most_recommended(recs: DataFrame, items: DataFrame) -> DataFrame:
    """How often each item is recommended, with its genre and share of all slots."""
    n = recs.groupBy("item_id").agg(F.count(F.lit(1)).alias("times_recommended"))
    total = recs.select(F.count(F.lit(1))).scalar()
    return (n.join(items.select("item_id", "genre"), "item_id", "left")
             .withColumn("share", F.col("times_recommended") / total))


def recommendation_mix(recs: DataFrame, users: DataFrame, items: DataFrame, by: str = "location") -> DataFrame:
    """Genre mix of the recommended items by a user attribute (place by default)."""
    j = (recs.join(users.select("user_id", by), "user_id", "left")
             .join(items.select("item_id", "genre"), "item_id", "left"))
    counts = j.groupBy(by, "genre").agg(F.count(F.lit(1)).alias("n"))
    totals = j.groupBy(by).agg(F.count(F.lit(1)).alias("_total"))
    return counts.join(totals, by, "left").select(by, "genre", "n", (F.col("n") / F.col("_total")).alias("share"))


def freshness(events: DataFrame, as_of=None, key: str = "event_type") -> DataFrame:
    """Age in seconds of the newest row per key at ``as_of`` (default: newest row overall)."""
    e = _with_event_time(events)
    as_of_col = (F.lit(as_of).cast("timestamp") if as_of is not None
                 else e.select(F.max("ts")).scalar())
    per = e.groupBy(key).agg(F.max("ts").alias("latest"))
    age = (F.unix_micros(as_of_col) - F.unix_micros("latest")) / 1e6
    return per.select(key, F.col("latest").cast("timestamp_ntz").alias("latest"), age.alias("age_seconds"))


def retain_recent(df: DataFrame, as_of, ts: str = "ts", days: int = RETENTION_DAYS) -> DataFrame:
    """Rows newer than ``days`` before ``as_of`` (a pushed-down filter on the scan)."""
    cutoff = F.lit(as_of).cast("timestamp") - F.make_interval(days=F.lit(days))
    return df.where(F.col(ts).cast("timestamp") >= cutoff)


# ---- streaming forms --------------------------------------------------------

def read_event_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Event stream from a directory of Parquet files (explicit schema, event time as TIMESTAMP)."""
    reader = spark.readStream.schema(EVENT_SCHEMA)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(path)


def stream_request_metrics(stream: DataFrame, window: str = "60 seconds", watermark: str = "2 minutes",
                           p95_accuracy: int = 10000) -> DataFrame:
    """T1-T4 on a stream: one windowed aggregate, emitted once the watermark passes the window.

    The p95 uses the bounded-memory percentile sketch, so window state stays small.
    """
    seconds = int(window.split()[0])
    agg = (stream.withWatermark("ts", watermark).groupBy(F.window("ts", window)).agg(
        F.count(F.lit(1)).alias("n_requests"),
        F.avg((F.col("event_type") == "error").cast("double")).alias("error_rate"),
        F.avg("value").alias("mean_latency_ms"),
        F.percentile_approx("value", 0.95, p95_accuracy).alias("p95_latency_ms")))
    return agg.select(*_window_cols(), "n_requests", (F.col("n_requests") / seconds).alias("request_rate"),
                      "error_rate", "mean_latency_ms", "p95_latency_ms",
                      (F.col("error_rate") > ERROR_RATE_MAX).alias("error_alert"),
                      (F.col("mean_latency_ms") > LATENCY_MEAN_MAX_MS).alias("latency_alert"),
                      (F.col("p95_latency_ms") > LATENCY_P95_MAX_MS).alias("p95_alert"))


def stream_click_through(stream: DataFrame, window: str = "3600 seconds", watermark: str = "1 hour") -> DataFrame:
    """T6 on a stream: clicks / views per window, emitted once the watermark passes the window."""
    return click_through(stream.withWatermark("ts", watermark), window)


def stream_active_users(stream: DataFrame, window: str = "86400 seconds", watermark: str = "1 hour") -> DataFrame:
    """T7 on a stream: distinct users per window by two chained aggregations
    (window x user, then window), since a distinct count is refused on streams."""
    per_user = (stream.withWatermark("ts", watermark)
                      .groupBy(F.window("ts", window).alias("w"), "user_id").count())
    per_window = per_user.groupBy(F.window(F.window_time("w"), window).alias("window")).agg(
        F.count(F.lit(1)).alias("active_users"))
    return per_window.select(*_window_cols(), "active_users", (F.col("active_users") < ACTIVE_USERS_MIN).alias("alert"))


def stream_sessions(stream: DataFrame, gap: str = "30 minutes", watermark: str = "1 hour") -> DataFrame:
    """T10 on a stream: a user's sessions, each emitted once the watermark has passed its end (last event + gap).

    An event that comes late but before that merges the sessions it lies between; one that is behind the watermark is dropped.  State is
    the users' open sessions.  A job with a very active user sets ``spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition``, so that
    each task hands on sessions and not events.  Rows without a user or time belong to no session, as in the batch form."""
    known = stream.where(F.col("user_id").isNotNull() & F.col("ts").isNotNull())
    agg = known.withWatermark("ts", watermark).groupBy(F.session_window("ts", gap), "user_id").agg(
        F.count(F.lit(1)).alias("n_events"), F.count(F.when(F.col("event_type") == "purchase", 1)).alias("n_purchases"))
    bound = lambda side: F.col(f"session_window.{side}").cast("timestamp_ntz").alias(f"session_{side}")
    return agg.select("user_id", bound("start"), bound("end"), "n_events", "n_purchases")


def stream_engagement(stream: DataFrame, gap: str = "30 minutes", watermark: str = "1 hour", window: str = "1 day") -> DataFrame:
    """T10 on a stream: engagement of the sessions by the window in which they end, emitted once the watermark has passed it:
    sessions into windows as two chained aggregations, so no session is kept longer than its window."""
    known = stream.where(F.col("user_id").isNotNull() & F.col("ts").isNotNull())
    per = known.withWatermark("ts", watermark).groupBy(F.session_window("ts", gap).alias("s"), "user_id").agg(
        F.count(F.lit(1)).alias("n_events"), F.count(F.when(F.col("event_type") == "purchase", 1)).alias("n_purchases"))
    length = (F.unix_micros("s.end") - F.unix_micros("s.start")) / 1e6
    out = per.groupBy(F.window(F.window_time("s"), window).alias("window")).agg(
        F.count(F.lit(1)).alias("n_sessions"), F.avg(length).alias("mean_session_seconds"), F.avg("n_events").alias("events_per_session"),
        F.avg((F.col("n_purchases") > 0).cast("double")).alias("session_conversion"))
    return out.select(*_window_cols(), "n_sessions", "mean_session_seconds", "events_per_session", "session_conversion")


ALERT_STATE = "run long, last_wno long, run_start timestamp, open_start timestamp, open_end timestamp, n_alerts long"
ALERT_OUT = "metric string, kind string, alert_start timestamp, alert_end timestamp, n long"


def _alert_fn(window_seconds: int, need: int, close_after: int):
    """State of one metric: the running condition (length, last window number, start) and the open incident.

    An event-time timer stands at what silence would decide next: the end of the running condition's last window (no
    window follows it) or, with no condition running, the incident's end plus ``close_after``."""
    width, quiet = pd.Timedelta(seconds=window_seconds), pd.Timedelta(seconds=close_after)

    def millis(at) -> int:
        return int(pd.Timestamp(at).value // 10 ** 6)

    def step(key, pdfs, state: GroupState):
        run, last, start, first, end, alerts = state.get if state.exists else (0, None, None, None, None, 0)
        out = []

        def run_ends() -> None:
            if run >= need:
                out.append((key[0], "alert", start, end, run))

        def last_end() -> pd.Timestamp:
            return pd.Timestamp((last + 1) * window_seconds * 10 ** 9)

        if state.hasTimedOut:
            watermark = state.getCurrentWatermarkMs()
            if run and watermark > millis(last_end()):
                run_ends()
                run = 0
            if first is not None and not run and watermark > millis(pd.Timestamp(end) + quiet):
                out.append((key[0], "incident", first, end, alerts))
                first, end, alerts = None, None, 0
        else:
            for row in pd.concat(list(pdfs)).sort_values("window_start").itertuples(index=False):
                at = pd.Timestamp(row.window_start)
                wno = int(at.value // (window_seconds * 10 ** 9))
                goes_on = bool(row.firing) and run > 0 and wno == last + 1
                if not goes_on:
                    run_ends()
                # a condition counts from its first window on, also while it has not been held for long
                if first is not None and (pd.Timestamp(start) if goes_on else at) - pd.Timestamp(end) >= quiet:
                    out.append((key[0], "incident", first, end, alerts))
                    first, end, alerts = None, None, 0
                if row.firing:
                    run, start = (run + 1, start) if goes_on else (1, at)
                    if run >= need:
                        alerts += run == need
                        first, end = (start if first is None else first), at + width
                else:
                    run = 0
                last = wno
        if run or first is not None:
            state.update((run, last, start, first, end, alerts))
            due = millis(last_end()) if run else millis(pd.Timestamp(end) + quiet)
            state.setTimeoutTimestamp(max(due, state.getCurrentWatermarkMs() + 1))
        elif state.exists:
            state.remove()  # neither a condition nor an incident is open: the next window begins anew
        yield pd.DataFrame(out, columns=["metric", "kind", "alert_start", "alert_end", "n"])
    return step


def stream_sustained_alerts(window_metrics: DataFrame, flag_col: str = "error_alert", metric: str | Column = "error_rate",
                            window_seconds: int = 60, hold_seconds: int = CONDITION_SECONDS,
                            auto_close_seconds: int = AUTO_CLOSE_SECONDS, watermark: str = "0 seconds") -> DataFrame:
    """T8 on a stream: rows of kind "alert" for each ended run of windows in which a condition has held for
    ``hold_seconds`` (n = windows), and of kind "incident" once ``auto_close_seconds`` have passed without an alert
    (n = alerts).  ``metric`` is a name for the whole stream or a column; the keyed state is six values per metric.

    Both also end without further rows of the metric, by event-time timers, as soon as the watermark on window_start
    (windows arrive in order but for ``watermark``) shows that the next window is missing or the quiet time over."""
    need = max(1, hold_seconds // window_seconds)
    keyed = window_metrics.select((F.lit(metric) if isinstance(metric, str) else metric).alias("metric"),
                                  F.col("window_start").cast("timestamp").alias("window_start"),
                                  F.col(flag_col).alias("firing")).withWatermark("window_start", watermark)
    return keyed.groupBy("metric").applyInPandasWithState(
        _alert_fn(window_seconds, need, auto_close_seconds), ALERT_OUT, ALERT_STATE, "append", GroupStateTimeout.EventTimeTimeout)


RUNNING_BUCKETS = 16


def running_stats(stream: DataFrame, key: str, value: str, ts: str, other: str, out_dir: str, checkpoint: str,
                  trigger_once: bool = True):
    """Running statistics per ``key`` (A1 / A2 columns; distinct partners as a sketch, which a stream can keep).

    Each micro-batch writes only the keys it changed, into a folder of its own number (written again, not added to, when
    the batch is retried), partitioned by a bucket of the key.  Nothing earlier is read or rewritten.
    ``read_running_stats`` gives the newest row per key, ``compact_running_stats`` folds old batches together."""
    agg = stream.groupBy(key).agg(
        F.count(value).alias("rating_count"), F.avg(value).alias("rating_mean"), F.stddev_samp(value).alias("rating_std"),
        F.min(value).alias("rating_min"), F.max(value).alias("rating_max"), F.min(ts).alias("timestamp_min"),
        F.max(ts).alias("timestamp_max"), F.approx_count_distinct(other).alias("partners"))

    def write(batch: DataFrame, batch_id: int):
        (batch.withColumn("bucket", F.pmod(F.xxhash64(key), F.lit(RUNNING_BUCKETS)).cast("int"))
         .write.mode("overwrite").partitionBy("bucket").parquet(f"{out_dir}/batch={batch_id}"))

    writer = agg.writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", checkpoint)
    if trigger_once:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def read_running_stats(spark: SparkSession, out_dir: str, key: str) -> DataFrame:
    """The newest row of every key."""
    rows = spark.read.option("basePath", out_dir).parquet(f"{out_dir}/batch=*")
    values = [c for c in rows.columns if c not in (key, "batch", "bucket")]
    return (rows.groupBy(key).agg(F.max_by(F.struct(*values), F.col("batch").cast("long")).alias("r"))
            .select(key, *[F.col(f"r.{c}").alias(c) for c in values]))


def compact_running_stats(spark: SparkSession, out_dir: str, key: str, target_dir: str) -> None:
    """The newest row of every key as one batch under another folder, from which a reader can go on."""
    (read_running_stats(spark, out_dir, key).withColumn("bucket", F.pmod(F.xxhash64(key), F.lit(RUNNING_BUCKETS)).cast("int"))
     .write.mode("overwrite").partitionBy("bucket").parquet(f"{target_dir}/batch=-1"))


def write_stream(df: DataFrame, path: str, checkpoint: str, fmt: str = "parquet", trigger_once: bool = False):
    """S8 / T1-T7 sink: append finished windows (or log rows) to files; exactly-once through
    the checkpoint.  Windowed aggregates must carry a watermark (append mode)."""
    writer = (df.writeStream.outputMode("append").format(fmt).option("path", path)
                .option("checkpointLocation", checkpoint))
    if trigger_once:
        writer = writer.trigger(availableNow=True)
    return writer.start()
