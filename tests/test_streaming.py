import datetime as dt
import os
import tempfile

from pyspark.sql import functions as F

from recsmith.streaming import monitoring as M

T0 = dt.datetime(2024, 1, 1, 0, 0, 0)


def _batch(spark, rows, root, name):
    df = spark.createDataFrame(rows, M.EVENT_SCHEMA)
    df.coalesce(1).write.mode("overwrite").parquet(os.path.join(root, "in", name))


def _ev(i, sec, etype="view", value=10.0, user=1):
    return (i, T0 + dt.timedelta(seconds=sec), user, etype, value, "{}")


def test_stream_windows_equal_batch_and_late_rows_drop(spark):
    root = tempfile.mkdtemp(prefix="recsmith-stream-")
    batches = [
        [_ev(1, 5), _ev(2, 70, "error", 600.0), _ev(3, 30)],          # out of order inside the batch
        [_ev(4, 200), _ev(5, 65, "click", 20.0)],                     # 65 s still on time
        [_ev(6, 1000), _ev(7, 10, "error", 1.0)],                     # 10 s arrives after the watermark
        [_ev(8, 2000)],
    ]
    stream = M.read_event_stream(spark, os.path.join(root, "in", "*"), max_files_per_trigger=1)
    q = (M.stream_request_metrics(stream, "60 seconds", "2 minutes").writeStream.outputMode("append")
         .format("memory").queryName("win_metrics").option("checkpointLocation", os.path.join(root, "ck")).start())
    for i, b in enumerate(batches):
        _batch(spark, b, root, f"b{i}")
        q.processAllAvailable()
    q.stop()
    got = {r.window_start: r for r in spark.sql("SELECT * FROM win_metrics").collect()}
    on_time = [e for b in batches for e in b if e[0] != 7]
    want = {r.window_start: r for r in M.request_metrics(spark.createDataFrame(on_time, M.EVENT_SCHEMA)).collect()}
    # every window closed by the final watermark matches the batch result without the late row
    for w, r in got.items():
        assert r.n_requests == want[w].n_requests and r.error_rate == want[w].error_rate
    assert got[T0].n_requests == 2  # the late error at 10 s was dropped
    assert T0 + dt.timedelta(seconds=60) in got


def test_batch_sustained_alerts(spark):
    rows = [_ev(i, 60 * m, "error") for i, m in enumerate([0, 1, 2, 3, 4, 6, 7, 9, 10, 11, 12, 13, 14, 15])]
    flags = M.request_metrics(spark.createDataFrame(rows, M.EVENT_SCHEMA))
    alerts = M.sustained_alerts(flags, "error_alert", 60, 300).orderBy("alert_start").collect()
    assert [(a.alert_start, a.n_windows) for a in alerts] == [(T0, 5), (T0 + dt.timedelta(minutes=9), 7)]


def test_stream_alert_state(spark):
    root = tempfile.mkdtemp(prefix="recsmith-alert-")
    schema = "window_start timestamp, error_alert boolean"
    minutes = [(0, True), (1, True), (2, True), (3, True), (4, True), (5, False), (6, True)]
    spark.createDataFrame([(T0 + dt.timedelta(minutes=m), f) for m, f in minutes], schema) \
         .coalesce(1).write.parquet(os.path.join(root, "in", "p0"))
    stream = spark.readStream.schema(schema).parquet(os.path.join(root, "in", "*"))
    q = (M.stream_sustained_alerts(stream).writeStream.outputMode("append").format("memory")
         .queryName("alerts_out").option("checkpointLocation", os.path.join(root, "ck")).start())
    q.processAllAvailable()
    q.stop()
    got = spark.sql("SELECT * FROM alerts_out").collect()
    assert [(r.kind, r.alert_start, r.alert_end, r.n) for r in got] == [("alert", T0, T0 + dt.timedelta(minutes=5), 5)]


def test_stream_incidents_equal_batch(spark):
    """Alerts with their ends and incidents with auto-close, over several micro-batches."""
    root = tempfile.mkdtemp(prefix="recsmith-incident-")
    schema = "window_start timestamp, error_alert boolean"
    firing = {0, 1, 2, 3, 4, 20, 21, 22, 23, 24, 25, 26, 70, 71, 72, 73, 74}
    rows = [(T0 + dt.timedelta(minutes=m), m in firing) for m in range(120)]
    for k in range(3):
        spark.createDataFrame(rows[40 * k:40 * k + 40], schema).coalesce(1).write.parquet(os.path.join(root, "in", f"p{k}"))
        q = (M.stream_sustained_alerts(spark.readStream.schema(schema).parquet(os.path.join(root, "in", "*"))).writeStream
             .outputMode("append").format("parquet").option("path", os.path.join(root, "out"))
             .option("checkpointLocation", os.path.join(root, "ck")).trigger(availableNow=True).start())
        q.awaitTermination()
    got = spark.read.parquet(os.path.join(root, "out")).collect()
    flags = spark.createDataFrame(rows, schema).withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))
    alerts = [(a.alert_start, a.alert_end, a.n_windows) for a in M.sustained_alerts(flags, "error_alert").collect()]
    incidents = [(a.incident_start, a.incident_end, a.n_alerts) for a in M.incidents(flags, "error_alert").collect()]
    assert sorted((r.alert_start, r.alert_end, r.n) for r in got if r.kind == "alert") == sorted(alerts)
    assert sorted((r.alert_start, r.alert_end, r.n) for r in got if r.kind == "incident") == sorted(incidents)


def _run_alerts(spark, root, **how):
    schema = "metric string, window_start timestamp, firing boolean"
    stream = spark.readStream.schema(schema).parquet(os.path.join(root, "in", "*"))
    q = (M.stream_sustained_alerts(stream, "firing", F.col("metric"), **how).writeStream.outputMode("append").format("parquet")
         .option("path", os.path.join(root, "out")).option("checkpointLocation", os.path.join(root, "ck")).trigger(availableNow=True).start())
    q.awaitTermination()
    return sorted((r.metric, r.kind, r.alert_start, r.alert_end, r.n) for r in spark.read.parquet(os.path.join(root, "out")).collect())


def test_alerts_close_without_further_rows(spark):
    """Metric a falls silent while it fires; metric b goes on.  Timers end a's alert and, 1800 s later, its incident, also when
    the stream is stopped in between and goes on from its checkpoint."""
    root = tempfile.mkdtemp(prefix="recsmith-silent-")
    m = lambda x: T0 + dt.timedelta(minutes=x)

    def feed(part, rows):
        spark.createDataFrame(rows, "metric string, window_start timestamp, firing boolean").coalesce(1).write.parquet(os.path.join(root, "in", part))

    feed("p0", [("a", m(x), True) for x in range(5)] + [("b", m(x), False) for x in range(4)])
    assert _run_alerts(spark, root) == []  # a's fifth window is the newest: its next may still come
    feed("p1", [("b", m(x), False) for x in range(4, 20)])
    alert = ("a", "alert", m(0), m(5), 5)
    assert _run_alerts(spark, root) == [alert]
    feed("p2", [("b", m(x), False) for x in range(20, 35)])
    assert _run_alerts(spark, root) == [alert]  # 1799 s are not yet over at minute 34
    feed("p3", [("b", m(x), False) for x in range(35, 40)])
    assert _run_alerts(spark, root) == [alert, ("a", "incident", m(0), m(5), 1)]
    feed("p4", [("a", m(x), True) for x in range(40, 46)] + [("b", m(x), False) for x in range(40, 90)])
    assert _run_alerts(spark, root) == sorted([alert, ("a", "incident", m(0), m(5), 1), ("a", "alert", m(40), m(46), 6), ("a", "incident", m(40), m(46), 1)])


def test_stream_incident_counts_a_condition_from_its_first_window(spark):
    """The next condition begins within the quiet time but has been held for long only behind it: one incident, as in the batch form."""
    root = tempfile.mkdtemp(prefix="recsmith-slow-")
    firing = {0, 1, 2, 3, 4, 33, 34, 35, 36, 37}
    rows = [("a", T0 + dt.timedelta(minutes=x), x in firing) for x in range(100)]
    for k in range(5):
        spark.createDataFrame(rows[20 * k:20 * k + 20], "metric string, window_start timestamp, firing boolean").coalesce(1).write.parquet(os.path.join(root, "in", f"p{k}"))
        got = _run_alerts(spark, root)
    flags = spark.createDataFrame(rows, "metric string, window_start timestamp, firing boolean").withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))
    want = [("a", "incident", i.incident_start, i.incident_end, i.n_alerts) for i in M.incidents(flags, "firing").collect()]
    assert [r for r in got if r[1] == "incident"] == want and len(want) == 1


def test_stream_sessions_equal_batch_out_of_order(spark):
    """Late events before the watermark merge two open sessions, also over a restart; a row behind it is dropped; the sessions that
    have ended equal the batch operator's."""
    root = tempfile.mkdtemp(prefix="recsmith-sessions-")
    m = 60
    batches = [
        [_ev(1, 0), _ev(2, 50 * m), _ev(3, 0, user=2), _ev(4, 30 * m, user=2)],      # 30 minutes apart: one session of user 2
        [_ev(5, 25 * m, "purchase"), _ev(6, 70 * m, user=2), (7, T0, None, "view", 1.0, "{}")],  # 25 min joins user 1's two sessions
        [_ev(8, 300 * m), _ev(9, 330 * m + 1, user=1), _ev(10, 310 * m, user=2)],
        [_ev(11, 5, user=3), _ev(12, 600 * m, user=4)],                              # user 3's row is behind the watermark
        [_ev(13, 900 * m, user=4)],
    ]
    for name, form in (("sessions", M.stream_sessions), ("engagement", M.stream_engagement)):
        for i, b in enumerate(batches):
            _batch(spark, b, os.path.join(root, name), f"b{i}")
            stream = M.read_event_stream(spark, os.path.join(root, name, "in", "*"))
            out = form(stream) if name == "sessions" else form(stream, window="1 hour")
            M.write_stream(out, os.path.join(root, name, "out"), os.path.join(root, name, "ck"), trigger_once=True).awaitTermination()
    on_time = spark.createDataFrame([e for b in batches for e in b if e[0] != 11], M.EVENT_SCHEMA)
    end = T0 + dt.timedelta(minutes=900 - 60)
    want = sorted(tuple(r) for r in M.sessions(on_time).collect() if r.session_end <= end)
    got = sorted(tuple(r) for r in spark.read.parquet(os.path.join(root, "sessions", "out")).collect())
    assert got == want
    assert (1, T0, T0 + dt.timedelta(minutes=80), 3, 1) in got and len(got) == 7
    hours = spark.read.parquet(os.path.join(root, "engagement", "out")).collect()
    assert sum(r.n_sessions for r in hours) == len(want)
    first = min(hours, key=lambda r: r.window_start)
    assert (first.n_sessions, first.mean_session_seconds, first.events_per_session, first.session_conversion) == (1, 3600.0, 2.0, 0.0)


def test_stream_active_users(spark):
    root = tempfile.mkdtemp(prefix="recsmith-active-")
    day = 86400
    rows = [_ev(1, 10, user=1), _ev(2, 20, user=2), _ev(3, 30, user=1), _ev(4, day + 5, user=3),
            _ev(5, 3 * day, user=1)]
    _batch(spark, rows, root, "b0")
    stream = M.read_event_stream(spark, os.path.join(root, "in", "*"))
    q = (M.stream_active_users(stream).writeStream.outputMode("append").format("memory")
         .queryName("active_out").option("checkpointLocation", os.path.join(root, "ck")).start())
    q.processAllAvailable()
    _batch(spark, [_ev(6, 10 * day, user=9)], root, "b1")  # moves the watermark on
    q.processAllAvailable()
    q.stop()
    got = {r.window_start: r.active_users for r in spark.sql("SELECT * FROM active_out").collect()}
    assert got[T0] == 2 and got[T0 + dt.timedelta(days=1)] == 1


def test_incidents_auto_close(spark):
    # alert runs (>= 5 firing minutes) at 0-4, 20-26 and 70-74; auto-close 1800 s merges the first two
    minutes = list(range(0, 5)) + list(range(20, 27)) + list(range(70, 75)) + [90, 91]
    rows = [_ev(i, 60 * m, "error") for i, m in enumerate(minutes)]
    flags = M.request_metrics(spark.createDataFrame(rows, M.EVENT_SCHEMA))
    got = sorted((r.incident_start, r.incident_end, r.n_alerts)
                 for r in M.incidents(flags, "error_alert", 60, 300, 1800).collect())
    m = lambda x: T0 + dt.timedelta(minutes=x)
    assert got == [(m(0), m(27), 2), (m(70), m(75), 1)]
    # quiet time of exactly auto-close opens a new incident
    rows = [_ev(i, 60 * x, "error") for i, x in enumerate(list(range(0, 5)) + list(range(35, 40)))]
    flags = M.request_metrics(spark.createDataFrame(rows, M.EVENT_SCHEMA))
    assert M.incidents(flags, "error_alert", 60, 300, 1800).count() == 2


def test_prediction_error_alerts(spark):
    rows = [_ev(i, 60 * m, "error" if m % 2 == 0 else "view") for i, m in enumerate(range(12))]
    rows += [_ev(100 + i, 60 * m + 1, "view") for i, m in enumerate(range(12))]
    alerts = M.error_rate_alerts(spark.createDataFrame(rows, M.EVENT_SCHEMA), 0.01, 60, 300).collect()
    # only even minutes have errors: no 5 consecutive firing minutes
    assert alerts == []


def test_file_sink_appends_closed_windows(spark):
    root = tempfile.mkdtemp(prefix="recsmith-sink-")
    _batch(spark, [_ev(1, 5), _ev(2, 65), _ev(3, 400)], root, "b0")
    stream = M.read_event_stream(spark, os.path.join(root, "in", "*"))
    q = M.write_stream(M.stream_request_metrics(stream), os.path.join(root, "out"), os.path.join(root, "ck"),
                       trigger_once=True)
    q.awaitTermination()
    got = sorted((r.window_start, r.n_requests) for r in spark.read.parquet(os.path.join(root, "out")).collect())
    # the watermark (400 s - 2 min) has passed the first two windows only
    assert got == [(T0, 1), (T0 + dt.timedelta(seconds=60), 1)]
