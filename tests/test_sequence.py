import datetime as dt
import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from recsmith.operators import sequence as S
from recsmith.streaming import monitoring as M

T0 = dt.datetime(2024, 1, 1)


def _events(n, seed):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        # user 0 is hot: about half of all rows
        user = 0 if rnd.random() < 0.5 else rnd.randrange(1, 20)
        rows.append((i, T0 + dt.timedelta(minutes=rnd.randrange(0, 3000)), user,
                     rnd.choice(["view", "click", "purchase"]), 1.0, "{}"))
    return rows


def test_previous_value_matches_lag(spark):
    df = spark.createDataFrame(_events(2000, 5), M.EVENT_SCHEMA)
    order = [F.col("ts").asc(), F.col("event_id").asc()]
    want = df.withColumn("prev", F.lag("ts").over(Window.partitionBy("user_id").orderBy(*order)))
    for parts in (1, 4, 9):
        got = S.previous_value(df, "user_id", order, "ts", "prev", parts)
        assert sorted(got.select("event_id", "prev").collect()) == sorted(want.select("event_id", "prev").collect())


def test_sessions_match_session_window(spark):
    df = spark.createDataFrame(_events(3000, 6), M.EVENT_SCHEMA)
    want = sorted(tuple(r) for r in M.sessions(df, "30 minutes")
                  .select("user_id", "session_start", "n_events").collect())
    for parts in (1, 3, 8):
        s = S.sessions(df, "user_id", "ts", 1800, parts)
        got = s.groupBy("user_id", "session_start").agg(F.count(F.lit(1)).alias("n")).collect()
        got = sorted((r.user_id, r.session_start, r.n) for r in got)
        assert got == want


def test_null_keys_and_times(spark):
    """Rows without key have no previous row; sessions leave out rows without key or time."""
    rows = [(i, T0 + dt.timedelta(minutes=i), None, "view", 1.0, "{}") for i in range(4)]
    rows += [(10, None, 5, "view", 1.0, "{}"), (11, T0, 5, "view", 1.0, "{}"), (12, T0 + dt.timedelta(minutes=1), 5, "view", 1.0, "{}")]
    df = spark.createDataFrame(rows, M.EVENT_SCHEMA)
    order = [F.col("ts").asc_nulls_last(), F.col("event_id").asc()]
    for parts in (1, 2, 5):
        prev = {r.event_id: r.p for r in S.previous_value(df, "user_id", order, "ts", "p", parts).collect()}
        assert [prev[i] for i in range(4)] == [None] * 4
        assert prev[11] is None and prev[12] == T0 and prev[10] == T0 + dt.timedelta(minutes=1)
        got = S.sessions(df, "user_id", "ts", 1800, parts).select("event_id", "session_start").collect()
        assert sorted((r.event_id, r.session_start) for r in got) == [(11, T0), (12, T0)]


def test_zone_free_times_across_a_clock_change(spark):
    """2024-03-10 02:30 does not exist in New York, but a zone-free time is no moment there."""
    from recsmith.operators import split
    start = dt.datetime(2024, 3, 10, 1, 30)
    rows = [(i, 1, float(i), start + dt.timedelta(minutes=i)) for i in range(90)]
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = spark.createDataFrame([(a, b, c, str(d)) for a, b, c, d in rows], "user_id long, item_id long, rating double, t string") \
                  .withColumn("timestamp", F.col("t").cast("timestamp_ntz")).drop("t")
        _, test = split.temporal_split(df, 0.4)
        assert sorted(r.user_id for r in test.collect()) == list(range(54, 90))
        micros = [r[0] for r in df.orderBy("user_id").select(S.epoch_micros(df, "timestamp")).collect()]
        assert micros == [int((d - dt.datetime(1970, 1, 1)).total_seconds() * 1e6) for *_, d in rows]
        one = S.sessions(df.withColumn("k", F.lit(1)), "k", "timestamp", 60, 4).select("session_start").distinct().collect()
        assert [r[0] for r in one] == [start]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_split_filters_reach_the_scan(spark, tmp_path):
    from recsmith.operators import split
    spark.range(5000).select(F.col("id").alias("user_id"), F.col("id").alias("item_id"), F.lit(1.0).alias("rating"),
                             F.timestamp_seconds(F.col("id") * 60).cast("timestamp_ntz").alias("timestamp")).write.parquet(f"{tmp_path}/t")
    train, test = split.temporal_split(spark.read.parquet(f"{tmp_path}/t"), 0.2)
    assert (train.count(), test.count()) == (4000, 1000)
    plan = test._jdf.queryExecution().toString()
    assert "GreaterThan(timestamp" in plan


def _prefix_brute(rows, key, states):
    """rows of dicts -> their states over the rows of the same key strictly before, by scanning."""
    out = []
    for r in rows:
        past = [p for p in rows if r["t"] is not None and None not in key(r) and p["t"] is not None and key(p) == key(r) and p["t"] < r["t"]]
        vals = [p["v"] for p in past if p["v"] is not None]
        out.append((r["i"], len(vals), sum(vals) if vals else None, min(vals, default=None), max(vals, default=None))[:1 + states])
    return sorted(out, key=repr)


def _facts(n, seed):
    """A third of all rows under user 0, many equal times, NULLs in key, time and value."""
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        user = None if rnd.random() < 0.02 else 0 if rnd.random() < 0.33 else rnd.randrange(1, 9)
        rows.append({"i": i, "u": user, "it": rnd.randrange(5), "t": None if rnd.random() < 0.02 else T0 + dt.timedelta(minutes=rnd.randrange(60)),
                     "v": None if rnd.random() < 0.1 else float(rnd.randrange(1, 6))})
    return rows


def test_prefix_states_match_a_scan(spark):
    rows = _facts(400, 3)
    df = spark.createDataFrame([(r["i"], r["u"], r["it"], r["t"], r["v"]) for r in rows], "i long, u long, it long, t timestamp, v double")
    v = F.col("v")
    states = {"n": ("count", v), "s": ("sum", v), "lo": ("min", v), "hi": ("max", v)}
    for keys in (["u"], ["u", "it"], []):
        want = _prefix_brute(rows, lambda r: tuple(r[k] for k in keys), 4)
        for parts in (1, 3, 16):
            got = S.prefix_states(df, keys, "t", states, parts)
            assert got.columns == [*df.columns, *states]
            assert sorted((tuple(r) for r in got.select("i", *states).collect()), key=repr) == want


def test_prefix_states_of_one_key_span_partitions(spark):
    """All rows under one key and three instants: equal times stay together and empty partitions carry the state on."""
    rows = [{"i": i, "u": 1, "it": 0, "t": T0 + dt.timedelta(minutes=i % 3), "v": 1.0} for i in range(90)]
    df = spark.createDataFrame([(r["i"], r["u"], r["t"], r["v"]) for r in rows], "i long, u long, t timestamp_ntz, v double")
    got = S.prefix_states(df, ["u"], "t", {"n": ("count", F.col("v"))}, 12).select("i", "n").collect()
    assert {(r.i % 3, r.n) for r in got} == {(0, 0), (1, 30), (2, 60)} and len(got) == 90
    assert S.prefix_states(df.where("i < 0"), ["u"], "t", {"n": ("count", F.col("v"))}).count() == 0


def test_ordered_passes_carry_over_batches_and_shuffle_once(spark):
    """States, first rows and previous values over batches of a few rows; the plan behind the written pass has no hash shuffle of rows."""
    rows = _facts(300, 5)
    df = spark.createDataFrame([(r["i"], r["u"], r["it"], r["t"], r["v"]) for r in rows], "i long, u long, it long, t timestamp, v double")
    v = F.col("v")
    states = {"n": ("count", v), "s": ("sum", v), "lo": ("min", v), "hi": ("max", v)}
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        for keys in (["u"], ["u", "it"], []):
            want = _prefix_brute(rows, lambda r: tuple(r[k] for k in keys), 4)
            for parts in (1, 5):
                got = S.prefix_states(df, keys, "t", states, parts, first="first")
                plan = got._jdf.queryExecution().executedPlan().toString()
                assert "hashpartitioning" not in plan.split("BroadcastExchange")[0]
                found = got.collect()
                assert sorted(((r.i, r.n, r.s, r.lo, r.hi) for r in found), key=repr) == want
                firsts = [r for r in found if r["first"]]
                groups = {}
                for r in rows:
                    if r["t"] is not None and all(r[k] is not None for k in keys):
                        groups.setdefault(tuple(r[k] for k in keys), []).append(r["t"])
                assert sorted((tuple(r[k] for k in keys), r.t) for r in firsts) == sorted((k, min(t)) for k, t in groups.items())
        for parts in (1, 5):
            out = S.previous_value(df, "u", [F.col("t").asc_nulls_last(), F.col("i").asc()], "i", "p", parts)
            assert "hashpartitioning" not in out._jdf.queryExecution().executedPlan().toString().split("BroadcastExchange")[0]
            prev, last = {}, {}
            for r in sorted(rows, key=lambda r: (r["t"] is None, r["t"] or T0, r["i"])):
                prev[r["i"]] = last.get(r["u"]) if r["u"] is not None else None
                last[r["u"]] = r["i"]
            assert {r.i: r.p for r in out.collect()} == prev
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)


def test_prefix_states_of_nan_and_whole_numbers(spark):
    """NaN is the greatest number, as in Spark's own aggregates; whole numbers stay whole; text keys, a NaN key is one key."""
    nan = float("nan")
    rows = [("a", 1.0, 1, nan, 5), ("a", 1.0, 2, 2.0, 7), ("a", 1.0, 3, nan, None), ("a", 1.0, 4, 1.0, 2), ("b", nan, 1, 4.0, 9), ("b", nan, 2, None, 1), ("b", nan, 3, 3.0, 1)]
    df = spark.createDataFrame([(k, g, T0 + dt.timedelta(minutes=m), d, x) for k, g, m, d, x in rows], "k string, g double, t timestamp, d double, x int")
    got = S.prefix_states(df, ["k", "g"], "t", {"lo": ("min", F.col("d")), "hi": ("max", F.col("d")), "least": ("min", F.col("x"))}, 2)
    assert [repr((r.lo, r.hi, r.least)) for r in got.orderBy("k", "t").collect()] == [
        repr(x) for x in [(None, None, None), (nan, nan, 5), (2.0, nan, 5), (2.0, nan, 5), (None, None, None), (4.0, 4.0, 9), (4.0, 4.0, 1)]]
