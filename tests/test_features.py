import datetime as dt
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from recsmith.functions import columns as C
from recsmith.operators import aggregates as A
from recsmith.operators import encoders as E
from recsmith.operators import features as FE

T0 = dt.datetime(2024, 1, 1, 10)
INTER = "user_id long, item_id long, rating double, timestamp timestamp"


def test_rounding_matches_numpy(spark):
    vals = [2.0625, 0.0125, 3.4445, 1.0005, 2.5, 7.1234567, -0.0125]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    got = [r[0] for r in df.select(C.round_half_even("x", 3)).collect()]
    assert got == [float(np.round(v, 3)) for v in vals]


def test_scalers_on_constant_column(spark):
    df = spark.createDataFrame([(1, 3.0), (2, 3.0), (3, 3.0), (4, None)], "id long, x double")
    std = E.standard_scale(df, ["x"], "_s").orderBy("id").collect()
    mm = E.min_max_scale(df, ["x"], "_m").orderBy("id").collect()
    assert [r.x_s for r in std] == [0.0, 0.0, 0.0, None]
    assert [r.x_m for r in mm] == [0.0, 0.0, 0.0, None]


def test_standard_scale_uses_population_std(spark):
    xs = [1.0, 2.0, 4.0, 9.0]
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    got = [r[0] for r in E.standard_scale(df, ["x"]).collect()]
    want = (np.array(xs) - np.mean(xs)) / np.std(xs)
    assert got == pytest.approx(list(want))


def test_label_encoder_sorted_positions(spark):
    df = spark.createDataFrame([("b",), (None,), ("a",), ("b",), ("c",)], "g string")
    got = [r.g_encoded for r in E.label_encode(df, "g").collect()]
    # sorted values: Unknown, a, b, c  (upper case sorts first)
    assert got == [2, 0, 1, 2, 3]


def test_single_interaction_user_stats(spark):
    df = spark.createDataFrame([(1, 10, 4.0, T0), (2, 10, 2.0, T0), (2, 11, 5.0, T0 + dt.timedelta(days=3, hours=23))],
                               INTER)
    s = {r.user_id: r for r in A.user_stats(df).collect()}
    assert s[1].rating_std == 0.0 and s[1].user_activity_days == 0 and s[1].interaction_frequency == 1.0
    assert s[2].user_activity_days == 3 and s[2].interaction_frequency == 2 / 4


def test_user_features_fills_and_segments(spark):
    users = spark.createDataFrame([(1, "M", "18-24", "US", '["A"]'), (2, None, None, None, None),
                                   (3, "F", "65+", "DE", '["B"]')],
                                  "user_id long, gender string, age_group string, location string, "
                                  "preferred_genres string")
    items = spark.createDataFrame([(10, "A"), (11, "B")], "item_id long, genre string")
    inter = spark.createDataFrame([(1, 10, 4.0, T0), (1, 11, 5.0, T0), (3, 11, 2.0, T0)], INTER)
    f = {r.user_id: r for r in FE.user_features(users, inter, items, ["A", "B"]).collect()}
    assert f[2].avg_rating == pytest.approx((4.5 + 2.0) / 2) and f[2].total_interactions == 0
    assert f[2].user_segment == "low_activity" and f[2].genre_pref_A is None
    assert f[1].genre_pref_A == 4.0 and f[1].genre_pref_B == 5.0 and f[3].genre_pref_A == 0.0
    # sorted values: F, M, Unknown
    assert (f[3].gender_encoded, f[1].gender_encoded, f[2].gender_encoded) == (0, 1, 2)


def test_affinity_unknowns_and_bad_json(spark):
    users = spark.createDataFrame([(1, '["A"]'), (2, "{bad")], "user_id long, preferred_genres string")
    items = spark.createDataFrame([(10, "A", 0.5, 0.2)], "item_id long, genre string, quality_score double, "
                                                        "popularity_score double")
    inter = spark.createDataFrame([(1, 10), (2, 10), (3, 10), (1, 99)], "user_id long, item_id long")
    got = {(r.user_id, r.item_id): r.user_item_affinity for r in FE.user_item_affinity(inter, users, items).collect()}
    assert got[(1, 10)] == pytest.approx(0.5 + 0.5 * 0.3 + 0.2 * 0.2)
    assert got[(2, 10)] == pytest.approx(0.5 * 0.3 + 0.2 * 0.2)
    assert got[(3, 10)] == 0.5 and got[(1, 99)] == 0.5


def test_weekday_monday_zero(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 19),), (dt.datetime(2024, 1, 6, 3),)], "ts timestamp")
    r = df.select(C.day_of_week("ts").alias("d"), C.is_weekend("ts").alias("w"), C.is_evening("ts").alias("e")).collect()
    assert [(x.d, x.w, x.e) for x in r] == [(0, 0, 1), (5, 1, 0)]


def test_exact_quantiles_match_numpy(spark):
    xs = [5.0, 1.0, 3.0, 3.0, 10.0, 7.5, 2.25]
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    got = {r.q: r.value for r in A.exact_quantiles(df, "x", [0.25, 0.5, 0.95]).collect()}
    for q in (0.25, 0.5, 0.95):
        assert got[q] == pytest.approx(float(np.quantile(xs, q)))


def test_latency_p95_matches_statistics_quantiles(spark):
    import statistics
    xs = [float(x) for x in (12, 40, 3, 8, 55, 21, 34, 9, 14, 29, 31, 2, 19, 44, 5, 27, 33, 38, 11, 50, 7, 13)]
    df = spark.createDataFrame([(x,) for x in xs], "latency_ms double")
    got = A.latency_summary(df).first()
    assert got.p95_latency_ms == pytest.approx(statistics.quantiles(xs, n=20)[-1])
    few = spark.createDataFrame([(x,) for x in xs[:5]], "latency_ms double")
    assert A.latency_summary(few).first().p95_latency_ms == pytest.approx(statistics.quantiles(xs[:5], n=5)[-1])


def test_unseen_labels_raise_in_both_forms(spark):
    from recsmith.operators import encoders as E
    seen, new = (spark.createDataFrame([(v,)], "c string") for v in ("a", "b"))
    with pytest.raises(Exception, match="unseen label in c: b"):
        E.apply_label_encoder(new, "c", E.fit_label_encoder(seen, "c")).collect()
    with pytest.raises(Exception, match="unseen label in c: b"):
        E.apply_label_encoders(new, ["c"], E.fit_label_encoders(seen, ["c"])).collect()


def test_interaction_features_of_unknown_users_and_items(spark):
    users = spark.createDataFrame([(1, "18-24", "M", "US", "free", '["A"]'), (9, "65+", "Z", "ZZ", "premium", None)],
                                  "user_id long, age_group string, gender string, location string, subscription_type string, "
                                  "preferred_genres string")
    items = spark.createDataFrame([(10, "A", 0.5, 0.5, 1.0), (11, "Q", 0.1, 0.1, 2.0)],
                                  "item_id long, genre string, popularity_score double, quality_score double, price double")
    inter = spark.createDataFrame([(1, 10, 4.0, T0), (2, 10, 5.0, T0), (1, 99, 3.0, T0), (None, None, None, T0)], INTER)
    rows = {(r.user_id, r.item_id): r for r in FE.interaction_features(inter, users, items).collect()}
    assert len(rows) == 4
    # only values that occur count: the unused user's Z and item's Q have no code
    assert (rows[1, 10].gender_encoded, rows[2, 10].gender_encoded) == (0, 1)
    assert (rows[1, 10].genre_encoded, rows[1, 99].genre_encoded, rows[None, None].genre_encoded) == (0, 1, 1)
    assert rows[2, 10].user_item_affinity == rows[1, 99].user_item_affinity == 0.5 and rows[1, 10].user_item_affinity == 0.75


def test_statistics_as_of_see_only_the_past(spark):
    """Hand-worked: a user's rows at 1, 2, 2, 3; the two at 2 do not see each other; distinct partners count once."""
    import datetime as dt
    t = [dt.datetime(2024, 1, 1, h) for h in range(5)]
    rows = [("u", "a", 4.0, t[1]), ("u", "b", 2.0, t[2]), ("u", "a", 3.0, t[2]), ("u", "a", None, t[3]), ("w", "a", 5.0, t[4]),
            ("u", "c", 1.0, None), (None, "a", 1.0, t[3])]
    df = spark.createDataFrame(rows, "user_id string, item_id string, rating double, timestamp timestamp_ntz")
    got = {(r.user_id, r.item_id, r.timestamp): r for r in FE.statistics_as_of(df, num_partitions=5).collect()}
    assert len(got) == len(rows)
    first, b, a2, a3, w = (got[k] for k in (("u", "a", t[1]), ("u", "b", t[2]), ("u", "a", t[2]), ("u", "a", t[3]), ("w", "a", t[4])))
    assert first.user_total_interactions == 0 and first.user_avg_rating is None and first.user_interactions_max is None
    assert (b.user_total_interactions, b.user_avg_rating, b.user_rating_std, b.user_unique_items) == (1, 4.0, None, 1)
    assert (a2.user_total_interactions, a2.user_item_interactions, a2.item_total_interactions, a2.item_unique_users) == (1, 1, 1, 1)
    assert (a3.user_total_interactions, a3.user_avg_rating, a3.user_rating_std, a3.user_unique_items) == (3, 3.0, 1.0, 2)
    assert (a3.user_item_interactions, a3.user_item_avg_rating, a3.user_rating_min, a3.user_rating_max) == (2, 3.5, 2.0, 4.0)
    # item a at 4: ratings 4, 3 of u and 1 of the row without user; its partners are u alone, since the other has no id
    assert (w.user_total_interactions, w.item_total_interactions, w.item_unique_users, w.item_interactions_max) == (0, 3, 1, 3)
    assert got["u", "c", None].user_total_interactions == 0 and got[None, "a", t[3]].item_total_interactions == 2


def test_point_in_time_features_do_not_leak(spark):
    """Other ratings of the row itself change nothing in its own features."""
    from recsmith.sources import fixtures
    t = fixtures.tables(spark, "/root/testdata/sf0.001")
    changed = t["interactions"].withColumn("rating", F.when(F.col("session_id") % 97 == 1, 5.0 - F.col("rating")).otherwise(F.col("rating")))
    latest = t["interactions"].groupBy("user_id").agg(F.max("timestamp").alias("timestamp"))
    keys = ["user_id", "item_id", "session_id", "line_number"]
    plain = FE.ranking_features(t["interactions"], t["users"], t["items"])
    lean = FE.ranking_features(t["interactions"], t["users"], t["items"], point_in_time=True)
    assert sorted(plain.columns) == sorted(lean.columns)
    first = t["interactions"].groupBy("user_id").agg(F.min("timestamp").alias("timestamp"))
    assert lean.join(first, ["user_id", "timestamp"]).where("user_total_interactions <> 0 OR user_avg_rating <> 0").count() == 0
    # ratings of a user's last instant are in no user statistic
    last = changed.join(latest, ["user_id", "timestamp"], "left_semi").unionByName(t["interactions"].join(latest, ["user_id", "timestamp"], "left_anti"))
    again = FE.ranking_features(last, t["users"], t["items"], point_in_time=True)
    cols = [*keys, "user_avg_rating", "user_rating_std"]
    assert lean.select(*cols).exceptAll(again.select(*cols)).count() == 0


def _shuffled_columns(df):
    """The columns of every exchange of a plan."""
    text = df.sparkSession.sparkContext._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    return re.findall(r"\) Exchange\nInput \[\d+\]: \[(.*)\]", text)


def test_ranking_features_shuffle_no_row_with_the_item_columns(spark):
    r = spark.createDataFrame([(1, 2, 3.0, 5, T0)], "user_id long, item_id long, rating double, session_id long, timestamp timestamp")
    users = spark.createDataFrame([(1, "x")], "user_id long, gender string")
    items = spark.createDataFrame([(2, "t")], "item_id long, title string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        met = _shuffled_columns(FE.ranking_features(r, users, items))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert any("session_id" in c for c in met)
    assert not [c for c in met if "session_id" in c and "title" in c]


def test_as_of_passes_sort_by_the_time_column_and_leave_out_bounds(spark):
    """A sort evaluates its keys in every comparison, so the key is the column; what no output shows is not carried."""
    from recsmith.operators import sequence as S
    from recsmith.sources import fixtures
    rows = fixtures.interactions(spark, "/root/testdata/sf0.001")
    for kind in ("timestamp", "timestamp_ntz"):
        df = rows.withColumn("timestamp", F.col("timestamp").cast(kind))
        assert str(S.time_order(df, "timestamp")) == str(F.col("timestamp"))
    bare, whole = FE.statistics_as_of(rows, bounds=False), FE.statistics_as_of(rows)
    assert set(whole.columns) - set(bare.columns) == {f"{p}_rating_{x}" for p in ("user", "item", "user_item") for x in ("min", "max")}
    assert bare.exceptAll(whole.select(*bare.columns)).count() == 0
