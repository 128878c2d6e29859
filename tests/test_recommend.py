from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from recsmith.functions.columns import parse_genres
from recsmith.operators import recommend as R
from recsmith.operators.recommend import GENRE_BONUS
from recsmith.plans import local_chain
from tests.conftest import SF_SMALL


def bruteforce_top_k(users: DataFrame, scores: DataFrame, history: DataFrame,
                     targets: DataFrame, k: int = 10) -> DataFrame:
    """The test oracle: every target user against the whole catalogue, O(users * items)."""
    prefs = (targets.select("user_id").distinct()
                    .join(users.select("user_id", parse_genres("preferred_genres").alias("pref")),
                          "user_id", "left"))
    bonus = F.when(F.coalesce(F.array_contains("pref", F.col("genre")), F.lit(False)),
                   F.lit(GENRE_BONUS)).otherwise(F.lit(0.0))
    cands = (prefs.crossJoin(scores.select("item_id", "genre", "base_score"))
                  .join(history.select("user_id", "item_id").distinct(), ["user_id", "item_id"], "left_anti")
                  .select("user_id", "item_id", (F.col("base_score") + bonus).alias("score")))
    w = Window.partitionBy("user_id").orderBy(F.col("score").desc(), F.col("item_id").desc())
    return (cands.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
                 .select("user_id", F.col("rank").cast("long").alias("rank"), "item_id", "score"))


def test_pruned_topk_equals_bruteforce_on_fixture(spark):
    c = local_chain.prepare_fixture(spark, SF_SMALL)
    for k in (1, 5, 10):
        got = R.top_k_unseen(c.users, c.items, c.scores, c.history, c.targets, k)
        want = bruteforce_top_k(c.users, c.scores, c.history, c.targets, k)
        assert sorted(got.collect()) == sorted(want.collect())


def test_never_recommends_seen_items(spark):
    c = local_chain.prepare_fixture(spark, SF_SMALL)
    recs = R.top_k_unseen(c.users, c.items, c.scores, c.history, c.targets, 10)
    assert recs.join(c.history, ["user_id", "item_id"]).count() == 0


def test_edge_catalogue(spark):
    users = spark.createDataFrame(
        [(1, '["A"]'), (2, "not json"), (3, '["B","A"]')], "user_id long, preferred_genres string")
    # item 13 has no genre; 11 and 12 tie after the bonus is added; user 4 is not in the user table
    scores = spark.createDataFrame(
        [(10, "A", 0.5), (11, "B", 0.1), (12, "B", 0.1000000000000001), (13, None, 0.9), (14, "A", 0.2)],
        "item_id long, genre string, base_score double")
    history = spark.createDataFrame([(1, 13), (3, 10), (3, 10)], "user_id long, item_id long")
    targets = spark.createDataFrame([(1,), (2,), (3,), (4,)], "user_id long")
    got = R.top_k_unseen(users, None, scores, history, targets, 3)
    want = bruteforce_top_k(users, scores, history, targets, 3)
    assert sorted(got.collect()) == sorted(want.collect())
    assert [r.item_id for r in got.where("user_id = 1").orderBy("rank").collect()] == [10, 14, 12]


def test_base_scores_formula(spark):
    items = spark.createDataFrame([(1, "A", 0.5, 0.5), (2, "A", None, 1.0), (3, "B", 0.1, 0.0)],
                                  "item_id long, genre string, popularity_score double, quality_score double")
    train = spark.createDataFrame([(1, 1, 4.0), (2, 1, None), (3, 2, 5.0), (4, 1, 3.0)],
                                  "user_id long, item_id long, rating double")
    got = {r.item_id: r.base_score for r in R.base_scores(items, train).collect()}
    assert got[1] == 1.0 * 0.5 + 0.5 * 0.3 + 0.5 * 0.2
    assert got[2] == 0.5 * 0.5 + 0.0 * 0.3 + 1.0 * 0.2
    assert got[3] == 0.0 * 0.5 + 0.1 * 0.3 + 0.0 * 0.2


def test_other_users_items_matches_definition(spark):
    c = local_chain.prepare_fixture(spark, SF_SMALL, min_test=0)
    pdf = c.test.toPandas().sort_values(["timestamp", "user_id", "item_id", "interaction_type", "rating",
                                         "session_id", "line_number"], kind="mergesort")
    want = set()
    for u in pdf.user_id.unique():
        for rank, i in enumerate(pdf[pdf.user_id != u].item_id.unique()[:10], 1):
            want.add((int(u), rank, int(i)))
    got = {tuple(r) for r in R.other_users_items(c.test, 10).collect()}
    assert got == want


def test_small_blocks_and_many_partitions(spark, monkeypatch):
    """Lists cut into blocks of 3 positions, dealt over other partition counts."""
    monkeypatch.setattr(R, "LIST_BLOCK", 3)
    monkeypatch.setattr(R.take_from_lists, "__defaults__", (3,))
    c = local_chain.prepare_fixture(spark, SF_SMALL)
    got = R.top_k_unseen(c.users, c.items, c.scores, c.history, c.targets, 10, num_partitions=5)
    want = bruteforce_top_k(c.users, c.scores, c.history, c.targets, 10)
    assert sorted(got.collect()) == sorted(want.collect())
    c0 = local_chain.prepare_fixture(spark, SF_SMALL, min_test=0)
    pdf = c0.test.toPandas().sort_values(["timestamp", "user_id", "item_id", "interaction_type", "rating",
                                          "session_id", "line_number"], kind="mergesort")
    want_w10 = {(int(u), rank, int(i)) for u in pdf.user_id.unique()
                for rank, i in enumerate(pdf[pdf.user_id != u].item_id.unique()[:10], 1)}
    assert {tuple(r) for r in R.other_users_items(c0.test, 10).collect()} == want_w10


def test_lists_view_keeps_rank_order(spark):
    recs = spark.createDataFrame([(1, 2, 20), (1, 1, 10), (1, 3, 5), (2, 1, 7)], "user_id long, rank long, item_id long")
    got = {r.user_id: r["items"] for r in R.recommendations_as_lists(recs).collect()}
    assert got == {1: [10, 20, 5], 2: [7]}
