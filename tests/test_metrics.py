import math

import pytest

from recsmith.operators import metrics as M

REC_SCHEMA = "user_id long, rank long, item_id long"
TEST_SCHEMA = "user_id long, item_id long, rating double, timestamp long"
ITEM_SCHEMA = "item_id long, genre string"


def _lists(recs):
    out = {}
    for u, r, i in sorted(recs):
        out.setdefault(u, []).append(i)
    return out


def _reference(recs, test, items, ks):
    """The evaluator's formulas written out in Python (sklearn's NDCG by hand)."""
    lists = _lists(recs)
    actual = {}
    rel = {}
    for u, i, r, t in sorted(test, key=lambda x: x[3]):
        actual.setdefault(u, set()).add(i)
        rel.setdefault(u, {})[i] = r
    genre = {i: g for i, g in items}
    res = {}
    for k in ks:
        rec = [len(set(l[:k]) & actual[u]) / len(actual[u]) for u, l in lists.items() if actual.get(u)]
        res[("recall", k)] = sum(rec) / len(rec) if rec else 0.0
        pre = [len(set(l[:k]) & actual.get(u, set())) / len(set(l[:k])) for u, l in lists.items() if l[:k]]
        res[("precision", k)] = sum(pre) / len(pre) if pre else 0.0
        nd = []
        for u, l in lists.items():
            if not actual.get(u) or not l[:k]:
                continue
            g = [rel[u].get(i, 0.0) for i in l[:k]]
            dcg = sum(x / math.log2(j + 2) for j, x in enumerate(g))
            idcg = sum(x / math.log2(j + 2) for j, x in enumerate(sorted(g, reverse=True)))
            nd.append(dcg / idcg if idcg > 0 else 0.0)
        res[("ndcg", k)] = sum(nd) / len(nd) if nd else 0.0
    mrr = []
    for u, l in lists.items():
        if actual.get(u):
            mrr.append(next((1.0 / (j + 1) for j, i in enumerate(l) if i in actual[u]), 0.0))
    res[("mrr", None)] = sum(mrr) / len(mrr) if mrr else 0.0
    res[("coverage", None)] = len({i for l in lists.values() for i in l}) / len(items)
    red = [1 - len({genre.get(i, "Unknown") for i in l}) / len(l) for l in lists.values() if len(l) > 1]
    res[("genre_redundancy", None)] = sum(red) / len(red) if red else 0.0
    div = [len({genre.get(i) for i in l if genre.get(i)}) / len(l) for l in lists.values() if l]
    res[("diversity", None)] = sum(div) / len(div) if div else 0.0
    counts = {}
    for _, i, _, _ in test:
        counts[i] = counts.get(i, 0) + 1
    mx = max(counts.values())
    nov = [1 - counts.get(i, 0) / mx for l in lists.values() for i in l]
    res[("novelty", None)] = sum(nov) / len(nov)
    return res


def test_suite_on_hand_table(spark):
    # user 1: hits at 1 and 3; user 2: no test rows; user 3: one-item list, a hit;
    # user 4: repeated item in the list and an unknown item; test has a repeated (user,item) pair
    recs = [(1, 1, 10), (1, 2, 11), (1, 3, 12), (2, 1, 10), (2, 2, 13),
            (3, 1, 14), (4, 1, 15), (4, 2, 15), (4, 3, 99)]
    test = [(1, 10, 5.0, 1), (1, 12, 3.0, 2), (1, 16, 4.0, 3), (3, 14, 2.0, 4), (4, 15, 1.0, 5),
            (4, 15, 4.0, 6), (5, 10, 5.0, 7)]
    items = [(10, "A"), (11, "A"), (12, "B"), (13, None), (14, "C"), (15, "C"), (16, "A")]
    got = M.evaluation_suite(spark.createDataFrame(recs, REC_SCHEMA), spark.createDataFrame(test, TEST_SCHEMA),
                             spark.createDataFrame(items, ITEM_SCHEMA), (1, 2, 3))
    want = _reference(recs, test, items, (1, 2, 3))
    got = {(r.metric, r.k): r.value for r in got.collect()}
    assert set(got) == set(want)
    for key, v in want.items():
        assert got[key] == pytest.approx(v, abs=1e-9), key


def test_metric_bounds_on_fixture(spark):
    from recsmith.plans import local_chain
    from tests.conftest import SF_SMALL
    c = local_chain.prepare_fixture(spark, SF_SMALL)
    recs = local_chain.recommendations(c, 20)
    vals = {(r.metric, r.k): r.value for r in M.evaluation_suite(recs, c.test, c.items).collect()}
    for (m, k), v in vals.items():
        assert 0.0 <= v <= 1.0, (m, k, v)
    assert vals[("recall", 5)] <= vals[("recall", 10)] <= vals[("recall", 20)]


def test_ndcg_is_one_for_ideal_order(spark):
    recs = spark.createDataFrame([(1, 1, 1), (1, 2, 2), (1, 3, 3)], REC_SCHEMA)
    test = spark.createDataFrame([(1, 1, 5.0, 1), (1, 2, 4.0, 2), (1, 3, 1.0, 3)], TEST_SCHEMA)
    assert M.ndcg_at_k(recs, test, 3).first()[0] == pytest.approx(1.0)


def test_lists_meet_a_large_catalogue_without_a_shuffle_by_item(spark):
    """Nearly all lists hold the same items: a join of the lists by item would give one task nearly all rows."""
    from pyspark.sql import functions as F
    from recsmith.session import materialize
    recs = materialize(spark.range(2000).select((F.col("id") % 200).alias("user_id"), F.floor(F.col("id") / 200 + 1).alias("rank"),
                                                F.floor(F.col("id") / 200).alias("item_id")))
    test = materialize(spark.range(40_000).select((F.col("id") % 200).alias("user_id"), F.col("id").alias("item_id"),
                                                  F.lit(4.0).alias("rating"), F.col("id").alias("timestamp")))
    items = materialize(spark.range(40_000).select(F.col("id").alias("item_id"), F.md5(F.col("id").cast("string").cast("binary")).alias("genre")))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "20k")
    try:
        out = M.per_user_table(recs, test, items)
        assert out.count() == 200
        rows = {r["user_id"]: r for r in out.collect()}
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "hashpartitioning(item_id" not in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert [rows[u]["hits_10"] for u in range(11)] == [1] * 10 + [0] and rows[0]["n_genres_known"] == 10 and rows[3]["first_hit"] == 4


def test_repeats_and_missing_values_in_lists(spark):
    """An item twice in a list counts at its first place, a list's item without an id counts as an item, a missing genre
    and the genre of that name are one."""
    recs = spark.createDataFrame([(1, 1, 7), (1, 2, 7), (1, 3, None), (1, 4, 8), (1, 5, 9), (None, 1, 7), (2, 1, 7)], REC_SCHEMA)
    test = spark.createDataFrame([(1, 7, 2.0, 1), (1, 7, 3.0, 2), (1, None, 1.0, 1), (1, 9, None, 1), (None, 7, 5.0, 1)], TEST_SCHEMA)
    items = spark.createDataFrame([(7, "Unknown"), (8, None), (9, "")], ITEM_SCHEMA)
    rows = {r["user_id"]: r for r in M.per_user_table(recs, test, items, (3, 5)).collect()}
    assert set(rows) == {1, 2}
    one = rows[1]
    assert (one["n_actual"], one["n_rec_3"], one["n_rec_5"], one["hits_3"], one["hits_5"], one["first_hit"]) == (3, 2, 4, 1, 2, 1)
    assert (one["n_list"], one["n_genres_unknown"], one["n_genres_known"]) == (5, 2, 1)
    assert rows[2]["n_actual"] == rows[2]["hits_5"] == 0 and rows[2]["first_hit"] is None


def test_the_placeholder_chain_scores_no_catalogue(spark):
    from recsmith.plans import local_chain
    c = local_chain.prepare_fixture(spark, "/root/testdata/sf0.001", min_test=0)
    assert "scores" not in vars(c)
    assert c.scores.count() == c.items.count() and c.scores is c.scores
