import os
import random
import tempfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from recsmith.operators import models as MO
from recsmith.operators import serving as SV
from recsmith.operators import text as TX


def _ratings(spark, n_users=30, n_items=40, n=500, seed=1):
    rnd = random.Random(seed)
    rows = [(rnd.randrange(n_users), rnd.randrange(n_items), float(rnd.randrange(1, 6))) for _ in range(n)]
    # one heavy user who has seen most of the catalogue
    rows += [(999, i, 4.0) for i in range(35)]
    return spark.createDataFrame(rows, "user_id long, item_id long, rating double")


def test_als_top_k_unseen_is_exact(spark):
    r = _ratings(spark)
    model = MO.train_als(r, rank=4, max_iter=5)
    got = {(x.user_id, x.rank): x.item_id for x in MO.top_k_unseen_factors(model, r, 3).collect()}
    uid, iid = ({x.code: x.value for x in t.collect()} for t in (model.users, model.items))
    U = {uid[x.id]: np.array(x.features) for x in model.als.userFactors.collect()}
    V = {iid[x.id]: np.array(x.features) for x in model.als.itemFactors.collect()}
    seen = {}
    for x in r.collect():
        seen.setdefault(x.user_id, set()).add(x.item_id)
    for u, uf in U.items():
        scores = sorted(((float(np.float32(uf @ vf)), i) for i, vf in V.items() if i not in seen[u]),
                        key=lambda t: (-t[0], -t[1]))
        for rank, (_, i) in enumerate(scores[:3], 1):
            assert got[(u, rank)] == i or abs(float(uf @ V[got[(u, rank)]]) - scores[rank - 1][0]) < 1e-5


def test_text_ids_and_cold_users(spark):
    """Ids as the declared schema has them; users without factors get base-score lists, cold rows are scored and counted."""
    r = _ratings(spark).select(F.format_string("user_%06d", "user_id").alias("user_id"),
                               F.format_string("item_%06d", "item_id").alias("item_id"), "rating")
    model = MO.train_als(r, rank=4, max_iter=3)
    cold = spark.createDataFrame([("user_new", "item_000001", 3.0), ("user_000001", "item_new", 2.0), ("user_000999", "item_000001", 4.0),
                                  (None, "item_000001", 1.0)], "user_id string, item_id string, rating double")
    err = MO.rmse(model, cold).first()
    assert (err.n, err.n_cold) == (4, 3)
    scores = r.select("item_id").distinct().select("item_id", F.lit("g").alias("genre"), F.length("item_id").cast("double").alias("base_score"))
    asked = spark.createDataFrame([("user_new",), ("user_000999",), ("user_000003",)], "user_id string")
    got = MO.top_k_unseen_factors(model, r, 5, users=asked, fallback=scores).groupBy("user_id").count().collect()
    assert {x["user_id"]: x["count"] for x in got} == {"user_new": 5, "user_000999": 5, "user_000003": 5}
    root = tempfile.mkdtemp(prefix="recsmith-als-")
    MO.save_model(model, root, {"rank": 4})
    again = MO.load_factors(spark, root)
    assert MO.rmse(again, r).first() == MO.rmse(model, r).first()


def test_als_error_below_mean_predictor(spark):
    r = _ratings(spark, n=2000, seed=2)
    train, test = r.randomSplit([0.8, 0.2], seed=3)
    model = MO.train_als(train, rank=8, max_iter=10, reg=0.1)
    err = MO.rmse(model, train).first()
    mean = train.agg(F.avg("rating")).first()[0]
    base = train.agg(F.sqrt(F.avg((F.col("rating") - mean) ** 2))).first()[0]
    assert err.rmse < base


@pytest.mark.parametrize("bucket", [512, 12])
def test_similar_items(spark, bucket):
    """Scores are cosines, every item has k neighbours; one bucket is exact, many find most of the true neighbours."""
    rnd = np.random.default_rng(0)
    base = rnd.normal(size=(30, 8))
    vecs = [(i, [float(x) for x in base[i % 30] + 0.15 * rnd.normal(size=8)]) for i in range(180)]
    df = spark.createDataFrame([*vecs, (500, None), (501, [0.0] * 8)], "item_id long, vector array<double>")
    details = spark.createDataFrame([(i, f"t{i}", "g", 4.5, 1.0) for i in range(100)],
                                    "item_id long, title string, genre string, rating_avg double, price double")
    out = SV.similar_items(df, k=5, bucket_items=bucket, items=details).collect()
    V = {i: np.array(v) / np.linalg.norm(v) for i, v in vecs}
    per = {}
    for r in out:
        assert r.similarity == pytest.approx(float(V[r.item_id] @ V[r.similar_id]), abs=1e-9)
        assert r.rating_avg == (4.5 if r.similar_id < 100 else 0.0)
        per.setdefault(r.item_id, set()).add(r.similar_id)
    assert set(per) == set(V) and all(len(s) == 5 and i not in s for i, s in per.items())
    true = {i: {j for _, j in sorted((-float(v @ V[j]), j) for j in V if j != i)[:5]} for i, v in V.items()}
    recall = np.mean([len(per[i] & true[i]) / 5 for i in V])
    assert recall == 1.0 if bucket == 512 else recall > 0.7


@pytest.mark.parametrize("n", [2000, 12000])
def test_similar_items_hold_recall_as_the_table_grows(spark, n):
    """Groups of 20 at cosines of about 0.76: as many bits as small buckets need lose a third of the lists in 8 tables."""
    rnd = np.random.default_rng(5)
    base = rnd.normal(size=(n // 20, 64))
    x = np.repeat(base, 20, axis=0) + 0.56 * rnd.normal(size=(n, 64))
    df = spark.createDataFrame([(i, v) for i, v in enumerate(x.tolist())], "item_id long, vector array<double>")
    out = SV.similar_items(df, k=10, bucket_items=64).select("item_id", "similar_id", "rank").collect()
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    got = [set() for _ in x]
    for r in out:
        got[r.item_id].add(r.similar_id)
    assert len(out) == 10 * n and all(len(g) == 10 for g in got)
    seen = range(0, n, 7)
    sim = x[::7] @ x.T
    sim[np.arange(len(sim)), np.arange(0, n, 7)] = -np.inf
    true = np.argsort(-sim, axis=1)[:, :10]
    recall = np.mean([len(got[i] & set(t.tolist())) / 10 for i, t in zip(seen, true)])
    print(f"recall of similar items, {n} vectors: {recall:.3f}")
    assert recall >= 0.9


@pytest.mark.parametrize("n", [2000, 12000])
def test_neighbours_of_neighbours_settle_without_more_tables(spark, monkeypatch, n):
    """Few tables and small buckets: rounds of neighbourhoods of fixed size reach the recall, whatever the table's size."""
    rnd = np.random.default_rng(8)
    base = rnd.normal(size=(n // 20, 32))
    x = np.repeat(base, 20, axis=0) + 0.5 * rnd.normal(size=(n, 32))
    df = spark.createDataFrame([(i, v) for i, v in enumerate(x.tolist())], "item_id long, vector array<double>")
    made = []
    bucketed = SV._bucketed
    monkeypatch.setattr(SV, "_bucketed", lambda clean, first, last, *rest: made.append(last) or bucketed(clean, first, last, *rest))
    out = SV.similar_items(df, k=10, tables=4, bucket_items=64).collect()
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    got = {}
    for r in out:
        got.setdefault(r.item_id, set()).add(r.similar_id)
    sim = x[::11] @ x.T
    sim[np.arange(len(sim)), np.arange(0, n, 11)] = -np.inf
    true = np.argsort(-sim, axis=1)[:, :10]
    assert np.mean([len(got[i] & set(t.tolist())) / 10 for i, t in zip(range(0, n, 11), true)]) >= 0.9
    assert len(out) == 10 * n and made[-1] * 64 <= 768  # an item met at most so many others in buckets, at both sizes


def test_vectors_without_groups_meet_all_others_once_that_is_cheaper(spark, monkeypatch):
    """Neighbours of evenly spread vectors share few buckets; tables were doubled until they had cost far more than all pairs."""
    x = np.random.default_rng(11).normal(size=(1500, 48))
    df = spark.createDataFrame([(i, v) for i, v in enumerate(x.tolist())], "item_id long, vector array<double>")
    made = []
    bucketed = SV._bucketed
    monkeypatch.setattr(SV, "_bucketed", lambda clean, first, last, *rest: made.append(last) or bucketed(clean, first, last, *rest))
    got = {(r.item_id, r.rank): r.similar_id for r in SV.similar_items(df, k=3, tables=2, bucket_items=16).collect()}
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    sim = x @ x.T - 3 * np.eye(1500)
    assert got == {(i, r + 1): int(j) for i in range(1500) for r, j in enumerate(np.argsort(-sim[i])[:3])}
    assert made == [2]


def test_rounds_of_neighbourhoods_are_tried_where_they_are_cheaper(spark, monkeypatch):
    rnd = np.random.default_rng(8)
    x = np.repeat(rnd.normal(size=(75, 32)), 20, axis=0) + 0.5 * rnd.normal(size=(1500, 32))
    df = spark.createDataFrame([(i, v) for i, v in enumerate(x.tolist())], "item_id long, vector array<double>")
    rounds, against = [], []
    near, every = SV._neighbourhoods, SV._against_all
    monkeypatch.setattr(SV, "ROUND_COSINES", 0)
    monkeypatch.setattr(SV, "_neighbourhoods", lambda *a: rounds.append(1) or near(*a))
    monkeypatch.setattr(SV, "_against_all", lambda asked, *a: against.append(asked.count()) or every(asked, *a))
    out = SV.similar_items(df, k=10, tables=4, bucket_items=64, probes=100).collect()
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    sim = x @ x.T - 3 * np.eye(1500)
    least = np.sort(sim, axis=1)[:, -10]
    assert len(out) == 15000 and rounds and max(against) <= 100
    assert np.mean([r.similarity >= least[r.item_id] - 1e-9 for r in out]) >= 0.9


def test_nearest_breaks_ties_and_takes_an_id_once():
    """More columns than the bar's, whole vectors repeated and ids of several rows: the best other ids, ties by the order of y."""
    rnd = np.random.default_rng(2)
    y = rnd.integers(-2, 3, size=(SV.BAR + 2500, 3)).astype(float)
    others = np.sort(rnd.integers(0, len(y) - 50, size=len(y)))
    assert len(set(others.tolist())) > SV.BAR
    x, ids = y[::97], others[::97]
    a, b, c = (np.concatenate(z) for z in zip(*SV._nearest(x, ids, y, others, 4)))
    want = []
    for i, v in zip(ids, x):
        best = {}
        for o, w in zip(others, y):
            if o != i:
                best[o] = max(best.get(o, -np.inf), float(v @ w))
        want += [(i, o, s) for o, s in sorted(best.items(), key=lambda z: (-z[1], z[0]))[:4]]
    assert list(zip(a, b, c)) == want


def test_lists_stay_full_where_ids_repeat(spark):
    rnd = np.random.default_rng(4)
    x = rnd.normal(size=(400, 16))
    rows = [(i, v) for i, v in enumerate(x.tolist())] * 3 + [(7, v) for v in rnd.normal(size=(30, 16)).tolist()]
    df = spark.createDataFrame(rows, "item_id long, vector array<double>")
    for exact in (True, False):
        out = SV.similar_items(df, k=5, tables=2, bucket_items=16, exact=exact).groupBy("item_id").agg(
            F.count("*").alias("n"), F.count_distinct("similar_id").alias("d")).collect()
        assert len(out) == 400 and all(r.n == r.d == 5 for r in out)


def test_exact_lists_on_request(spark):
    rnd = np.random.default_rng(1)
    x = rnd.normal(size=(600, 8))
    df = spark.createDataFrame([(i, v) for i, v in enumerate(x.tolist())], "item_id long, vector array<double>")
    got = {(r.item_id, r.rank): r.similar_id for r in SV.similar_items(df, k=3, tables=1, bucket_items=8, exact=True).collect()}
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    sim = x @ x.T - 3 * np.eye(600)
    assert got == {(i, r + 1): int(j) for i in range(600) for r, j in enumerate(np.argsort(-sim[i])[:3])}


def test_tfidf_matches_formula(spark):
    docs = spark.createDataFrame([(1, "red apple red"), (2, "green apple"), (3, None)], "id long, t string")
    got = {(r.id, r.term): r.weight for r in TX.tfidf(docs, "id", "t", 10, stop_words=[]).collect()}
    idf = lambda d: np.log((1 + 3) / (1 + d)) + 1
    raw1 = {"red": 2 * idf(1), "apple": idf(2)}
    n1 = np.sqrt(sum(v * v for v in raw1.values()))
    assert got[(1, "red")] == pytest.approx(raw1["red"] / n1)
    assert got[(1, "apple")] == pytest.approx(raw1["apple"] / n1)
    out, s = TX.truncated_svd(TX.tfidf(docs, "id", "t", 10, stop_words=[]), "id", 3, 2)
    assert out.count() == 3 and s[0] >= s[1]
    zero = out.where("id = 3").first()
    assert zero.svd_0 == zero.svd_1 == 0.0
    words = spark.createDataFrame([(1, "Am\u00e9lie \u00e0 Montr\u00e9al"), (2, "\u00e9t\u00e9"), (3, "1")], "id long, t string")
    got = sorted((r.id, r.term) for r in TX.tfidf(words, "id", "t", 10, stop_words=[]).collect() if r.term)
    assert got == [(1, "am\u00e9lie"), (1, "montr\u00e9al"), (2, "\u00e9t\u00e9")]


def test_hybrid_reranks_retrieved_candidates(spark):
    r = _ratings(spark, n=800, seed=4).withColumn("timestamp", F.current_timestamp().cast("timestamp_ntz")) \
                                      .withColumn("session_id", F.lit(1).cast("long"))
    users = spark.createDataFrame([(u, "x") for u in list(range(30)) + [999]], "user_id long, segment string")
    items = spark.createDataFrame([(i, float(i % 7)) for i in range(40)], "item_id long, price double")
    als = MO.train_als(r, rank=4, max_iter=5)
    matrix, inputs, fitted = MO.ranking_matrix(r, users, items)
    gbt = MO.train_gbt(matrix, trees=5, depth=3)
    out = MO.hybrid_top_k(als, gbt, fitted, r, r, users, items, inputs, k=3, candidates=8)
    cands = MO.top_k_unseen_factors(als, r, 8).select("user_id", "item_id")
    assert out.join(cands, ["user_id", "item_id"], "left_anti").count() == 0
    assert out.groupBy("user_id").count().where("count > 3").count() == 0


def test_running_stats_keep_every_key(spark):
    from recsmith.streaming import monitoring as M
    import datetime as dt
    root = tempfile.mkdtemp(prefix="recsmith-t13-")
    t0 = dt.datetime(2024, 1, 1)

    def feed(name, rows):
        spark.createDataFrame(rows, M.EVENT_SCHEMA).write.parquet(os.path.join(root, "in", name))
        M.running_stats(M.read_event_stream(spark, os.path.join(root, "in", "*")), "user_id", "value", "ts", "event_type",
                        os.path.join(root, "out"), os.path.join(root, "ck")).awaitTermination()
        return {r.user_id: (r.rating_count, r.rating_mean, r.rating_min, r.rating_max, r.timestamp_max, r.partners)
                for r in M.read_running_stats(spark, os.path.join(root, "out"), "user_id").collect()}

    feed("b0", [(1, t0, 1, "view", 2.0, "{}"), (2, t0, 2, "view", 3.0, "{}")])
    later = t0 + dt.timedelta(hours=1)
    want = {1: (2, 3.5, 2.0, 5.0, later, 2), 2: (1, 3.0, 3.0, 3.0, t0, 1)}
    assert feed("b1", [(3, later, 1, "click", 5.0, "{}")]) == want
    M.compact_running_stats(spark, os.path.join(root, "out"), "user_id", os.path.join(root, "small"))
    assert M.read_running_stats(spark, os.path.join(root, "small"), "user_id").count() == 2


def test_importance_and_save(spark):
    r = _ratings(spark, n=600, seed=7).withColumn("timestamp", F.current_timestamp().cast("timestamp_ntz")) \
                                      .withColumn("session_id", F.lit(1).cast("long"))
    matrix, inputs, _ = MO.ranking_matrix(r, None, None)
    gbt = MO.train_gbt(matrix, trees=3, depth=2)
    imp = MO.feature_importance(gbt, inputs).collect()
    assert len(imp) == len(inputs) and [x.importance for x in imp] == sorted((x.importance for x in imp), reverse=True)
    root = tempfile.mkdtemp(prefix="recsmith-model-")
    MO.save_model(gbt, root, {"trees": 3, "inputs": inputs})
    from pyspark.ml.regression import GBTRegressionModel
    assert GBTRegressionModel.load(os.path.join(root, "model")).getNumTrees == gbt.getNumTrees
    assert "trees" in spark.read.json(os.path.join(root, "metadata")).first().metadata


def test_svd_matches_numpy_up_to_sign(spark):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(
        ["red apple", "green apple pie", "red green", "blue sky pie", "apple sky", "red red blue"])], "id long, t string")
    long = TX.tfidf(docs, "id", "t", 10, stop_words=[])
    size = long.select(F.max("col")).first()[0] + 1
    A = np.zeros((6, size))
    for r in long.collect():
        A[r.id, r.col] = r.weight
    u, s, _ = np.linalg.svd(A, full_matrices=False)
    out, sing = TX.truncated_svd(long, "id", size, 3)
    assert sing == pytest.approx(list(s[:3]), abs=1e-9)
    got = {r.id: [r.svd_0, r.svd_1, r.svd_2] for r in out.collect()}
    us = u[:, :3] * s[:3]
    for j in range(3):
        col = np.array([got[i][j] for i in range(6)])
        assert min(np.abs(col - us[:, j]).max(), np.abs(col + us[:, j]).max()) < 1e-9


def test_svd_of_a_wide_vocabulary_matches_numpy(spark, monkeypatch):
    """More terms than the first block: several passes, a cut-back subspace, long documents cut into stretches."""
    rng = np.random.default_rng(5)
    n, size, k = 900, 400, 6
    A = np.where(rng.random((n, size)) < 0.03, rng.random((n, size)), 0.0)
    A[0] = rng.random(size)  # one document with every term
    A[:300, :9] += rng.random((300, 1))  # a third of all documents are alike in a few terms
    A[1] = 0.0
    cells = [(int(i), int(j), float(A[i, j])) for i, j in zip(*np.nonzero(A))] + [(1, None, 0.0), (5000, None, 0.0)]
    long = spark.createDataFrame(cells, "id long, col long, weight double").repartition(5)
    monkeypatch.setattr(TX, "FIRST_BLOCK", 24)
    monkeypatch.setattr(TX, "CELLS", 500)
    u, s, vt = np.linalg.svd(A, full_matrices=False)
    rows = TX.sparse_rows(long, "id")
    values, vectors, passes = TX.right_factors(rows, size, k)
    assert passes > 5 and np.abs(np.sqrt(values) - s[:k]).max() < 1e-9
    out, sing = TX.truncated_svd(long, "id", size, k)
    got = {r.id: list(r)[1:] for r in out.collect()}
    assert sorted(got) == [*range(n), 5000] and got[1] == got[5000] == [0.0] * k
    signs = np.sign(np.einsum("ij,ji->i", vt[:k], vectors))
    assert np.abs(np.array([got[i] for i in range(n)]) - u[:, :k] * s[:k] * signs).max() < 1e-6
    plan = out._jdf.queryExecution().toString()
    assert "Join" not in plan
    with pytest.raises(RuntimeError):
        TX.right_factors(rows, size, k, max_passes=2)


def test_tfidf_of_repeated_and_null_ids(spark):
    """An id of several rows is one document, each of its rows has its cells; NULL is nobody's id, but its terms count as a document's."""
    rows = [(1, "a1 a1 b1"), (1, "a1 c1"), (None, "b1 d1"), (None, "b1"), (2, "b1 the zz zz"), (3, "x"), (4, None)]
    docs = spark.createDataFrame(rows, "id long, t string")
    tf = {1: {"a1": 3, "b1": 1, "c1": 1}, None: {"b1": 2, "d1": 1}, 2: {"b1": 1, "the": 1, "zz": 2}}
    terms = sorted({t for c in tf.values() for t in c})
    idf = {t: np.log((1 + 7) / (1 + sum(t in c for c in tf.values()))) + 1 for t in terms}
    want = []
    for i, _ in rows:
        raw = {t: n * idf[t] for t, n in tf.get(i, {}).items()} if i is not None else {}
        norm = np.sqrt(sum(v * v for v in raw.values()))
        want += [(i, t, terms.index(t), round(v / norm, 9)) for t, v in raw.items()] or [(i, None, None, 0.0)]
    long = TX.tfidf(docs, "id", "t", 10, stop_words=[])
    got = [(r.id, r.term, r.col, round(r.weight, 9)) for r in long.collect()]
    assert sorted(got, key=str) == sorted(want, key=str) and long.columns == ["id", "term", "col", "weight"]
    # the compact rows and the long table are the same matrix
    a, s = TX.truncated_svd(TX.tfidf_rows(docs, "id", "t", 10, stop_words=[])[0], "id", len(terms), 2)
    b, z = TX.truncated_svd(long, "id", len(terms), 2)
    assert s == pytest.approx(z, abs=1e-12)
    a, b = ({r.id: list(r)[1:] for r in x.collect()} for x in (a, b))
    assert sorted(a, key=str) == sorted(b, key=str) == [1, 2, 3, 4, None]
    assert all(a[i] == pytest.approx(b[i], abs=1e-9) for i in a)


def test_tfidf_shuffles_no_document(spark):
    """Where ids do not repeat, no cell and no document is shuffled: the counts, lengths and weights are made where the text lies."""
    docs = spark.createDataFrame([(i, f"red w{i % 7}") for i in range(40)], "id long, t string")
    rows, _ = TX.tfidf_rows(docs, "id", "t", 100, stop_words=[])
    for df in (rows, TX.tfidf(docs, "id", "t", 100, stop_words=[])):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Exchange hashpartitioning" not in plan and "SortMergeJoin" not in plan


def test_blocks_are_bounded():
    """Dense blocks hold whole documents, few enough to stay small; a document longer than a block is taken whole."""
    import pyarrow as pa
    rng = np.random.default_rng(3)
    cols = [sorted(rng.choice(9000, size=n, replace=False).tolist()) for n in (0, 5, 8000, 1, *[2] * 300, *[900] * 20)]
    weights = [rng.random(len(c)).tolist() for c in cols]
    batch = pa.RecordBatch.from_arrays([pa.array([1 + i % 2 for i in range(len(cols))]), pa.array(cols, pa.list_(pa.int32())),
                                        pa.array(weights, pa.list_(pa.float64()))], names=["n", "cols", "weights"])
    met = []
    for docs, terms, cells, found in TX._blocks(batch, 9000):
        block = TX._dense(len(docs), terms, cells, found)
        assert block.shape == (len(docs), len(terms)) and (len(docs) == 1 or len(docs) <= TX.DOCUMENTS and len(terms) <= TX.CELLS)
        for d, row in zip(docs, block):
            assert {int(terms[j]): row[j] for j in np.flatnonzero(row)} == {c: w * (1 + d % 2) for c, w in zip(cols[d], weights[d])}
        met += docs.tolist()
    assert met == [i for i, c in enumerate(cols) if c]


def test_svd_of_nothing(spark):
    none = spark.createDataFrame([], "id string, col long, weight double")
    out, sing = TX.truncated_svd(none, "id", 4, 2)
    assert out.count() == 0 and sing == [0.0, 0.0] and out.columns == ["id", "svd_0", "svd_1"]


def test_fitted_transform_round_trip(spark):
    from recsmith.operators import encoders as E
    from recsmith.operators import features as FE
    df = spark.createDataFrame([("a", 1.0, 2.0), ("b", 3.0, 2.0), (None, 5.0, 4.0)], "g string, x double, rating double")
    m1, inputs, fitted = FE.model_matrix(df)
    root = tempfile.mkdtemp(prefix="recsmith-fitted-")
    E.save_fitted(fitted, root)
    m2, inputs2, _ = FE.model_matrix(df, fitted=E.load_fitted(spark, root))
    assert inputs == inputs2 == ["g", "x"]
    assert sorted(m1.select(*inputs).collect()) == sorted(m2.select(*inputs).collect())


def test_als_keeps_one_iteration_of_shuffle_files(spark):
    import time
    env = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get()

    def shuffled():
        files = env.blockManager().diskBlockManager().getAllFiles()
        return sum(files.apply(i).getName().startswith("shuffle_") for i in range(files.size()))

    r = spark.range(400).select((F.col("id") % 20).alias("user_id"), (F.col("id") % 37).alias("item_id"), (F.col("id") % 5 + 1.0).alias("rating"))
    before = shuffled()
    MO.train_als(r, rank=2, max_iter=12)
    for _ in range(40):  # files are deleted in the background
        left = shuffled() - before
        if left < 120:
            break
        time.sleep(0.25)
    assert left < 120  # 24 half-iterations of 10 maps, two files each, come to 480


def test_coded_features_are_those_of_the_encoders(spark):
    from recsmith.operators import features as FE
    r = spark.createDataFrame([(u, i, float(1 + (u * i) % 5), f"2024-01-{1 + u:02d} 0{i}:00:00", 10 * u + i) for u in range(1, 7) for i in range(1, 8)]
                              + [(None, 1, 2.0, None, 98), (77, None, 3.0, "2024-02-01 00:00:00", 99), (1, 1, None, "2024-02-01 00:00:00", 97)],
                              "user_id long, item_id long, rating double, timestamp string, session_id long").withColumn("timestamp", F.col("timestamp").cast("timestamp"))
    users = spark.createDataFrame([(u, ["a", "b", None][u % 3]) for u in range(1, 6)] + [(None, "z"), (50, "only here")], "user_id long, age_group string")
    items = spark.createDataFrame([(i, f"title {i}", 0.1 * i) for i in range(2, 9)], "item_id long, title string, price double")
    plain, inputs, _ = FE.model_matrix(FE.ranking_features(r, users, items), also=[users, items])
    matrix, own, fitted = MO.ranking_matrix(r, users, items)
    assert own == inputs

    def rows(m):
        return sorted([tuple(None if v is None else round(v, 9) for v in x) for x in m.select("session_id", "rating", *inputs).collect()], key=repr)

    assert rows(matrix) == rows(plain)
    stranger = spark.createDataFrame([(1, "never seen")], "user_id long, age_group string")
    with pytest.raises(Exception, match="unseen label in age_group"):
        FE.coded_ranking_features(r, stranger, items, fitted["cat"], fitted["lookup"]).collect()


def test_als_blocks_grow_with_the_ratings(spark, monkeypatch):
    """A task holds what one block's ratings meet: more ratings make more blocks, not larger ones."""
    asked, als = [], MO.ALS
    monkeypatch.setattr(MO, "ALS", lambda **k: asked.append((k["numUserBlocks"], k["numItemBlocks"])) or als(**k))
    monkeypatch.setattr(MO, "ALS_BLOCK_BYTES", 20 * (4 * 2 + 24))
    for n in (100, 300):
        rows = spark.range(n).select((F.col("id") % 20).alias("user_id"), (F.col("id") % 13).alias("item_id"), (F.col("id") % 5).cast("double").alias("rating"))
        MO.train_als(rows, rank=2, max_iter=1)
    assert asked == [(10, 10), (15, 15)]
