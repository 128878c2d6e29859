import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from recsmith.llm import embedding_dedup, topk

NAN, INF = float("nan"), float("inf")
SCHEMA = "vec_id long, embedding array<float>, label int"
ODD = [(0, [1.0, 0.0], 1), (50, [0.99, 0.05], 1), (1, [1.0, 0.0], None), (1, [1.0, 0.0], 2), (2, [0.0, 0.0], 1), (3, None, 1), (4, [], 1),
       (5, [None, 1.0], 1), (6, [NAN, 1.0], 1), (7, [INF, 1.0], 1), (8, [1.0, 0.0, 0.0], 1), (100, [1.0, 0.02, 0.0], 1), (None, [0.0, 1.0], 1),
       (9, [-0.0, 1.0], 1), (150, [-1.0, 0.0], 1), (10, [1e30, 0.0], 1)]


def brute_links(rows, cosine=0.95):
    n = [0] * len(rows)
    root = list(range(len(rows)))

    def usable(v):
        return v and all(x is not None and np.isfinite(x) for x in v) and any(v)

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(rows):
        for j, b in enumerate(rows[:i]):
            if usable(a[1]) and usable(b[1]) and len(a[1]) == len(b[1]):
                x, y = (np.asarray(np.float32(v), float) for v in (a[1], b[1]))
                if x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= cosine:
                    n[i] += 1
                    n[j] += 1
                    root[find(i)] = find(j)
    comp = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            comp[find(i)] = min(comp.get(find(i), r[0]), r[0])
    return sorted(((r[0], n[i], comp.get(find(i))) for i, r in enumerate(rows)), key=str)


def test_links_of_odd_vectors(spark):
    df = spark.createDataFrame(ODD, SCHEMA).withColumn("cid", F.lit("clash")).withColumn("near", F.lit(1))
    got = embedding_dedup.near_duplicates(df).collect()
    assert sorted(((r["vec_id"], r["n_links"], r["component_id"]) for r in got), key=str) == brute_links(ODD)
    assert all(r["kept"] == (r["vec_id"] is not None and r["vec_id"] == r["component_id"]) for r in got)
    assert embedding_dedup.near_duplicates(df.where("false")).count() == 0


def test_recall_against_all_pairs(spark):
    rng = np.random.default_rng(1)
    base = rng.normal(size=(600, 32))
    base /= np.linalg.norm(base, axis=1, keepdims=True)
    near = []
    for b, c in zip(base, np.linspace(0.9501, 0.9999, len(base))):
        o = rng.normal(size=32)
        o -= o @ b * b
        near.append(c * b + np.sqrt(1 - c * c) * o / np.linalg.norm(o))
    group = base[0] + 0.02 * rng.normal(size=(400, 32))  # a third of all rows are near copies of one vector
    x = np.vstack([base, near, group]).astype("f4")
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>")
    got = sorted((r["vec_id"], r["n_links"]) for r in embedding_dedup.near_duplicates(df).collect())
    y = x.astype(float)
    y /= np.linalg.norm(y, axis=1, keepdims=True)
    want = (y @ y.T >= 0.95).sum(1) - 1
    found = np.array([n for _, n in got])
    assert (found <= want).all() and found.sum() >= 0.9 * want.sum()
    assert found[:1200].sum() >= 0.9 * want[:1200].sum()


@pytest.mark.parametrize("cosine", [0.951, 0.96, 0.98])
def test_recall_with_as_many_pivots_as_a_large_table_has(spark, monkeypatch, cosine):
    rng = np.random.default_rng(7)

    def unit(x):
        return x / np.linalg.norm(x, axis=1, keepdims=True)

    pivots = unit(rng.normal(size=(embedding_dedup.MAX_PIVOTS, 64)))
    monkeypatch.setattr(embedding_dedup, "draw_pivots", lambda classes, n: {64: pivots})
    a, o = unit(rng.normal(size=(1500, 64))), rng.normal(size=(1500, 64))
    o = unit(o - (o * a).sum(1, keepdims=True) * a)
    x = np.vstack([a, cosine * a + np.sqrt(1 - cosine ** 2) * o]).astype("f4")
    df = spark.createDataFrame([(i, v) for i, v in enumerate(x.tolist())], "cid long, embedding array<float>")
    got = {tuple(sorted(r)) for r in embedding_dedup.links(df).collect()}
    recall = len(got & {(i, i + 1500) for i in range(1500)}) / 1500
    print(f"recall of links at cosine {cosine}, {embedding_dedup.MAX_PIVOTS} pivots: {recall:.4f}")
    assert recall >= 0.97


def test_copies_are_counted_not_paired(spark):
    df = spark.range(900).select(F.col("id").alias("vec_id"), F.when(F.col("id") % 3 == 0, F.array(F.lit(1.0), F.lit(2.0)))
                                 .otherwise(F.array(F.sin(F.col("id") * 1.0), F.cos(F.col("id") * 1.0))).cast("array<float>").alias("embedding"))
    rows = [(r["vec_id"], r["embedding"]) for r in df.collect()]
    got = embedding_dedup.near_duplicates(df).collect()
    want = brute_links(rows)
    found = sorted(((r["vec_id"], r["n_links"], r["component_id"]) for r in got), key=str)
    assert sum(f[1] for f in found) >= 0.9 * sum(w[1] for w in want)
    assert all(r["n_links"] >= 299 for r in got if r["vec_id"] % 3 == 0)


def test_components(spark):
    from recsmith.llm.common import connected_components
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, 101), (102, 101), (7, 7), (None, 3)] + [(200, 200 + i) for i in range(1, 50)] + [(100, 101)]
    got = {r["node"]: r["root"] for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{i: 100 for i in (100, 101, 102)}, **{i: 200 for i in range(200, 250)}}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


# ---- top k -----------------------------------------------------------------

def brute_top(rows, k=5):
    good = [(i, [int(np.floor(256.0 * float(np.float32(x)))) for x in v]) for i, v, *_ in rows
            if i is not None and v and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for q in sorted({i for i, _ in good if i % 50 == 0}):
        hits = []
        for qi, qv in good:
            if qi == q:
                hits += [(-sum(a * b for a, b in zip(qv, v)), c) for c, v in good if c != q and len(v) == len(qv)]
        out += [(q, n + 1, c, -s) for n, (s, c) in enumerate(sorted(hits)[:k])]
    return out


@pytest.mark.parametrize("slices", [(16384, 8192), (7, 3)])
def test_top_k_of_odd_vectors(spark, monkeypatch, slices):
    monkeypatch.setattr(topk, "SLICE", slices[0])
    monkeypatch.setattr(topk, "BLOCK", slices[1])
    rows = [r for r in ODD if r[0] != 10] + [(i, [i % 7 / 7, i % 11 / 11], 0) for i in range(200, 300)]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("v", F.lit("clash")).withColumn("norm", F.lit(1))
    got = topk.top_k(df, F.col("vec_id") % 50 == 0)
    assert sorted(map(tuple, got.collect())) == brute_top(rows)


def test_top_k_equals_sql(spark, small):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{small}/embeddings.parquet')")
    want = sorted(con.sql(f"SELECT query_id, rank, vec_id, score FROM ({topk.ORACLE})").fetchall())
    assert sorted(map(tuple, topk.op9_topk(spark, small).collect())) == want
    assert topk.top_k(spark.read.parquet(f"{small}/embeddings.parquet").where("false"), F.col("vec_id") % 50 == 0).count() == 0


def test_bounds_never_lose_a_score():
    rng = np.random.default_rng(4)
    c = np.floor(rng.normal(size=(3000, 12)) * rng.uniform(0, 200, (3000, 1)))
    c = c[np.argsort(-np.linalg.norm(c, axis=1))]
    q, ids = c[::500], np.arange(3000)
    rot = np.linalg.eigh(c.T @ c)[1][:, ::-1]
    got = topk.scan(ids[::500], q, ids, c, np.full(len(q), -np.inf), rot, k=5, lead=4)
    for i, v in zip(ids[::500], q):
        s = c @ v
        s[i] = -np.inf
        best = np.lexsort((ids, -s))[:5]
        assert [(x[1], x[2]) for x in got if x[0] == i] == [(int(b), int(s[b])) for b in best]
