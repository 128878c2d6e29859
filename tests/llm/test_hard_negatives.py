import numpy as np
import pytest
from pyspark.sql import functions as F

from recsmith.llm import hard_negatives as H


def _brute(rows, step=50, positives=5, negatives=3, scale=256):
    """rows (id, vector, label) -> the result by scoring everything, as a sorted list."""
    usable = [(i, [int(np.floor(scale * float(x))) for x in v], int(y)) for i, v, y in rows
              if i is not None and y is not None and v and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for i, v, y in usable:
        if i % step:
            continue
        scored = [(-sum(a * b for a, b in zip(v, w)), j, z) for j, w, z in usable if j != i and len(w) == len(v)]
        best = sorted(s for s in scored if s[2] == y)[:positives]
        for p, j, _ in best:
            fits = sorted((s, k) for s, k, z in scored if z != y and 50 * -p <= 100 * -s <= 95 * -p)[:negatives]
            out += [(i, j, r + 1, k, -p, -s) for r, (s, k) in enumerate(fits)]
    return sorted(out)


def _got(df):
    assert df.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(tuple(r) for r in df.collect())


def _frame(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], y) for i, v, y in rows],
                                 "vec_id long, embedding array<double>, label int")


def _clusters(rng, n, dim, labels=6, noise=0.5):
    centre = rng.normal(size=(labels, dim))
    y = rng.integers(0, labels, n)
    x = (centre[y] + noise * rng.normal(size=(n, dim))) * rng.uniform(0.05, 0.6, n)[:, None]
    return [(int(i), [float(c) for c in v], int(z)) for i, v, z in zip(range(n), x, y)]


def _relabelled(rows):
    return [(i, v, None if y is None else (y + 1) % 10 if i is not None and i % 7 == 0 else y) for i, v, y in rows]


def test_embeddings_as_brute_force(spark, small):
    rows = [(r["vec_id"], r["embedding"], r["label"]) for r in spark.read.parquet(f"{small}/embeddings.parquet").collect()]
    got = _got(H.op13_hard_negatives(spark, small))
    assert got and got == _brute(_relabelled(rows))


@pytest.mark.parametrize("seed,dim,noise", [(1, 3, 0.3), (2, 12, 0.7)])
def test_many_slices_and_blocks(spark, monkeypatch, seed, dim, noise):
    monkeypatch.setattr(H, "SLICE", 64)
    monkeypatch.setattr(H, "BLOCK", 16)
    monkeypatch.setattr(H, "CHUNK", 8)
    rows = _clusters(np.random.default_rng(seed), 700, dim, noise=noise)
    got = _got(H.mine(_frame(spark, rows), F.col("vec_id") % 10 == 0))
    assert got and got == _brute(rows, 10)


def test_intervals_hold_every_score():
    rng = np.random.default_rng(4)
    v = np.floor(256 * rng.normal(size=(500, 8)) * rng.uniform(0, 1, (500, 1)))
    v[:20] = v[20:40]
    v[40:50] = -v[50:60]
    v[60] = 0
    norm = np.linalg.norm(v, axis=1)
    refs = H.spread_directions(v[100:140] / norm[100:140, None], 6)
    angles = np.arccos(np.clip(v / np.maximum(norm, 1e-300)[:, None] @ refs.T, -1, 1))
    angles[norm == 0] = 0
    s = H.Slice(np.arange(500), np.zeros(500, int), np.arange(500), v, norm, angles)
    every = np.arange(500)
    for i in range(0, 500, 5):
        score = s.score(v[i], every)
        lower, upper = s.intervals(angles[i], norm[i], every)
        assert (lower <= score).all() and (score <= upper).all()
        for low, high in ((-np.inf, np.inf), (float(np.quantile(score, 0.9)), np.inf), (float(score.max()), np.inf), (-3000.0, 500.0)):
            at, up = s.candidates(angles[i], norm[i], low, high)
            need = np.flatnonzero((score >= low) & (score <= high))
            assert set(need) <= set(at) and (np.diff(up) <= 0).all()


def test_filter_spares_most_rows_of_narrow_groups():
    """Groups narrow in angle: what a high window looks at is little more than the anchor's own group."""
    rng = np.random.default_rng(7)
    centre = rng.normal(size=(40, 16))
    v = np.floor(256 * (np.repeat(centre, 50, axis=0) + 0.03 * rng.normal(size=(2000, 16))))
    norm = np.linalg.norm(v, axis=1)
    refs = H.spread_directions(v / norm[:, None], 16)
    angles = np.arccos(np.clip(v / norm[:, None] @ refs.T, -1, 1))
    s = H.Slice(np.arange(2000), np.zeros(2000, int), np.arange(2000), v, norm, angles)
    looked = [len(s.candidates(angles[i], norm[i], 0.95 * norm[i] ** 2, np.inf)[0]) for i in range(0, 2000, 50)]
    assert np.mean(looked) < 400


def test_ties_repeats_and_odd_rows(spark):
    rng = np.random.default_rng(3)
    rows = [(i, [float(x) for x in rng.integers(-3, 4, 4) / 4.0], int(i % 3)) for i in range(120)]  # many equal scores
    rows += [(200, None, 1), (201, [1.0, None, 0.0, 0.0], 1), (202, [float("nan"), 0, 0, 0], 1), (203, [float("inf"), 0, 0, 0], 1), (204, [], 1),
             (205, [1.0, 1.0], 1), (210, [1.0, 0.5], 1), (211, [1.0, 0.4], 2), (206, [1.0, 0.0, 0.0, 0.0], None), (None, [1.0, 0.0, 0.0, 0.0], 1),
             (220, [0.0] * 4, 0), (230, [-5.0] * 4, 9), (240, [9.0] * 4, 8)]
    df = _frame(spark, rows)
    for c in ("pos", "slice", "block", "anchor", "norm", "v", "score"):
        df = df.withColumn(c, F.lit("clash"))
    want = _brute(rows, 10)
    assert _got(H.mine(df, F.col("vec_id") % 10 == 0)) == want
    assert any(r[4] == 0 for r in want)  # a positive that scores 0 has the rows that score 0 as negatives
    # a repeated row: every anchor row has its lists, and never its own id
    twice = rows + rows[10:12] + [(7, rows[8][1], 0)]
    got = _got(H.mine(_frame(spark, twice), F.col("vec_id") % 10 == 0))
    assert got == _brute(twice, 10)
    assert _got(H.mine(df.where("vec_id = 230"), F.col("vec_id") % 10 == 0)) == []
    assert _got(H.mine(df.where("vec_id < 0"), F.col("vec_id") % 10 == 0)) == []
    assert _got(H.mine(df, F.col("vec_id") < 0)) == []


def test_one_label_holds_most_rows(spark, monkeypatch):
    monkeypatch.setattr(H, "SLICE", 32)
    monkeypatch.setattr(H, "BLOCK", 8)
    rng = np.random.default_rng(11)
    rows = [(i, v, 0 if i % 3 else y) for i, v, y in _clusters(rng, 500, 6)]
    rows += [(1000 + i, rows[4][1], 0) for i in range(200)]  # and a group of copies
    assert _got(H.mine(_frame(spark, rows), F.col("vec_id") % 25 == 0)) == _brute(rows, 25)


def test_scores_beyond_doubles_are_exact(spark):
    rng = np.random.default_rng(2)
    rows = [(i, [float(x) for x in rng.integers(-2 ** 29, 2 ** 29, 3)], int(i % 2)) for i in range(40)]
    df = _frame(spark, rows)
    assert _got(H.mine(df, F.col("vec_id") % 10 == 0, scale=1)) == _brute(rows, 10, scale=1)


def test_oracle_states_the_same(spark, small):
    import duckdb
    con = duckdb.connect()
    rng = np.random.default_rng(9)
    rows = _clusters(rng, 300, 5) + [(50, [0.1] * 5, 3), (50, [0.1] * 5, 3), (7, [0.2] * 5, None), (8, None, 1)]
    table = _frame(spark, rows)
    embeddings = table.toPandas()  # noqa: F841 (read by the SQL)
    want = sorted(con.sql(H.ORACLE).fetchall())
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    assert _got(H.mine(table.withColumn("label", label), F.col("vec_id") % 50 == 0)) == want
