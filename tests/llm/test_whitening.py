import numpy as np
import pytest
from pyspark.sql import functions as F

from recsmith.llm import whitening as W


def _matrix(rng, n, rank, spread):
    q, _ = np.linalg.qr(rng.normal(size=(n, n)))
    e = np.zeros(n)
    e[:rank] = 10.0 ** -np.linspace(0, spread, rank)
    return (q * e) @ q.T


@pytest.mark.parametrize("n,rank,spread", [(1, 1, 0), (2, 2, 3), (7, 7, 0), (16, 16, 8), (33, 20, 4), (64, 64, 6), (64, 3, 1)])
def test_factorisation_as_numpy(n, rank, spread):
    rng = np.random.default_rng(n + rank)
    v = _matrix(rng, n, rank, spread)
    v = (v + v.T) / 2
    factor, order = W.pivoted_cholesky(v)
    assert np.allclose(factor @ factor.T, v[order][:, order], atol=1e-14)
    assert np.allclose(factor, np.tril(factor)) and (np.diff(factor.diagonal()[:factor.shape[1]]) <= 1e-12).all()
    values, vectors = W.eigen(v)
    want, axes = np.linalg.eigh(v)
    want, axes = want[::-1], axes[:, ::-1]
    assert rank <= len(values) <= n and (np.diff(values) <= 0).all()
    assert np.allclose(values[:rank], want[:rank], rtol=1e-9, atol=1e-15)
    assert np.allclose(vectors.T @ vectors, np.eye(len(values)), atol=1e-10 * 10 ** (spread / 2))
    if spread:  # distinct eigenvalues: the vectors are the same up to sign
        assert np.allclose(np.abs((vectors[:, :rank] * axes[:, :rank]).sum(axis=0)), 1, atol=1e-8)


def test_small_eigenvalues_keep_their_digits():
    """Jacobi on the factor of a graded matrix: each eigenvalue to its own relative precision."""
    rng = np.random.default_rng(3)
    d = 10.0 ** -np.linspace(0, 7, 6)
    b = np.eye(6) + 0.03 * rng.normal(size=(6, 6))
    v = d[:, None] * (b @ b.T) * d[None, :]
    values, _ = W.eigen((v + v.T) / 2)
    det = np.linalg.det(b @ b.T) * np.prod(d * d)  # the product of the eigenvalues
    assert len(values) == 6 and np.isclose(np.prod(values), det, rtol=1e-8)


def test_pairs_of_columns_meet_once():
    for r in range(0, 9):
        met = [(int(a), int(b)) for p, q in W._rounds(r) for a, b in zip(p, q)]
        assert sorted(met) == [(i, j) for i in range(r) for j in range(i + 1, r)]
        assert all(len({*p, *q}) == 2 * len(p) for p, q in W._rounds(r))


def _want(rows, k=8):
    x = np.array([[int(np.floor(1024 * float(c))) + 100000 for c in v] for _, v in rows], np.int64)
    n, s = len(x), x.sum(axis=0)
    dev = ((n * x - s) ** 2).sum(axis=1)
    centred = (n * x - s) / n
    v = centred.T @ centred / n
    e, u = np.linalg.eigh(v)
    e, u = e[::-1], u[:, ::-1]
    return n, dev, centred @ u[:, :k] / np.sqrt(e[:k]), e[:k] / np.trace(v)


def _check(got, rows, k=8):
    n, dev, white, explained = _want(rows, k)
    ids = [i for i, _ in rows]
    table = {(r["vec_id"], r["component"]): r for r in got}
    assert len(got) == len(table) == len(rows) * k
    mine = np.array([[table[i, j + 1]["whitened"] for j in range(k)] for i in ids])
    sign = np.sign((mine * white).sum(axis=0))
    assert np.allclose(mine * sign, white, atol=1e-6)
    assert all(table[i, j + 1]["deviation"] == dev[at] and table[i, j + 1]["n"] == n for at, i in enumerate(ids) for j in range(k))
    assert all(np.isclose(table[ids[0], j + 1]["explained"], explained[j], rtol=1e-10) for j in range(k))
    errors = {r["identity_error"] for r in got}
    cov = np.cov(mine.T, bias=True)
    assert len(errors) == 1 and errors.pop() < 1e-9 and np.abs(cov - np.eye(k)).max() < 1e-9


def test_embeddings_as_brute_force(spark, small):
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{small}/embeddings.parquet").collect()]
    _check(W.op12_whitening(spark, small).collect(), rows)


def test_result_does_not_hang_on_the_partitions(spark, small):
    df = spark.read.parquet(f"{small}/embeddings.parquet")
    rows = [(r["vec_id"], r["embedding"]) for r in df.collect()]
    _check(W.whiten(df.repartition(7)).collect(), rows)


def test_odd_rows(spark):
    rng = np.random.default_rng(5)
    plain = [(i, [float(x) for x in rng.normal(size=4)]) for i in range(30)]
    odd = [(100, None), (101, [1.0, None, 2.0, 3.0]), (102, [float("nan"), 0.0, 0.0, 0.0]), (103, [float("inf"), 0.0, 0.0, 0.0]), (104, []), (105, [1.0, 2.0]),
           (106, [0.0] * 3), (107, [0.0] * 3)]
    schema = "vec_id long, embedding array<float>, x string, dim string, n string, component string"
    df = spark.createDataFrame([(i, v, "c", "c", "c", "c") for i, v in plain + odd], schema)
    as_float = [(i, np.array(v, np.float32).tolist()) for i, v in plain]
    # a single vector of two entries and two equal ones of three have no variance and no component
    _check(W.whiten(df).collect(), as_float, 4)
    assert W.whiten(df.where("vec_id > 100")).count() == 0 and W.whiten(df.where("vec_id < 0")).count() == 0
    twice = W.whiten(df.where("vec_id < 30").unionByName(df.where("vec_id < 2")).withColumn("vec_id", F.expr("CASE WHEN vec_id >= 2 THEN vec_id END")))
    assert twice.count() == 32 * 4 and twice.where("vec_id IS NULL").count() == 4 * 4
    assert twice.agg({"identity_error": "max"}).first()[0] < 1e-9


def test_fewer_components_than_asked(spark):
    """Five dimensions, two of them free: two components; their variance is the whole trace."""
    rng = np.random.default_rng(8)
    flat = [(i, [a, b, a, 0.5, b]) for i, (a, b) in enumerate(rng.integers(-50, 50, (40, 2)) / 64.0)]
    got = W.whiten(spark.createDataFrame([(i, [float(x) for x in v]) for i, v in flat], "vec_id long, embedding array<double>")).collect()
    assert len(got) == 80 and {r["component"] for r in got} == {1, 2}
    assert np.isclose(sum({r["component"]: r["explained"] for r in got}.values()), 1, rtol=1e-12)


def test_deviations_are_exact_or_refused():
    f = W.Whitening(3, [3 * 10 ** 9], 1.0, np.ones(1), np.ones((1, 1)))
    assert f.squares(np.array([[10 ** 9 + 5]])) == [225]
    big = W.Whitening(10 ** 9, [0] * 64, 1.0, np.ones(1), np.ones((64, 1)))
    assert big.squares(np.array([[3] + [0] * 63])) == [9 * 10 ** 18]
    with pytest.raises(OverflowError):
        big.squares(np.array([[10] * 64]))
