import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from recsmith.operators import aggregates as A
from recsmith.operators import quantiles as Q

PROBS = [0.0, 0.01, 0.25, 0.5, 0.95, 1.0]


def data(seed=5):
    """A third of all rows in one group, heavy ties, NULL values and a NULL group, groups of one and two."""
    rng = random.Random(seed)
    rows = [("hot", rng.gauss(0, 100)) for _ in range(3000)]
    rows += [("ties", float(rng.randrange(4))) for _ in range(2500)]
    rows += [(None, rng.random()) for _ in range(900)]
    rows += [("one", 7.0), ("two", -1.0), ("two", 4.0), ("none", None)] + [("const", 3.5)] * 1500
    rows += [("hot", None)] * 50
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("accuracy, margin", [(10_000, 2), (100, 2), (20, 0.01), (3, 0)])
def test_groups_equal_numpy(spark, accuracy, margin):
    rows = data()
    df = spark.createDataFrame(rows, "k string, x double").repartition(5)
    got = {r["k"]: r for r in Q.values_at(df, ["k"], "x", PROBS, accuracy=accuracy, margin=margin).collect()}
    keys = {k for k, x in rows if x is not None}
    assert set(got) == keys
    for k in keys:
        xs = np.sort([x for g, x in rows if g == k and x is not None])
        assert got[k]["n"] == len(xs)
        for i, p in enumerate(PROBS):
            at = int((len(xs) - 1) * p)
            assert got[k][f"low{i}"] == xs[at]
            assert got[k][f"high{i}"] == (xs[at + 1] if at + 1 < len(xs) else None)


def test_large_table_of_groups_by_shuffle(spark, monkeypatch):
    df = spark.createDataFrame(data(), "k string, x double")
    want = sorted(Q.values_at(df, ["k"], "x", PROBS, accuracy=50).collect(), key=str)
    monkeypatch.setattr(Q, "BROADCAST_GROUPS", 0)
    assert sorted(Q.values_at(df, ["k"], "x", PROBS, accuracy=50).collect(), key=str) == want


def test_only_the_brackets_are_sorted(spark, monkeypatch):
    """Of 200,000 distinct values the sorted table holds no more than the brackets and one sum each."""
    sizes = []
    plain = Q.materialize

    def counted(df):
        out = plain(df)
        if "w" in out.columns:
            sizes.append(out.count())
        return out

    monkeypatch.setattr(Q, "materialize", counted)
    df = spark.range(200_000).select((F.col("id") * 7919 % 200_003).cast("double").alias("x"))
    got = {r["q"]: r["value"] for r in A.exact_quantiles(df, "x", [0.25, 0.5, 0.95]).collect()}
    xs = np.arange(200_000) * 7919 % 200_003
    assert got == {q: pytest.approx(float(np.quantile(xs, q))) for q in (0.25, 0.5, 0.95)}
    assert len(sizes) == 1 and sizes[0] <= 3 * (2 * (Q.MARGIN + 1) * 200_000 / Q.ACCURACY + 2)


def test_empty_and_null_columns(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 2.0)], "a double, b double")
    got = {(r["column"], r["statistic"]): r["value"] for r in A.numeric_summary(df, ["a", "b"]).collect()}
    assert got["a", "count"] == 0 and got["a", "50%"] is None and got["b", "50%"] == 1.5 and len(got) == 16
    assert Q.values_at(df.where("false"), ["a"], "b", [0.5]).count() == 0
    assert [tuple(r) for r in A.exact_quantiles(df.where("false"), "b", [0.5]).collect()] == [(0.5, None)]
