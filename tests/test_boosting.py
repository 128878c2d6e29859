import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from recsmith.operators import models as MO


def test_best_round_waits_for_patience():
    up_and_down = [5.0, 4.0, 4.5, 4.6, 4.2, 3.0, 3.1, 3.2, 3.3, 2.0]
    assert MO.best_round(up_and_down, 10) == (9, 9)
    assert MO.best_round(up_and_down, 4) == (9, 9)  # the rise of three rounds is waited out
    assert MO.best_round(up_and_down, 3) == (1, 4)
    assert MO.best_round([3.0, 3.0, 3.0], 2) == (0, 2)  # the first of equals
    assert MO.best_round([1.0], 1) == (0, 0)


@pytest.fixture(scope="module")
def matrix(spark):
    df = spark.range(1200).select(
        F.col("id"), (F.col("id") * 37 % 101).cast("double").alias("a"), (F.col("id") * 53 % 17).cast("double").alias("b"),
        (F.col("id") % 5 == 0).alias("is_validation"))
    noise = F.pmod(F.xxhash64("id"), F.lit(1000)) / 400.0
    df = df.withColumn("rating", F.when(F.col("id") % 97 > 0, F.sin(F.col("a") / 9) + F.col("b") / 17 + noise))
    return VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(df)


def test_model_is_cut_at_the_best_round(spark, matrix):
    model, history = MO.train_gbt_with_patience(matrix, trees=60, depth=6, patience=5)
    rows = history.orderBy("iteration").collect()
    errors = [r["validation_rmse"] for r in rows]
    best = [r["iteration"] for r in rows if r["is_best"]]
    assert best == [int(np.argmin(errors))] and model.getNumTrees == best[0] + 1
    assert len(rows) == min(60, best[0] + 6)  # five rounds without gain end it
    assert len(rows) < 60  # the noise makes the error rise before the last round
    held = matrix.where("is_validation")
    assert MO.rmse(model, held).first()["rmse"] == pytest.approx(min(errors))
    assert model.featureImportances.size == 2


@pytest.mark.parametrize("patience,trees", [(5, 60), (13, 16)])
def test_rounds_after_the_end_are_not_fitted(spark, matrix, monkeypatch, patience, trees):
    """The whole ensemble is fitted only where its first quarter does not end the boosting; the history is that of the whole."""
    asked, fit = [], MO.GBTRegressor.fit
    monkeypatch.setattr(MO.GBTRegressor, "fit", lambda self, rows: asked.append(self.getMaxIter()) or fit(self, rows))
    model, history = MO.train_gbt_with_patience(matrix, trees=trees, depth=6, patience=patience)
    rows = history.orderBy("iteration").collect()
    monkeypatch.undo()
    first = max(patience + 1, -(-trees // 4))
    ended = len(rows) - 1 - next(r["iteration"] for r in rows if r["is_best"]) == patience
    assert asked == ([first] if ended and len(rows) <= first else [first, trees])
    known = matrix.where("rating is not null")
    whole = MO.GBTRegressor(maxIter=trees, maxDepth=6, stepSize=MO.GBT_LEARNING_RATE, subsamplingRate=MO.GBT_SUBSAMPLE, labelCol="rating",
                            featureSubsetStrategy=MO.GBT_COLSAMPLE, seed=MO.SEED).fit(known.where("not is_validation"))
    errors = [e ** 0.5 for e in whole.evaluateEachIteration(known.where("is_validation"), "squared")]
    assert [r["validation_rmse"] for r in rows] == pytest.approx(errors[:len(rows)], rel=1e-12)


def test_without_validation_rows_the_ensemble_stays_whole(spark, matrix):
    model, history = MO.train_gbt_with_patience(matrix.withColumn("is_validation", F.lit(False)), trees=3, depth=2)
    assert model.getNumTrees == 3 and history.count() == 0


def brute_ndcg(y, p):
    discount = 1 / np.log2(np.arange(len(y)) + 2)

    def dcg(key):
        order = np.argsort(-key, kind="stable")
        out = 0.0
        for k in np.unique(key):
            at = np.flatnonzero(key[order] == k)
            out += y[order][at].mean() * discount[at].sum()
        return out
    return dcg(p) / dcg(y)


def test_ndcg_of_predictions(spark):
    rng = np.random.default_rng(3)
    y, p = rng.integers(1, 6, 400).astype(float), np.round(rng.normal(size=400), 1)
    df = spark.createDataFrame([(float(a), float(b)) for a, b in zip(y, p)] + [(None, 1.0), (3.0, None)], "rating double, prediction double")
    got = MO.prediction_ndcg(df).first()
    assert got["n"] == 400 and got["ndcg"] == pytest.approx(brute_ndcg(y, p))
    assert MO.prediction_ndcg(df.where("rating = 3")).first()["ndcg"] is None
    assert MO.prediction_ndcg(df.where("false")).first()["ndcg"] is None
