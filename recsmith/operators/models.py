"""Models and retrieval on Spark ML.

Collaborative factors come from ALS (same capability as the reference's
two-tower model, not the same numbers); the rating regressor is a gradient
boosted tree ensemble on the ranking features.
"""

from __future__ import annotations

import json
from dataclasses import dataclass
from functools import reduce

from pyspark import SparkContext
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recsmith.operators import aggregates as A
from recsmith.operators import encoders as E
from recsmith.operators import features as FE
from recsmith.operators.recommend import top_k_unseen
from recsmith.operators.retrieval import top_k_inner
from recsmith.operators.split import with_global_index
from recsmith.session import ensure_checkpoint_dir, materialize

# Fixed settings of the reference trainers.
EMBEDDING_DIM = 64
GBT_TREES = 100
GBT_DEPTH = 6
GBT_LEARNING_RATE = 0.1
GBT_SUBSAMPLE = 0.8
GBT_COLSAMPLE = "0.8"
GBT_PATIENCE = 10
SEED = 42
INT_MAX = 2 ** 31 - 1
#: What a task of ALS may hold of the other side's factors, if every rating of its block is of another one.
ALS_BLOCK_BYTES = 640 << 20


@dataclass
class FactorModel:
    """ALS factors with the lookups from the tables' own ids (any type) to the dense ids of the factors."""
    als: ALSModel
    users: DataFrame  # value, code
    items: DataFrame
    mean: float  # of the training ratings: the prediction where a user or item is unknown


def _dense_ids(ratings: DataFrame, col: str) -> DataFrame:
    """Codes 0, 1, .. of the distinct ids; more than ALS can hold (32 bits) raise, none is wrapped or dropped."""
    codes = E.fit_label_encoder(ratings, col, fill=None)
    return codes.select("value", F.when(F.col("code") <= INT_MAX, F.col("code")).otherwise(
        F.raise_error(F.lit(f"more than 2^31 values of {col}")).cast("long")).cast("int").alias("code"))


def _coded(df: DataFrame, model: FactorModel, how: str = "left") -> DataFrame:
    """``df`` with the dense ids ``_user`` and ``_item`` (NULL where the model does not know them)."""
    u = model.users.select(F.col("value").alias("_uv"), F.col("code").alias("_user"))
    i = model.items.select(F.col("value").alias("_iv"), F.col("code").alias("_item"))
    return (df.join(u, F.col("user_id") == F.col("_uv"), how).join(i, F.col("item_id") == F.col("_iv"), how)
            .drop("_uv", "_iv"))


def train_als(interactions: DataFrame, rank: int = EMBEDDING_DIM, max_iter: int = 10, reg: float = 0.1,
              implicit: bool = False, seed: int = SEED) -> FactorModel:
    """M1: explicit (rating) or implicit (retrieval) collaborative factors, for ids of any type.

    Every half-iteration shuffles each side's factors to the blocks of the other; the factors are checkpointed after each
    iteration, which deletes its shuffle files, so the disk holds one iteration's whatever their number.  A task holds the factors that its
    block's ratings meet, so the blocks (10, Spark's number, at least) grow with the ratings; more blocks mean more copies of a factor on disk."""
    ensure_checkpoint_dir(interactions.sparkSession)
    data = interactions.where(F.col("rating").isNotNull() & F.col("user_id").isNotNull() & F.col("item_id").isNotNull())
    mean, n = data.agg(F.avg("rating"), F.count("rating")).first()
    model = FactorModel(None, materialize(_dense_ids(data, "user_id")), materialize(_dense_ids(data, "item_id")), mean)
    blocks = max(10, -(-n * (4 * rank + 24) // ALS_BLOCK_BYTES))
    als = ALS(numUserBlocks=blocks, numItemBlocks=blocks, rank=rank, maxIter=max_iter, regParam=reg, implicitPrefs=implicit, userCol="_user",
              itemCol="_item", ratingCol="rating", coldStartStrategy="nan", seed=seed, nonnegative=False, checkpointInterval=1)
    model.als = als.fit(_coded(data, model, "inner").select("_user", "_item", F.col("rating").cast("float").alias("rating")))
    return model


def predict(model, rows: DataFrame) -> DataFrame:
    """``rows`` with prediction and is_cold: every row is scored, unknown users and items by the training mean."""
    if not isinstance(model, FactorModel):
        return model.transform(rows).withColumn("is_cold", F.lit(False))
    coded = _coded(rows, model).withColumn("_user", F.coalesce("_user", F.lit(-1))).withColumn("_item", F.coalesce("_item", F.lit(-1)))
    scored = model.als.transform(coded)
    cold = F.col("prediction").isNull() | F.isnan("prediction")
    return (scored.withColumn("is_cold", cold)
            .withColumn("prediction", F.when(cold, F.lit(model.mean)).otherwise(F.col("prediction").cast("double")))
            .drop("_user", "_item"))


def rmse(model, test: DataFrame, label: str = "rating") -> DataFrame:
    """M3 / M6: MSE, RMSE, MAE of a model's predictions over all rated rows as one row, and how many of them
    had a user or item the model does not know (scored with the training mean)."""
    pred = predict(model, test.where(F.col(label).isNotNull()))
    err = F.col("prediction") - F.col(label)
    return pred.agg(F.avg(err * err).alias("mse"), F.sqrt(F.avg(err * err)).alias("rmse"),
                    F.avg(F.abs(err)).alias("mae"), F.count(F.lit(1)).alias("n"),
                    F.count(F.when(F.col("is_cold"), 1)).alias("n_cold"))


def rmse_evaluator(model: FactorModel, test: DataFrame) -> float:
    """M3 with Spark's evaluator (a single number)."""
    return RegressionEvaluator(metricName="rmse", labelCol="rating", predictionCol="prediction").evaluate(predict(model, test))


def factor_tables(model: FactorModel) -> tuple[DataFrame, DataFrame]:
    """The factors under the tables' own ids: (user_id, vector), (item_id, vector)."""
    def own(factors: DataFrame, ids: DataFrame, name: str) -> DataFrame:
        return factors.join(ids, F.col("id") == F.col("code")).select(F.col("value").alias(name), F.col("features").alias("vector"))

    return own(model.als.userFactors, model.users, "user_id"), own(model.als.itemFactors, model.items, "item_id")


def top_k_unseen_factors(model: FactorModel, history: DataFrame, k: int = 10, users: DataFrame | None = None,
                         fallback: DataFrame | None = None) -> DataFrame:
    """M2 + J6: exact top-k by inner product among items a user has not seen (``retrieval.top_k_inner``).

    ``users`` without factors get the lists of ``fallback`` (base scores item_id, genre, base_score: W5 in the order of W6).
    """
    vectors, items = factor_tables(model)
    if users is not None:
        vectors = vectors.join(users.select("user_id").distinct(), "user_id", "left_semi")
    out, _ = top_k_inner(vectors, items, history, k)
    if fallback is not None and users is not None:
        cold = materialize(users.select("user_id").distinct().join(model.users, F.col("user_id") == F.col("value"), "left_anti"))
        plain = cold.withColumn("preferred_genres", F.lit(None).cast("string"))
        out = out.unionByName(top_k_unseen(plain, fallback, fallback, history, cold, k))
    return out


def ranking_matrix(interactions: DataFrame, users: DataFrame | None, items: DataFrame | None,
                   validation_fraction: float = 0.2, seed: int = SEED):
    """P17 + W4: scaled feature vector per interaction, with a stable validation flag.

    Returns (matrix, inputs, fitted): ``fitted`` holds the encoders and scaler.  The coded features are stored once, since fitting the
    scaler, training, validation and evaluation read them; scaling and assembling are arithmetic on what is read, so the disk
    holds small columns and no vectors.  Encoders know every value of the user and item tables."""
    none = [t if t is None else t.where(F.lit(False)) for t in (interactions, users, items)]
    cat, num = FE.feature_columns(FE.ranking_features(*none))  # by their types alone
    lookup = FE.ranking_labels(interactions, users, items, cat)
    inputs = cat + num
    feats = FE.coded_ranking_features(interactions, users, items, cat, lookup)
    feats = materialize(feats.select(*[F.col(c).cast("double").alias(c) for c in inputs], *[c for c in feats.columns if c not in inputs]))
    state = materialize(E.fit_standard_scaler(feats, inputs))
    fitted = {"cat": cat, "num": num, "lookup": lookup, "scaler": state}
    bucket = F.pmod(F.xxhash64("user_id", "item_id", "session_id", "timestamp", F.lit(seed)), F.lit(10000))
    matrix = (E.standard_scale(feats, inputs, state=state)
              .withColumn("is_validation", bucket >= int((1 - validation_fraction) * 10000)))
    return VectorAssembler(inputCols=inputs, outputCol="features", handleInvalid="keep").transform(matrix), inputs, fitted


def train_gbt(matrix: DataFrame, trees: int = GBT_TREES, depth: int = GBT_DEPTH, tol: float = 0.01,
              seed: int = SEED):
    """M4 + M5: boosted rating regressor; the validation rows stop the boosting once the
    validation error no longer improves by ``tol``."""
    gbt = GBTRegressor(featuresCol="features", labelCol="rating", maxIter=trees, maxDepth=depth,
                       stepSize=GBT_LEARNING_RATE, subsamplingRate=GBT_SUBSAMPLE,
                       featureSubsetStrategy=GBT_COLSAMPLE, seed=seed,
                       validationIndicatorCol="is_validation", validationTol=tol)
    return gbt.fit(matrix)


def best_round(errors: list[float], patience: int) -> tuple[int, int]:
    """(best, last): the round of least error (0-based, the first of equals) when boosting ends after ``patience`` rounds without
    a lower one, and the last round looked at."""
    best = 0
    for i, e in enumerate(errors):
        if e < errors[best]:
            best = i
        elif i - best >= patience:
            return best, i
    return best, len(errors) - 1


def train_gbt_with_patience(matrix: DataFrame, trees: int = GBT_TREES, depth: int = GBT_DEPTH, patience: int = GBT_PATIENCE,
                            seed: int = SEED):
    """M4 + M5: boosted rating regressor cut at the round of least validation error; (model, history).

    ``history`` has a row per round up to the one that ends the boosting: iteration (0-based), validation_rmse, is_best.  Spark's own
    tolerance ends at the first small gain and knows no patience, so a quarter of the rounds is fitted on the training rows, and the whole
    ensemble only if the boosting does not end within it: a longer ensemble begins with the trees of a shorter one (each round has its own
    seed), so the result is the same.  One pass over the validation rows gives the error of every round (``evaluateEachIteration``).
    Without validation rows the whole ensemble is kept and the history is empty."""
    spark = matrix.sparkSession
    gbt = GBTRegressor(featuresCol="features", labelCol="rating", maxIter=trees, maxDepth=depth, stepSize=GBT_LEARNING_RATE,
                       subsamplingRate=GBT_SUBSAMPLE, featureSubsetStrategy=GBT_COLSAMPLE, seed=seed)
    rows = matrix.where(~F.col("is_validation") & F.col("rating").isNotNull())
    held = matrix.where(F.col("is_validation") & F.col("rating").isNotNull())
    schema = "iteration int, validation_rmse double, is_best boolean"
    if held.isEmpty():
        return gbt.fit(rows), spark.createDataFrame([], schema)
    quarter = max(patience + 1, -(-trees // 4))
    for n in ([quarter] if quarter < trees else []) + [trees]:
        fitted = gbt.copy({gbt.maxIter: n}).fit(rows)
        errors = [e ** 0.5 for e in fitted.evaluateEachIteration(held, "squared")]
        best, last = best_round(errors, patience)
        if last - best >= patience:
            break
    history = spark.createDataFrame([(i, errors[i], i == best) for i in range(last + 1)], schema)
    return first_trees(fitted, best + 1), history


def first_trees(model: GBTRegressionModel, n: int) -> GBTRegressionModel:
    """The ensemble as it was after ``n`` rounds."""
    sc = SparkContext._active_spark_context
    kinds = sc._jvm.org.apache.spark.ml.regression
    own = model._java_obj
    trees = sc._gateway.new_array(kinds.DecisionTreeRegressionModel, n)
    weights = sc._gateway.new_array(sc._jvm.double, n)
    for i in range(n):
        trees[i], weights[i] = own.trees()[i], float(model.treeWeights[i])
    cut = GBTRegressionModel(kinds.GBTRegressionModel(own.uid(), trees, weights, model.numFeatures))
    return model._copyValues(cut)


def prediction_ndcg(pred: DataFrame, label: str = "rating", prediction: str = "prediction") -> DataFrame:
    """M6: NDCG of the predictions over all rows as one list (gain = label, discount log2(position + 2), tied predictions share
    the mean of their discounts); NULL with fewer than two different labels.

    Positions come from the global index, so no task holds the list; ties are summed before the shuffle."""
    rows = pred.where(F.col(label).isNotNull() & F.col(prediction).isNotNull()).select(
        F.col(label).cast("double").alias("gain"), F.col(prediction).cast("double").alias("key"))
    rows = materialize(rows)

    def dcg(by: str) -> Column:
        placed = with_global_index(rows.select("gain", F.col(by).alias("by")), [F.col("by").desc(), F.col("gain").desc()], "pos")
        ties = placed.groupBy("by").agg(F.sum("gain").alias("g"), F.count(F.lit(1)).alias("n"),
                                        F.sum(1.0 / F.log2(F.col("pos") + 2)).alias("d"))
        return ties.select(F.sum(F.col("g") * F.col("d") / F.col("n"))).scalar()

    one = rows.agg(F.count(F.lit(1)).alias("n"), F.min("gain").alias("least"), F.max("gain").alias("most"))
    return one.select("n", F.when(F.col("least") < F.col("most"), dcg("key") / dcg("gain")).alias("ndcg"))


def feature_importance(model, inputs: list[str]) -> DataFrame:
    """Importances, descending (one row per input column)."""
    from pyspark.sql import SparkSession
    spark = SparkSession.getActiveSession()
    imp = model.featureImportances.toArray()
    rows = [(c, float(v)) for c, v in zip(inputs, imp)]
    return spark.createDataFrame(rows, "feature string, importance double").orderBy(F.col("importance").desc())


def save_model(model, path: str, metadata: dict) -> None:
    """M7: model plus a JSON metadata record next to it."""
    from pyspark.sql import SparkSession
    if isinstance(model, FactorModel):
        for name, table in (("users", model.users), ("items", model.items)):
            table.write.mode("overwrite").parquet(f"{path}/{name}")
        metadata = {**metadata, "mean_rating": model.mean}
        model = model.als
    model.write().overwrite().save(f"{path}/model")
    spark = SparkSession.getActiveSession()
    spark.createDataFrame([(json.dumps(metadata, sort_keys=True),)], "metadata string") \
         .write.mode("overwrite").json(f"{path}/metadata")


def load_factors(spark, path: str) -> FactorModel:
    """M7: factors saved by ``save_model``."""
    meta = json.loads(spark.read.json(f"{path}/metadata").first()["metadata"])
    return FactorModel(ALSModel.load(f"{path}/model"), spark.read.parquet(f"{path}/users"), spark.read.parquet(f"{path}/items"),
                       meta["mean_rating"])


def hybrid_top_k(als: FactorModel, gbt, fitted: dict, history: DataFrame, interactions: DataFrame,
                 users: DataFrame | None, items: DataFrame | None, inputs: list[str], k: int = 10,
                 candidates: int = 50, targets: DataFrame | None = None, fallback: DataFrame | None = None) -> DataFrame:
    """Retrieve ``candidates`` unseen items per user (of ``targets``) with the factors, then re-rank
    them with the boosted regressor.  Candidate pairs are featurized by the training
    feature function (statistics from ``interactions``) and transformed with the
    training encoders and scaler (``fitted``).  Users without factors get their candidates from ``fallback``."""
    cands = top_k_unseen_factors(als, history, candidates, targets, fallback).select("user_id", "item_id")
    rows = cands
    for f in interactions.schema.fields:
        if f.name not in rows.columns:
            rows = rows.withColumn(f.name, F.lit(None).cast(f.dataType))
    feats = FE.coded_ranking_features(rows.select(*interactions.columns), users, items, fitted["cat"], fitted["lookup"], history=interactions)
    feats = feats.withColumns({c: F.col(c).cast("double") for c in inputs})
    matrix = E.standard_scale(feats, inputs, state=fitted["scaler"])
    scored = gbt.transform(VectorAssembler(inputCols=inputs, outputCol="features", handleInvalid="keep")
                           .transform(matrix))
    w = Window.partitionBy("user_id").orderBy(F.col("prediction").desc(), F.col("item_id").desc())
    return (scored.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
                  .select("user_id", F.col("rank").cast("long").alias("rank"), "item_id",
                          F.col("prediction").alias("score")))


def assign_variants(users: DataFrame, salt: str = "ab-1", treatment_percent: int = 50) -> DataFrame:
    """Stable A/B assignment from a salted hash bucket of the user id."""
    digest = F.md5(F.concat_ws(":", F.lit(salt), F.col("user_id").cast("string")).cast("binary"))
    bucket = (F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") % 100)
    return users.select("user_id", F.when(bucket < treatment_percent, "treatment").otherwise("control")
                        .alias("variant"), bucket.alias("bucket"))


def variant_metrics(per_user: DataFrame, variants: DataFrame, ks=(10,)) -> DataFrame:
    """Recall / precision / NDCG / MRR per variant from the evaluator's per-user table."""
    j = per_user.join(variants, "user_id")
    has = F.col("n_actual") > 0
    aggs = [F.count(F.lit(1)).alias("users")]
    for k in ks:
        aggs += [F.avg(F.when(has, F.col(f"hits_{k}") / F.col("n_actual"))).alias(f"recall_{k}"),
                 F.avg(F.when(F.col(f"n_rec_{k}") > 0, F.col(f"hits_{k}") / F.col(f"n_rec_{k}"))).alias(f"precision_{k}"),
                 F.avg(F.when(has, F.col(f"ndcg_{k}"))).alias(f"ndcg_{k}")]
    aggs.append(F.avg(F.when(has, F.coalesce(1.0 / F.col("first_hit"), F.lit(0.0)))).alias("mrr"))
    return j.groupBy("variant").agg(*aggs)


def compare_versions(results: dict[str, DataFrame]) -> DataFrame:
    """Metric tables of several model versions side by side (one column per version)."""
    tagged = [r.withColumn("version", F.lit(v)) for v, r in results.items()]
    allr = reduce(DataFrame.unionByName, tagged)
    return allr.groupBy("metric", "k").pivot("version", sorted(results)).agg(F.first("value"))


def user_stats_as_of(interactions: DataFrame, as_of, time_col: str = "timestamp") -> DataFrame:
    """Point-in-time user features: only interactions strictly before ``as_of``."""
    past = interactions.where(F.col(time_col) < F.lit(as_of).cast(interactions.schema[time_col].dataType))
    return A.user_stats(past)
