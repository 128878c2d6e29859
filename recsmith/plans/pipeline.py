"""The end-to-end job: validate -> features -> split -> top-K -> metrics (-> models).

The order of steps of the reference's local chain and training pipeline, as one
Spark application; every step is a DataFrame plan and every output a table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from recsmith.operators import features as FE
from recsmith.operators import metrics as ME
from recsmith.operators import models as MO
from recsmith.operators import validation as V
from recsmith.operators.aggregates import genre_preferences, table_summary
from recsmith.plans import local_chain
from recsmith.sources import io


def run_pipeline(spark: SparkSession, users: DataFrame, items: DataFrame, interactions: DataFrame,
                 out_dir: str, k: int = 10, ks=(5, 10, 20), gate: bool = True,
                 train_models: bool = False, genres: list[str] | None = None) -> dict[str, str]:
    """Run every step and write its output under ``out_dir``; returns the paths.

    ``genres`` are the genres whose preference becomes a column of the user features; the table
    ``genre_preferences`` holds those of all genres in long form.
    ``gate=True`` stops before any feature work when a validation rule fails (V11).
    """
    out = {}
    checks = {name: V.validate_preset(df, name) for name, df in
              (("interactions", interactions), ("users", users), ("items", items))}
    report = V.validation_report(checks)
    report.write.mode("overwrite").json(f"{out_dir}/validation_report")
    out["validation_report"] = f"{out_dir}/validation_report"
    if gate:
        for result in checks.values():
            V.require_valid(result)

    feats = {"genre_preferences": genre_preferences(interactions, items),
             "user_features": FE.user_features(users, interactions, items, genres),
             "item_features": FE.item_features(items, interactions, text="title" in items.columns),
             "interaction_features": FE.interaction_features(interactions, users, items)}
    io.save_features(feats, f"{out_dir}/features")
    written = {n: spark.read.parquet(f"{out_dir}/features/{n}") for n in feats}
    table_summary(written).write.mode("overwrite").json(f"{out_dir}/feature_summary")
    out.update({n: f"{out_dir}/features/{n}" for n in feats})

    chain = local_chain.prepare(users, items, interactions)
    recs = local_chain.recommendations(chain, max(max(ks), k), keep=True)
    io.save_recommendations(recs.where(recs["rank"] <= k), f"{out_dir}/recommendations")
    io.save_metrics(ME.evaluation_suite(recs, chain.test, items, ks), f"{out_dir}/metrics")
    out["recommendations"] = f"{out_dir}/recommendations"
    out["metrics"] = f"{out_dir}/metrics"

    if train_models:
        als = MO.train_als(chain.train)
        MO.save_model(als, f"{out_dir}/models/als", {"rank": MO.EMBEDDING_DIM})
        matrix, inputs, _ = MO.ranking_matrix(chain.train, users, items)
        gbt, history = MO.train_gbt_with_patience(matrix)
        history.write.mode("overwrite").json(f"{out_dir}/models/gbt_history")
        errors = MO.rmse(gbt, matrix.where("is_validation"))
        ndcg = MO.prediction_ndcg(MO.predict(gbt, matrix.where("is_validation"))).select("ndcg")
        errors.crossJoin(ndcg).write.mode("overwrite").json(f"{out_dir}/models/gbt_evaluation")  # one row each
        MO.save_model(gbt, f"{out_dir}/models/gbt", {"inputs": inputs, "trees": gbt.getNumTrees})
        MO.feature_importance(gbt, inputs).write.mode("overwrite").json(f"{out_dir}/models/gbt_importance")
        out["models"] = f"{out_dir}/models"
    return out
