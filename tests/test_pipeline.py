import os
import tempfile

import pytest

from recsmith.operators import validation as V
from recsmith.plans.pipeline import run_pipeline
from recsmith.sources import fixtures
from tests.conftest import SF_SMALL


def test_pipeline_writes_every_output(spark):
    t = fixtures.tables(spark, SF_SMALL)
    root = tempfile.mkdtemp(prefix="recsmith-pipe-")
    out = run_pipeline(spark, t["users"], t["items"], t["interactions"], root)
    for name in ("validation_report", "genre_preferences", "user_features", "item_features", "interaction_features",
                 "recommendations", "metrics"):
        assert os.path.exists(out[name]), name
    recs = spark.read.json(out["recommendations"])
    assert recs.count() > 0
    metrics = spark.read.json(os.path.join(out["metrics"], "json"))
    assert metrics.count() == 14


def test_pipeline_gate_stops_on_bad_data(spark):
    t = fixtures.tables(spark, SF_SMALL)
    bad = t["interactions"].withColumn("rating", t["interactions"]["rating"] + 10)
    with pytest.raises(V.ValidationError):
        run_pipeline(spark, t["users"], t["items"], bad, tempfile.mkdtemp(prefix="recsmith-gate-"))


def test_pipeline_trains_models_on_text_ids(spark, monkeypatch):
    from pyspark.sql import functions as F

    from recsmith.operators import models as MO
    monkeypatch.setattr(MO.train_gbt_with_patience, "__defaults__", (5, 3, 10, 42))
    t = fixtures.tables(spark, SF_SMALL)
    user, item = F.format_string("user_%06d", "user_id"), F.format_string("item_%06d", "item_id")
    out = run_pipeline(spark, t["users"].withColumn("user_id", user), t["items"].withColumn("item_id", item),
                       t["interactions"].withColumn("user_id", user).withColumn("item_id", item),
                       tempfile.mkdtemp(prefix="recsmith-pipe-"), train_models=True)
    factors = MO.load_factors(spark, os.path.join(out["models"], "als"))
    assert factors.users.first()["value"].startswith("user_0")
    history = spark.read.json(os.path.join(out["models"], "gbt_history")).collect()
    evaluation = spark.read.json(os.path.join(out["models"], "gbt_evaluation")).first()
    assert sum(r["is_best"] for r in history) == 1
    assert evaluation["rmse"] == pytest.approx(min(r["validation_rmse"] for r in history)) and 0 < evaluation["ndcg"] <= 1
    items = spark.read.parquet(out["item_features"])
    assert "svd_0" in items.columns and items.count() == t["items"].count()
