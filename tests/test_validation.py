import pytest
from pyspark.sql import functions as F

from recsmith.operators import validation as V

SCHEMA = "user_id string, item_id string, interaction_type string, rating double"
ROWS = [("u1", "i1", "view", 3.0), (None, "i2", "like", 5.0), ("u3", None, "bogus", 0.5),
        ("u4", "i4", None, None), ("u5", "i5", "share", 6.0), ("u6", "i6", "watch", 1.0)]


def test_rule_counts(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    got = {(r.column, r.rule): r.n_bad for r in V.validate_preset(df, "interactions").collect()}
    assert got == {("user_id", "presence_required"): 1, ("item_id", "presence_required"): 1,
                   ("interaction_type", "allowed_values"): 1, ("rating", "min_value"): 1,
                   ("rating", "max_value"): 1}


def test_missing_columns_are_skipped_and_gate(spark):
    df = spark.createDataFrame([("i1", 0.5, 0.9, 1.0)], "item_id string, popularity_score double, "
                                                         "quality_score double, price double")
    res = V.validate_preset(df, "items")
    assert "rating_avg" not in {r.column for r in res.collect()}
    V.require_valid(res)
    bad = V.validate_preset(spark.createDataFrame(ROWS, SCHEMA), "interactions")
    with pytest.raises(V.ValidationError):
        V.require_valid(bad)


def test_report_and_quarantine(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    rep = V.validation_report({"interactions": V.validate_preset(df, "interactions")}).first()
    assert rep.n_rules == 5 and rep.n_anomalies == 5 and not rep.is_valid
    good, bad = V.quarantine(df, V.INTERACTION_RULES)
    assert good.count() == 3 and bad.count() == 3


def test_infer_and_update_schema(spark):
    a = spark.createDataFrame([("x", 1.0), ("y", 2.0)], "c string, v double")
    b = spark.createDataFrame([("z", 5.0), (None, 0.5)], "c string, v double")
    s = V.infer_schema(a)
    rows = {r.column: r for r in s.collect()}
    assert rows["v"].min == 1.0 and rows["c"].required
    u = {r.column: r for r in V.update_schema(s, b).collect()}
    assert not u["c"].required
    domains = V.infer_domains(a)
    assert sorted(r.value for r in domains.collect()) == ["x", "y"]
    assert sorted(r.value for r in V.update_domains(domains, b).collect()) == ["x", "y", "z"]
    bad = V.domain_violations(b, domains).first()
    assert (bad.column, bad.n_bad, bad.n_rows) == ("c", 1, 2)
    assert (u["v"].min, u["v"].max) == (0.5, 5.0)
    rules = V.baseline_rules(s, [("v", "max_value", 10.0)])
    assert ("v", "max_value", 10.0) in rules and ("v", "max_value", 2.0) not in rules


def test_drift(spark):
    a = spark.createDataFrame([("x",), ("x",), ("y",)], "c string")
    b = spark.createDataFrame([("x",), ("z",)], "c string")
    assert V.categorical_drift(a, b, "c").first().linf_distance == pytest.approx(0.5)
    n = spark.createDataFrame([(float(i),) for i in range(10)], "v double")
    assert V.numeric_drift(n, n, "v").first().js_divergence == pytest.approx(0.0)


def test_wide_domains_and_domain_rules(spark):
    df = spark.range(200).select(F.concat(F.lit("v"), "id").alias("c"), (F.col("id") / 10.0).alias("x"))
    assert V.infer_domains(df).count() == 200  # no cap
    got = {(r.column, r.rule): r.n_bad for r in V.validate(df, [("c", "domain", ["v1", "v2"])]).collect()}
    got |= {("x", "domain"): V.validate(df, [("x", "domain", (1.0, None))]).first().n_bad}
    assert got == {("c", "domain"): 198, ("x", "domain"): 10}
    stats = {r.column: r for r in V.column_statistics(df, ["c"]).collect()}
    assert stats["c"].n_distinct == 200 and stats["x"].n_zero == 1
    q = {r.q: r.value for r in V.quantile_sketch(df, ["x"]).collect()}
    assert (q[0.0], q[1.0]) == (0.0, 19.9) and abs(q[0.5] - 9.95) < 0.1
