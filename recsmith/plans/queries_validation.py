"""Registered validation queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recsmith.operators import validation as V
from recsmith.plans import local_chain
from recsmith.plans import oracle_sql as osql
from recsmith.plans.catalog import register
from recsmith.sources import fixtures
from recsmith.sources.fixtures import oracle

# Columns of the fixture tables (rules on other columns are skipped, as in Spark).
FIXTURE_COLUMNS = {
    "interactions": ["user_id", "item_id", "interaction_type", "rating", "timestamp", "session_id", "line_number"],
    "users": ["user_id", "age_group", "gender", "location", "preferred_genres", "activity_level",
              "subscription_type"],
    "items": ["item_id", "title", "genre", "popularity_score", "quality_score", "price", "language"],
}


def _bad_sql(col: str, kind: str, param) -> str:
    if kind == "presence_required":
        return f"{col} IS NULL"
    if kind == "allowed_values":
        vals = ", ".join("'" + v + "'" for v in param)
        return f"{col} IS NOT NULL AND CAST({col} AS VARCHAR) NOT IN ({vals})"
    if kind == "min_value":
        return f"{col} IS NOT NULL AND CAST({col} AS DOUBLE) < {float(param)}"
    if kind == "max_value":
        return f"{col} IS NOT NULL AND CAST({col} AS DOUBLE) > {float(param)}"
    raise ValueError(kind)


def _validate_sql_body(dataset: str) -> str:
    parts = []
    for col, kind, param in V.PRESETS[dataset]:
        if col not in FIXTURE_COLUMNS[dataset]:
            continue
        parts.append(f"""SELECT '{col}' AS "column", '{kind}' AS rule,
  count(*) FILTER (WHERE {_bad_sql(col, kind, param)}) AS n_bad, count(*) AS n_rows,
  coalesce(count(*) FILTER (WHERE {_bad_sql(col, kind, param)}) / nullif(count(*), 0), 0.0) AS fraction
FROM {dataset}""")
    return "\nUNION ALL\n".join(parts)


def _validate_sql(dataset: str) -> str:
    return oracle(_validate_sql_body(dataset))


def _register_preset(dataset: str):
    @register(f"validate_{dataset}", _validate_sql(dataset))
    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        return V.validate_preset(fixtures.tables(spark, sf_dir)[dataset], dataset)
    q.__doc__ = f"V3 + V6 with the reference's {dataset} rules: rows failing each rule."
    return q


for _ds in ("interactions", "users", "items"):
    _register_preset(_ds)


_REPORT_SQL = oracle(f"""
SELECT dataset, count(*) AS n_rules, count(*) FILTER (WHERE n_bad > 0) AS n_anomalies,
  list_sort(coalesce(list("column" || ':' || rule) FILTER (WHERE n_bad > 0), [])) AS anomalies,
  count(*) FILTER (WHERE n_bad > 0) = 0 AS is_valid
FROM (SELECT 'interactions' AS dataset, * FROM ({_validate_sql_body("interactions")})
      UNION ALL SELECT 'users', * FROM ({_validate_sql_body("users")})
      UNION ALL SELECT 'items', * FROM ({_validate_sql_body("items")}))
GROUP BY dataset""")


@register("validation_report", _REPORT_SQL)
def q_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-dataset rule and anomaly counts with the failing rules."""
    t = fixtures.tables(spark, sf_dir)
    return V.validation_report({d: V.validate_preset(t[d], d) for d in ("interactions", "users", "items")})


def _stats_sql() -> str:
    dtypes = {"item_id": "bigint", "title": "string", "genre": "string", "popularity_score": "double",
              "quality_score": "double", "price": "double", "language": "string"}
    parts = []
    for c, t in dtypes.items():
        num = t != "string"
        parts.append(f"""SELECT (SELECT count(*) FROM items) AS n_rows, '{c}' AS "column", '{t}' AS dtype,
  count(*) - count({c}) AS n_null, count(DISTINCT {c}) AS n_distinct,
  {f"CAST(min({c}) AS DOUBLE)" if num else "CAST(NULL AS DOUBLE)"} AS min,
  {f"CAST(max({c}) AS DOUBLE)" if num else "CAST(NULL AS DOUBLE)"} AS max,
  {f"round(avg({c}), 9)" if num else "CAST(NULL AS DOUBLE)"} AS mean,
  {f"round(stddev_pop({c}), 9)" if num else "CAST(NULL AS DOUBLE)"} AS std,
  {f"count(*) FILTER (WHERE {c} = 0)" if num else "CAST(NULL AS BIGINT)"} AS n_zero,
  {"CAST(NULL AS BIGINT)" if num else f"CAST(min(length({c})) AS BIGINT)"} AS min_length,
  {"CAST(NULL AS BIGINT)" if num else f"CAST(max(length({c})) AS BIGINT)"} AS max_length
FROM items""")
    return oracle("\nUNION ALL\n".join(parts))


@register("item_column_statistics", _stats_sql())
def q_column_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V1: per-column statistics of the catalogue, distinct counts exact."""
    items = fixtures.tables(spark, sf_dir)["items"]
    out = V.column_statistics(items, exact_distinct=items.columns)
    return out.withColumn("mean", F.round("mean", 9)).withColumn("std", F.round("std", 9))


@register("quarantined_items", oracle(f"""
SELECT * FROM items WHERE {" OR ".join("(" + _bad_sql(c, k, p) + ")" for c, k, p in V.ITEM_RULES
                                        if c in FIXTURE_COLUMNS["items"])}"""))
def q_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V11 row level: catalogue rows that break any item rule."""
    items = fixtures.tables(spark, sf_dir)["items"]
    return V.quarantine(items, V.ITEM_RULES)[1]


_DRIFT_CAT_SQL = oracle("""
SELECT 'interaction_type' AS "column", round(max(abs(coalesce(b.p, 0.0) - coalesce(c.p, 0.0))), 9) AS linf_distance
FROM (SELECT interaction_type, count(*) / sum(count(*)) OVER () AS p FROM train
      WHERE interaction_type IS NOT NULL GROUP BY interaction_type) b
FULL OUTER JOIN (SELECT interaction_type, count(*) / sum(count(*)) OVER () AS p FROM test
      WHERE interaction_type IS NOT NULL GROUP BY interaction_type) c USING (interaction_type)""",
                        osql.split_ctes())


@register("interaction_type_drift", _DRIFT_CAT_SQL)
def q_drift_cat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V12 categorical: L-infinity distance of interaction-type shares, train vs test."""
    c = local_chain.prepare_fixture(spark, sf_dir)
    out = V.categorical_drift(c.train, c.test, "interaction_type")
    return out.withColumn("linf_distance", F.round("linf_distance", 9))


_DRIFT_NUM_SQL = oracle("""
SELECT 'rating' AS "column", round(sum(CASE WHEN p > 0 THEN p * log2(p / ((p + q) / 2)) ELSE 0.0 END) * 0.5
                                + sum(CASE WHEN q > 0 THEN q * log2(q / ((p + q) / 2)) ELSE 0.0 END) * 0.5, 9)
       AS js_divergence
FROM (SELECT coalesce(b.p, 0.0) AS p, coalesce(c.q, 0.0) AS q FROM
  (SELECT bin, count(*) / sum(count(*)) OVER () AS p FROM (SELECT CAST(CASE WHEN hi = lo THEN 0
     ELSE least(floor((CAST(rating AS DOUBLE) - lo) / (hi - lo) * 10), 9) END AS INTEGER) AS bin
     FROM train, rng WHERE rating IS NOT NULL) GROUP BY bin) b
  FULL OUTER JOIN
  (SELECT bin, count(*) / sum(count(*)) OVER () AS q FROM (SELECT CAST(CASE WHEN hi = lo THEN 0
     ELSE least(floor((CAST(rating AS DOUBLE) - lo) / (hi - lo) * 10), 9) END AS INTEGER) AS bin
     FROM test, rng WHERE rating IS NOT NULL) GROUP BY bin) c USING (bin))""",
                        osql.split_ctes() + """,
rng AS (SELECT CAST(min(rating) AS DOUBLE) AS lo, CAST(max(rating) AS DOUBLE) AS hi FROM interactions)""")


@register("rating_drift", _DRIFT_NUM_SQL)
def q_drift_num(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V12 numeric: Jensen-Shannon divergence of rating histograms, train vs test."""
    c = local_chain.prepare_fixture(spark, sf_dir)
    out = V.numeric_drift(c.train, c.test, "rating")
    return out.withColumn("js_divergence", F.round("js_divergence", 9))


@register("interaction_top_values", oracle("""
SELECT "column", value, count FROM (
  SELECT 'interaction_type' AS "column", CAST(interaction_type AS VARCHAR) AS value, count(*) AS count,
    row_number() OVER (ORDER BY count(*) DESC, CAST(interaction_type AS VARCHAR)) AS rn
  FROM interactions WHERE interaction_type IS NOT NULL GROUP BY interaction_type
  UNION ALL
  SELECT 'item_id', CAST(item_id AS VARCHAR), count(*),
    row_number() OVER (ORDER BY count(*) DESC, CAST(item_id AS VARCHAR))
  FROM interactions WHERE item_id IS NOT NULL GROUP BY item_id) WHERE rn <= 10"""))
def q_top_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V1: ten most frequent values of two interaction columns (top-k report)."""
    i = fixtures.tables(spark, sf_dir)["interactions"]
    return V.top_values(i, "interaction_type").unionByName(V.top_values(i, "item_id"))


ITEM_TYPES = {"item_id": "bigint", "title": "string", "genre": "string", "popularity_score": "double",
              "quality_score": "double", "price": "double", "language": "string"}
INTERACTION_TYPES = {"user_id": "bigint", "item_id": "bigint", "interaction_type": "string", "rating": "double",
                     "timestamp": "timestamp_ntz", "session_id": "bigint", "line_number": "int"}


def _bounds_sql(types: dict[str, str], table: str) -> list[str]:
    out = []
    for c, t in types.items():
        num = t not in ("string", "timestamp_ntz")
        out.append(f"""SELECT '{c}' AS "column", '{t}' AS dtype, count(*) = count("{c}") AS required,
  {f"CAST(min({c}) AS DOUBLE)" if num else "CAST(NULL AS DOUBLE)"} AS min,
  {f"CAST(max({c}) AS DOUBLE)" if num else "CAST(NULL AS DOUBLE)"} AS max
FROM {table}""")
    return out


@register("inferred_item_schema", oracle("\nUNION ALL\n".join(_bounds_sql(ITEM_TYPES, "items"))))
def q_infer_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V2: schema inferred from the catalogue's statistics."""
    return V.infer_schema(fixtures.tables(spark, sf_dir)["items"])


@register("inferred_item_domains", oracle("\nUNION ALL\n".join(
    f"SELECT DISTINCT '{c}' AS \"column\", {c} AS value FROM items WHERE {c} IS NOT NULL" for c in ("title", "genre", "language"))))
def q_infer_domains(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V2: value sets of the catalogue's string columns, titles included, in long form."""
    return V.infer_domains(fixtures.tables(spark, sf_dir)["items"])


def _widen_sql() -> str:
    parts = [f"""SELECT "column", dtype, bool_and(required) AS required, min(min) AS min, max(max) AS max
FROM ({a} UNION ALL {b}) GROUP BY "column", dtype""" for a, b in zip(_bounds_sql(INTERACTION_TYPES, "train"), _bounds_sql(INTERACTION_TYPES, "test"))]
    return oracle("\nUNION ALL\n".join(parts), osql.split_ctes())


@register("widened_interaction_schema", _widen_sql())
def q_widen_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V4: schema inferred from the train rows, widened by the test rows of the time split."""
    c = local_chain.prepare_fixture(spark, sf_dir)
    return V.update_schema(V.infer_schema(c.train), c.test)


@register("item_histograms", oracle("\nUNION ALL\n".join(f"""
SELECT '{c}' AS "column", CAST(least(floor((CAST({c} AS DOUBLE) - lo) / (hi - lo) * 10), 9) AS INTEGER) AS bin, count(*) AS n
FROM items, (SELECT CAST(min({c}) AS DOUBLE) AS lo, CAST(max({c}) AS DOUBLE) AS hi FROM items) GROUP BY 1, 2"""
                                                          for c in ("price", "popularity_score"))))
def q_histograms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V1: equal-width histograms of two catalogue columns."""
    return V.numeric_histogram(fixtures.tables(spark, sf_dir)["items"], ["price", "popularity_score"])


# ---- data with known faults --------------------------------------------------
# Deterministic expressions on the given rows, the same in both engines; one broken rule of each kind.

_FAULTY = """
faulty AS (SELECT CASE WHEN session_id % 11 <> 0 THEN user_id END AS user_id, item_id,
  CASE WHEN item_id % 13 = 0 THEN 'skip' WHEN item_id % 17 <> 0 THEN interaction_type END AS interaction_type,
  CASE WHEN line_number = 3 THEN 0.5 WHEN line_number = 5 THEN 7.0 ELSE rating END AS rating,
  CASE WHEN user_id % 19 = 0 THEN 'tv' ELSE 'mobile' END AS device_type, line_number FROM interactions)"""

FAULT_RULES = [*V.INTERACTION_RULES, ("device_type", "domain", ["mobile", "desktop", "tablet"]), ("line_number", "domain", (1.0, 6.0))]


def _faulty(spark: SparkSession, sf_dir: str) -> DataFrame:
    line, item = F.col("line_number"), F.col("item_id")
    return fixtures.interactions(spark, sf_dir).select(
        F.when(F.col("session_id") % 11 != 0, F.col("user_id")).alias("user_id"), "item_id",
        F.when(item % 13 == 0, "skip").when(item % 17 != 0, F.col("interaction_type")).alias("interaction_type"),
        F.when(line == 3, 0.5).when(line == 5, 7.0).otherwise(F.col("rating")).alias("rating"),
        F.when(F.col("user_id") % 19 == 0, "tv").otherwise("mobile").alias("device_type"), "line_number")


def _fault_sql(rule) -> str:
    col, kind, param = rule
    if kind == "domain":
        return (f"{col} IS NOT NULL AND ({col} < {param[0]} OR {col} > {param[1]})" if isinstance(param, tuple)
                else _bad_sql(col, "allowed_values", param))
    return _bad_sql(col, kind, param)


@register("validate_faulty_interactions", oracle("\nUNION ALL\n".join(f"""SELECT '{r[0]}' AS "column", '{r[1]}' AS rule,
  count(*) FILTER (WHERE {_fault_sql(r)}) AS n_bad, count(*) AS n_rows, count(*) FILTER (WHERE {_fault_sql(r)}) / count(*) AS fraction
FROM faulty""" for r in FAULT_RULES), _FAULTY))
def q_faulty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V3 + V6 + V7 on rows with known faults: every rule kind fails somewhere."""
    return V.validate(_faulty(spark, sf_dir), FAULT_RULES)


@register("quarantined_faulty_interactions", oracle(
    "SELECT * FROM faulty WHERE " + " OR ".join(f"coalesce({_fault_sql(r)}, false)" for r in FAULT_RULES), _FAULTY))
def q_quarantine_faulty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V11 row level on rows with known faults."""
    return V.quarantine(_faulty(spark, sf_dir), FAULT_RULES)[1]


@register("faulty_report", oracle(f"""
SELECT 'faulty' AS dataset, count(*) AS n_rules, count(*) FILTER (WHERE bad) AS n_anomalies,
  list_sort(list(name) FILTER (WHERE bad)) AS anomalies, false AS is_valid
FROM ({" UNION ALL ".join(f"SELECT '{r[0]}:{r[1]}' AS name, count(*) FILTER (WHERE {_fault_sql(r)}) > 0 AS bad FROM faulty" for r in FAULT_RULES)})""",
                                  _FAULTY))
def q_faulty_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V10 with anomalies."""
    return V.validation_report({"faulty": V.validate(_faulty(spark, sf_dir), FAULT_RULES)})


@register("baseline_rule_check", oracle(f"""
SELECT 'rating' AS "column", 'max_value' AS rule, count(*) FILTER (WHERE rating > 4.0) AS n_bad FROM test
UNION ALL SELECT 'rating', 'min_value', count(*) FILTER (WHERE rating < (SELECT min(rating) FROM train)) FROM test
UNION ALL SELECT 'line_number', 'max_value', count(*) FILTER (WHERE line_number > (SELECT max(line_number) FROM train)) FROM test
UNION ALL SELECT 'user_id', 'presence_required', count(*) FILTER (WHERE user_id IS NULL) FROM test""", osql.split_ctes()))
def q_baseline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V5: rules of the train rows' schema with a tighter rating bound, checked on the test rows."""
    c = local_chain.prepare_fixture(spark, sf_dir)
    rules = V.baseline_rules(V.infer_schema(c.train), [("rating", "max_value", 4.0)])
    wanted = {("rating", "max_value"), ("rating", "min_value"), ("line_number", "max_value"), ("user_id", "presence_required")}
    return V.validate(c.test, [r for r in rules if (r[0], r[1]) in wanted]).select("column", "rule", "n_bad")


@register("domain_violations", oracle("""
SELECT 'interaction_type' AS "column", 'domain' AS rule,
  count(*) FILTER (WHERE interaction_type IS NOT NULL AND interaction_type NOT IN (SELECT interaction_type FROM interactions)) AS n_bad,
  count(*) AS n_rows FROM faulty""", _FAULTY))
def q_domain_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V3 against an inferred value set: the faulty rows' types, checked with the domain of the given rows."""
    known = V.infer_domains(fixtures.interactions(spark, sf_dir))
    return V.domain_violations(_faulty(spark, sf_dir), known).select("column", "rule", "n_bad", "n_rows")
