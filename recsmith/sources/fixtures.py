"""Map the given star-schema test tables onto users / items / interactions.

The Spark side is a plain DataFrame plan over the parquet tables, so every
query built on it grows with the tables.  ``ORACLE_CTES`` is the same
mapping written for DuckDB, used as the prefix of every oracle query.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values of the mapping (must equal the oracle text below).
AGE_GROUPS = ["18-24", "25-34", "35-44", "45-54", "55-64", "65+"]
INTERACTION_TYPES = ["view", "like", "watch", "purchase", "share"]
TIER1_GENRES = ["ECONOMY", "STANDARD", "PROMO"]
TIER2_GENRES = ["SMALL", "LARGE"]


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _pick(index: Column, values: list[str]) -> Column:
    expr = None
    for i, v in enumerate(values):
        expr = F.when(index == i, F.lit(v)) if expr is None else expr.when(index == i, F.lit(v))
    return expr


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read_table(spark, sf_dir, "customer")
    n = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    key = F.col("c_custkey")
    t1 = _pick(key % 3, TIER1_GENRES)
    t2 = _pick(key % 2, TIER2_GENRES)
    genres = F.when(F.col("c_mktsegment").isin("MACHINERY", "BUILDING"),
                    F.concat(F.lit('["'), t1, F.lit('","'), t2, F.lit('"]'))) \
              .otherwise(F.concat(F.lit('["'), t1, F.lit('"]')))
    bal = F.col("c_acctbal")
    return (c.join(n, c.c_nationkey == n.n_nationkey)
             .select(key.alias("user_id"),
                     _pick(key % 6, AGE_GROUPS).alias("age_group"),
                     F.when(key % 25 < 12, "M").when(key % 25 < 24, "F").otherwise("Other").alias("gender"),
                     F.col("n_name").alias("location"),
                     genres.alias("preferred_genres"),
                     F.when(bal < 0, "low").when(bal < 5000, "medium").otherwise("high").alias("activity_level"),
                     F.when(bal >= 5000, "premium").otherwise("free").alias("subscription_type")))


def items(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = read_table(spark, sf_dir, "part")
    return p.select(F.col("p_partkey").alias("item_id"),
                    F.col("p_name").alias("title"),
                    F.col("p_type").alias("genre"),
                    (F.col("p_size").cast("double") / F.lit(50.0)).alias("popularity_score"),
                    ((F.col("p_retailprice") - F.lit(900.0)) / F.lit(100.0)).alias("quality_score"),
                    F.col("p_retailprice").alias("price"),
                    F.col("p_brand").alias("language"))


def interactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return interactions_of(read_table(spark, sf_dir, "lineitem"), read_table(spark, sf_dir, "orders"))


def interactions_of(lineitem: DataFrame, orders: DataFrame) -> DataFrame:
    """The mapping alone: ``lineitem`` may be a stream."""
    li = lineitem.select("l_orderkey", "l_partkey", "l_linenumber", "l_quantity")
    o = orders.select("o_orderkey", "o_custkey", "o_orderdate")
    hr = ((F.col("l_partkey") * 7 + F.col("l_linenumber")) % 24).cast("int")
    return (li.join(o, li.l_orderkey == o.o_orderkey)
              .select(F.col("o_custkey").alias("user_id"),
                      F.col("l_partkey").alias("item_id"),
                      _pick(F.col("l_linenumber") % 5, INTERACTION_TYPES).alias("interaction_type"),
                      (F.lit(1.0) + F.col("l_quantity") % 5).alias("rating"),
                      (F.col("o_orderdate") + F.make_interval(hours=hr)).alias("timestamp"),
                      F.col("l_orderkey").alias("session_id"),
                      F.col("l_linenumber").alias("line_number")))


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The event stream table, with event time as a zone-aware timestamp."""
    return read_table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))


def tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {"users": users(spark, sf_dir), "items": items(spark, sf_dir),
            "interactions": interactions(spark, sf_dir)}


# DuckDB text of the same mapping; prefix of every oracle query.
ORACLE_CTES = """
users AS (
  SELECT c_custkey AS user_id,
    CASE c_custkey % 6 WHEN 0 THEN '18-24' WHEN 1 THEN '25-34' WHEN 2 THEN '35-44'
      WHEN 3 THEN '45-54' WHEN 4 THEN '55-64' ELSE '65+' END AS age_group,
    CASE WHEN c_custkey % 25 < 12 THEN 'M' WHEN c_custkey % 25 < 24 THEN 'F' ELSE 'Other' END AS gender,
    n_name AS location,
    CASE WHEN c_mktsegment IN ('MACHINERY','BUILDING') THEN concat('["',t1,'","',t2,'"]')
      ELSE concat('["',t1,'"]') END AS preferred_genres,
    CASE WHEN c_acctbal < 0 THEN 'low' WHEN c_acctbal < 5000 THEN 'medium' ELSE 'high' END AS activity_level,
    CASE WHEN c_acctbal >= 5000 THEN 'premium' ELSE 'free' END AS subscription_type
  FROM (SELECT *, CASE c_custkey % 3 WHEN 0 THEN 'ECONOMY' WHEN 1 THEN 'STANDARD' ELSE 'PROMO' END AS t1,
               CASE c_custkey % 2 WHEN 0 THEN 'SMALL' ELSE 'LARGE' END AS t2 FROM customer) c
  JOIN nation ON c_nationkey = n_nationkey),
items AS (
  SELECT p_partkey AS item_id, p_name AS title, p_type AS genre,
    CAST(p_size AS DOUBLE) / CAST(50 AS DOUBLE) AS popularity_score,
    (p_retailprice - 900.0) / 100.0 AS quality_score,
    p_retailprice AS price, p_brand AS language
  FROM part),
interactions AS (
  SELECT o_custkey AS user_id, l_partkey AS item_id,
    CASE l_linenumber % 5 WHEN 0 THEN 'view' WHEN 1 THEN 'like' WHEN 2 THEN 'watch'
      WHEN 3 THEN 'purchase' ELSE 'share' END AS interaction_type,
    1.0 + l_quantity % 5 AS rating,
    o_orderdate + to_hours(CAST((l_partkey * 7 + l_linenumber) % 24 AS INTEGER)) AS "timestamp",
    l_orderkey AS session_id, l_linenumber AS line_number
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""


def oracle(body: str, extra_ctes: str = "") -> str:
    """Oracle query = fixture CTEs + optional extra CTEs + final SELECT."""
    ctes = ORACLE_CTES + ((",\n" + extra_ctes.strip().rstrip(",")) if extra_ctes.strip() else "")
    return f"WITH {ctes}\n{body.strip()}"
