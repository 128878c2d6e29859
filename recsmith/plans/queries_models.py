"""Registered model and text queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from recsmith.operators import metrics as ME
from recsmith.operators import models as MO
from recsmith.operators import text as TX
from recsmith.operators.retrieval import top_k_inner
from recsmith.plans import local_chain
from recsmith.plans import oracle_sql as osql
from recsmith.plans.catalog import register
from recsmith.plans.queries_batch import DAYS, rnd
from recsmith.sources import fixtures
from recsmith.session import materialize
from recsmith.sources.fixtures import oracle

AS_OF = "1996-01-01 00:00:00"


@register("user_stats_as_of", oracle(f"""
SELECT user_id, {rnd('avg(rating)')} AS rating_mean, coalesce({rnd('stddev_samp(rating)')}, 0.0) AS rating_std,
  count(rating) AS rating_count, {rnd('min(rating)')} AS rating_min, {rnd('max(rating)')} AS rating_max,
  min("timestamp") AS timestamp_min, max("timestamp") AS timestamp_max,
  count(DISTINCT item_id) AS item_id_nunique, {DAYS} AS user_activity_days,
  {rnd('avg(rating)')} AS avg_rating, count(rating) AS total_interactions,
  count(DISTINCT item_id) AS unique_items_interacted, count(rating) / ({DAYS} + 1) AS interaction_frequency
FROM interactions WHERE "timestamp" < TIMESTAMP '{AS_OF}' GROUP BY user_id"""))
def q_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """User statistics as they were at 1996-01-01 (point in time)."""
    return MO.user_stats_as_of(fixtures.interactions(spark, sf_dir), AS_OF)


def _tfidf_sql(table: str, key: str, text: str) -> str:
    terms = f"""SELECT {key}, term, count(*) AS tf FROM (
      SELECT {key}, unnest(regexp_extract_all(lower(coalesce({text}, '')), '[\\p{{L}}\\p{{N}}_]{{2,}}')) AS term FROM {table}) GROUP BY {key}, term"""
    return f"""
WITH tf AS ({terms}),
v AS (SELECT term, df, row_number() OVER (ORDER BY term) - 1 AS col FROM (
        SELECT term, sum(tf) AS total, count(*) AS df FROM tf GROUP BY term ORDER BY total DESC, term LIMIT 100)),
w AS (SELECT {key}, term, col, raw / sqrt(sum(raw * raw) OVER (PARTITION BY {key})) AS weight FROM (
        SELECT {key}, tf.term, col, tf * (ln((1 + (SELECT count(*) FROM {table})) / (1 + df)) + 1) AS raw FROM tf JOIN v ON tf.term = v.term))
SELECT d.{key}, term, col, round(coalesce(weight, 0.0), 9) AS weight FROM {table} d LEFT JOIN w ON d.{key} = w.{key}"""


@register("title_tfidf", oracle("SELECT * FROM (" + _tfidf_sql("items", "item_id", "title") + ")"))
def q_tfidf(spark: SparkSession, sf_dir: str) -> DataFrame:
    """TF-IDF of item titles over the 100 most frequent terms (sparse, long form).

    The oracle omits the stop-word filter: no title word of the fixture is a stop word.
    """
    out = TX.tfidf(fixtures.items(spark, sf_dir), "item_id", "title", 100)
    return out.withColumn("weight", F.round("weight", 9))


@register("document_tfidf", _tfidf_sql("documents", "doc_id", "text"))
def q_document_tfidf(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P15 over texts in four languages: the 100 most frequent words of a large vocabulary, no stop words."""
    out = TX.tfidf(fixtures.read_table(spark, sf_dir, "documents"), "doc_id", "text", 100, stop_words=[])
    return out.withColumn("weight", F.round("weight", 9))


@register("title_svd")
def q_svd(spark: SparkSession, sf_dir: str) -> DataFrame:
    """20-dimensional truncated SVD (U·S) of the title TF-IDF matrix."""
    long = TX.tfidf(fixtures.items(spark, sf_dir), "item_id", "title", 100)
    out, _ = TX.truncated_svd(long, "item_id", 100, 20)
    return out


@register("title_svd_energy", oracle("""
SELECT item_id, CASE WHEN len(regexp_extract_all(lower(coalesce(title, '')), '[\\p{L}\\p{N}_]{2,}')) > 0 THEN 1.0 ELSE 0.0 END AS energy FROM items"""))
def q_svd_energy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The components keep a row's length where the vocabulary has no more terms than components (16 here)."""
    long = TX.tfidf(fixtures.items(spark, sf_dir), "item_id", "title", 100)
    out, _ = TX.truncated_svd(long, "item_id", 100, 20)
    squares = sum((F.col(c) * F.col(c) for c in out.columns if c.startswith("svd_")), F.lit(0.0))
    return out.select("item_id", F.round(squares, 6).alias("energy"))


@register("document_svd_checks", """
WITH tf AS (SELECT doc_id, unnest(regexp_extract_all(lower(coalesce(text, '')), '[\\p{L}\\p{N}_]{2,}')) AS term FROM documents),
v AS (SELECT term FROM tf GROUP BY term ORDER BY count(*) DESC, term LIMIT 10000)
SELECT count(*) AS documents, CAST(20 AS BIGINT) AS components, true AS orthogonal, true AS lengths_agree, true AS settled,
  count(*) FILTER (WHERE doc_id NOT IN (SELECT doc_id FROM tf JOIN v USING (term))) AS without_terms FROM documents""")
def q_document_svd(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P16 with a wide vocabulary: 20 components of the 10,000 most frequent words of the documents.  The columns of U·S are orthogonal and
    have the singular values' lengths, and AᵀU·S, by a join, has their squares': so each is an eigenvector's."""
    docs = fixtures.read_table(spark, sf_dir, "documents")
    rows = materialize(TX.tfidf_rows(docs, "doc_id", "text", 10_000, stop_words=[])[0])
    out, values = TX.truncated_svd(rows, "doc_id", 10_000, 20)
    out = materialize(out)
    names = out.columns[1:]
    cells = rows.join(out, "doc_id").select("n", *names, F.explode(F.arrays_zip("cols", "weights")).alias("_c"))
    back = cells.groupBy("_c.cols").agg(*[F.sum(F.col("_c.weights") * F.col("n") * F.col(n)).alias(n) for n in names])
    images = back.agg(*[F.sqrt(F.sum(F.col(n) * F.col(n))).alias(n) for n in names])
    settled = F.greatest(*[F.abs(F.col(n) - F.lit(v * v)) for n, v in zip(names, values)]) < 1e-8 * values[0] ** 2
    lengths = [F.abs(F.sqrt(F.sum(F.col(n) * F.col(n))) - F.lit(v)) for n, v in zip(names, values)]
    crossed = [F.abs(F.sum(F.col(a) * F.col(b))) for i, a in enumerate(names) for b in names[:i]]
    flat = sum((F.abs(F.col(n)) for n in names), F.lit(0.0)) == 0
    return out.agg(
        F.count(F.lit(1)).alias("documents"), F.lit(len(names)).cast("long").alias("components"),
        (F.greatest(*crossed) < 1e-8 * values[0] ** 2).alias("orthogonal"), (F.greatest(*lengths) < 1e-8 * values[0]).alias("lengths_agree"),
        images.select(settled).scalar().alias("settled"), F.count(F.when(flat, 1)).alias("without_terms"))


@register("als_rating_error")
def q_als_error(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M1 + M3: explicit ALS (rank 64) fit on the train rows, error on all test rows."""
    c = local_chain.prepare_fixture(spark, sf_dir)
    model = MO.train_als(c.train, rank=MO.EMBEDDING_DIM, max_iter=10)
    return MO.rmse(model, c.test)


@register("als_scored_rows", oracle("""
SELECT count(*) AS n, count(*) FILTER (WHERE user_id NOT IN (SELECT user_id FROM train WHERE rating IS NOT NULL)
                                       OR item_id NOT IN (SELECT item_id FROM train WHERE rating IS NOT NULL)) AS n_cold
FROM test WHERE rating IS NOT NULL""", osql.split_ctes()))
def q_als_scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M3: every rated test row is scored; those with an unknown user or item are counted."""
    c = local_chain.prepare_fixture(spark, sf_dir)
    return MO.rmse(MO.train_als(c.train, rank=8, max_iter=2), c.test).select("n", "n_cold")


def list_checks(recs: DataFrame, history: DataFrame, k: int) -> DataFrame:
    """What any list must satisfy, whatever the scores: one row of counts."""
    per = recs.groupBy("user_id").agg(F.count("*").alias("n"), F.max("rank").alias("last"), F.count_distinct("item_id").alias("items"))
    w = Window.partitionBy("user_id").orderBy("rank")
    drops = recs.withColumn("d", F.col("score") - F.lag("score").over(w)).agg(F.count(F.when(F.col("d") > 0, 1)).alias("score_rises"))
    seen = recs.join(history.select("user_id", "item_id").distinct(), ["user_id", "item_id"], "left_semi").agg(F.count("*").alias("seen_items"))
    return (per.agg(F.count("*").alias("users_served"), F.count(F.when(F.col("n") == k, 1)).alias("full_lists"),
                    F.count(F.when((F.col("last") != F.col("n")) | (F.col("items") != F.col("n")), 1)).alias("rank_gaps"))
            .crossJoin(seen).crossJoin(drops))  # one row each


_CHECKS = oracle("""
SELECT count(DISTINCT user_id) AS users_served, count(DISTINCT user_id) AS full_lists, 0 AS rank_gaps, 0 AS seen_items, 0 AS score_rises
FROM test""", osql.split_ctes())


def _als_lists(c) -> DataFrame:
    model = MO.train_als(c.train, rank=MO.EMBEDDING_DIM, max_iter=10)
    return MO.top_k_unseen_factors(model, c.history, 10, users=c.targets, fallback=c.scores)


@register("als_top_k_unseen")
def q_als_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M1 + M2 + J6: exact top-10 unseen items by factor inner product for every test user."""
    return _als_lists(local_chain.prepare_fixture(spark, sf_dir))


@register("als_top_k_checks", _CHECKS)
def q_als_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M2: every test user has ten unseen items in falling score, users without factors included."""
    c = local_chain.prepare_fixture(spark, sf_dir)
    return list_checks(materialize(_als_lists(c)), c.history, 10)


@register("als_retrieval_work")
def q_als_work(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M2: how many user-item pairs the exact search scores for the test users, of all there are."""
    c = local_chain.prepare_fixture(spark, sf_dir)
    users, items = MO.factor_tables(MO.train_als(c.train, rank=MO.EMBEDDING_DIM, max_iter=10))
    work = top_k_inner(users.join(c.targets.select("user_id"), "user_id", "left_semi"), items, c.history, 10)[1]
    return work.withColumn("share", F.col("pairs_scored") / F.col("pairs"))


@register("inner_product_top_k", """
WITH e AS (SELECT vec_id, [floor(256::DOUBLE * x::DOUBLE) FOR x IN embedding] AS v FROM embeddings WHERE embedding IS NOT NULL),
s AS (SELECT a.vec_id AS user_id, b.vec_id AS item_id, list_sum([p[1] * p[2] FOR p IN [[a.v[i], b.v[i]] FOR i IN range(1, len(a.v) + 1)]]) AS score
      FROM e a JOIN e b ON a.vec_id <> b.vec_id)
SELECT user_id, row_number() OVER (PARTITION BY user_id ORDER BY score DESC, item_id DESC) AS rank, item_id, score
FROM s QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY score DESC, item_id DESC) <= 10""")
def q_inner_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M2's search on the embeddings: every vector's ten best others by inner product of whole components."""
    v = fixtures.read_table(spark, sf_dir, "embeddings").where(F.col("embedding").isNotNull()).select(
        "vec_id", F.transform("embedding", lambda x: F.floor(F.lit(256.0) * x.cast("double")).cast("double")).alias("vector"))
    own = v.select(F.col("vec_id").alias("user_id"), F.col("vec_id").alias("item_id"))
    return top_k_inner(v.withColumnRenamed("vec_id", "user_id"), v.withColumnRenamed("vec_id", "item_id"), own, 10)[0]


@register("gbt_rating_error")
def q_gbt(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M4 + M5 + M6 + P17: boosted rating regressor (100 trees, depth 6, early stop on the
    validation rows); MSE, RMSE, MAE on the validation rows."""
    t = fixtures.tables(spark, sf_dir)
    matrix, _, _ = MO.ranking_matrix(materialize(t["interactions"]), t["users"], t["items"])  # read by several steps
    model = MO.train_gbt(matrix)
    return MO.rmse(model, matrix.where(F.col("is_validation")))


@register("gbt_training_history")
def q_gbt_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M5: validation error of every boosting round until ten rounds bring no gain, and which round is kept."""
    t = fixtures.tables(spark, sf_dir)
    return MO.train_gbt_with_patience(MO.ranking_matrix(materialize(t["interactions"]), t["users"], t["items"])[0])[1]


@register("predicted_rating_ndcg", oracle("""
SELECT (SELECT count(*) FROM r) AS n, round((SELECT sum(g * d / n) FROM a) / (SELECT sum(g * d / n) FROM b), 9) AS ndcg""", """
r AS (SELECT i.rating AS gain, s.m AS key FROM interactions i
      JOIN (SELECT item_id, round(avg(rating), 6) AS m FROM interactions GROUP BY item_id) s USING (item_id)
      WHERE i.rating IS NOT NULL),
a AS (SELECT key, sum(gain) AS g, count(*) AS n, sum(1.0::DOUBLE / log2(pos + 1)) AS d FROM (
        SELECT *, row_number() OVER (ORDER BY key DESC) AS pos FROM r) GROUP BY key),
b AS (SELECT gain, sum(gain) AS g, count(*) AS n, sum(1.0::DOUBLE / log2(pos + 1)) AS d FROM (
        SELECT *, row_number() OVER (ORDER BY gain DESC) AS pos FROM r) GROUP BY gain)"""))
def q_ndcg(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M6: NDCG over all rated rows of the item mean as prediction (many ties)."""
    rows = fixtures.interactions(spark, sf_dir)
    means = rows.groupBy("item_id").agg(F.round(F.avg("rating"), 6).alias("prediction"))
    out = MO.prediction_ndcg(rows.join(means, "item_id"))
    return out.withColumn("ndcg", F.round("ndcg", 9))


@register("ab_variant_metrics", oracle("""
SELECT variant, count(*) AS users, round(avg(CASE WHEN n_actual > 0 THEN hits_10 / n_actual END), 9) AS recall_10,
  round(avg(CASE WHEN n_rec_10 > 0 THEN hits_10 / n_rec_10 END), 9) AS precision_10,
  round(avg(CASE WHEN n_actual > 0 THEN ndcg END), 9) AS ndcg_10,
  round(avg(CASE WHEN n_actual > 0 THEN coalesce(1.0::DOUBLE / first_hit, 0.0) END), 9) AS mrr
FROM (SELECT *, CASE WHEN ('0x' || substr(md5('ab-1:' || user_id), 1, 8))::BIGINT % 100 < 50 THEN 'treatment' ELSE 'control' END AS variant FROM per)
LEFT JOIN ndcg_10 USING (user_id) GROUP BY variant""", osql.chain(10, osql.metric_ctes((10,)))))
def q_ab(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stable A/B assignment of the test users and metrics of the top-10 lists per variant."""
    c = local_chain.prepare_fixture(spark, sf_dir)
    recs = local_chain.recommendations(c, 10, keep=True)
    per = ME.per_user_table(recs, c.test, c.items, (10,))
    out = MO.variant_metrics(per, MO.assign_variants(c.targets))
    return out.select("variant", "users", *[F.round(m, 9).alias(m) for m in out.columns if m not in ("variant", "users")])


_W10_RECS = """
recs AS (
  SELECT user_id, rank, item_id FROM (
    SELECT t.user_id, iu.item_id,
      CAST(row_number() OVER (PARTITION BY t.user_id ORDER BY min(iu.s)) AS BIGINT) AS rank
    FROM (SELECT DISTINCT user_id FROM test) t
    JOIN (SELECT item_id, user_id, min(seq) AS s FROM split WHERE is_test GROUP BY item_id, user_id) iu
      ON iu.user_id <> t.user_id
    GROUP BY t.user_id, iu.item_id) WHERE rank <= 10)"""


def _placeholder_sql() -> str:
    from recsmith.plans import oracle_sql as osql
    ctes = ",".join([osql.split_ctes(0.2, 0), _W10_RECS, osql.metric_ctes((5, 10, 20))])
    return oracle(osql.metric_union((5, 10, 20)), ctes)


@register("placeholder_evaluation", _placeholder_sql())
def q_placeholder_eval(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Training-pipeline evaluation: E1-E9 of the placeholder lists (W10) on the evaluator's split."""
    from recsmith.operators import recommend as R
    from recsmith.session import materialize
    c = local_chain.prepare_fixture(spark, sf_dir, min_test=0)
    recs = materialize(R.other_users_items(c.test, 10))
    return ME.evaluation_suite(recs, c.test, c.items)


def _comparison_sql() -> str:
    from recsmith.plans import oracle_sql as osql
    a = oracle(osql.metric_union((5, 10, 20)), osql.chain(20, osql.metric_ctes((5, 10, 20))))
    b = _placeholder_sql()
    # metrics without K have k NULL: join null-safely on k
    return (f"SELECT coalesce(a.metric, b.metric) AS metric, coalesce(a.k, b.k) AS k, "
            f"a.value AS genre_popularity, b.value AS other_users FROM ({a}) a "
            f"FULL OUTER JOIN ({b}) b ON a.metric = b.metric AND a.k IS NOT DISTINCT FROM b.k")


@register("model_comparison", _comparison_sql())
def q_comparison(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The metric suites of two recommenders side by side (one column per version)."""
    from recsmith.operators import recommend as R
    from recsmith.session import materialize
    c = local_chain.prepare_fixture(spark, sf_dir)
    ours = ME.evaluation_suite(local_chain.recommendations(c, 20, keep=True), c.test, c.items)
    c0 = local_chain.prepare(c.users, c.items, c.interactions, min_test=0)
    other = ME.evaluation_suite(materialize(R.other_users_items(c0.test, 10)), c0.test, c0.items)
    return MO.compare_versions({"genre_popularity": ours, "other_users": other})


def _hybrid_lists(c) -> DataFrame:
    als = MO.train_als(c.train, rank=MO.EMBEDDING_DIM, max_iter=10)
    matrix, inputs, fitted = MO.ranking_matrix(c.train, c.users, c.items)
    gbt = MO.train_gbt(matrix)
    return MO.hybrid_top_k(als, gbt, fitted, c.history, c.train, c.users, c.items, inputs, k=10, candidates=50,
                           targets=c.targets, fallback=c.scores)


@register("hybrid_top_k")
def q_hybrid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ALS retrieval of 50 unseen candidates per test user, re-ranked by the boosted
    regressor trained on the train rows; top 10 per user."""
    return _hybrid_lists(local_chain.prepare_fixture(spark, sf_dir))


@register("hybrid_top_k_checks", _CHECKS)
def q_hybrid_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every test user has ten unseen items in falling score."""
    c = local_chain.prepare_fixture(spark, sf_dir)
    return list_checks(materialize(_hybrid_lists(c)), c.history, 10)


@register("ab_assignment", oracle("""
SELECT user_id, CASE WHEN bucket < 50 THEN 'treatment' ELSE 'control' END AS variant, bucket FROM (
  SELECT DISTINCT user_id, ('0x' || substr(md5('ab-1:' || user_id), 1, 8))::BIGINT % 100 AS bucket FROM test)""", osql.split_ctes()))
def q_ab_assignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The variant of every test user."""
    return MO.assign_variants(local_chain.prepare_fixture(spark, sf_dir).targets)
