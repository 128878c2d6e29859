"""DuckDB oracle text for the registered queries.

Each oracle is written independently of the Spark code, as plain SQL over the
pre-registered test tables (fixture mapping in ``sources.fixtures``).  The
top-K oracle is the brute-force user x catalogue form.
"""

from __future__ import annotations

from recsmith.sources.fixtures import oracle

SPLIT_ORDER = '"timestamp" NULLS LAST, user_id, item_id, interaction_type, rating, session_id, line_number'


def split_ctes(test_ratio: float = 0.2, min_test: int = 1) -> str:
    return f"""
ranked AS (
  SELECT *, row_number() OVER (ORDER BY {SPLIT_ORDER}) - 1 AS seq, count(*) OVER () AS n_rows
  FROM interactions),
split AS (
  SELECT *, seq >= n_rows - least(greatest(floor(n_rows * CAST({test_ratio} AS DOUBLE)), {min_test}), n_rows)
         AS is_test
  FROM ranked),
train AS (SELECT user_id, item_id, interaction_type, rating, "timestamp", session_id, line_number
          FROM split WHERE NOT is_test),
test AS (SELECT user_id, item_id, interaction_type, rating, "timestamp", session_id, line_number
         FROM split WHERE is_test)"""


BASE_CTES = """
cnt AS (SELECT item_id, count(rating) AS n_interactions FROM train WHERE rating IS NOT NULL GROUP BY item_id),
base AS (
  SELECT i.item_id, i.genre,
    coalesce(CAST(coalesce(c.n_interactions, 0) AS DOUBLE) / CAST((SELECT max(n_interactions) FROM cnt) AS DOUBLE), 0.0)
      * CAST(0.5 AS DOUBLE)
    + coalesce(i.popularity_score, 0.0) * CAST(0.3 AS DOUBLE)
    + coalesce(i.quality_score, 0.0) * CAST(0.2 AS DOUBLE) AS base_score
  FROM items i LEFT JOIN cnt c USING (item_id))"""


def topk_ctes(k: int) -> str:
    return f"""
hist AS (SELECT DISTINCT user_id, item_id FROM train),
targets AS (SELECT DISTINCT user_id FROM test),
prefs AS (SELECT t.user_id, json_extract_string(u.preferred_genres, '$[*]') AS pref
          FROM targets t LEFT JOIN users u USING (user_id)),
cand AS (
  SELECT p.user_id, b.item_id,
    CASE WHEN coalesce(list_contains(p.pref, b.genre), false) THEN b.base_score + CAST(0.3 AS DOUBLE)
         ELSE b.base_score END AS score
  FROM prefs p CROSS JOIN base b
  WHERE NOT EXISTS (SELECT 1 FROM hist h WHERE h.user_id = p.user_id AND h.item_id = b.item_id)),
recs AS (
  SELECT user_id, rank, item_id, score FROM (
    SELECT user_id, item_id, score,
      CAST(row_number() OVER (PARTITION BY user_id ORDER BY score DESC, item_id DESC) AS BIGINT) AS rank
    FROM cand) WHERE rank <= {k})"""


def chain(k: int, extra: str = "") -> str:
    """CTEs for split + base + top-K (+ extra), as one WITH list."""
    parts = [split_ctes(), BASE_CTES, topk_ctes(k)]
    if extra:
        parts.append(extra)
    return ",".join(parts)


def metric_ctes(ks=(5, 10, 20)) -> str:
    hit_cols = ", ".join(f"count(*) FILTER (WHERE first_rank <= {k}) AS hits_{k}" for k in ks)
    rec_cols = ", ".join(f"count(*) FILTER (WHERE first_rank <= {k}) AS n_rec_{k}" for k in ks)
    hit_sel = ", ".join(f"coalesce(h.hits_{k}, 0) AS hits_{k}" for k in ks)
    ndcg = []
    for k in ks:
        ndcg.append(f"""
gains_{k} AS (
  SELECT r.user_id, r.rank, coalesce(l.rel, 0.0) AS g,
    row_number() OVER (PARTITION BY r.user_id ORDER BY coalesce(l.rel, 0.0) DESC) AS ideal_pos
  FROM recs r LEFT JOIN rel l USING (user_id, item_id)
  WHERE r.rank <= {k} AND r.user_id IN (SELECT user_id FROM actual)),
ndcg_{k} AS (
  SELECT user_id, CASE WHEN sum(g / log2(ideal_pos + 1)) > 0
                       THEN sum(g / log2(rank + 1)) / sum(g / log2(ideal_pos + 1)) ELSE 0.0 END AS ndcg
  FROM gains_{k} GROUP BY user_id)""")
    return f"""
first_pos AS (SELECT user_id, item_id, min(rank) AS first_rank FROM recs GROUP BY user_id, item_id),
actual AS (SELECT DISTINCT user_id, item_id FROM test),
n_act AS (SELECT user_id, count(*) AS n_actual FROM actual GROUP BY user_id),
hits AS (SELECT f.user_id, {hit_cols}, min(first_rank) AS first_hit
         FROM first_pos f JOIN actual a USING (user_id, item_id) GROUP BY f.user_id),
per_rec AS (SELECT user_id, {rec_cols} FROM first_pos GROUP BY user_id),
per AS (SELECT p.*, coalesce(n.n_actual, 0) AS n_actual, {hit_sel}, h.first_hit
        FROM per_rec p LEFT JOIN n_act n USING (user_id) LEFT JOIN hits h USING (user_id)),
rel AS (
  SELECT user_id, item_id, rating AS rel FROM (
    SELECT user_id, item_id, rating, row_number() OVER (
      PARTITION BY user_id, item_id
      ORDER BY ("timestamp" IS NULL) DESC, "timestamp" DESC, interaction_type DESC, rating DESC,
               session_id DESC, line_number DESC) AS rn
    FROM test) WHERE rn = 1),
list_genres AS (SELECT r.user_id, r.item_id, i.genre FROM recs r LEFT JOIN items i USING (item_id)),
item_counts AS (SELECT item_id, count(*) AS n FROM test GROUP BY item_id),{",".join(ndcg)}"""


def metric_union(ks=(5, 10, 20)) -> str:
    rows = []
    for k in ks:
        rows.append(f"SELECT 'recall' AS metric, CAST({k} AS BIGINT) AS k, "
                    f"coalesce(avg(hits_{k} / n_actual), 0.0) AS value FROM per WHERE n_actual > 0")
        rows.append(f"SELECT 'precision', CAST({k} AS BIGINT), "
                    f"coalesce(avg(hits_{k} / n_rec_{k}), 0.0) FROM per WHERE n_rec_{k} > 0")
        rows.append(f"SELECT 'ndcg', CAST({k} AS BIGINT), coalesce(avg(ndcg), 0.0) FROM ndcg_{k}")
    rows += [
        "SELECT 'mrr', CAST(NULL AS BIGINT), coalesce(avg(coalesce(CAST(1.0 AS DOUBLE) / first_hit, 0.0)), 0.0) "
        "FROM per WHERE n_actual > 0",
        "SELECT 'coverage', CAST(NULL AS BIGINT), "
        "coalesce(CAST(count(DISTINCT item_id) AS DOUBLE) / (SELECT count(*) FROM items), 0.0) FROM recs",
        "SELECT 'genre_redundancy', CAST(NULL AS BIGINT), coalesce(avg(1.0 - g / n), 0.0) FROM ("
        "SELECT user_id, count(*) AS n, count(DISTINCT coalesce(genre, 'Unknown')) AS g "
        "FROM list_genres GROUP BY user_id) WHERE n > 1",
        "SELECT 'diversity', CAST(NULL AS BIGINT), coalesce(avg(g / n), 0.0) FROM ("
        "SELECT user_id, count(*) AS n, count(DISTINCT CASE WHEN genre <> '' THEN genre END) AS g "
        "FROM list_genres GROUP BY user_id)",
        "SELECT 'novelty', CAST(NULL AS BIGINT), "
        "coalesce(avg(1.0 - coalesce(c.n, 0) / (SELECT max(n) FROM item_counts)), 0.0) "
        "FROM recs r LEFT JOIN item_counts c USING (item_id)",
    ]
    return "SELECT metric, k, round(value, 10) AS value FROM (\n" + "\nUNION ALL\n".join(rows) + ")"


def flagship_sql(k: int = 10) -> str:
    return oracle("SELECT user_id, rank, item_id, score FROM recs", chain(k))


def split_test_sql() -> str:
    return oracle('SELECT user_id, item_id, interaction_type, rating, "timestamp", session_id, line_number FROM test',
                  split_ctes())


def base_scores_sql() -> str:
    return oracle("SELECT item_id, genre, base_score FROM base", split_ctes() + "," + BASE_CTES)


def evaluation_sql(k: int = 20, ks=(5, 10, 20)) -> str:
    return oracle(metric_union(ks), chain(k, metric_ctes(ks)))
