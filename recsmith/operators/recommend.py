"""Scoring and top-K recommendation.

``top_k_unseen`` never forms the user x catalogue product, nor users x genres.  The genre bonus is
the same for every item of a genre, so all users that prefer a genre see its items in one fixed order
(base + bonus).  Of the other genres a user can only get items that are high in the one global order by
base score: an unseen item there beats every unseen item below it.  So a user's best ``k`` are among the first
``k + seen in the genre`` items of each preferred genre and the first ``k + seen at all`` of the global list.
Work is O(users * (preferences + 1) * k + history) instead of O(users * items).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from recsmith.functions.columns import parse_genres
from recsmith.operators.split import with_global_index
from recsmith.session import materialize, shuffle_partitions

# Fixed values of the local scorer: weights of the base score and the bonus.
BASE_WEIGHT_INTERACTIONS = 0.5
BASE_WEIGHT_POPULARITY = 0.3
BASE_WEIGHT_QUALITY = 0.2
GENRE_BONUS = 0.3

# Ranked lists are cut into blocks of so many positions: a user joins the blocks it can reach.
LIST_BLOCK = 64


def base_scores(items: DataFrame, train: DataFrame, rating_col: str = "rating") -> DataFrame:
    """``0.5 * n/max(n) + 0.3 * popularity + 0.2 * quality`` for every catalogue item.

    ``n`` counts non-null ratings of the item in ``train`` (A9); items never seen get 0.
    ``max(n)`` is a scalar subquery, so nothing passes through the driver.
    """
    counts = (train.where(F.col(rating_col).isNotNull())
                   .groupBy("item_id").agg(F.count(rating_col).alias("n_interactions")))
    max_n = counts.select(F.max("n_interactions")).scalar()
    ratio = F.coalesce(F.try_divide(F.coalesce(F.col("n_interactions"), F.lit(0)).cast("double"),
                                    max_n.cast("double")), F.lit(0.0))
    base = (ratio * F.lit(BASE_WEIGHT_INTERACTIONS)
            + F.coalesce(F.col("popularity_score"), F.lit(0.0)) * F.lit(BASE_WEIGHT_POPULARITY)
            + F.coalesce(F.col("quality_score"), F.lit(0.0)) * F.lit(BASE_WEIGHT_QUALITY))
    return (items.select("item_id", "genre", "popularity_score", "quality_score")
                 .join(counts, "item_id", "left")
                 .select("item_id", "genre", base.alias("base_score")))


def user_history(interactions: DataFrame) -> DataFrame:
    """The (user, item) pairs a user has interacted with, without repeats."""
    return interactions.select("user_id", "item_id").distinct()


def take_from_lists(wants: DataFrame, lists: DataFrame, num_partitions: int, block: int = LIST_BLOCK) -> DataFrame:
    """wants (user_id, list, need, ..) and lists (list, pos from 1, entry struct): each user's first ``need`` entries.

    Lists are cut into blocks, so a deep reach is a few block numbers, not an array of positions.  The first
    blocks are wanted by nearly every user: they are replicated by a salt (half as often with each further
    block), so no join key holds all users.  Only positions that some user reaches are kept.
    """
    def salts(number):
        return F.greatest(F.floor(F.lit(num_partitions) / F.pow(F.lit(2.0), number)).cast("int"), F.lit(1))

    reach = wants.groupBy(F.col("list").alias("_l")).agg(F.max("need").alias("_reach"))
    at = F.floor((F.col("pos") - 1) / block).cast("long")
    blocks = (lists.join(reach, (F.col("list") == F.col("_l")) & (F.col("pos") <= F.col("_reach")))
              .groupBy(F.col("_l").alias("_list"), at.alias("_block"))
              .agg(F.collect_list(F.struct("pos", "entry")).alias("_entries"))
              .withColumn("_salt", F.explode(F.sequence(F.lit(0), salts(F.col("_block")) - 1))))
    last = F.floor((F.col("need") - 1) / block).cast("long")
    asked = (wants.where(F.col("need") > 0).withColumn("_b", F.explode(F.sequence(F.lit(0).cast("long"), last)))
             .withColumn("_s", F.pmod(F.xxhash64("user_id"), salts(F.col("_b"))).cast("int")))
    met = asked.join(blocks, (F.col("list") == F.col("_list")) & (F.col("_b") == F.col("_block")) & (F.col("_s") == F.col("_salt")))
    return (met.withColumn("_e", F.explode("_entries")).where(F.col("_e.pos") <= F.col("need"))
            .select(*wants.columns, F.col("_e.pos").alias("pos"), "_e.entry.*"))


GLOBAL_LIST = ""  # a genre's list is "=" and its name


def _ranked_lists(scored: DataFrame, num_partitions: int | None) -> DataFrame:
    """(list, pos, entry): the catalogue by base score, and each genre by base + bonus; ties by item_id descending.

    All lists are ranked by one range-partitioned global index, so a genre holding a large share of
    the catalogue is spread over many tasks.
    """
    entry = F.struct("item_id", "genre", "score")
    both = (scored.select(F.lit(GLOBAL_LIST).alias("list"), "item_id", "genre", F.col("base_score").alias("score"))
            .unionByName(scored.where(F.col("genre").isNotNull()).select(
                F.concat(F.lit("="), F.col("genre")).alias("list"), "item_id", "genre",
                (F.col("base_score") + F.lit(GENRE_BONUS)).alias("score"))))
    idx = with_global_index(both, [F.col("list").asc(), F.col("score").desc(), F.col("item_id").desc()], "_gidx",
                            num_partitions=num_partitions)
    start = idx.groupBy(F.col("list").alias("_l")).agg(F.min("_gidx").alias("_start"))
    return (idx.join(start, F.col("list") == F.col("_l"))
            .select("list", (F.col("_gidx") - F.col("_start") + 1).alias("pos"), entry.alias("entry")))


def top_k_unseen(users: DataFrame, items: DataFrame, scores: DataFrame, history: DataFrame,
                 targets: DataFrame, k: int = 10, num_partitions: int | None = None) -> DataFrame:
    """For every target user, the ``k`` best items not in the user's history.

    score = base + 0.3 if the item's genre is in the user's ``preferred_genres``;
    order is score desc, then item_id desc.  Returns (user_id, rank, item_id, score).
    ``items`` is accepted for symmetry; genre and base score come from ``scores``.
    An item of a preferred genre is taken from that genre's list only.
    """
    nparts = num_partitions or shuffle_partitions(scores.sparkSession)
    scored = scores.select("item_id", "genre", "base_score")
    asked = targets.select("user_id").distinct()
    # read by several steps below: without copies their plans would run again for each
    hist = materialize(history.select("user_id", "item_id").distinct().join(asked, "user_id", "left_semi"))

    prefs = (asked.join(users.select("user_id", parse_genres("preferred_genres").alias("pref")), "user_id", "left")
             .select("user_id", F.array_distinct(F.coalesce("pref", F.array().cast("array<string>"))).alias("pref")))
    seen = (hist.join(scored.select("item_id", "genre"), "item_id")
                .groupBy("user_id", "genre").agg(F.count(F.lit(1)).alias("n")))
    seen_all = seen.groupBy(F.col("user_id").alias("_u")).agg(F.sum("n").alias("seen"))
    in_genre = seen.where(F.col("genre").isNotNull()).select(F.col("user_id").alias("_u"), F.col("genre").alias("_g"),
                                                             F.col("n").alias("seen"))
    need = (F.lit(k) + F.coalesce("seen", F.lit(0))).cast("long")
    everywhere = (prefs.join(seen_all, F.col("user_id") == F.col("_u"), "left")
                  .select("user_id", "pref", F.lit(GLOBAL_LIST).alias("list"), need.alias("need")))
    preferred = (prefs.select("user_id", "pref", F.explode("pref").alias("genre")).where(F.col("genre").isNotNull())
                 .join(in_genre, (F.col("user_id") == F.col("_u")) & (F.col("genre") == F.col("_g")), "left")
                 .select("user_id", "pref", F.concat(F.lit("="), F.col("genre")).alias("list"), need.alias("need")))
    wants = materialize(everywhere.unionByName(preferred))
    found = take_from_lists(wants, _ranked_lists(scored, nparts), nparts)
    other = F.coalesce(~F.array_contains("pref", F.col("genre")), F.lit(True))
    cands = (found.where((F.col("list") != GLOBAL_LIST) | other)
             .select("user_id", "item_id", "score")
             .join(hist.select(F.col("user_id").alias("_u"), F.col("item_id").alias("_i")),
                   (F.col("user_id") == F.col("_u")) & (F.col("item_id") == F.col("_i")), "left_anti"))
    w = Window.partitionBy("user_id").orderBy(F.col("score").desc(), F.col("item_id").desc())
    return (cands.withColumn("rank", F.row_number().over(w))
                 .where(F.col("rank") <= k)
                 .select("user_id", F.col("rank").cast("long").alias("rank"), "item_id", "score"))


def sample_users(candidates: DataFrame, n: int, seed: int = 42) -> DataFrame:
    """A deterministic sample of ``n`` users (order by a seeded hash, then limit).

    The limit is the feature here (the reference scores a sample of users).
    """
    return (candidates.select("user_id").distinct()
                      .orderBy(F.md5(F.concat_ws(":", F.lit(seed), F.col("user_id").cast("string")).cast("binary")), "user_id").limit(n))


def recommendations_as_lists(recs: DataFrame) -> DataFrame:
    """Long (user, rank, item) table to one ordered array per user."""
    return (recs.groupBy("user_id")
                .agg(F.sort_array(F.collect_list(F.struct("rank", "item_id"))).alias("_l"))
                .select("user_id", F.col("_l.item_id").alias("items")))


def other_users_items(test: DataFrame, n: int = 10, time_col: str = "timestamp") -> DataFrame:
    """The placeholder recommender of the training pipeline.

    For each user of ``test``: the first ``n`` distinct items, in order of first
    appearance among the rows of *other* users.  An item's key for user u is its
    first appearance, unless u is the item's first user; then it is the first
    appearance by anyone else.  So u needs the global first-appearance list up to
    ``n + owned(u)`` plus its own owned items, never the whole table per user.
    """
    order = [F.col(time_col).asc_nulls_last()] + [F.col(c).asc_nulls_last()
                                                  for c in test.columns if c != time_col]
    indexed = with_global_index(test, order, "_seq")
    per_user = indexed.groupBy("item_id", "user_id").agg(F.min("_seq").alias("s"))
    w_item = Window.partitionBy("item_id").orderBy("s")
    firsts = (per_user.withColumn("_r", F.row_number().over(w_item)).where(F.col("_r") <= 2)
                      .groupBy("item_id")
                      .agg(F.min_by("user_id", "s").alias("u1"), F.min("s").alias("s1"),
                           F.max(F.when(F.col("_r") == 2, F.col("s"))).alias("s2")))
    firsts = materialize(firsts)  # read three times below
    owned = firsts.groupBy(F.col("u1").alias("user_id")).agg(F.count(F.lit(1)).alias("n_owned"))
    ordered = (with_global_index(firsts, [F.col("s1")], "_p")
               .select((F.col("_p") + 1).alias("pos"), F.struct("item_id", "u1", "s1").alias("entry")))
    users = test.select("user_id").distinct().join(owned, "user_id", "left")
    # the first n items are the same for everybody who owns none of the list: n rows
    head = ordered.where(F.col("pos") <= n).select("entry.item_id", F.col("entry.s1").alias("key"))
    plain = users.where(F.col("n_owned").isNull()).select("user_id").crossJoin(F.broadcast(head))
    wants = users.where(F.col("n_owned").isNotNull()).select(
        "user_id", F.lit(GLOBAL_LIST).alias("list"), (F.lit(n) + F.col("n_owned")).cast("long").alias("need"))
    listed = (take_from_lists(wants, ordered.withColumn("list", F.lit(GLOBAL_LIST)), shuffle_partitions(test.sparkSession))
              .where(F.col("u1") != F.col("user_id")).select("user_id", "item_id", F.col("s1").alias("key")))
    own = (firsts.where(F.col("s2").isNotNull())
                 .select(F.col("u1").alias("user_id"), "item_id", F.col("s2").alias("key")))
    w = Window.partitionBy("user_id").orderBy("key")
    return (listed.unionByName(plain).unionByName(own).withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n)
                  .select("user_id", F.col("rank").cast("long").alias("rank"), "item_id"))
