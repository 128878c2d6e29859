"""Feature tables (user, item, interaction, ranking) as joins of grouped statistics.

The row loops of the reference (affinity, segments) become column expressions
over left joins, so each feature table is one plan of shuffles and scans.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recsmith.functions import columns as C
from recsmith.operators import aggregates as A
from recsmith.operators import encoders as E
from recsmith.operators import text as TX
from recsmith.operators.sequence import epoch_micros, prefix_states, previous_value
from recsmith.session import drop_tables, materialize, tables_made

# Affinity weights and its value for unknown users or items.
AFFINITY_GENRE = 0.5
AFFINITY_QUALITY = 0.3
AFFINITY_POPULARITY = 0.2
AFFINITY_UNKNOWN = 0.5

# The columns that J1 takes from each table.
USER_JOIN_COLS = ["age_group", "gender", "location", "subscription_type"]
ITEM_JOIN_COLS = ["genre", "popularity_score", "quality_score", "price"]


def user_features(users: DataFrame, interactions: DataFrame, items: DataFrame,
                  genres: list[str] | None = None) -> DataFrame:
    """User table + encodings + preferences for ``genres`` (wide, a given list) + A1 statistics + fills + segment."""
    out = E.label_encode(users, "user_id", "user_id_encoded", fill=None)
    cats = ["gender", "age_group", "location"]
    out = E.apply_label_encoders(out, cats, E.fit_label_encoders(users, cats))
    stats = A.user_stats(interactions)
    if genres:  # the wide form needs the caller's list; A.genre_preferences is the long form for any number of genres
        out = out.join(A.genre_preferences_wide(A.genre_preferences(interactions, items), genres), "user_id", "left")
    out = out.join(stats, "user_id", "left")
    # mean over the users of the table that have statistics (fit on the small stats table)
    mean_avg = stats.join(users.select("user_id"), "user_id", "left_semi").select(F.avg("avg_rating")).scalar()
    out = (out.withColumn("avg_rating", F.coalesce(F.col("avg_rating"), mean_avg))
              .fillna(0, subset=["rating_std", "total_interactions", "unique_items_interacted",
                                 "interaction_frequency", "user_activity_days"]))
    return out.withColumn("user_segment", C.user_segment("total_interactions", "avg_rating"))


TITLE_TERMS, TITLE_DIMENSIONS = 100, 20


def title_vectors(items: DataFrame) -> DataFrame:
    """P15 + P16: item_id and the title's components svd_0, svd_1, ..; items without terms have zeros."""
    long = TX.tfidf(items, "item_id", "title", TITLE_TERMS)
    return TX.truncated_svd(materialize(long), "item_id", TITLE_TERMS, TITLE_DIMENSIONS)[0]


def item_features(items: DataFrame, interactions: DataFrame, text: bool = False) -> DataFrame:
    """Item table + encodings + A2 statistics + computed popularity (A3) + fills + segment.

    The computed popularity is named ``interaction_popularity`` so it does not
    collide with the catalogue's own ``popularity_score``.  ``text`` appends the title components (P15, P16).
    """
    out = E.label_encode(items, "item_id", "item_id_encoded", fill=None)
    out = E.apply_label_encoders(out, ["genre"], E.fit_label_encoders(items, ["genre"]))
    stats = A.item_stats(interactions)
    scaled = E.min_max_scale(stats, ["total_interactions", "unique_users_interacted"], "_mm")
    stats = scaled.withColumn(
        "interaction_popularity",
        (F.col("total_interactions_mm") + F.col("unique_users_interacted_mm")) / 2.0
    ).drop("total_interactions_mm", "unique_users_interacted_mm")
    out = out.join(stats, "item_id", "left")
    mean_avg = stats.join(items.select("item_id"), "item_id", "left_semi").select(F.avg("avg_rating")).scalar()
    out = (out.withColumn("avg_rating", F.coalesce(F.col("avg_rating"), mean_avg))
              .fillna(0, subset=["rating_std", "total_interactions", "unique_users_interacted",
                                 "interaction_frequency", "item_activity_days", "interaction_popularity"]))
    out = out.withColumn("item_segment", C.item_segment("interaction_popularity", "quality_score"))
    return out.join(title_vectors(items), "item_id", "left") if text else out


def time_since_last(interactions: DataFrame, time_col: str = "timestamp") -> DataFrame:
    """Seconds since the user's previous interaction (first one 0).

    Ties on time are ordered by all other columns, so the result is deterministic.
    """
    others = [c for c in interactions.columns if c not in (time_col, "user_id")]
    order = [F.col(time_col).asc_nulls_last()] + [F.col(c).asc_nulls_last() for c in others]
    # range-partitioned previous row: a user with a huge history spans many tasks
    out = previous_value(interactions, "user_id", order, time_col, "_prev_ts")
    secs = (epoch_micros(out, time_col) - epoch_micros(out, "_prev_ts")) / 1e6
    return out.withColumn("time_since_last", F.coalesce(secs, F.lit(0.0))).drop("_prev_ts")


def known_interactions(interactions: DataFrame, users: DataFrame, items: DataFrame) -> DataFrame:
    """Interactions whose user and item are in the tables (semi joins on the ids only)."""
    return (interactions.join(users.select("user_id"), "user_id", "left_semi")
                        .join(items.select("item_id"), "item_id", "left_semi"))


def affinity(pref, genre, quality, popularity, known):
    """0.5 * genre match + 0.3 * quality + 0.2 * popularity; 0.5 if user or item unknown."""
    aff = (C.genre_match(pref, genre) * AFFINITY_GENRE + F.col(quality) * AFFINITY_QUALITY
           + F.col(popularity) * AFFINITY_POPULARITY)
    return F.when(known, aff).otherwise(F.lit(AFFINITY_UNKNOWN))


def user_item_affinity(df: DataFrame, users: DataFrame, items: DataFrame) -> DataFrame:
    """P9 for (user_id, item_id) rows."""
    u = users.select("user_id", C.parse_genres("preferred_genres").alias("_pref"), F.lit(True).alias("_u_known"))
    i = items.select("item_id", F.col("genre").alias("_genre"), F.col("quality_score").alias("_q"),
                     F.col("popularity_score").alias("_p"), F.lit(True).alias("_i_known"))
    j = df.join(u, "user_id", "left").join(i, "item_id", "left")
    known = F.col("_u_known").isNotNull() & F.col("_i_known").isNotNull()
    return (j.withColumn("user_item_affinity", affinity("_pref", "_genre", "_q", "_p", known))
             .drop("_pref", "_genre", "_q", "_p", "_u_known", "_i_known"))


def _encoded_dimension(interactions: DataFrame, dim: DataFrame, key: str, cats: list[str]):
    """A dimension's rows that occur in the interactions, and the label values those interactions show."""
    used = dim.join(interactions.select(key), key, "left_semi")
    orphan = interactions.join(dim.select(key), key, "left_anti").select(*[F.lit(None).cast("string").alias(c) for c in cats])
    return used, E.label_values(used, cats).unionByName(E.label_values(orphan, cats)).distinct()


def interaction_features(interactions: DataFrame, users: DataFrame, items: DataFrame) -> DataFrame:
    """Time parts, W1, J1 joins, label encodings, P9 affinity, P6 rating scaling.

    A category's code depends on the user or item alone, so the dimension tables are encoded (on the values that occur
    in interactions) before J1, and the interactions are joined once to each."""
    out = time_since_last(interactions)  # a written table: the keys and ratings below are read from it
    used_users, user_values = _encoded_dimension(out, users.select(
        "user_id", *USER_JOIN_COLS, C.parse_genres("preferred_genres").alias("_pref"), F.lit(True).alias("_u_known")),
        "user_id", USER_JOIN_COLS)
    used_items, item_values = _encoded_dimension(out, items.select(
        "item_id", *ITEM_JOIN_COLS, F.lit(True).alias("_i_known")), "item_id", ["genre"])
    lookup = E.number_labels(user_values.unionByName(item_values))
    of_user = E.apply_label_encoders(used_users, USER_JOIN_COLS, lookup)
    of_item = E.apply_label_encoders(used_items, ["genre"], lookup)
    # the user's texts are the widest: they come last, the time parts after them, so neither is shuffled again
    ratings = out.select(F.col("rating").alias("rating_normalized"))
    parts = C.time_parts("timestamp")
    out = out.join(of_item, "item_id", "left").join(of_user, "user_id", "left").withColumns(parts)
    ids = ("item_id", "user_id")
    out = out.select(*ids, *[c for t in (interactions.columns, parts, ["time_since_last"], of_user.columns, of_item.columns)
                             for c in t if c not in ids])
    for c in [*USER_JOIN_COLS, "genre"]:  # rows without a user or item
        out = out.withColumn(f"{c}_encoded", F.coalesce(F.col(f"{c}_encoded"), E.code_of(lookup, c, C.UNKNOWN)))
    known = F.col("_u_known").isNotNull() & F.col("_i_known").isNotNull()
    out = (out.withColumn("user_item_affinity", affinity("_pref", "genre", "quality_score", "popularity_score", known))
              .drop("_pref", "_u_known", "_i_known"))
    # the scaler is fit on the ratings themselves (left joins keep one row per interaction)
    state = E.fit_standard_scaler(ratings, ["rating_normalized"])
    return E.standard_scale(out.withColumn("rating_normalized", F.col("rating")), ["rating_normalized"],
                            state=state)


def _rating_states(prefix: str, bounds: bool = True) -> dict:
    r = F.col("rating").cast("double")
    least_and_greatest = {f"{prefix}_rating_min": ("min", r), f"{prefix}_rating_max": ("max", r)} if bounds else {}
    return {f"_{prefix}_n": ("count", r), f"_{prefix}_s": ("sum", r), f"_{prefix}_q": ("sum", r * r), **least_and_greatest}


def _from_states(df: DataFrame, prefix: str, total: str, avg: str, std: str) -> DataFrame:
    """Count, mean and sample deviation (3 places; NULL where there is too little) of the states of one prefix."""
    n, s, q = (F.col(f"_{prefix}_{x}") for x in "nsq")
    spread = F.sqrt(F.greatest(q - s * s / n, F.lit(0.0)) / (n - 1))
    return (df.withColumns({total: n, avg: C.round_half_even(C.safe_ratio(s, n)), std: C.round_half_even(F.when(n > 1, spread))})
            .drop(f"_{prefix}_n", f"_{prefix}_s", f"_{prefix}_q"))


def statistics_as_of(interactions: DataFrame, time_col: str = "timestamp", num_partitions: int | None = None,
                     bounds: bool = True) -> DataFrame:
    """Every interaction with the statistics that were known strictly before it: of its user, its item and the pair (A1, A2,
    A6-A8: rated rows, mean, deviation, least and greatest rating, distinct partners), and the busiest user's and item's count so far.

    A row never sees its own rating, nor one of the same instant.  Each statistic is a prefix aggregate of one range
    shuffle (``prefix_states``), so an online store that folds ratings in one by one holds the same numbers.  One first row
    of each user and item is marked; the marks before a time are the number of distinct partners.
    Counts without history are 0, the other statistics NULL.  Rows without a time, or without the id concerned, have no history.
    Without ``bounds`` the least and greatest ratings are left out: no later pass carries them.
    A pass reads what the one before has stored, which is dropped when the pass is.
    """
    cols = [*interactions.columns]
    with tables_made() as before:
        out = prefix_states(interactions, ["user_id", "item_id"], time_col, _rating_states("user_item", bounds), num_partitions, first="_first")
    out = _from_states(out, "user_item", "user_item_interactions", "user_item_avg_rating", "user_item_rating_std")
    opens = F.when(F.col("_first"), 1)
    for side, other, key in (("user", "items", "user_id"), ("item", "users", "item_id")):
        found = {**_rating_states(side, bounds), f"{side}_unique_{other}": ("count", opens)}
        with tables_made() as made:
            states = prefix_states(out, [key], time_col, found, num_partitions)
        drop_tables(interactions.sparkSession, before)
        before = made
        out = _from_states(states, side, f"{side}_total_interactions", f"{side}_avg_rating", f"{side}_rating_std")
    out = out.drop("_first")
    # the busiest user's and item's count so far: one row a time is enough
    rated = F.when(F.col("rating").isNotNull(), 1).otherwise(0)
    busiest = (out.where(F.col(time_col).isNotNull()).groupBy(F.col(time_col).alias("_time"))
               .agg(*[F.max(F.col(f"{s}_total_interactions") + rated).alias(f"_{s}") for s in ("user", "item")]))
    busiest = prefix_states(busiest, [], "_time", {f"{s}_interactions_max": ("max", F.col(f"_{s}")) for s in ("user", "item")}, num_partitions)
    busiest = materialize(busiest.drop("_user", "_item"))  # so that its size is known: a small one is broadcast
    out = out.join(busiest, F.col(time_col) == F.col("_time"), "left").drop("_time")
    return out.select(*cols, *[c for c in out.columns if c not in cols])


def ranking_features(interactions: DataFrame, users: DataFrame | None = None,
                     items: DataFrame | None = None, history: DataFrame | None = None, point_in_time: bool = False,
                     codes: dict[str, Column] | None = None) -> DataFrame:
    """Features of the rating regressor: J2 joins, time parts, A6-A8 with J8, P12 ratios, zero fill.

    A user's and an item's columns and statistics are joined to each other first, so a row is shuffled three times: bare for the
    pair's statistics, then with these for its user, then with the user's columns for its item.  The statistics and the rows with their
    pair's are stored on the way, so the disk never holds the shuffles of all steps.
    ``codes`` names columns that hold label codes already, with what a row without a code gets in place of 0.

    Statistics come from ``history`` (default: the rows themselves, as the
    reference computes them), so candidate pairs can be featurized the same way.
    ``point_in_time`` takes each row's statistics strictly before its time instead (M14), so no row sees its own rating.
    """
    if point_in_time:
        with tables_made() as made:
            own = statistics_as_of(interactions, bounds=False)
        if users is not None:
            own = own.join(users, "user_id", "left")
        if users is not None and items is not None:
            own = materialize(own)  # the shuffle by user and what it read go before the one by item
            drop_tables(interactions.sparkSession, made)
        if items is not None:
            own = own.join(items, "item_id", "left")
        return _with_ratios(own.withColumns(C.time_parts("timestamp")), F.col("user_interactions_max"),
                            F.col("item_interactions_max")).drop("user_interactions_max", "item_interactions_max")
    history = interactions if history is None else history
    us = materialize(A.ranking_entity_stats(history, "user_id", "item_id", "user"))
    its = materialize(A.ranking_entity_stats(history, "item_id", "user_id", "item"))
    pairs, parts = A.pair_stats(history), C.time_parts("timestamp")
    out = materialize(interactions.join(pairs, ["user_id", "item_id"], "left"))
    # ids with statistics need not be in the tables, nor the tables' ids have any
    out = out.join(us if users is None else users.join(us, "user_id", "full"), "user_id", "left")
    out = out.join(its if items is None else items.join(its, "item_id", "full"), "item_id", "left")
    out = out.withColumns(parts)
    ids = {"user_id", "item_id"}
    tables = [t for t in (interactions, users, items) if t is not None]
    out = out.select("item_id", "user_id", *[c for t in tables for c in t.columns if c not in ids], *parts,
                     *[c for t in (pairs, us, its) for c in t.columns if c not in ids])
    if codes:
        out = out.withColumns({c: F.coalesce(F.col(c), missing) for c, missing in codes.items()})
    # every interaction row carries its user's and item's statistics: maxima over the stats tables
    max_u = us.select(F.max("user_total_interactions")).scalar()
    max_i = its.select(F.max("item_total_interactions")).scalar()
    return _with_ratios(out, max_u, max_i)


def _with_ratios(out: DataFrame, max_u: Column, max_i: Column) -> DataFrame:
    """P12 ratios from the joined statistics, and the zero fill."""
    out = (out.withColumn("user_popularity", C.safe_ratio("user_total_interactions", max_u))
              .withColumn("item_popularity", C.safe_ratio("item_total_interactions", max_i))
              .withColumn("user_quality", F.col("user_avg_rating") / 5.0)
              .withColumn("item_quality", F.col("item_avg_rating") / 5.0)
              .withColumn("user_diversity", C.safe_ratio("user_unique_items", "user_total_interactions"))
              .withColumn("item_diversity", C.safe_ratio("item_unique_users", "item_total_interactions")))
    numeric = [f.name for f in out.schema.fields
               if f.dataType.typeName() in ("double", "float", "long", "integer", "short")]
    return out.fillna(0, subset=numeric).fillna(0.0, subset=numeric)


# Metadata columns never used as model inputs (fixed list of the ranking trainer).
EXCLUDED_FEATURE_COLUMNS = ["rating", "user_id", "item_id", "timestamp", "session_id",
                            "device_type", "duration_seconds", "interaction_type"]


def feature_columns(df: DataFrame, target: str = "rating") -> tuple[list[str], list[str]]:
    """(categorical, numeric) input columns by type, minus target, ids and metadata."""
    excluded = set(EXCLUDED_FEATURE_COLUMNS) | {target}
    cat, num = [], []
    for f in df.schema.fields:
        if f.name in excluded:
            continue
        t = f.dataType.typeName()
        if t == "string":
            cat.append(f.name)
        elif t in ("double", "float", "long", "integer", "short", "boolean"):
            num.append(f.name)
    return cat, num


def ranking_labels(interactions: DataFrame, users: DataFrame | None, items: DataFrame | None, cat: list[str]) -> DataFrame | None:
    """Codes of the categoricals of the ranking features, and of every value of the user and item tables; a missing value is the
    text 'nan'.  A table's values are read there, not from the joined rows: those add 'nan' if an interaction has no row in the table."""
    own = [c for c in cat if c in interactions.columns]
    values = [E.label_values(interactions, own, fill="nan")] if own else []
    for t, key in ((users, "user_id"), (items, "item_id")):
        cols = [c for c in cat if t is not None and c in t.columns]
        if cols:
            orphan = interactions.select(key).distinct().join(t.select(key), key, "left_anti")
            values += [E.label_values(t, cols, fill="nan"),
                       E.label_values(orphan.select(*[F.lit(None).cast("string").alias(c) for c in cols]), cols, fill="nan")]
    return E.number_labels(reduce(DataFrame.unionByName, values).distinct()) if values else None


def coded_ranking_features(interactions: DataFrame, users: DataFrame | None, items: DataFrame | None, cat: list[str],
                           lookup: DataFrame | None, history: DataFrame | None = None) -> DataFrame:
    """``ranking_features`` with the codes of ``lookup`` in place of the categoricals ``cat``.

    A user's and an item's labels are coded in their tables, so no interaction is shuffled by a label and no text goes through
    the joins.  A value that was never fitted raises where a row shows it."""
    unseen = -1
    tables, codes = [], {}
    for t in (users, items):
        cols = [c for c in cat if t is not None and c in t.columns]
        for c in cols:
            one = lookup.where(F.col("column") == c).select(F.col("value").alias("_v"), F.col("code").alias("_code"))
            t = (t.join(one, F.coalesce(F.col(c), F.lit("nan")) == F.col("_v"), "left")
                 .withColumn(c, F.coalesce("_code", F.lit(unseen).cast("long"))).drop("_v", "_code"))
            codes[c] = F.coalesce(E.code_of(lookup, c, "nan"), F.lit(unseen).cast("long"))
        tables.append(t)
    out = ranking_features(interactions, *tables, history=history, codes=codes)
    for c in codes:
        out = out.withColumn(c, F.when(F.col(c) != unseen, F.col(c)).otherwise(F.raise_error(F.lit(f"unseen label in {c}")).cast("long")))
    own = [c for c in cat if c not in codes]
    if own:
        out = E.apply_label_encoders(out, own, lookup, fill="nan", suffix="__code").drop(*own)
        out = out.withColumnsRenamed({c + "__code": c for c in own})
    return out


def model_matrix(df: DataFrame, target: str = "rating", fitted: dict | None = None, also: list[DataFrame] = ()):
    """Label-encode categoricals, then standard-scale every input (encoded ones too).

    Values of the tables ``also`` get codes too, so rows of other users and items can be encoded later.

    Returns (matrix, inputs, fitted); pass ``fitted`` back to transform new rows
    with the training encoders and scaler.
    """
    if fitted is None:
        cat, num = feature_columns(df, target)
        # the reference encodes ``astype(str)``: a missing value becomes the text 'nan'
        values = [E.label_values(df, cat, fill="nan")] if cat else []
        for t in also:
            own = [c for c in cat if c in t.columns]
            values += [E.label_values(t, own, fill="nan")] if own else []
        lookup = E.number_labels(reduce(DataFrame.unionByName, values).distinct()) if cat else None
    else:
        cat, num, lookup = fitted["cat"], fitted["num"], fitted["lookup"]
    out = df
    if cat:
        out = E.apply_label_encoders(out, cat, lookup, fill="nan", suffix="__code")
        for c in cat:
            out = out.drop(c).withColumnRenamed(c + "__code", c)
    inputs = cat + num
    out = out.select(*[F.col(c).cast("double").alias(c) for c in inputs],
                     *[c for c in out.columns if c not in inputs])
    state = fitted["scaler"] if fitted is not None else E.fit_standard_scaler(out, inputs)
    fitted = {"cat": cat, "num": num, "lookup": lookup, "scaler": state}
    return E.standard_scale(out, inputs, state=state), inputs, fitted
