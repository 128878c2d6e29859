"""Column expressions (P2-P14).  All built-in functions, so they stay in codegen."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Segment thresholds and labels.
HIGH_ACTIVITY_MIN = 50
MEDIUM_ACTIVITY_MIN = 10
POSITIVE_RATING_MIN = 4.0
POPULAR_MIN = 0.7
HIGH_QUALITY_MIN = 0.7
UNKNOWN = "Unknown"

MICROS_PER_DAY = 86_400_000_000


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def parse_genres(col: str | Column) -> Column:
    """JSON array text to ``array<string>``; malformed text gives NULL (no match)."""
    return F.from_json(_c(col), "array<string>")


def genre_match(genres: str | Column, genre: str | Column) -> Column:
    """1.0 when ``genre`` is in the parsed list, else 0.0 (NULLs give 0.0)."""
    return F.when(F.coalesce(F.array_contains(_c(genres), _c(genre)), F.lit(False)), 1.0).otherwise(0.0)


def hour(ts: str | Column) -> Column:
    return F.hour(_c(ts))


def day_of_week(ts: str | Column) -> Column:
    """Monday = 0 ... Sunday = 6 (pandas ``dayofweek``; Spark's ``dayofweek`` is Sunday = 1)."""
    return F.weekday(_c(ts))


def month(ts: str | Column) -> Column:
    return F.month(_c(ts))


def is_weekend(ts: str | Column) -> Column:
    """Saturday or Sunday as 0/1."""
    return day_of_week(ts).isin(5, 6).cast("int")


def is_evening(ts: str | Column) -> Column:
    """Hour 18..23 inclusive as 0/1."""
    return F.hour(_c(ts)).between(18, 23).cast("int")


def time_parts(ts: str = "timestamp") -> dict[str, Column]:
    return {"hour": hour(ts), "day_of_week": day_of_week(ts), "month": month(ts),
            "is_weekend": is_weekend(ts), "is_evening": is_evening(ts)}


def whole_days(start: str | Column, end: str | Column) -> Column:
    """Floor of elapsed time in days (not calendar-day difference)."""
    delta = F.unix_micros(_c(end).cast("timestamp")) - F.unix_micros(_c(start).cast("timestamp"))
    return F.floor(delta / F.lit(MICROS_PER_DAY)).cast("long")


def safe_ratio(num: str | Column, den: str | Column) -> Column:
    """Division that yields NULL instead of failing on 0 (ANSI mode)."""
    return F.try_divide(_c(num).cast("double"), _c(den).cast("double"))


def round_half_even(col: str | Column, places: int = 3) -> Column:
    """pandas/numpy ``round``: scale, round half to even, unscale.

    Rounding the scaled double (not its exact decimal value) is what numpy does,
    so 0.0125 rounds to 0.012 here as there.
    """
    scale = float(10 ** places)
    return F.bround(_c(col).cast("double") * F.lit(scale), 0) / F.lit(scale)


def user_segment(total: str | Column = "total_interactions", avg: str | Column = "avg_rating") -> Column:
    """P10: five activity x sentiment labels."""
    t, a = _c(total), _c(avg)
    pos = a >= POSITIVE_RATING_MIN
    return (F.when(t >= HIGH_ACTIVITY_MIN, F.when(pos, "high_activity_positive").otherwise("high_activity_mixed"))
             .when(t >= MEDIUM_ACTIVITY_MIN, F.when(pos, "medium_activity_positive").otherwise("medium_activity_mixed"))
             .otherwise("low_activity"))


def item_segment(popularity: str | Column = "interaction_popularity",
                 quality: str | Column = "quality_score") -> Column:
    """Four popularity x quality labels (NULL compares false, as in pandas)."""
    p, q = _c(popularity), _c(quality)
    hq = F.coalesce(q >= HIGH_QUALITY_MIN, F.lit(False))
    return (F.when(F.coalesce(p >= POPULAR_MIN, F.lit(False)),
                   F.when(hq, "popular_high_quality").otherwise("popular_mixed_quality"))
             .when(hq, "niche_high_quality")
             .otherwise("niche_mixed_quality"))
