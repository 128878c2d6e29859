"""Train/test splits (W2, W3, W4) and the distributed global row index.

A global order ("the last n rows by time") is computed without funnelling
rows through one partition: the table is range-partitioned on the full sort
key, each partition numbers its own rows, and a table of per-partition row
counts (one row per partition, so its size is bounded by the partition
count, not by the data) turns local numbers into global ones.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recsmith.session import materialize, shuffle_partitions

_LOCAL_BITS = 33  # monotonically_increasing_id keeps the row number in the low 33 bits


def sort_key(df: DataFrame, time_col: str | None = "timestamp",
             tiebreak: list[str] | None = None, descending: bool = False) -> list[Column]:
    """Time first (NULLs last, as pandas sorts), then every other column as tie-break."""
    cols = ([time_col] if time_col else []) + (
        tiebreak if tiebreak is not None else [c for c in df.columns if c != time_col])
    if descending:
        return [F.col(c).desc_nulls_first() for c in cols]
    return [F.col(c).asc_nulls_last() for c in cols]


def with_global_index(df: DataFrame, order: list[Column], index_col: str = "row_idx",
                      total_col: str | None = None, num_partitions: int | None = None) -> DataFrame:
    """Add a 0-based position of every row in ``order`` (and optionally the row total).

    ``order`` must be total up to identical rows, so positions are a function of the
    data.  One range shuffle, one write of the numbered rows, two scans of that copy
    (one for the per-partition counts) and no single-partition step over the rows,
    whatever the input size.
    """
    n = num_partitions or shuffle_partitions(df.sparkSession)
    # Range bounds come from sampling, which Spark may redo differently on another
    # evaluation; the numbered rows are therefore written once and both the counts
    # and the positions are read from that one copy.
    staged = materialize(df.repartitionByRange(n, *order).sortWithinPartitions(*order)
                           .withColumn("_mid", F.monotonically_increasing_id()))
    staged = staged.withColumn("_pid", F.shiftright(F.col("_mid"), _LOCAL_BITS))
    per_part = staged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_cnt"))
    # per_part holds at most n rows: an unpartitioned window over it is cheap.
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_part.select(
        "_pid",
        F.coalesce(F.sum("_cnt").over(before), F.lit(0)).alias("_offset"),
        F.sum("_cnt").over(Window.partitionBy()).alias("_total"))
    out = (staged.join(F.broadcast(offsets), "_pid")
                 .withColumn(index_col, F.col("_offset") + F.col("_mid")
                             - F.shiftleft(F.col("_pid"), _LOCAL_BITS)))
    if total_col:
        out = out.withColumnRenamed("_total", total_col)
    return out.drop("_mid", "_pid", "_offset", "_total")


def temporal_split(interactions: DataFrame, test_ratio: float = 0.2, min_test: int = 0,
                   time_col: str = "timestamp", tiebreak: list[str] | None = None,
                   num_partitions: int | None = None) -> tuple[DataFrame, DataFrame]:
    """The last ``int(n * test_ratio)`` rows in time order are test.

    ``min_test=1`` gives the local-chain variant (at least one test row).  When the
    test size is 0 every row is train (the reference would return an empty train).
    Ties on time are broken by all other columns, so the split is deterministic.
    """
    flagged = flag_temporal_split(interactions, test_ratio, min_test, time_col, tiebreak, num_partitions)
    return (flagged.where(~F.col("is_test")).drop("is_test"),
            flagged.where(F.col("is_test")).drop("is_test"))


def _literal(value: str, dtype: T.DataType) -> Column:
    """A constant of the column's own type, so that a comparison with the raw column reaches the scan."""
    if isinstance(dtype, T.TimestampType):  # read as microseconds: text would pass through the session zone
        return F.timestamp_micros(F.lit(int(value)))
    return F.lit(value).cast(dtype)


def flag_temporal_split(interactions: DataFrame, test_ratio: float = 0.2, min_test: int = 0,
                        time_col: str = "timestamp", tiebreak: list[str] | None = None,
                        num_partitions: int | None = None, accuracy: int = 10_000) -> DataFrame:
    """The time split as one table with ``is_test``; the whole table is never sorted.

    1. A percentile sketch (bounded memory, map-side) brackets the cut time with
       two times whose rank error is at most n/accuracy, and one exact counting
       pass checks that the cut lies between them.
    2. Rows after the bracket are test and rows before it train, where they lie.
    3. Only the rows inside the bracket (about 4n/accuracy, plus ties) are ranked
       exactly by the global index on the full sort key.
    If the check fails (never expected) the whole table is ranked instead.
    Rows without time sort last, as pandas sorts.  Times are compared in the column's own type with constants,
    so both sides of the split are filters that the Parquet scan can use, whatever the session zone.
    """
    order = sort_key(interactions, time_col, tiebreak)
    t, dtype = F.col(time_col), interactions.schema[time_col].dataType
    eps = 2.0 / accuracy

    def bracket(q: float) -> list[Column]:
        two = F.percentile_approx(t, [min(1.0, max(0.0, q - eps)), min(1.0, max(0.0, q + eps))], accuracy)
        shown = (lambda c: F.unix_micros(c).cast("string")) if isinstance(dtype, T.TimestampType) else (lambda c: c.cast("string"))
        return [shown(two[0]).alias("lo"), shown(two[1]).alias("hi")]

    # One pass for the counts and the bracket: the cut fraction is 1 - ratio up to 1/n,
    # far inside the bracket's width; the exact check below guards every other case.
    first = interactions.agg(F.count(F.lit(1)).alias("n"), F.count(t).alias("timed"), *bracket(1.0 - float(test_ratio))).first()
    n, untimed = first["n"], first["n"] - first["timed"]
    test_size = min(max(int(n * float(test_ratio)), int(min_test)), n)
    if test_size == 0 or n == 0:
        return interactions.withColumn("is_test", F.lit(False))
    if test_size == n:
        return interactions.withColumn("is_test", F.lit(True))
    if test_size <= untimed:  # the cut lies among the rows without time
        outside = interactions.where(t.isNotNull()).withColumn("is_test", F.lit(False))
        band, k_band = interactions.where(t.isNull()), test_size
    else:
        if untimed:
            first = interactions.agg(*bracket(1.0 - (test_size - untimed) / first["timed"])).first()
        lo, hi = _literal(first["lo"], dtype), _literal(first["hi"], dtype)
        c = interactions.agg(F.count(F.when(t > hi, 1)).alias("above"), F.count(F.when(t >= lo, 1)).alias("from_lo")).first()
        if not (c["above"] + untimed <= test_size <= c["from_lo"] + untimed):
            indexed = with_global_index(interactions, order, "_idx", None, num_partitions)
            return indexed.withColumn("is_test", F.col("_idx") >= n - test_size).drop("_idx")
        before = interactions.where(t < lo).withColumn("is_test", F.lit(False))
        after = interactions.where(t > hi).withColumn("is_test", F.lit(True))
        outside = before.unionByName(after)
        if untimed:
            outside = outside.unionByName(interactions.where(t.isNull()).withColumn("is_test", F.lit(True)))
        band, k_band = interactions.where((t >= lo) & (t <= hi)), test_size - c["above"] - untimed
    ranked = with_global_index(band, order, "_idx", "_n", num_partitions)
    band_flag = ranked.withColumn("is_test", F.col("_idx") >= F.col("_n") - k_band).drop("_idx", "_n")
    return outside.unionByName(band_flag)


def hash_split(df: DataFrame, key_cols: list[str], train_fraction: float = 0.8,
               seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """Stable random split by a hash bucket of the key (no shuffle, partition-independent)."""
    bucket = F.pmod(F.xxhash64(*[F.col(c) for c in key_cols], F.lit(seed)), F.lit(10000))
    is_train = bucket < F.lit(int(round(train_fraction * 10000)))
    return df.where(is_train), df.where(~is_train)


def random_split(df: DataFrame, train_fraction: float = 0.8, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """W4 as Spark's ``randomSplit`` (seeded, depends on the input partitioning)."""
    train, test = df.randomSplit([train_fraction, 1.0 - train_fraction], seed=seed)
    return train, test
