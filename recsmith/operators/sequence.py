"""Per-key sequential operators that stay balanced when one key is huge.

``lag`` or ``session_window`` partitioned by user puts all rows of a user into
one task.  Here rows are range-partitioned on (key, order): a very active user
spans many partitions.  Each partition is processed in order on its own; the
only cross-partition information is a table of each partition's first and last
row (one row per partition, so its size is bounded by the partition count),
which is resolved in partition order and broadcast back.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recsmith.session import materialize, shuffle_partitions


def _staged(df: DataFrame, key: str | list[str], order: list[Column], num_partitions: int | None) -> DataFrame:
    n = num_partitions or shuffle_partitions(df.sparkSession)
    keys = [F.col(k).asc_nulls_first() for k in ([key] if isinstance(key, str) else key)]
    # the partition id is frozen into the data: range bounds come from sampling,
    # which Spark may redo differently if the plan were evaluated again
    return materialize(df.repartitionByRange(n, *keys, *order)
                         .withColumn("_pid", F.spark_partition_id()))


def _pass_in_order(df: DataFrame, keys: list[str], order: list[Column], num_partitions: int | None, read: list[Column],
                   fields: list[T.StructField], step: Callable[[], Callable]) -> DataFrame:
    """``df`` with ``_pid`` and ``fields``, range-partitioned on (keys, order), each partition read in order once: one shuffle, of ``df`` alone.

    ``step()`` makes a partition's function: (record batch of the columns ``read``, is it the last) -> the arrays of ``fields``.  The
    result is written, since range bounds come from sampling, which Spark may redo differently if the plan were evaluated again."""
    n = num_partitions or shuffle_partitions(df.sparkSession)
    by = [*[F.col(k).asc_nulls_first() for k in keys], *order]
    width = len(df.columns) + 1
    schema = T.StructType([*df.schema.fields, T.StructField("_pid", T.IntegerType()), *fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one, held = step(), None
        for b in batches:
            if not len(b):
                continue
            if held is not None:
                yield done(one, held, False)
            held = b
        if held is not None:
            yield done(one, held, True)

    def done(one: Callable, b: pa.RecordBatch, last: bool) -> pa.RecordBatch:
        read = pa.RecordBatch.from_arrays(b.columns[width:], names=b.schema.names[width:])
        return pa.RecordBatch.from_arrays([*b.columns[:width], *one(read, last)], names=schema.names)

    ordered = df.repartitionByRange(n, *by).sortWithinPartitions(*by)
    return materialize(ordered.select(*df.columns, F.spark_partition_id().alias("_pid"), *read).mapInArrow(run, schema))


def _changes(column: pa.Array) -> np.ndarray:
    """Where a value is another than the one before it (NULL and NaN equal themselves); one less than the values."""
    a, b = column[:-1], column[1:]
    out = np.asarray(pc.not_equal(a, b).fill_null(False))
    if pa.types.is_floating(column.type):
        out = out & ~np.asarray(pc.and_(pc.is_nan(a), pc.is_nan(b)).fill_null(False))
    none = np.asarray(pc.is_null(column))
    return out | (none[1:] != none[:-1])


def epoch_micros(df: DataFrame, ts: str) -> Column:
    """Microseconds of a time column as it stands: a zone-free time is not read in the session zone, whose clock
    changes would bend the order."""
    if isinstance(df.schema[ts].dataType, T.TimestampNTZType):
        span = F.col(ts) - F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
        part = lambda unit: F.extract(F.lit(unit), span)
        seconds = (part("DAY") * 24 + part("HOUR")) * 60 + part("MINUTE")
        return seconds.cast("long") * 60_000_000 + (part("SECOND") * 1_000_000).cast("long")
    return F.unix_micros(F.col(ts).cast("timestamp"))


def time_order(df: DataFrame, ts: str) -> Column:
    """What rows are sorted by for their time: a time column itself has the order of its microseconds, and a sort evaluates
    its keys again in every comparison."""
    if isinstance(df.schema[ts].dataType, (T.TimestampType, T.TimestampNTZType)):
        return F.col(ts)
    return epoch_micros(df, ts)


def micros_time(df: DataFrame, ts: str, micros: Column) -> Column:
    """The inverse of ``epoch_micros``, in the column's type."""
    if isinstance(df.schema[ts].dataType, T.TimestampNTZType):
        return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(
            secs=(micros.cast("decimal(24,6)") / F.lit(1_000_000).cast("decimal(8,0)")).cast("decimal(24,6)"))
    return F.timestamp_micros(micros).cast(df.schema[ts].dataType)


def previous_value(df: DataFrame, key: str, order: list[Column], value: str, out: str,
                   num_partitions: int | None = None) -> DataFrame:
    """``out`` = ``value`` of the previous row of the same ``key`` in ``order`` (NULL for the first).

    Rows with a NULL key have no previous row, as a grouped ``diff`` leaves them out."""
    def step() -> Callable:
        before: list[pa.Array] = []  # the last key and value of the batch before

        def one(b: pa.RecordBatch, last: bool) -> list[pa.Array]:
            keys, values = b.columns
            if before:
                keys, values = (pa.concat_arrays([x, y]) for x, y in zip(before, (keys, values)))
            same = ~_changes(keys) & np.asarray(pc.is_valid(keys))[1:]
            earlier = pc.if_else(pa.array(same), values[:-1], pa.scalar(None, values.type))
            n, first = len(b), not before
            if first:
                earlier = pa.concat_arrays([pa.nulls(1, values.type), earlier])
            before[:] = keys[-1:], values[-1:]
            return [earlier, pa.array(np.arange(n) == 0 if first else np.zeros(n, bool)), pa.array(np.arange(n) == n - 1 if last else np.zeros(n, bool))]

        return one

    flag = T.BooleanType()
    rows = _pass_in_order(df, [key], order, num_partitions, [F.col(key).alias("_key"), F.col(value).alias("_value")], [
        T.StructField("_prev_val", df.schema[value].dataType), T.StructField("_first", flag), T.StructField("_last", flag)], step)
    # each partition's last row, moved to the next one that has rows (one row per partition)
    prev_last = rows.where("_last").select(F.lead("_pid").over(Window.orderBy("_pid")).alias("_pid"), F.col(key).alias("_bk"),
                                           F.col(value).alias("_bv"))
    fixed = rows.join(F.broadcast(prev_last), "_pid", "left")
    from_prev = F.col("_first") & (F.col("_bk") == F.col(key))
    return (fixed.withColumn(out, F.when(from_prev, F.col("_bv")).otherwise(F.col("_prev_val")))
                 .drop("_pid", "_prev_val", "_first", "_last", "_bk", "_bv"))


def sessions(df: DataFrame, key: str, ts: str, gap_seconds: int, num_partitions: int | None = None,
             gap_micros_adjust: int = 0) -> DataFrame:
    """Session start of every row: a row opens a session when it is the key's first row or
    ``ts - previous ts > gap``.  Returns ``df`` + ``session_start``, without the rows whose key or time is NULL.

    Within a partition the start is the running maximum of (key, ts) over opening
    rows.  A partition whose first session continues from the previous partition
    takes that session's start; the chain is resolved over the per-partition
    table in partition order (bounded by the partition count).
    """
    df = df.where(F.col(key).isNotNull() & F.col(ts).isNotNull())
    micros = epoch_micros(df, ts)
    gap = gap_seconds * 1_000_000 + gap_micros_adjust
    staged = _staged(df.withColumn("_t", micros), key, [F.col("_t").asc()], num_partitions)
    w = Window.partitionBy("_pid").orderBy(F.col(key).asc_nulls_first(), F.col("_t").asc())
    prev_k, prev_t = F.lag(key).over(w), F.lag("_t").over(w)
    # as Spark's session_window: an event exactly ``gap`` after the previous one stays in the session
    opens = prev_k.isNull() | (prev_k != F.col(key)) | (F.col("_t") - prev_t > gap)
    rows = staged.withColumn("_open", opens)
    running = Window.partitionBy("_pid").orderBy(F.col(key).asc_nulls_first(), F.col("_t").asc()) \
                    .rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("_start", F.max(F.when(F.col("_open"), F.struct(F.col(key).alias("k"),
                                                                           F.col("_t").alias("t")))).over(running)) \
               .withColumn("_prov", F.col("_start.t"))
    # per partition: first row, last row, the last row's provisional start (one row per partition)
    kt = F.struct(F.col(key).alias("k"), F.col("_t").alias("t"))
    bounds = (rows.groupBy("_pid")
                  .agg(F.min(kt).alias("first"), F.max(kt).alias("last"),
                       F.max_by("_prov", kt).alias("last_prov"))
                  .orderBy("_pid").collect())
    fixes, prev, prev_resolved = [], None, None
    for r in bounds:
        fix = None
        if (prev is not None and prev["last"]["k"] == r["first"]["k"]
                and r["first"]["t"] - prev["last"]["t"] <= gap):
            fix = prev_resolved
        whole_first_run = r["last"]["k"] == r["first"]["k"] and r["last_prov"] == r["first"]["t"]
        resolved = fix if (fix is not None and whole_first_run) else r["last_prov"]
        if fix is not None:
            fixes.append((int(r["_pid"]), r["first"]["k"], int(r["first"]["t"]), int(fix)))
        prev, prev_resolved = r, resolved
    spark = df.sparkSession
    key_type = df.schema[key].dataType.simpleString()
    fix_df = spark.createDataFrame(fixes, f"_pid int, _fk {key_type}, _ft long, _fix long")
    out = rows.join(F.broadcast(fix_df), "_pid", "left")
    cont = (F.col(key) == F.col("_fk")) & (F.col("_prov") == F.col("_ft"))
    start = F.when(cont, F.col("_fix")).otherwise(F.col("_prov"))
    return (out.withColumn("session_start", micros_time(df, ts, start))
               .drop("_pid", "_t", "_open", "_start", "_prov", "_fk", "_ft", "_fix"))


#: How the states of two adjacent stretches of rows become one; a stretch without rows has NULL.
_MERGE = {
    "count": lambda a, b: F.coalesce(a, F.lit(0)) + F.coalesce(b, F.lit(0)),
    "sum": lambda a, b: F.coalesce(a + b, a, b),
    "min": lambda a, b: F.least(a, b),
    "max": lambda a, b: F.greatest(a, b),
}
_OF_ROWS = {"count": F.count, "sum": F.sum, "min": F.min, "max": F.max}
_OF_STATES = {"count": F.sum, "sum": F.sum, "min": F.min, "max": F.max}
#: The same inside a task; NaN is the greatest number.
_JOINED = {"count": np.add, "sum": np.add, "min": np.fmin, "max": np.maximum}


def _nothing(kind: str, dtype: np.dtype):
    """What leaves a state of the kind as it is."""
    if kind in ("count", "sum"):
        return 0
    if dtype.kind == "f":
        return np.nan if kind == "min" else -np.inf
    return np.iinfo(dtype).max if kind == "min" else np.iinfo(dtype).min


def _running(values: np.ndarray, group: np.ndarray, join: Callable, longest: int) -> np.ndarray:
    """``join`` of all values up to each within its group (equal numbers side by side), by doubling."""
    gap = 1
    while gap < longest:
        values = np.concatenate([values[:gap], np.where(group[gap:] == group[:-gap], join(values[:-gap], values[gap:]), values[gap:])])
        gap *= 2
    return values


def _states_before(kinds: list[str], n_keys: int, first: int) -> Callable:
    """Of one partition in order: the states of the batches' columns (keys, time, values) over rows of the key strictly before each row's
    time; for ``first`` (a position among the values) the rows up to and with each."""
    kept: dict = {}  # of the batch before: its last key and time, the states before that time and with its last row

    def one(b: pa.RecordBatch, last: bool) -> list[pa.Array]:
        labels, cols = b.columns[:n_keys + 1], b.columns[n_keys + 1:]
        if kept:
            labels = [pa.concat_arrays([x, y]) for x, y in zip(kept["labels"], labels)]
        n, lead = len(labels[0]), 1 if kept else 0
        other = np.zeros(n - 1, bool)
        for c in labels[:-1]:
            other |= _changes(c)
        later = other | _changes(labels[-1])
        group, run = (np.concatenate([[0], np.cumsum(x)]) for x in (other, later))
        longest = int(np.bincount(group).max())
        start = np.searchsorted(run, np.arange(run[-1] + 1))[run]  # where each row's time begins
        from_group = np.concatenate([[-1], np.where(other, -1, np.arange(n - 1))])[start]  # the row before it, if of the key
        opened = (run == 0) & (lead == 1)
        out, totals, befores = [], [], []
        counted: dict = {}  # states of the same rows have the same count

        def count(real: np.ndarray, so_far: int) -> np.ndarray:
            mark = so_far, real.tobytes()
            if mark not in counted:
                seen = real.astype(np.int64)
                counted[mark] = _running(np.concatenate([[so_far], seen]) if lead else seen, group, np.add, longest)
            return counted[mark]

        for i, (kind, c) in enumerate(zip(kinds, cols)):
            real = np.asarray(pc.is_valid(c))
            v = seen = count(real, int(kept["totals"][i][1]) if lead else 0)
            if kind != "count":
                v = np.asarray(c.fill_null(0))
                v = np.where(real, v, _nothing(kind, v.dtype)).astype(v.dtype)
                if lead:
                    v = np.concatenate([[kept["totals"][i][0]], v]).astype(v.dtype)
                v = _running(v, group, _JOINED[kind], longest)
            before, many = (np.where(from_group >= 0, x[from_group], 0) for x in (v, seen))
            if lead:
                before, many = (np.where(opened, x, y).astype(y.dtype) for x, y in zip(kept["befores"][i], (before, many)))
            totals.append((v[-1], seen[-1]))
            befores.append((before[-1], many[-1]))
            if i == first:
                before, many = v, seen
            out.append(pa.array(before[lead:], c.type if kind != "count" else pa.int64(), mask=None if kind == "count" else many[lead:] == 0))
        kept.update(labels=[c[-1:] for c in labels], totals=totals, befores=befores)
        return out

    return one


def prefix_states(df: DataFrame, keys: list[str], ts: str, states: dict[str, tuple[str, Column]],
                  num_partitions: int | None = None, first: str | None = None) -> DataFrame:
    """``df`` + one column for each of ``states`` (name -> (count, sum, min or max, of what number)), aggregated over the rows of the same
    ``keys`` whose time is strictly before the row's.  Rows of one time see the same state; no keys mean the whole table.
    ``first`` adds a column that is true for one of each key's earliest rows.

    Rows are range-partitioned on (keys, time), so equal times of a key lie in one partition and a key with a third of all
    rows spans many.  A partition is read in order once, right behind that shuffle; what earlier partitions hold of its first
    key is carried in: one row per partition, the state of its last key there, accumulated in partition order.
    A count without rows is 0, the other states are NULL.  Rows whose key or time is NULL have no rows before them and are before none.
    """
    known = F.lit(True)
    for c in [*keys, ts]:
        known = known & F.col(c).isNotNull()
    asked = dict(states)
    if first is not None:
        asked[first] = ("count", F.lit(1))
    wide = {"byte": "long", "short": "long", "integer": "long", "long": "long", "float": "double", "double": "double"}
    types = {n: wide[df.select(c.alias("_v")).schema["_v"].dataType.typeName()] if kind != "count" else "long" for n, (kind, c) in asked.items()}
    asked = {n: (kind, F.when(known, c if kind == "count" else c.cast(types[n]))) for n, (kind, c) in asked.items()}
    # a count needs to know only whether there is a value
    time, read = time_order(df, ts), [F.when(c.isNotNull(), True) if kind == "count" else c for kind, c in asked.values()]
    read = [c.alias(f"_read_{i}") for i, c in enumerate([*map(F.col, keys), time, *read])]
    fields = [T.StructField(f"_own_{n}", T.DoubleType() if types[n] == "double" else T.LongType()) for n in asked]
    kinds, place, n_keys = [kind for kind, _ in asked.values()], len(states) if first is not None else -1, len(keys)
    staged = _pass_in_order(df, keys, [time.asc_nulls_first()], num_partitions, read, fields, lambda: _states_before(kinds, n_keys, place))
    key = F.struct(*keys) if keys else F.struct(F.lit(0).alias("all"))
    ends = staged.groupBy("_pid").agg(F.min(key).alias("_begin"), F.max(key).alias("_end"))  # one row per partition
    last = (staged.join(F.broadcast(ends), "_pid").where(key == F.col("_end")).groupBy("_pid", "_begin", "_end")
            .agg(*[_OF_ROWS[kind](c).alias(n) for n, (kind, c) in asked.items()]))
    last = materialize(last)
    so_far = Window.partitionBy("_end").orderBy("_pid").rowsBetween(Window.unboundedPreceding, 0)
    total = last.withColumns({n: _OF_STATES[kind](n).over(so_far) for n, (kind, _) in asked.items()})
    previous = Window.orderBy("_pid")  # at most one row per partition
    carried = total.select("_pid", (F.lag("_end").over(previous) == F.col("_begin")).alias("_goes_on"), F.col("_begin").alias("_carried_key"),
                           *[F.lag(n).over(previous).alias(f"_in_{n}") for n in asked]).where("_goes_on").drop("_goes_on")
    joined = staged.join(F.broadcast(carried), "_pid", "left")
    inside = F.coalesce(key == F.col("_carried_key"), F.lit(False))
    nothing = {"count": F.lit(0).cast("long")}
    found = {n: F.when(known, F.when(inside, _MERGE[kind](F.col(f"_own_{n}"), F.col(f"_in_{n}"))).otherwise(F.col(f"_own_{n}")))
             .otherwise(nothing.get(kind, F.lit(None))) for n, (kind, _) in asked.items()}
    if first is not None:
        found[first] = known & (found[first] == 1)
    return joined.select(*df.columns, *[c.alias(n) for n, c in found.items()])
