"""Exact values at sorted positions (A12, A16, T3, T9) by refinement.

A sketch brackets every wanted position of every group in one pass.  A second pass drops what lies above a bracket, sums
what lies below it to one number and keeps only the distinct values inside with their counts, combined before the
shuffle.  Only those are range-sorted; running counts lead to the cells that hold the wanted positions.  No task holds a
group, and no exchange carries more than the brackets: about 2 * MARGIN * n / ACCURACY values of a large group and
position.  Groups of up to ACCURACY rows are one open bracket.

The input is scanned twice and must give the same rows both times.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recsmith.session import materialize, shuffle_partitions

ACCURACY, MARGIN = 10_000, 2
BROADCAST_GROUPS, SALTS = 100_000, 32

Position = Callable[[Column, float], Column]


def linear_position(n: Column, p: float) -> Column:
    """0-based position below the ``p`` quantile of n values: floor((n - 1) p)."""
    return F.floor((n - 1) * F.lit(float(p))).cast("long")


def _brackets(values: DataFrame, probs: list[float], accuracy: int, margin: float) -> DataFrame:
    """One row per group: g, n, brackets (array of low, high); NULL bounds are open."""
    slack, k = margin / accuracy, len(probs)
    ends = [max(0.0, p - slack) for p in probs] + [min(1.0, p + slack) for p in probs]
    sketch = values.groupBy("g").agg(F.count(F.lit(1)).alias("n"), F.percentile_approx("v", ends, accuracy).alias("s"))
    each = F.array(*[F.struct(F.col("s")[i].alias("low"), F.col("s")[k + i].alias("high")) for i in range(k)])
    return sketch.select("g", "n", F.when(F.col("n") > accuracy, each).otherwise(_open()).alias("brackets"))


def _open() -> Column:
    return F.array(F.struct(F.lit(None).cast("double").alias("low"), F.lit(None).cast("double").alias("high")))


def _meet(values: DataFrame, brackets: DataFrame) -> DataFrame:
    """Every value with the brackets of its group; the table of groups goes out whole only below a checked size."""
    if brackets.count() <= BROADCAST_GROUPS:
        return values.join(F.broadcast(brackets), "g")
    salted = brackets.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return values.withColumn("salt", F.pmod(F.xxhash64("v"), F.lit(SALTS)).cast("int")).join(salted, ["g", "salt"]).drop("salt")


def _found(values: DataFrame, brackets: DataFrame, probs: list[float], position: Position, parts: int) -> DataFrame:
    """One row per group: g, n, low<i>, high<i> (the values at and behind each position; NULL where the bracket missed)."""
    rows = _meet(values, brackets).select("g", "n", "v", F.posexplode("brackets").alias("b", "r"))
    under = F.coalesce(F.col("v") < F.col("r.low"), F.lit(False))
    rows = rows.where(F.col("r.high").isNull() | (F.col("v") <= F.col("r.high")))
    cells = rows.groupBy("g", "n", "b", F.when(~under, F.col("v")).alias("v")).agg(F.count(F.lit(1)).alias("w"))
    order = [F.col("g"), F.col("b"), F.col("v").asc_nulls_first()]  # the sum below a bracket is its first cell
    staged = materialize(cells.repartitionByRange(parts, *order).sortWithinPartitions(*order)
                         .withColumn("part", F.spark_partition_id()))
    spans = staged.groupBy("part", "g", "b", "n").agg(F.sum("w").alias("held"))
    before = Window.partitionBy("g", "b").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    spans = spans.withColumn("offset", F.coalesce(F.sum("held").over(before), F.lit(0)))
    at = [position(F.col("n"), p) for p in probs]
    wanted = F.array(*at, *[a + 1 for a in at])

    def holds(start: Column, size: Column) -> Column:
        return F.exists(wanted, lambda x: (x >= start) & (x < start + size))

    spans = spans.where(holds(F.col("offset"), F.col("held"))).select("part", "g", "b", "offset")
    inside = Window.partitionBy("part", "g", "b").orderBy(F.col("v").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, -1)
    placed = (staged.join(spans, ["part", "g", "b"])
              .withColumn("start", F.col("offset") + F.coalesce(F.sum("w").over(inside), F.lit(0))))
    placed = placed.where(holds(F.col("start"), F.col("w")))

    def value(x: Column) -> Column:
        return F.max(F.when((x >= F.col("start")) & (x < F.col("start") + F.col("w")), F.col("v")))

    return placed.groupBy("g", "n").agg(*[c for i, a in enumerate(at) for c in (value(a).alias(f"low{i}"), value(a + 1).alias(f"high{i}"))])


def values_at(df: DataFrame, groups: list[str], value: str, probs: list[float], position: Position = linear_position,
              accuracy: int = ACCURACY, margin: float = MARGIN) -> DataFrame:
    """groups + n, low0, high0, low1, ..: of every group the value at ``position(n, p)`` of each p and the one behind it.

    NULL values are left out; a NULL group is a group; the last value has none behind it (NULL).  A group whose sketch
    missed a position is ranked anew with open brackets, so the result is exact whatever the sketch."""
    key = F.struct(*groups) if groups else F.struct(F.lit(0).alias("all"))
    values = df.select(key.alias("g"), F.col(value).cast("double").alias("v")).where(F.col("v").isNotNull())
    parts = shuffle_partitions(df.sparkSession)
    brackets = materialize(_brackets(values, probs, accuracy, margin))
    found = materialize(_found(values, brackets, probs, position, parts))
    missed = F.lit(False)
    for i, p in enumerate(probs):
        behind = position(F.col("n"), p) + 1 < F.col("n")
        missed = missed | F.col(f"low{i}").isNull() | (behind & F.col(f"high{i}").isNull())
    # a bracket that misses every wanted cell leaves no row: such groups count as missed too
    good = found.where(~missed)
    rest = materialize(brackets.join(good.select("g"), "g", "left_anti").withColumn("brackets", _open()))
    if not rest.isEmpty():
        again = values.join(rest.select("g"), "g", "left_semi")
        good = good.unionByName(_found(again, rest, probs, position, parts))
    return good.select(*[F.col(f"g.{c}").alias(c) for c in groups], *[c for c in good.columns if c != "g"])
