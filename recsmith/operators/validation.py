"""Data validation (V1-V12): statistics, schema inference, rule checks, drift.

A schema is a small DataFrame (one row per column); rules are compiled into one
aggregate with a conditional count per rule, so validating a table is a single
scan whatever the number of rules.
"""

from __future__ import annotations

import logging
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

log = logging.getLogger(__name__)

NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)

# Fixed rule presets of the reference validator (column, kind, parameter).
INTERACTION_RULES = [
    ("user_id", "presence_required", None),
    ("item_id", "presence_required", None),
    ("interaction_type", "allowed_values", ["view", "like", "watch", "purchase", "share"]),
    ("rating", "min_value", 1.0),
    ("rating", "max_value", 5.0),
]
USER_RULES = [
    ("user_id", "presence_required", None),
    ("age_group", "allowed_values", ["18-24", "25-34", "35-44", "45-54", "55-64", "65+"]),
    ("gender", "allowed_values", ["M", "F", "Other"]),
    ("subscription_type", "allowed_values", ["free", "premium"]),
]
ITEM_RULES = [
    ("item_id", "presence_required", None),
    ("popularity_score", "min_value", 0.0),
    ("popularity_score", "max_value", 1.0),
    ("quality_score", "min_value", 0.0),
    ("quality_score", "max_value", 1.0),
    ("price", "min_value", 0.0),
    ("rating_avg", "min_value", 0.0),
    ("rating_avg", "max_value", 5.0),
]
PRESETS = {"interactions": INTERACTION_RULES, "users": USER_RULES, "items": ITEM_RULES}


def _is_numeric(df: DataFrame, col: str) -> bool:
    return isinstance(df.schema[col].dataType, NUMERIC)


def column_statistics(df: DataFrame, exact_distinct: list[str] = ()) -> DataFrame:
    """V1: one row per column: type, rows, nulls, distinct values, numeric min/max/mean/std and zeros,
    string length min/max.  One aggregate over the table.

    Distinct counts are sketches (as the reference's are); columns in ``exact_distinct`` are counted exactly by
    a second, two-level aggregation.
    """
    aggs, entries = [F.count(F.lit(1)).alias("n_rows")], []
    for i, f in enumerate(df.schema.fields):
        c = F.col(f"`{f.name}`")
        num = isinstance(f.dataType, NUMERIC)
        s = f"s{i}"
        aggs += [F.count(c).alias(f"{s}_nn"), F.approx_count_distinct(c).alias(f"{s}_nd")]
        if num:
            aggs += [F.min(c).cast("double").alias(f"{s}_min"), F.max(c).cast("double").alias(f"{s}_max"),
                     F.avg(c).alias(f"{s}_mean"), F.stddev_pop(c).alias(f"{s}_std"), F.count(F.when(c == 0, 1)).alias(f"{s}_z")]
        else:
            aggs += [F.lit(None).cast("double").alias(f"{s}_{m}") for m in ("min", "max", "mean", "std")]
            aggs += [F.lit(None).cast("long").alias(f"{s}_z")]
        if isinstance(f.dataType, T.StringType):
            aggs += [F.min(F.length(c)).cast("long").alias(f"{s}_lmin"), F.max(F.length(c)).cast("long").alias(f"{s}_lmax")]
        else:
            aggs += [F.lit(None).cast("long").alias(f"{s}_lmin"), F.lit(None).cast("long").alias(f"{s}_lmax")]
        entries.append(f"'{f.name}', '{f.dataType.simpleString()}', n_rows - {s}_nn, {s}_nd, "
                       f"{s}_min, {s}_max, {s}_mean, {s}_std, {s}_z, {s}_lmin, {s}_lmax")
    out = df.agg(*aggs).selectExpr("n_rows", f"stack({len(entries)}, {', '.join(entries)}) AS "
                                   "(column, dtype, n_null, n_distinct, min, max, mean, std, n_zero, min_length, max_length)")
    if not exact_distinct:
        return out
    exact = (column_values(df, list(exact_distinct)).groupBy(F.col("column").alias("_c"))
             .agg(F.count(F.lit(1)).alias("_n")))
    return (out.join(exact, F.col("column") == F.col("_c"), "left")
            .withColumn("n_distinct", F.when(F.col("column").isin(list(exact_distinct)), F.coalesce("_n", F.lit(0)))
                        .otherwise(F.col("n_distinct"))).drop("_c", "_n"))


def column_values(df: DataFrame, cols: list[str]) -> DataFrame:
    """The distinct non-null values of several columns as text, long form (column, value), any number of them."""
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").cast("string").alias("value")) for c in cols]))
    return df.select(pairs.alias("p")).select("p.column", "p.value").where(F.col("value").isNotNull()).distinct()


def numeric_histogram(df: DataFrame, cols: list[str], bins: int = 10) -> DataFrame:
    """V1: equal-width histogram of numeric columns between their minimum and maximum: (column, bin from 0, n), occupied bins only."""
    ends = df.agg(*[F.min(c).cast("double").alias(f"lo{i}") for i, c in enumerate(cols)],
                  *[F.max(c).cast("double").alias(f"hi{i}") for i, c in enumerate(cols)])
    cells = []
    for i, c in enumerate(cols):
        x, lo, hi = F.col(c).cast("double"), F.col(f"lo{i}"), F.col(f"hi{i}")
        place = F.when(hi == lo, F.lit(0)).otherwise(F.least(F.floor((x - lo) / (hi - lo) * bins), F.lit(bins - 1)))
        cells.append(F.struct(F.lit(c).alias("column"), place.cast("int").alias("bin")))
    rows = df.select(*cols).crossJoin(F.broadcast(ends)).select(F.explode(F.array(*cells)).alias("c"))  # one row of ends
    return rows.select("c.column", "c.bin").where(F.col("bin").isNotNull()).groupBy("column", "bin").agg(F.count(F.lit(1)).alias("n"))


def quantile_sketch(df: DataFrame, cols: list[str], probs=(0.0, 0.25, 0.5, 0.75, 1.0), accuracy: int = 10_000) -> DataFrame:
    """V1: approximate quantiles (values of the column, rank error at most n/accuracy): (column, q, value)."""
    one = df.agg(*[F.percentile_approx(F.col(c).cast("double"), list(probs), accuracy).alias(f"q{i}") for i, c in enumerate(cols)])
    cells = [F.struct(F.lit(c).alias("column"), F.lit(float(p)).alias("q"), F.col(f"q{i}")[k].alias("value"))
             for i, c in enumerate(cols) for k, p in enumerate(probs)]
    return one.select(F.explode(F.array(*cells)).alias("c")).select("c.*")


def top_values(df: DataFrame, col: str, n: int = 10) -> DataFrame:
    """V1: the ``n`` most frequent values of a column with counts (a top-k report), ties by value."""
    counts = df.where(F.col(col).isNotNull()).groupBy(F.col(col).cast("string").alias("value")) \
               .agg(F.count(F.lit(1)).alias("count"))
    return counts.orderBy(F.col("count").desc(), F.col("value").asc()).limit(n) \
                 .select(F.lit(col).alias("column"), "value", "count")


def infer_schema(df: DataFrame) -> DataFrame:
    """V2: (column, dtype, required, min, max) from statistics; ``infer_domains`` has the value sets."""
    stats = column_statistics(df)
    return stats.select("column", "dtype", (F.col("n_null") == 0).alias("required"), "min", "max")


def infer_domains(df: DataFrame) -> DataFrame:
    """V2: the value sets of the string columns in long form (column, value), whatever their size."""
    return column_values(df, [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)])


def update_schema(schema: DataFrame, df: DataFrame) -> DataFrame:
    """V4: widen a schema with new data: outer bounds, presence kept only if required in both."""
    o, n = schema.alias("o"), infer_schema(df).alias("n")
    return o.join(n, "column", "full_outer").select(
        "column", F.coalesce("o.dtype", "n.dtype").alias("dtype"),
        (F.coalesce("o.required", F.lit(True)) & F.coalesce("n.required", F.lit(True))).alias("required"),
        F.least("o.min", "n.min").alias("min"), F.greatest("o.max", "n.max").alias("max"))


def update_domains(domains: DataFrame, df: DataFrame) -> DataFrame:
    """V4: the union of value sets."""
    return domains.unionByName(infer_domains(df)).distinct()


def domain_violations(df: DataFrame, domains: DataFrame) -> DataFrame:
    """V3 for inferred value sets of any size: (column, rule, n_bad, n_rows, fraction), one row per column with a domain.

    Values are counted first (combined on the map side), so only distinct values meet the domain table."""
    cols = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").alias("value")) for c in cols]))
    counts = df.select(pairs.alias("p")).select("p.*").groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
    known = domains.select(F.col("column").alias("_c"), F.col("value").alias("_v"), F.lit(True).alias("_known"))
    has = domains.select("column").distinct()
    met = counts.join(known, (F.col("column") == F.col("_c")) & (F.col("value") == F.col("_v")), "left").join(has, "column", "left_semi")
    bad = F.col("value").isNotNull() & F.col("_known").isNull()
    out = met.groupBy("column").agg(F.coalesce(F.sum(F.when(bad, F.col("n"))), F.lit(0)).alias("n_bad"), F.sum("n").alias("n_rows"))
    return out.select("column", F.lit("domain").alias("rule"), "n_bad", "n_rows", (F.col("n_bad") / F.col("n_rows")).alias("fraction"))


def schema_rules(schema: DataFrame) -> list[tuple]:
    """Rules implied by an inferred schema (presence, numeric bounds); value sets are checked by ``domain_violations``."""
    rules = []
    for r in schema.collect():  # one row per column: bounded by the table's width
        if r["required"]:
            rules.append((r["column"], "presence_required", None))
        if r["min"] is not None:
            rules.append((r["column"], "min_value", r["min"]))
        if r["max"] is not None:
            rules.append((r["column"], "max_value", r["max"]))
    return rules


def baseline_rules(schema: DataFrame, constraints: list[tuple]) -> list[tuple]:
    """V5: schema rules overridden by explicit constraints per (column, kind)."""
    override = {(c, k) for c, k, _ in constraints}
    return [r for r in schema_rules(schema) if (r[0], r[1]) not in override] + list(constraints)


def _bad(df: DataFrame, col: str, kind: str, param):
    c = F.col(f"`{col}`")
    if kind == "presence_required":
        return c.isNull() if param in (None, True, 1.0) else F.lit(False)
    if kind == "allowed_values":
        return c.isNotNull() & ~c.cast("string").isin(list(param))
    if kind == "domain":  # a list of values, or the bounds (min, max) of a number with None for an open end
        if isinstance(param, tuple):
            low, high = ((F.lit(False) if p is None else None) for p in param)
            x = c.cast("double")
            low = (x < F.lit(float(param[0]))) if low is None else low
            high = (x > F.lit(float(param[1]))) if high is None else high
            return c.isNotNull() & (low | high)
        return c.isNotNull() & ~c.cast("string").isin(list(param))
    if kind == "min_value":
        return c.isNotNull() & (c.cast("double") < F.lit(float(param)))
    if kind == "max_value":
        return c.isNotNull() & (c.cast("double") > F.lit(float(param)))
    raise ValueError(f"unknown rule kind {kind}")


def validate(df: DataFrame, rules: list[tuple]) -> DataFrame:
    """V3/V6: one row per applicable rule: (column, rule, n_bad, n_rows, fraction).

    Rules on absent columns are skipped with a warning.  The table is valid iff
    every ``n_bad`` is 0 (see ``anomalies`` / ``require_valid``).
    """
    usable = []
    for col, kind, param in rules:
        if col not in df.columns:
            log.warning("validation: column %s not in data, rule %s skipped", col, kind)
            continue
        usable.append((col, kind, param))
    if not usable:
        return df.sparkSession.createDataFrame([], "column string, rule string, n_bad long, n_rows long, fraction double")
    aggs = [F.count(F.lit(1)).alias("n_rows")]
    entries = []
    for i, (col, kind, param) in enumerate(usable):
        aggs.append(F.count(F.when(_bad(df, col, kind, param), 1)).alias(f"r{i}"))
        entries.append(f"'{col}', '{kind}', r{i}")
    one = df.agg(*aggs)
    out = one.selectExpr("n_rows", f"stack({len(entries)}, {', '.join(entries)}) AS (column, rule, n_bad)")
    return out.select("column", "rule", "n_bad", "n_rows",
                      F.coalesce(F.try_divide(F.col("n_bad").cast("double"), F.col("n_rows").cast("double")),
                                 F.lit(0.0)).alias("fraction"))


def anomalies(result: DataFrame) -> DataFrame:
    return result.where(F.col("n_bad") > 0)


def validate_preset(df: DataFrame, dataset: str) -> DataFrame:
    """V7-V9: the reference's rule set for interactions, users or items."""
    return validate(df, PRESETS[dataset])


def validation_report(results: dict[str, DataFrame]) -> DataFrame:
    """Per dataset: number of rules, number of anomalies, the failing rules."""
    tagged = [r.withColumn("dataset", F.lit(name)) for name, r in results.items()]
    allr = reduce(DataFrame.unionByName, tagged)
    return allr.groupBy("dataset").agg(
        F.count(F.lit(1)).alias("n_rules"),
        F.count(F.when(F.col("n_bad") > 0, 1)).alias("n_anomalies"),
        F.array_sort(F.collect_list(F.when(F.col("n_bad") > 0, F.concat_ws(":", "column", "rule"))))
         .alias("anomalies"),
        (F.count(F.when(F.col("n_bad") > 0, 1)) == 0).alias("is_valid"))


class ValidationError(RuntimeError):
    pass


def require_valid(result: DataFrame) -> None:
    """Stop the pipeline when any rule fails (reads a handful of rule rows)."""
    bad = anomalies(result).select("column", "rule", "n_bad").collect()
    if bad:
        raise ValidationError("; ".join(f"{r['column']}:{r['rule']}={r['n_bad']}" for r in bad))


def quarantine(df: DataFrame, rules: list[tuple]) -> tuple[DataFrame, DataFrame]:
    """V11 row-level: (valid rows, rows breaking any rule) by one predicate."""
    conds = [_bad(df, c, k, p) for c, k, p in rules if c in df.columns]
    bad = reduce(lambda a, b: a | b, conds) if conds else F.lit(False)
    flagged = df.withColumn("_bad", F.coalesce(bad, F.lit(False)))
    return flagged.where(~F.col("_bad")).drop("_bad"), flagged.where(F.col("_bad")).drop("_bad")


def categorical_drift(baseline: DataFrame, current: DataFrame, col: str) -> DataFrame:
    """V12 categorical: L-infinity distance between the value shares (full outer join)."""
    def shares(df):
        c = df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("n"))
        return c.withColumn("p", F.col("n") / c.select(F.sum("n")).scalar()).select(col, "p")
    b, c = shares(baseline).withColumnRenamed("p", "p_base"), shares(current).withColumnRenamed("p", "p_cur")
    j = b.join(c, col, "full_outer")
    return j.agg(F.max(F.abs(F.coalesce("p_base", F.lit(0.0)) - F.coalesce("p_cur", F.lit(0.0))))
                 .alias("linf_distance")).select(F.lit(col).alias("column"), "linf_distance")


def numeric_drift(baseline: DataFrame, current: DataFrame, col: str, bins: int = 10) -> DataFrame:
    """V12 numeric: Jensen-Shannon divergence (log base 2) of histograms on a common range."""
    both = baseline.select(col).unionByName(current.select(col))
    lo = both.select(F.min(col).cast("double")).scalar()
    hi = both.select(F.max(col).cast("double")).scalar()

    def hist(df, name):
        x = F.col(col).cast("double")
        b = F.when(hi == lo, F.lit(0)).otherwise(
            F.least(F.floor((x - lo) / (hi - lo) * bins), F.lit(bins - 1))).cast("int")
        h = (df.where(F.col(col).isNotNull()).select(b.alias("bin"))
               .groupBy("bin").agg(F.count(F.lit(1)).alias("n")))
        return h.withColumn(name, F.col("n") / h.select(F.sum("n")).scalar()).select("bin", name)

    j = hist(baseline, "p").join(hist(current, "q"), "bin", "full_outer").fillna(0.0, subset=["p", "q"])
    m = (F.col("p") + F.col("q")) / 2
    kl_p = F.when(F.col("p") > 0, F.col("p") * F.log2(F.col("p") / m)).otherwise(F.lit(0.0))
    kl_q = F.when(F.col("q") > 0, F.col("q") * F.log2(F.col("q") / m)).otherwise(F.lit(0.0))
    return j.agg((F.sum(kl_p) * 0.5 + F.sum(kl_q) * 0.5).alias("js_divergence")) \
            .select(F.lit(col).alias("column"), "js_divergence")
