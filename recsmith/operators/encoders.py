"""Fitted encoders and scalers (P4-P7, S5) as DataFrame joins and scalar subqueries.

A fitted encoder is a small lookup table (value, code) that can be written as
Parquet and joined back; nothing is pulled into the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recsmith.functions.columns import UNKNOWN
from recsmith.operators.split import with_global_index


def fit_label_encoder(df: DataFrame, col: str, fill: str | None = UNKNOWN) -> DataFrame:
    """P5: code = position of the value among the sorted distinct values, from 0.

    Values sort in their own type (numbers numerically, strings by code point).

    Returns the lookup table (value, code).  Positions come from the distributed
    global index, so a high-cardinality column (user ids) needs no single task.
    """
    v = F.coalesce(F.col(col), F.lit(fill)) if fill is not None else F.col(col)
    values = df.select(v.alias("value")).distinct()
    if fill is None:
        values = values.where(F.col("value").isNotNull())
    return with_global_index(values, [F.col("value").asc()], "code")


def apply_label_encoder(df: DataFrame, col: str, lookup: DataFrame, out_col: str | None = None,
                        fill: str | None = UNKNOWN) -> DataFrame:
    """Join the codes back; an unseen value raises at run time (as the reference's encoder)."""
    out_col = out_col or f"{col}_encoded"
    key = F.coalesce(F.col(col), F.lit(fill)) if fill is not None else F.col(col)
    tagged = df.withColumn("_enc_key", key)
    joined = tagged.join(lookup.select(F.col("value").alias("_enc_key"), F.col("code").alias(out_col)),
                         "_enc_key", "left")
    checked = joined.withColumn(
        out_col, F.when(F.col(out_col).isNotNull() | F.col("_enc_key").isNull(), F.col(out_col))
                  .otherwise(F.raise_error(F.concat(F.lit(f"unseen label in {col}: "),
                                                    F.col("_enc_key").cast("string")))
                             .cast("long")))
    return checked.drop("_enc_key")


def label_encode(df: DataFrame, col: str, out_col: str | None = None, fill: str | None = UNKNOWN) -> DataFrame:
    """Fit on ``df`` and transform it (the reference's ``fit_transform``)."""
    return apply_label_encoder(df, col, fit_label_encoder(df, col, fill), out_col, fill)


def fit_label_encoders(df: DataFrame, cols: list[str], fill: str | None = UNKNOWN) -> DataFrame:
    """P5 for several string columns in one pass: lookup (column, value, code).

    The distinct (column, value) pairs are range sorted and numbered; a value's code is its index minus its
    column's first index.
    """
    return number_labels(label_values(df, cols, fill))


def label_values(df: DataFrame, cols: list[str], fill: str | None = UNKNOWN) -> DataFrame:
    """The distinct (column, value) pairs of several columns, in one scan."""
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("column"),
                                         (F.coalesce(F.col(c).cast("string"), F.lit(fill)) if fill is not None
                                          else F.col(c).cast("string")).alias("value")) for c in cols]))
    values = df.select(pairs.alias("p")).select("p.column", "p.value").distinct()
    return values if fill is not None else values.where(F.col("value").isNotNull())


def number_labels(values: DataFrame) -> DataFrame:
    """Lookup (column, value, code) of distinct (column, value) pairs."""
    idx = with_global_index(values, [F.col("column").asc(), F.col("value").asc()], "_i")
    first = idx.groupBy(F.col("column").alias("_c")).agg(F.min("_i").alias("_first"))
    return (idx.join(first, idx.column == first._c)
               .select("column", "value", (F.col("_i") - F.col("_first")).alias("code")))


def apply_label_encoders(df: DataFrame, cols: list[str], lookup: DataFrame, fill: str | None = UNKNOWN,
                         suffix: str = "_encoded") -> DataFrame:
    """Attach ``<col>_encoded`` for each column from a combined lookup; an unseen value raises at run time.

    Meant for dimension tables: a fact table would be shuffled on keys with few values."""
    out = df
    for c in cols:
        one = lookup.where(F.col("column") == c).select(F.col("value").alias("_v"), F.col("code").alias("_code"))
        key = F.coalesce(F.col(c).cast("string"), F.lit(fill)) if fill is not None else F.col(c).cast("string")
        unseen = F.raise_error(F.concat(F.lit(f"unseen label in {c}: "), F.col("_k"))).cast("long")
        out = (out.withColumn("_k", key).join(one, F.col("_k") == F.col("_v"), "left")
               .withColumn(c + suffix, F.when(F.col("_code").isNotNull() | F.col("_k").isNull(), F.col("_code")).otherwise(unseen))
               .drop("_k", "_v", "_code"))
    return out


def code_of(lookup: DataFrame, column: str, value: str):
    """The code of one value as a scalar (NULL if it was never fitted)."""
    return lookup.where((F.col("column") == column) & (F.col("value") == value)).select(F.max("code")).scalar()


def fit_standard_scaler(df: DataFrame, cols: list[str]) -> DataFrame:
    """P6 state: one row of mean and population std per column (NULLs ignored)."""
    aggs = []
    for c in cols:
        aggs += [F.avg(c).alias(f"{c}__mean"), F.stddev_pop(c).alias(f"{c}__std")]
    return df.agg(*aggs)


def standard_scale(df: DataFrame, cols: list[str], suffix: str = "", state: DataFrame | None = None) -> DataFrame:
    """(x - mean) / population std; a constant column gives 0 (as the reference's scaler)."""
    state = state if state is not None else fit_standard_scaler(df, cols)
    out = df.crossJoin(F.broadcast(state))  # one row of fitted means and stds
    for c in cols:
        mean, std = F.col(f"{c}__mean"), F.col(f"{c}__std")
        out = out.withColumn(c + suffix, F.when(std == 0, F.col(c) - F.col(c))
                                          .otherwise((F.col(c) - mean) / std).cast("double"))
    return out.drop(*[f"{c}__mean" for c in cols], *[f"{c}__std" for c in cols])


def min_max_scale(df: DataFrame, cols: list[str], suffix: str = "") -> DataFrame:
    """(x - min) / (max - min); a constant column gives 0."""
    bounds = df.agg(*[F.min(c).alias(f"_lo_{i}") for i, c in enumerate(cols)],
                    *[F.max(c).alias(f"_hi_{i}") for i, c in enumerate(cols)])
    out = df.crossJoin(F.broadcast(bounds))  # one row
    for i, c in enumerate(cols):
        lo, hi = F.col(f"_lo_{i}"), F.col(f"_hi_{i}")
        out = out.withColumn(c + suffix, F.when(hi == lo, F.col(c) - F.col(c))
                                          .otherwise((F.col(c) - lo) / (hi - lo)).cast("double"))
    return out.drop(*[f"_lo_{i}" for i in range(len(cols))], *[f"_hi_{i}" for i in range(len(cols))])


def fill_missing(df: DataFrame, values: dict) -> DataFrame:
    """Per-column constants; the string 'mean' fills with the column mean."""
    out = df
    for c, v in values.items():
        if v == "mean":
            out = out.withColumn(c, F.coalesce(F.col(c), df.select(F.avg(c)).scalar()))
        else:
            out = out.withColumn(c, F.coalesce(F.col(c), F.lit(v)))
    return out


def save_lookup(lookup: DataFrame, path: str) -> None:
    """Fitted state as a Parquet table."""
    lookup.write.mode("overwrite").parquet(path)


def save_fitted(fitted: dict, path: str) -> None:
    """A fitted feature transform (encoder lookup + scaler state + column lists) as tables."""
    from pyspark.sql import SparkSession
    spark = SparkSession.getActiveSession()
    if fitted.get("lookup") is not None:
        fitted["lookup"].write.mode("overwrite").parquet(f"{path}/lookup")
    fitted["scaler"].write.mode("overwrite").parquet(f"{path}/scaler")
    spark.createDataFrame([(",".join(fitted["cat"]), ",".join(fitted["num"]))], "cat string, num string") \
         .write.mode("overwrite").json(f"{path}/columns")


def load_fitted(spark, path: str) -> dict:
    cols = spark.read.json(f"{path}/columns").first()
    cat = [c for c in (cols["cat"] or "").split(",") if c]
    num = [c for c in (cols["num"] or "").split(",") if c]
    lookup = spark.read.parquet(f"{path}/lookup") if cat else None
    return {"cat": cat, "num": num, "lookup": lookup, "scaler": spark.read.parquet(f"{path}/scaler")}
