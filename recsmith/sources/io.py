"""Readers and writers (S1-S8) with explicit schemas; no inference at read time."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

USERS = T.StructType([
    T.StructField("user_id", T.StringType(), False),
    T.StructField("age_group", T.StringType()),
    T.StructField("gender", T.StringType()),
    T.StructField("location", T.StringType()),
    T.StructField("signup_date", T.DateType()),
    T.StructField("preferred_genres", T.StringType()),
    T.StructField("activity_level", T.StringType()),
    T.StructField("subscription_type", T.StringType()),
])
ITEMS = T.StructType([
    T.StructField("item_id", T.StringType(), False),
    T.StructField("title", T.StringType()),
    T.StructField("genre", T.StringType()),
    T.StructField("release_date", T.DateType()),
    T.StructField("popularity_score", T.DoubleType()),
    T.StructField("quality_score", T.DoubleType()),
    T.StructField("price", T.DoubleType()),
    T.StructField("duration_minutes", T.LongType()),
    T.StructField("language", T.StringType()),
    T.StructField("rating_avg", T.DoubleType()),
    T.StructField("rating_count", T.LongType()),
])
INTERACTIONS = T.StructType([
    T.StructField("user_id", T.StringType(), False),
    T.StructField("item_id", T.StringType(), False),
    T.StructField("interaction_type", T.StringType()),
    T.StructField("rating", T.DoubleType()),
    T.StructField("timestamp", T.StringType()),
    T.StructField("session_id", T.StringType()),
    T.StructField("device_type", T.StringType()),
    T.StructField("duration_seconds", T.LongType()),
])
REQUEST_LOG = T.StructType([
    T.StructField("key", T.StringType()),
    T.StructField("k", T.LongType()),
    T.StructField("processing_time_ms", T.DoubleType()),
    T.StructField("timestamp", T.TimestampType()),
])
SCHEMAS = {"users": USERS, "items": ITEMS, "interactions": INTERACTIONS}


def read_table(spark: SparkSession, path: str, name: str, fmt: str = "csv") -> DataFrame:
    """One of the three tables with its declared schema; ISO timestamps parsed."""
    schema = SCHEMAS[name]
    if fmt == "csv":
        df = _read_csv(spark, path, schema).drop(CORRUPT)
    else:
        df = spark.read.parquet(path)
    if name == "interactions" and isinstance(df.schema["timestamp"].dataType, T.StringType):
        df = df.withColumn("timestamp", F.to_timestamp("timestamp"))
    return df


CORRUPT = "_corrupt_record"


def _read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return (spark.read.schema(T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])).option("header", True)
            .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT).csv(path))


def corrupt_rows(spark: SparkSession, path: str, name: str) -> DataFrame:
    """Rows read and rows with values that do not parse (their unparsable values are read as NULL)."""
    df = _read_csv(spark, path, SCHEMAS[name])
    # every column is read, else its values are not parsed and cannot be found corrupt
    read = F.xxhash64(*[f.name for f in SCHEMAS[name].fields]) != F.lit(0)
    return df.agg(F.count(F.lit(1)).alias("n_rows"), F.count(F.when(F.col(CORRUPT).isNotNull() & read, 1)).alias("n_corrupt"))


def empty_table(spark: SparkSession, name: str) -> DataFrame:
    """A missing optional table is an empty DataFrame of the declared schema."""
    return spark.createDataFrame([], SCHEMAS[name])


def load_tables(spark: SparkSession, interactions_path: str, users_path: str | None = None,
                items_path: str | None = None, fmt: str = "csv") -> dict[str, DataFrame]:
    """S1 + S2: interactions required, users and items optional."""
    return {"interactions": read_table(spark, interactions_path, "interactions", fmt),
            "users": read_table(spark, users_path, "users", fmt) if users_path else empty_table(spark, "users"),
            "items": read_table(spark, items_path, "items", fmt) if items_path else empty_table(spark, "items")}


def save_features(tables: dict[str, DataFrame], out_dir: str, fmt: str = "parquet") -> None:
    """S3: each feature table under ``out_dir/<name>``."""
    for name, df in tables.items():
        df.write.mode("overwrite").format(fmt).option("header", True).save(f"{out_dir}/{name}")


def save_recommendations(recs: DataFrame, path: str) -> None:
    """One JSON line per user with the ordered item list (and the long form's scores)."""
    lists = (recs.groupBy("user_id")
                 .agg(F.sort_array(F.collect_list(F.struct("rank", "item_id"))).alias("_l"))
                 .select(F.col("user_id").cast("string").alias("user_id"), F.col("_l.item_id").alias("items")))
    lists.write.mode("overwrite").json(path)


def load_recommendations(spark: SparkSession, path: str, item_type: str = "string") -> DataFrame:
    """Lists back to the long (user_id, rank, item_id) form; also accepts one JSON
    object mapping user ids to lists (the reference's file) when ``multiLine``."""
    df = spark.read.schema(f"user_id string, items array<{item_type}>").json(path)
    return df.select("user_id", F.posexplode("items").alias("pos", "item_id")) \
             .select("user_id", (F.col("pos") + 1).cast("long").alias("rank"), "item_id")


def load_recommendation_map(spark: SparkSession, path: str) -> DataFrame:
    """S6 for a single JSON object {user_id: [item_id, ...]}."""
    raw = spark.read.text(path, wholetext=True)
    m = raw.select(F.from_json("value", "map<string,array<string>>").alias("m"))
    return (m.select(F.explode("m").alias("user_id", "items"))
             .select("user_id", F.posexplode("items").alias("pos", "item_id"))
             .select("user_id", (F.col("pos") + 1).cast("long").alias("rank"), "item_id"))


def save_metrics(metrics: DataFrame, path: str) -> None:
    """The (metric, k, value) table as JSON lines and as one CSV."""
    metrics.write.mode("overwrite").json(f"{path}/json")
    metrics.coalesce(1).write.mode("overwrite").option("header", True).csv(f"{path}/csv")


def append_request_log(spark: SparkSession, path: str, rows: DataFrame | list[tuple]) -> None:
    """Append request-log rows (key, k, processing_time_ms, timestamp): a table of any size, or a few tuples."""
    df = rows if isinstance(rows, DataFrame) else spark.createDataFrame(rows, REQUEST_LOG)
    df.select(*[F.col(f.name).cast(f.dataType) for f in REQUEST_LOG.fields]).write.mode("append").parquet(path)


def read_request_log(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(REQUEST_LOG).parquet(path)
