"""A training corpus from raw documents: good text, no near copies, no secrets, mixed to target weights, as token ids.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again as the next one's
docs.  All but the last return the columns of ``documents``; each works on all that its predecessor kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recsmith.llm import bpe, mixing, quality, secret_scan, simhash
from recsmith.llm.common import read_table
from recsmith.session import materialize


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    return quality.keep_good(docs, read_table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    return simhash.drop_near_copies(docs)


def secret_redaction(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document stays; the secrets found in it are replaced."""
    return secret_scan.redact(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it: not at all, once or twice."""
    cols = tuple(docs.columns)
    taken = mixing.mix(docs.withColumn("_doc", F.struct(*cols)), keep=("_doc",)).where("copies > 0")
    return taken.select(F.explode(F.sequence(F.lit(1), F.col("copies"))), "_doc").select("_doc.*")


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every row of the mix."""
    return bpe.encode_documents(docs)


STAGES = [
    ("quality classifier", quality_filter),
    ("simhash near-dedup", near_duplicates),
    ("secret scans", secret_redaction),
    ("source mix", source_mix),
    ("bpe", token_ids),
]

#: Learned stages have no SQL form; the tests hold each stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to ``documents``, each written before the next reads it."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
