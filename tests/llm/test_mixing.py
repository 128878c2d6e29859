import duckdb
import pytest
from pyspark.sql import functions as F

from recsmith.llm import mixing


def oracle(con, docs):
    con.register("documents", docs)
    return sorted(map(tuple, con.sql(f"SELECT doc_id, size, source_size, target, taken, copies FROM ({mixing.oracle()})").fetchall()), key=str)


def rows(df):
    return sorted(map(tuple, df.select("doc_id", "size", "source_size", "target", "taken", "copies").collect()), key=str)


def test_equals_one_ordered_pass(spark, small):
    got = rows(mixing.op4_mixing(spark, small))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{small}/documents.parquet')")
    want = sorted(map(tuple, con.sql(f"SELECT doc_id, size, source_size, target, taken, copies FROM ({mixing.oracle()})").fetchall()), key=str)
    assert got == want


def test_many_sources_by_shuffle(spark, odd_docs, monkeypatch):
    want = rows(mixing.mix(odd_docs))
    monkeypatch.setattr(mixing, "BROADCAST_SOURCES", 0)
    assert rows(mixing.mix(odd_docs)) == want


def test_odd_rows(spark, odd_docs):
    got = rows(mixing.mix(odd_docs))
    want = oracle(duckdb.connect(), odd_docs.select("doc_id", "text", "source").toArrow())
    assert got == want
    assert len(got) == odd_docs.count()
    assert all(r[4] <= 2 * r[1] for r in got)


def test_targets_and_nesting(spark):
    docs = spark.range(3000).select(
        F.col("id").alias("doc_id"), F.repeat(F.lit("w "), (F.col("id") % 37 + 1).cast("int")).alias("text"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("s"), F.col("id") % 5)).alias("source"))
    low, high = mixing.mix(docs, share=0.6), mixing.mix(docs, share=1.5)
    for df in (low, high):
        per = df.groupBy("source_size").agg(F.sum("taken").alias("t"), F.first("target").alias("g")).collect()
        assert all(abs(r["t"] - r["g"]) <= 37 for r in per)
    both = low.select("doc_id", F.col("copies").alias("a")).join(high.select("doc_id", F.col("copies").alias("b")), "doc_id")
    assert both.where("a > b").count() == 0  # a larger budget only adds
    assert rows(high) == rows(mixing.mix(docs.repartition(7)))


@pytest.mark.parametrize("doc_id", ["0", "NULL"])
@pytest.mark.parametrize("few", [100_000, 0])
def test_a_third_under_one_id(spark, monkeypatch, doc_id, few):
    """A third of all rows are one repeated row, and another third different texts of that id: the targets are still met."""
    monkeypatch.setattr(mixing, "BROADCAST_SOURCES", few)
    docs = spark.range(600).select(
        F.expr(f"CASE WHEN id % 3 < 2 THEN {doc_id} ELSE id END").cast("long").alias("doc_id"),
        F.when(F.col("id") % 3 == 0, F.repeat(F.lit("w "), 33)).otherwise(
            F.concat(F.repeat(F.lit("w "), (F.col("id") % 20 + 1).cast("int")), F.col("id").cast("string"))).alias("text"),
        F.lit("s").alias("source"))
    for share in (0.3, 0.77, 1.5, 1.9):
        got = mixing.mix(docs, share=share).agg(F.sum("taken").alias("t"), F.max("target").alias("g"), F.count("*").alias("n")).first()
        assert got["n"] == 600 and abs(got["t"] - got["g"]) <= 17
    got = rows(mixing.mix(docs, keep=("text",)))
    assert got == oracle(duckdb.connect(), docs.toArrow())


def test_only_equal_rows(spark):
    docs = spark.range(1000).select(F.lit(7).cast("long").alias("doc_id"), F.lit("a b c").alias("text"), F.lit("s").alias("source"))
    got = mixing.mix(docs, share=0.5).groupBy("copies").count().collect()
    assert sorted(map(tuple, got)) == [(0, 500), (1, 500)]


def test_water_filling(spark):
    sizes = spark.createDataFrame([("a", 10), ("b", 100), ("c", 50), (None, 40)], "source string, size long")
    got = {r["source"]: r["target"] for r in mixing.source_targets(sizes).collect()}
    # 300 to deal by 5:2:1:5; a stops at 20, NULL at 80; the other 200 by 2:1 would be 133 and 67
    assert got["a"] == 20 and got[None] == 80
    assert got["b"] == pytest.approx(400 / 3) and got["c"] == pytest.approx(200 / 3)


def test_empty(spark, no_docs):
    assert mixing.mix(no_docs).count() == 0
