import gzip
import os
import zlib

import duckdb
import pytest
from pyspark.sql import functions as F

from recsmith.llm import warc
from recsmith.session import tables_folder


def pages(spark):
    big, mid = "x" * 1500, "é" * 600
    rows = [(1, "http://a/", big), (2, "http://b/", big), (2, "http://b/", big), (None, "http://c/", big), (3, None, None), (4, "", ""), (5, "http://d/\r\nX: y", "small"),
            (6, "http://e/", "small"), (7, "http://f/", mid), (8, "http://g/", mid), (9, "u", "\r\n\r\nWARC/1.1\r\n"), (None, None, None), (10, "h", "y" * 1000), (11, "h", "y" * 1000),
            (12, "h", "z" * 999), (13, "h", "z" * 999)]
    return spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("file", F.lit("clash")).withColumn("nth", F.lit(0))


def through(spark, df, folder, **limits):
    written = warc.materialize(warc.write_archives(df, f"{folder}/whole", **limits))
    done = warc.materialize(warc.normalise(warc.revisits(written), f"{folder}/whole", f"{folder}/members"))
    return warc.read_archives(done, f"{folder}/members")


def test_equals_sql(spark, small):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM read_parquet('{small}/pages.parquet')")
    cols = "page_id, payload_bytes, payload_digest, record_type, refers_to"
    want = sorted(con.sql(f"SELECT {cols} FROM ({warc.ORACLE})").fetchall(), key=str)
    assert sorted(map(tuple, warc.op1_warc(spark, small).collect()), key=str) == want


@pytest.mark.parametrize("limits", [{}, {"file_records": 3}])
def test_odd_pages(spark, tmp_path, limits):
    got = through(spark, pages(spark), f"file://{tmp_path}", **limits).collect()
    assert len(got) == 16
    kinds = sorted(((r["page_id"], r["record_type"], r["refers_to"], r["payload_bytes"]) for r in got), key=str)
    assert kinds == sorted([
        (1, "revisit", 2, 1500), (2, "response", None, 1500), (2, "revisit", 2, 1500), (None, "revisit", 2, 1500), (3, "response", None, 0), (4, "response", None, 0),
        (5, "response", None, 5), (6, "response", None, 5), (7, "revisit", 8, 1200), (8, "response", None, 1200), (9, "response", None, 14), (None, "response", None, 0),
        (10, "revisit", 11, 1000), (11, "response", None, 1000), (12, "response", None, 999), (13, "response", None, 999)], key=str)
    con = duckdb.connect()
    con.register("pages", pages(spark).toArrow())
    assert sorted(map(tuple, got), key=str) == sorted(con.sql(warc.ORACLE).fetchall(), key=str)
    for name in os.listdir(tmp_path / "members"):
        if name.endswith(".warc.gz"):
            data = (tmp_path / "members" / name).read_bytes()
            index = [line.split("\t") for line in (tmp_path / "members" / f"{name}.idx").read_text().splitlines()]
            parts = [data[int(o):int(o) + int(n)] for o, n, *_ in index]
            assert b"".join(parts) == data  # one member a record, nothing between
            assert all(gzip.decompress(p).startswith(b"WARC/1.1\r\n") for p in parts)
            whole = gzip.decompress((tmp_path / "whole" / name).read_bytes())
            assert (tmp_path / "whole" / name).read_bytes().count(b"\x1f\x8b\x08") < len(index) or len(index) == 1
            assert whole.count(b"WARC/1.1\r\n") >= len(index)


def test_scratch_goes_with_the_stored_tables(spark):
    assert warc.scratch_folder(spark).startswith(tables_folder(spark))


def test_empty(spark, tmp_path):
    assert through(spark, pages(spark).where("false"), f"file://{tmp_path}").count() == 0


def test_streams_of_one_and_many_members():
    recs = [warc.record([("WARC-Type", "resource")], bytes([i]) * (i * 50_000)) for i in range(6)]
    one, many = gzip.compress(b"".join(recs)), b"".join(map(gzip.compress, recs))
    for data in (one, many):
        chunks = (data[i:i + 97] for i in range(0, len(data), 97))
        assert [b for _, b in warc.records(warc.inflated(chunks))] == [bytes([i]) * (i * 50_000) for i in range(6)]
    for bad in (one[:-20], gzip.compress(b"".join(recs)[:-30]), gzip.compress(b"no record\r\n\r\n")):
        with pytest.raises((ValueError, zlib.error)):
            list(warc.records(warc.inflated(iter([bad]))))
