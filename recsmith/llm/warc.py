"""WARC archives: write, normalise from one gzip stream to one member a record, index, read back.

A crawler's archive is often one gzip stream over the whole file, which cannot be entered in the middle.  The normaliser inflates
such a stream once, from begin to end and a record at a time, rewrites every record as a gzip member of its own and
writes a sidecar index (one line a record: offset, length, type, record id).  A reader then opens any record by its offset.
Files that already have members are read just as well.

Files go through ``pyarrow.fs``, under the shared ``spark.checkpoint.dir`` or any folder that executors share.  Each is written under a
name of its attempt and then renamed, so a task that runs twice leaves one whole file.

While rewriting, records can be turned into revisits: of records with equal payloads only one keeps its payload.  Equal payloads
are found from the digests (a grouped maximum, combined on the map side), not by moving payloads.

Defined cases: NULL html is an empty payload; NULL page ids and urls leave out their header, and a NULL id never names the response when
another copy has an id; of rows that repeat id and payload one is the response; line breaks in a url are percent-encoded; payloads
below the size bound are always responses; an empty table gives an empty result; further columns are ignored.  A truncated or
malformed archive raises ValueError.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recsmith.llm.common import read_table
from recsmith.session import materialize, tables_folder

MIN_REVISIT_BYTES = 1000
FILE_BYTES, FILE_RECORDS = 64 << 20, 20_000  # an archive is closed at about this size
LEVEL = 6
DATE = "1970-01-01T00:00:00Z"  # the tables have no crawl time, and reruns must agree
_READ = 1 << 20


def _open_folder(folder: str):
    from pyarrow import fs
    store, root = fs.FileSystem.from_uri(folder)
    return store, root.rstrip("/")


def scratch_folder(spark: SparkSession) -> str:
    """A new folder for archives; it goes when the application's stored tables do (``drop_materialized``)."""
    return f"{tables_folder(spark)}/warc/{uuid.uuid4().hex}"


class _Out:
    """A file that gets its name only when it is whole."""

    def __init__(self, folder: str, name: str):
        self.store, root = _open_folder(folder)
        self.store.create_dir(root, recursive=True)
        self.temp, self.path = f"{root}/.{name}.{uuid.uuid4().hex}", f"{root}/{name}"
        self.file, self.size = self.store.open_output_stream(self.temp, compression=None), 0

    def write(self, data: bytes) -> None:
        self.file.write(data)
        self.size += len(data)

    def close(self) -> None:
        self.file.close()
        self.store.move(self.temp, self.path)


def record(headers: list[tuple[str, str]], block: bytes) -> bytes:
    lines = "".join(f"{k}: {v}\r\n" for k, v in [*headers, ("Content-Length", str(len(block)))])
    return f"WARC/1.1\r\n{lines}\r\n".encode("utf-8") + block + b"\r\n\r\n"


def record_id(file: str, nth: int) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{file}#{nth}')}>"


def digest_header(hexed: str) -> str:
    return "sha1:" + base64.b32encode(bytes.fromhex(hexed)).decode()


def _http(n: int) -> bytes:
    return f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {n}\r\n\r\n".encode()


def inflated(chunks: Iterator[bytes]) -> Iterator[bytes]:
    """The plain bytes of a gzip stream of one or many members."""
    z = zlib.decompressobj(wbits=31)
    begun = False
    for data in chunks:
        while data:
            if z.eof:
                z = zlib.decompressobj(wbits=31)
            out = z.decompress(data, _READ)
            begun = True
            data = z.unused_data if z.eof else z.unconsumed_tail
            if out:
                yield out
    if begun and not z.eof:
        raise ValueError("the gzip stream ends early")


def records(plain: Iterator[bytes]) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, block) of each record of an inflated archive, holding one record at a time."""
    buf = bytearray()

    def more() -> bool:
        chunk = next(plain, None)
        if chunk is not None:
            buf.extend(chunk)
        return chunk is not None

    while True:
        seen = 0
        while (end := buf.find(b"\r\n\r\n", max(0, seen - 3))) < 0:
            seen = len(buf)
            if not more():
                if buf.strip():
                    raise ValueError("the archive ends inside a record header")
                return
        first, *lines = bytes(buf[:end]).decode("utf-8").split("\r\n")
        if not first.startswith("WARC/"):
            raise ValueError(f"not a record: {first[:40]!r}")
        headers = {k.lower(): v.strip() for k, v in (x.split(":", 1) for x in lines)}
        n = int(headers["content-length"])
        while len(buf) < end + 4 + n + 4:
            if not more():
                raise ValueError("the archive ends inside a record")
        block = bytes(buf[end + 4:end + 4 + n])
        if buf[end + 4 + n:end + 8 + n] != b"\r\n\r\n":
            raise ValueError("a record is longer than it says")
        del buf[:end + 8 + n]
        yield headers, block


def _chunks(file) -> Iterator[bytes]:
    while data := file.read(_READ):
        yield data


def write_archives(pages: DataFrame, folder: str, file_bytes: int = FILE_BYTES, file_records: int = FILE_RECORDS) -> DataFrame:
    """pages (page_id, url, html, ..) -> archives of one gzip stream each in ``folder``, and a row per record:
    page_id, file, nth, payload_bytes, payload_digest.  The rows are to be stored once: evaluating them writes the files."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, out, z, count, made = TaskContext.get().partitionId(), None, None, 0, 0
        for b in batches:
            rows = []
            for page, url, html in zip(*(b.column(i).to_pylist() for i in range(3))):
                if out is None:
                    name = f"part-{part:06d}-{made:05d}.warc.gz"
                    out, z, count, made = _Out(folder, name), zlib.compressobj(LEVEL, zlib.DEFLATED, 31), 0, made + 1
                body = (html or "").encode("utf-8")
                hexed = hashlib.sha1(body).hexdigest()
                head = [("WARC-Type", "response"), ("WARC-Record-ID", record_id(name, count)), ("WARC-Date", DATE)]
                head += [("WARC-Target-URI", re.sub(r"[\x00-\x1f\x7f]", lambda m: f"%{ord(m[0]):02X}", url or ""))] * (url is not None)
                head += [("X-Page-Id", str(page))] * (page is not None)
                head += [("Content-Type", "application/http; msgtype=response"), ("WARC-Payload-Digest", digest_header(hexed))]
                out.write(z.compress(record(head, _http(len(body)) + body)))
                rows.append((page, name, count, len(body), hexed))
                count += 1
                if out.size >= file_bytes or count >= file_records:
                    out.write(z.flush())
                    out.close()
                    out = None
            if rows:
                cols = list(zip(*rows))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string()))],
                                                 names=["page_id", "file", "nth", "payload_bytes", "payload_digest"])
        if out is not None:
            out.write(z.flush())
            out.close()

    return pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html")).mapInArrow(
        run, "page_id long, file string, nth long, payload_bytes long, payload_digest string")


def revisits(written: DataFrame, least: int = MIN_REVISIT_BYTES) -> DataFrame:
    """Rows of write_archives -> one row per file: file, turn = the records that become revisits (nth, page, file and nth of the response).

    Payloads below ``least`` bytes never meet in the digest join.  A digest with a third of all records rests on Spark's skew split of
    that join (spark.sql.adaptive.skewJoin.enabled).  A list holds at most a file's records, which the writer bounds."""
    me = F.struct("page_id", "file", "nth")  # NULL ids are smallest
    top = (written.where(F.col("payload_bytes") >= least).groupBy("payload_digest", "payload_bytes")
           .agg(F.max(me).alias("top"), F.count("*").alias("n")).where("n > 1").drop("n"))
    joined = written.where(F.col("payload_bytes") >= least).join(top, ["payload_digest", "payload_bytes"])
    other = F.col("top").isNotNull() & ~((F.col("top.file") == F.col("file")) & (F.col("top.nth") == F.col("nth")))
    turn = F.when(other, F.struct("nth", F.col("top.page_id").alias("page"), F.col("top.file").alias("at"), F.col("top.nth").alias("at_nth")))
    turned = joined.select("file", turn.alias("turn")).where(F.col("turn").isNotNull())
    files = written.groupBy("file").agg(F.count(F.lit(1)).alias("n"))
    return files.join(turned.groupBy("file").agg(F.collect_list("turn").alias("turn")), "file", "left").select("file", "turn")


def _one_a_task(files: DataFrame) -> DataFrame:
    return files.repartitionByRange(max(1, files.count()), "file")


def _as_revisit(headers: dict[str, str], block: bytes, page: int | None, at: str, at_nth: int) -> tuple[list[tuple[str, str]], bytes]:
    http, _, body = block.partition(b"\r\n\r\n")
    keep = [(k.title() if not k.startswith("warc") else "WARC" + k[4:].title().replace("-Id", "-ID").replace("Uri", "URI"), v)
            for k, v in headers.items() if k not in ("warc-type", "content-length")]
    refer = [("WARC-Type", "revisit"), ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
             ("WARC-Refers-To", record_id(at, at_nth)), ("X-Payload-Length", str(len(body)))]
    return refer + [("X-Refers-To-Page-Id", str(page))] * (page is not None) + keep, http + b"\r\n\r\n"


def normalise(files: DataFrame, source: str, target: str) -> DataFrame:
    """files (file, turn) -> archives of one member a record in ``target``, each with its sidecar index; rows (file, n_records).

    Each file is inflated once by one task, in constant memory beside its largest record."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = _open_folder(source)
        for b in batches:
            for name, turn in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                turned = {t["nth"]: t for t in turn or []}
                out, index, n = _Out(target, name), _Out(target, f"{name}.idx"), 0
                with store.open_input_stream(f"{root}/{name}", compression=None) as f:
                    for n, (headers, block) in enumerate(records(inflated(_chunks(f))), 1):
                        t = turned.get(n - 1)
                        if t:
                            head, block = _as_revisit(headers, block, t["page"], t["at"], t["at_nth"])
                        else:
                            head = [(k, v) for k, v in headers.items() if k != "content-length"]
                        z = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
                        member = z.compress(record(head, block)) + z.flush()
                        index.write(f"{out.size}\t{len(member)}\t{'revisit' if t else headers['warc-type']}\t{headers.get('warc-record-id', '')}\n".encode())
                        out.write(member)
                out.close()
                index.close()
                yield pa.RecordBatch.from_pydict({"file": [name], "n_records": pa.array([n], pa.int64())})

    return files.mapInArrow(run, "file string, n_records long")


def read_archives(files: DataFrame, folder: str) -> DataFrame:
    """files (file, ..) -> page_id, payload_bytes, payload_digest, record_type, refers_to of every record, opened through the index."""
    types = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64())

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)],
                                          names=["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = _open_folder(folder)
        for b in batches:
            for name in b.column(0).to_pylist():
                rows: list[tuple] = []
                with store.open_input_stream(f"{root}/{name}.idx", compression=None) as f:
                    lines = f.read().decode().splitlines()  # one line a record of one archive
                with store.open_input_file(f"{root}/{name}") as f:
                    for line in lines:
                        offset, length, kind, _ = line.split("\t")
                        f.seek(int(offset))
                        (headers, block), = records(iter([zlib.decompress(f.read(int(length)), wbits=31)]))
                        body = block.partition(b"\r\n\r\n")[2]
                        stated = base64.b32decode(headers["warc-payload-digest"].partition(":")[2]).hex()
                        if kind != headers["warc-type"] or kind == "response" and hashlib.sha1(body).hexdigest() != stated:
                            raise ValueError(f"{name}, offset {offset}: the record is not what its index or digest says")
                        page, refers = headers.get("x-page-id"), headers.get("x-refers-to-page-id")
                        rows.append((int(page) if page else None, int(headers["x-payload-length"]) if kind == "revisit" else len(body),
                                     stated, kind, int(refers) if refers else None))
                        if len(rows) == 4096:
                            yield batch(rows)
                            rows = []
                if rows:
                    yield batch(rows)

    return files.select("file").mapInArrow(
        run, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long")


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to of every page, read from the normalised archives."""
    folder = scratch_folder(spark)
    written = materialize(write_archives(read_table(spark, sf_dir, "pages"), f"{folder}/whole"))
    files = materialize(revisits(written))
    done = materialize(normalise(_one_a_task(files), f"{folder}/whole", f"{folder}/members"))
    return read_archives(_one_a_task(done), f"{folder}/members")


ORACLE = """
WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, '')))::BIGINT AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages),
t AS (SELECT *, payload_bytes >= 1000 AND row_number() OVER (PARTITION BY payload_digest ORDER BY page_id DESC NULLS LAST) > 1 AS again,
      max(page_id) OVER (PARTITION BY payload_digest) AS top FROM p)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN again THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN again THEN top END AS refers_to
FROM t
"""
