"""Token counts of whole texts, huge ones by overlap resynchronisation.

A text longer than one chunk is cut into chunks that overlap.  Every chunk is encoded on its own, with offsets, by any
task, so one huge document is no single task's work.  Neighbouring chunks are spliced at a boundary that is proven
stable: a position in the overlap, further from both its ends than a special string is long, where both encodings begin a
pre-split word.  The pre-splitter reads from left to right without memory, so from such a position on both
chunks read the same words, and by induction the splice equals the encoding of the whole text.  Where no common
boundary exists (say, one word longer than the overlap) the document is cut anew with wider overlaps, in the
end as one chunk.

The count is then a sum: tokens of all chunks, less at each seam the left chunk's tokens after the boundary and the
right chunk's before it.

Shorter texts are counted run by run (one optional space and non-space characters; a run's tokens do not depend on
its neighbours): the library encodes each distinct run once per worker and the counts are kept in a bounded table.

Defined cases: NULL counts as the empty text (0 tokens, 0 bytes); special strings inside a text are handled as the
library does by default; repeated rows and ids are counted each; an empty table gives an empty result; further
columns of the input are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recsmith.llm.bpe import RUNS, read_tokenizer
from recsmith.llm.common import in_slices, read_table, text_or_empty
from recsmith.session import materialize, shuffle_partitions

CHUNK_CHARS, OVERLAP_CHARS, WIDEN = 32768, 512, 4
LIMIT_TOKENS = 512
CACHE_RUNS = 400_000  # runs whose counts a worker keeps, in two generations


class Counter:
    """The library's tokenizer with a bounded table of counts by run."""

    def __init__(self, spec: str):
        import os
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer
        self.tok = Tokenizer.from_str(spec)
        self.tok.no_truncation()
        self.tok.no_padding()
        self.special = [t.content for t in self.tok.get_added_tokens_decoder().values()]
        self.margin = max(map(len, self.special), default=0) + 2
        self.by_run = self.tok.normalizer is None and '"ByteLevel"' in spec  # only then runs are independent
        self.runs: dict[str, int] = {}
        self.older: dict[str, int] = {}

    def count(self, texts: list[str]) -> list[int]:
        if not self.by_run:
            return [len(e.ids) for e in self.tok.encode_batch(texts, add_special_tokens=False)]
        out = []
        for text in texts:
            if any(s in text for s in self.special):
                out.append(len(self.tok.encode(text, add_special_tokens=False).ids))
                continue
            found = RUNS.findall(text)
            missing = set(found).difference(self.runs)
            if missing:
                known = {r: self.older[r] for r in missing if r in self.older}
                new = list(missing.difference(known))
                known.update(zip(new, [len(e.ids) for e in self.tok.encode_batch(new, add_special_tokens=False)] if new else []))
                if len(self.runs) + len(known) > CACHE_RUNS // 2:  # a full table becomes the old one
                    known.update((r, self.runs[r]) for r in set(found) if r in self.runs)
                    self.older, self.runs = self.runs, {}
                self.runs.update(known)
            out.append(sum(map(self.runs.__getitem__, found)))
        return out

    def boundaries(self, text: str, begin: int, end: int) -> tuple[int, list[dict], list[dict]]:
        """Tokens of the chunk, and the word starts (p, tokens before p) with p < begin and with p >= end."""
        e = self.tok.encode(text, add_special_tokens=False)
        starts = ([], [])
        before = -1
        for i, (word, (p, _)) in enumerate(zip(e.word_ids, e.offsets)):
            if word != before and (p < begin or p >= end):
                starts[p >= end].append({"p": p, "i": i})
            before = word
        return len(e.ids), *starts


_counters: dict[str, Counter] = {}  # of this worker process


def counter(spec: str) -> Counter:
    key = hashlib.sha1(spec.encode("utf-8")).hexdigest()
    if key not in _counters:
        _counters.clear()
        _counters[key] = Counter(spec)
    return _counters[key]


def _short_counts(texts: DataFrame, spec: str) -> DataFrame:
    """texts (row, text) -> row, n_tokens."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = counter(spec)
        for b in in_slices(batches):
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(c.count(b.column(b.num_columns - 1).to_pylist()), pa.int64())],
                                             names=[*b.schema.names[:-1], "n_tokens"])

    head = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in texts.schema.fields[:-1])
    return texts.mapInArrow(run, f"{head}, n_tokens long")


def _chunked_counts(huge: DataFrame, spec: str, chunk: int, overlap: int) -> DataFrame:
    """huge (row, text) -> row, n_tokens; n_tokens is NULL where a seam has no common boundary."""
    step = chunk - overlap

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                for k, start in enumerate(range(0, max(1, len(text) - overlap), step)):
                    last = start + chunk >= len(text)
                    yield pa.RecordBatch.from_pydict({"row": [row], "k": [k], "last": [last], "chunk": [text[start:start + chunk]]})

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = counter(spec)
        at = pa.list_(pa.struct([("p", pa.int64()), ("i", pa.int64())]))
        for b in batches:
            cols = b.to_pydict()
            out = []
            for k, last, text in zip(cols["k"], cols["last"], cols["chunk"]):
                n, head, tail = c.boundaries(text, overlap - c.margin, len(text) - overlap + c.margin)
                stop = len(text) - c.margin
                out.append((n, [{"p": x["p"] + k * step, "i": x["i"]} for x in head if x["p"] >= c.margin and k],
                            [{"p": x["p"] + k * step, "i": x["i"]} for x in tail if x["p"] < stop and not last]))
            n, head, tail = zip(*out)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2), pa.array(n, pa.int64()),
                                              pa.array(head, at), pa.array(tail, at)],
                                             names=["row", "k", "last", "n", "head", "tail"])

    pieces = huge.mapInArrow(cut, "row long, k long, last boolean, chunk string")
    pieces = pieces.repartition(shuffle_partitions(huge.sparkSession), "row", "k")
    done = materialize(pieces.mapInArrow(encode, "row long, k long, last boolean, n long, "
                                         "head array<struct<p:long,i:long>>, tail array<struct<p:long,i:long>>"))
    left = done.where(~F.col("last")).select("row", "k", "n", "tail")
    right = done.where("k > 0").select("row", (F.col("k") - 1).alias("k"), "head")
    p = F.array_min(F.array_intersect(F.col("tail.p"), F.col("head.p")))
    at = lambda side: F.element_at(F.col(f"{side}.i"), F.array_position(F.col(f"{side}.p"), F.col("p")).cast("int"))
    seams = (left.join(right, ["row", "k"]).withColumn("p", p)
             .select("row", F.when(F.col("p").isNotNull(), at("tail") - F.col("n") - at("head")).alias("part")))
    parts = done.select("row", F.col("n").alias("part")).unionByName(seams)
    return parts.groupBy("row").agg(F.when(F.count("*") == F.count("part"), F.sum("part")).alias("n_tokens"))


def count_tokens(docs: DataFrame, path: str | None = None, chunk: int = CHUNK_CHARS, overlap: int = OVERLAP_CHARS) -> DataFrame:
    """docs (doc_id, text, ..) -> doc_id, n_bytes, n_tokens for every row."""
    spec = read_tokenizer(path)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.octet_length(text_or_empty(F.col("text"))).cast("long").alias("n_bytes"),
                       text_or_empty(F.col("text")).alias("text"))
    is_huge = F.length("text") > chunk
    short = _short_counts(rows.where(~is_huge), spec)
    huge = materialize(rows.where(is_huge).withColumn("row", F.monotonically_increasing_id()))
    open_rows, parts = huge.select("row", "text"), []
    while not open_rows.isEmpty():
        found = materialize(_chunked_counts(open_rows, spec, chunk, overlap))
        parts.append(found.where(F.col("n_tokens").isNotNull()))
        open_rows = open_rows.join(found.where(F.col("n_tokens").isNull()), "row", "left_semi")
        overlap *= WIDEN
        chunk = max(chunk, WIDEN * overlap)
    for part in parts:
        short = short.unionByName(huge.join(part, "row").select("doc_id", "n_bytes", "n_tokens"))
    return short


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit for every document."""
    return (count_tokens(read_table(spark, sf_dir, "documents"))
            .withColumn("over_limit", F.col("n_tokens") > LIMIT_TOKENS))
