"""SimHash near-duplicates by segment popcounts.

A 64-bit fingerprint is mapped to the bit counts of its 32 two-bit segments.  The Manhattan distance of two such
count vectors never exceeds the Hamming distance of the fingerprints, so pairs within 3 bits lie within Manhattan
distance 3, and then at least one half of the vector (16 segments) lies within distance 1.  Each half is a unit grid:
every fingerprint is stored in its own cell and probes that cell and the cells one step up in one segment.  The
candidates of this range join are cut by the Manhattan distance of the whole vector and then checked bit by bit.

Counts are kept in unary (0 -> 00, 1 -> 01, 2 -> 11), so a Manhattan distance is the popcount of an XOR.

Copies collapse to one fingerprint before the join (a grouped minimum, combined on the map side), so a group of
copies with a third of all rows is one row there.  Links are between different fingerprints and none is lost.

Defined cases: NULL or empty texts and texts without words have fingerprint 0, which is linked like any other; a text with
fewer words than the shingle length is one shingle; NULL ids keep their row and never name a component (a component
without any id has a NULL component_id); repeated ids and rows each keep their row; an empty table gives an empty
result; further columns of the input are ignored.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from recsmith.llm.common import connected_components, in_slices, read_table, worker_tables
from recsmith.session import materialize

SHINGLE, MAX_BITS, SEED = 3, 3, 42
_BLOCK = 1 << 16  # shingles hashed at a time, so a very long text needs bounded memory beside its words


def simhash(text: str | None, shingle: int = SHINGLE) -> int:
    """The unsigned fingerprint of one text: words lower-cased in A-Z only, XXH64 of the space-joined shingles."""
    words = (text or "").encode("utf-8").lower().split()  # bytes.lower and bytes.split are ASCII-only
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    grams = map(b" ".join, zip(*[words[i:] for i in range(shingle)])) if len(words) >= shingle else iter([b" ".join(words)])
    ones = np.zeros(64, np.int64)
    digest = xxhash.xxh64_intdigest
    while block := list(itertools.islice(grams, _BLOCK)):
        h = np.array([digest(g, SEED) for g in block], dtype="<u8")
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, keep: tuple[str, ...] = ()) -> DataFrame:
    """docs (doc_id, text, ..) -> doc_id long, fp long (the fingerprint's 64 bits) and the columns ``keep``."""
    rows = docs.select(F.col("doc_id").cast("long").alias("_id"), F.col("text").alias("_text"),
                       *[F.col(c).alias(f"_keep_{c}") for c in keep])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker_tables("simhash")
        for b in in_slices(batches):
            fp = np.array([simhash(t, shingle) for t in b.column(1).to_pylist()], dtype="<u8").view("<i8")
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fp), *b.columns[2:]],
                                             names=["doc_id", "fp", *keep])

    schema = "doc_id long, fp long" + "".join(f", `{c}` {docs.schema[c].dataType.simpleString()}" for c in keep)
    return rows.mapInArrow(run, schema)


_ODD = 0x55555555


def _unary(half: Column) -> Column:
    """Bit counts of the 16 two-bit segments of a 32-bit half, in unary."""
    up = F.shiftrightunsigned(half, 1)
    low = half.bitwiseOR(up).bitwiseAND(F.lit(_ODD))
    return low.bitwiseOR(F.shiftleft(half.bitwiseAND(up).bitwiseAND(F.lit(_ODD)), 1))


def embedding(fp: Column) -> tuple[Column, Column]:
    """The segment counts of the high and the low half."""
    return _unary(F.shiftrightunsigned(fp, 32)), _unary(fp.bitwiseAND(F.lit(0xFFFFFFFF)))


def _cells_above(cell: Column) -> Column:
    """The cells that exceed ``cell`` by one in one segment: 0 -> 1 sets the low bit, 1 -> 2 the high bit."""
    low = cell.bitwiseAND(F.lit(_ODD))
    high = F.shiftrightunsigned(cell, 1).bitwiseAND(F.lit(_ODD))
    steps = [F.when(low.bitwiseAND(F.lit(1 << (2 * i))) == 0, cell.bitwiseOR(F.lit(1 << (2 * i))))
              .when(high.bitwiseAND(F.lit(1 << (2 * i))) == 0, cell.bitwiseOR(F.lit(2 << (2 * i)))) for i in range(16)]
    return F.filter(F.array(*steps), lambda x: x.isNotNull())


def near_pairs(fps: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """fps (fp long, distinct) -> all pairs (a, b) of fingerprints that differ in at most ``max_bits`` bits, each once."""
    if not 0 <= max_bits <= 3:
        raise ValueError("the grid covers distances up to 3 bits")
    halves = F.array(*[F.struct(F.lit(i).alias("half"), c.alias("cell")) for i, c in enumerate(embedding(F.col("fp")))])
    cells = fps.select("fp", F.explode(halves).alias("h")).select("fp", "h.half", "h.cell")
    tagged = F.shiftleft(F.col("half").cast("long"), 32)
    stored = cells.select(tagged.bitwiseOR(F.col("cell")).alias("key"), F.col("fp").alias("b"))
    probe = F.concat(F.array("cell"), _cells_above(F.col("cell")))
    probes = (cells.select("fp", "half", "cell", F.explode(probe).alias("at"))
              .select(tagged.bitwiseOR(F.col("at")).alias("key"), F.col("fp").alias("a"), "half",
                      (F.col("at") == F.col("cell")).alias("same")))
    high_a, low_a = embedding(F.col("a"))
    high_b, low_b = embedding(F.col("b"))
    d_high, d_low = F.bit_count(high_a.bitwiseXOR(high_b)), F.bit_count(low_a.bitwiseXOR(low_b))
    once = (~F.col("same") | (F.col("a") < F.col("b"))) & ((F.col("half") == 0) | (d_high > 1))
    # both sides are exploded, which Spark's size of them leaves out: by that size it would broadcast a side many times as large
    return (probes.join(stored.hint("merge"), "key").where(once & (d_high + d_low <= max_bits)
                                             & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits))
            .select("a", "b"))


def fingerprint_groups(marked: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """marked (doc_id, fp, ..; stored) -> one row per fingerprint: fp, root, component_id (the smallest doc_id reachable)."""
    distinct = materialize(marked.groupBy("fp").agg(F.min("doc_id").alias("least")))
    comp = materialize(connected_components(near_pairs(distinct.select("fp"), max_bits)))
    named = (distinct.join(comp.withColumnRenamed("node", "fp"), "fp", "left")
             .select("fp", F.coalesce("root", "fp").alias("root"), "least"))
    lowest = named.groupBy("root").agg(F.min("least").alias("component_id"))
    return named.join(lowest, "root").select("fp", "root", "component_id")


def hex16(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id for every document."""
    marked = materialize(fingerprints(read_table(spark, sf_dir, "documents")))
    return (marked.join(fingerprint_groups(marked), "fp")
            .select("doc_id", hex16(F.col("fp")).alias("fingerprint"), "component_id"))


def drop_near_copies(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """One document of each group, all columns: a row whose id names the component and whose text is of the group.

    Groups that share their smallest id, as an id repeats with other texts, keep one row each.
    Rows without an id stay only where no row of their group has one, one row for each such group.
    """
    cols = docs.columns
    marked = materialize(fingerprints(docs, shingle))
    named = materialize(fingerprint_groups(marked, max_bits))
    chosen = (marked.join(named, "fp").where(F.col("doc_id") == F.col("component_id"))
              .groupBy("root").agg(F.min("fp").alias("_fp"), F.min("doc_id").alias("_chosen")))
    often = marked.groupBy("doc_id").agg(F.count("*").alias("_rows")).where("_rows > 1")
    chosen = materialize(chosen.join(often.select(F.col("doc_id").alias("_chosen"), "_rows"), "_chosen", "left"))
    same_id = F.col("doc_id").cast("long") == F.col("_chosen")
    kept = docs.join(chosen.where("_rows is null").select("_chosen"), same_id).select(*cols)
    # an id of several rows: the text decides which of them is of the group
    again = (docs.join(chosen.where("_rows is not null").select("_chosen").distinct(), same_id, "left_semi")
             .select("doc_id", "text", F.struct(*cols).alias("_whole")))
    of_group = chosen.where("_rows is not null").select(F.col("_chosen").alias("doc_id"), F.col("_fp").alias("fp"), "root")
    first = Window.partitionBy("root").orderBy(F.xxhash64("_whole"))
    again = (fingerprints(again, shingle, keep=("_whole",)).join(of_group, ["doc_id", "fp"])
             .withColumn("_nth", F.row_number().over(first)).where("_nth = 1").select("_whole.*"))
    whole = docs.where(F.col("doc_id").isNull()).select("doc_id", "text", F.struct(*cols).alias("_whole"))
    blank = fingerprints(whole, shingle, keep=("_whole",)).join(named.where(F.col("component_id").isNull()), "fp")
    lone = Window.partitionBy("root").orderBy("fp", F.xxhash64("_whole"))
    blank = blank.withColumn("_nth", F.row_number().over(lone)).where("_nth = 1").select("_whole.*")
    return kept.unionByName(again).unionByName(blank)
