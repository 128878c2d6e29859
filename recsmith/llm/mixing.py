"""Mix sources to target weights by hash-threshold histograms.

Every document gets a 60-bit hash of its id and text.  Sizes are summed per source and hash bucket; the boundary bucket,
where the running sum crosses the source's budget, is found from the histogram and only that bucket is refined by
the next 12 bits.  After five levels the boundary is one hash value.  A document is in when its hash lies below the
boundary, so nothing is sorted, budgets are nested (a larger budget only adds documents) and reruns agree.

Histograms are keyed by (source, bucket) and combined on the map side, so a source with a third of all rows costs
no more than 4096 partial sums per task.  All DataFrame functions; the driver sees only sums over the sources.

Defined cases: NULL or empty text has size 0; NULL source is a source of its own, last in order; NULL id hashes as
the empty string; rows of equal id and text share a hash, and where the boundary falls on them a counted share of them is
in (equal rows, so it does not matter which); an empty table gives an empty result; further columns of the input are ignored; source totals of 0 give target 0.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from recsmith.llm.common import WORD_PATTERN, read_table, text_or_empty
from recsmith.operators.split import with_global_index
from recsmith.session import materialize

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MAX_COPIES = 2
BUCKET_BITS, LEVELS = 12, 5
BROADCAST_SOURCES, SALTS = 100_000, 32


def row_hash(doc_id: Column, text: Column) -> Column:
    """The first 60 bits of the MD5 of the id as text, a colon and the text."""
    both = F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), text_or_empty(text))
    hexed = F.substring(F.md5(both.cast("binary")), 1, 15)
    return F.conv(hexed, 16, 10).cast("long")


def word_count(text: Column) -> Column:
    return F.regexp_count(text_or_empty(text), F.lit(WORD_PATTERN)).cast("long")


def source_targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, cap: int = MAX_COPIES) -> DataFrame:
    """sizes (source, size) -> one row per source: source, source_size, target.

    ``share`` of all sizes is dealt by weight; what a source gets beyond ``cap`` times its size is dealt anew among the
    others until none is above.  Each round is one aggregate over the source table and caps at least one source more.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    per = with_global_index(per, [F.col("source").asc_nulls_last()], "pos")
    wheel = F.array(*[F.lit(float(w)) for w in weights])
    per = materialize(per.select("source", "source_size", wheel[(F.col("pos") % len(weights)).cast("int")].alias("w")))
    limit = F.lit(float(cap)) * F.col("source_size")
    budget = share * float(per.agg(F.sum("source_size")).first()[0] or 0)
    level, capped = 0.0, -1
    while True:
        over = F.lit(level) * F.col("w") > limit
        row = per.agg(F.count(F.when(over, 1)), F.sum(F.when(over, limit).otherwise(0.0)),
                      F.sum(F.when(over, 0.0).otherwise(F.col("w")))).first()
        if row[0] == capped or not row[2]:
            break
        capped, level = row[0], (budget - row[1]) / row[2]
    return per.select("source", "source_size", F.least(F.lit(level) * F.col("w"), limit).alias("target"))


def _key(source: Column) -> Column:
    """A join key that is never NULL: a NULL source is a source of its own."""
    return F.coalesce(F.concat(F.lit("="), source), F.lit(""))


def _meet(rows: DataFrame, plan: DataFrame, on: list[str], few: bool) -> DataFrame:
    """Rows with the plan row of their source: ``few`` short rows go out whole, of more a hot source meets its row in SALTS places."""
    if few:
        return rows.join(F.broadcast(plan), on)
    salted = plan.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return rows.withColumn("salt", F.pmod("h", F.lit(SALTS)).cast("int")).join(salted, ["salt", *on]).drop("salt")


def mix(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, cap: int = MAX_COPIES,
        keep: tuple[str, ...] = ()) -> DataFrame:
    """docs (doc_id, text, source, ..) -> doc_id, size, source_size, target, taken, copies and the columns ``keep``.

    ``copies`` is how often the mix takes the document and ``taken`` = size * copies.  A source whose target is k whole
    sizes and a rest takes each document k times and those below the boundary once more.  Of the rows with the one hash
    value at the boundary as many are in as come nearest to the budget, so a source misses its target by at most half a document.
    """
    sized = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source"), word_count(F.col("text")).alias("size"),
                        row_hash(F.col("doc_id"), F.col("text")).alias("h"), *[F.col(c).alias(f"_keep_{c}") for c in keep])
    base = materialize(sized.select("source", "size", "h")) if keep else materialize(sized)
    targets = source_targets(base.select("source", "size"), weights, share, cap)
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    targets = materialize(targets.select(_key(F.col("source")).alias("key"), "source_size", "target",
                                         whole.cast("long").alias("whole")))
    narrow = base.select(_key(F.col("source")).alias("key"), "size", "h")
    few = targets.count() <= BROADCAST_SOURCES
    # One row per source: what is still to be filled, and the hash prefix of the boundary bucket so far.
    edge = targets.select("key", (F.col("target") - F.col("whole") * F.col("source_size")).alias("need"),
                          F.lit(0).cast("long").alias("above"))
    for lev in range(LEVELS):
        shift = BUCKET_BITS * (LEVELS - 1 - lev)
        rows = narrow.select("key", "size", "h", F.shiftright("h", shift).alias("bucket"),
                             F.shiftright("h", shift + BUCKET_BITS).alias("above"))
        hist = (_meet(rows, edge, ["key", "above"], few).groupBy("key", "need", "bucket")
                .agg(F.sum("size").alias("n"), F.count(F.lit(1)).alias("edge_rows")))
        # At most 4096 buckets per source: these windows run over the histogram, never over documents.
        run, last = Window.partitionBy("key").orderBy("bucket"), Window.partitionBy("key")
        grid = hist.withColumn("cum", F.sum("n").over(run))
        grid = grid.withColumn("cut", F.coalesce(
            F.min(F.when(F.col("cum") >= F.col("need"), F.col("bucket"))).over(last), F.max("bucket").over(last)))
        edge = materialize(grid.where(F.col("bucket") == F.col("cut")).select(
            "key", (F.col("need") - (F.col("cum") - F.col("n"))).alias("need"), F.col("bucket").alias("above"),
            F.col("n").alias("at_edge"), "edge_rows"))
        if lev + 1 < LEVELS:
            edge = edge.drop("at_edge", "edge_rows")
    # equal rows have equal sizes: of edge_rows rows with at_edge words together, edge_take come nearest to what is needed
    take = F.floor(F.col("need") * F.col("edge_rows") / F.col("at_edge") + 0.5)
    edge = edge.select("key", F.col("above").alias("cut"), "edge_rows",
                       F.when(F.col("at_edge") > 0, take).otherwise(F.lit(0)).cast("long").alias("edge_take"))
    plan = materialize(targets.join(edge, "key", "left"))
    met = _meet((sized if keep else base).withColumn("key", _key(F.col("source"))), plan, ["key"], few)
    at_edge = F.coalesce(F.col("h") == F.col("cut"), F.lit(False))
    if plan.where("edge_rows > 1 AND edge_take BETWEEN 1 AND edge_rows - 1").isEmpty():
        out = met.withColumn("nth", F.lit(0).cast("long"))
    else:  # the boundary falls between equal rows: they are numbered, over as many tasks as they need
        order = [F.col("key"), F.xxhash64("doc_id", *[f"_keep_{c}" for c in keep]), F.monotonically_increasing_id()]
        tied = met.where(at_edge)
        tied = with_global_index(tied.select("*", *[c.alias(f"_o{i}") for i, c in enumerate(order)]),
                                 [F.col(f"_o{i}") for i in range(len(order))], "pos").drop(*[f"_o{i}" for i in range(len(order))])
        first = materialize(tied.groupBy("key").agg(F.min("pos").alias("first")))
        tied = _meet(tied, first, ["key"], few).withColumn("nth", F.col("pos") - F.col("first")).drop("pos", "first")
        out = met.where(~at_edge).withColumn("nth", F.lit(0).cast("long")).unionByName(tied)
    more = (F.col("h") < F.col("cut")) | (at_edge & (F.col("nth") < F.col("edge_take")))
    copies = F.least(F.col("whole") + F.coalesce(more, F.lit(False)).cast("long"), F.lit(cap).cast("long"))
    out = out.withColumn("copies", F.when(F.col("size") > 0, copies).otherwise(F.lit(0).cast("long")))
    return out.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"),
                      "copies", *[F.col(f"_keep_{c}").alias(c) for c in keep])


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, size, source_size, target, taken, copies for every document."""
    return mix(read_table(spark, sf_dir, "documents"))


def oracle() -> str:
    """The same mix in one ordered pass per source: a document is in while the sums fit, of the boundary hash the share that comes nearest."""
    return """
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size,
         ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '') || ':' || coalesce(text, '')), 1, 15))::BIGINT AS h FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
p AS (SELECT *, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3
                WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS w FROM s),
r AS (SELECT *, 2.0::DOUBLE * source_size AS cap, row_number() OVER (ORDER BY source_size / w, source NULLS LAST) AS pos FROM p),
o AS (SELECT *, coalesce(sum(cap) OVER (ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0::DOUBLE) AS cap_before,
             sum(w) OVER (ORDER BY pos ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS w_left,
             (SELECT 1.5::DOUBLE * sum(source_size) FROM s) AS budget FROM r),
lam AS (SELECT min_by((budget - cap_before) / w_left, pos) FILTER (WHERE (budget - cap_before) / w_left * w <= cap) AS l FROM o),
t AS (SELECT source, source_size, least(l * w, cap) AS target,
             CASE WHEN source_size > 0 THEN floor(least(l * w, cap) / source_size) ELSE 0 END::BIGINT AS whole FROM o, lam),
g AS (SELECT d.source, h, sum(size)::BIGINT AS n, count(*) AS r FROM d GROUP BY d.source, h),
c AS (SELECT g.source, h, n, r, sum(n) OVER (PARTITION BY g.source ORDER BY h) AS cum,
             target - whole * source_size AS need FROM g JOIN t ON g.source IS NOT DISTINCT FROM t.source),
e AS (SELECT source, h, CASE WHEN cum < need THEN r WHEN cum - n < need AND n > 0 THEN floor((need - (cum - n)) * r / n + 0.5) ELSE 0 END AS take FROM c),
m AS (SELECT *, row_number() OVER (PARTITION BY source, h) AS nth FROM d)
SELECT d.doc_id, d.size, t.source_size, t.target, d.size * k AS taken, k AS copies
FROM (SELECT d.*, CASE WHEN d.size = 0 THEN 0 ELSE least(2, t.whole + CASE WHEN d.nth <= e.take THEN 1 ELSE 0 END) END::BIGINT AS k
      FROM m d JOIN t ON d.source IS NOT DISTINCT FROM t.source
             JOIN e ON d.source IS NOT DISTINCT FROM e.source AND d.h = e.h) d
JOIN t ON d.source IS NOT DISTINCT FROM t.source
"""
