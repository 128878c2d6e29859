"""Hard-negative mining by angular triangle filtering.

For an anchor the positives are the best other rows of its label, by integer inner product; for each positive the hard
negatives are the best rows of other labels whose score lies between a lower and an upper share of the positive's.

Every row stores its angles to a few reference directions.  By the triangle inequality on the sphere two rows with angles
s and t to one reference are at least |s - t| and at most min(s + t, 2 pi - s - t) apart; over all references that gives
an interval for their cosine, and times both norms an interval for their score, widened by more than rounding can take.
A row is scored, in whole numbers, only if this interval meets a window that an anchor still needs: from the worst
score that would still enter a list to the window's upper end.  Inside a slice the rows stand sorted by each reference's
angle, so the reference with the narrowest window names the rows to look at; they are scored from the highest upper bound
down, and the list's worst score raises the window's lower end as they come.

Rows are numbered by (label, nearest reference, angle to it), so slices of them are narrow in angle.  Slices and blocks of
anchors have intervals of angles and norms too: only pairs (block, slice) whose score interval meets what the block
needs are met at all.  Positives begin with each anchor's own slice, negatives with the slice of the highest bound; both
give the bars that the other slices must reach.  A group holds one block of anchors and one slice, whatever the size of a label.

References are spread over a sample of ``SAMPLE`` rows a vector length (chosen by a hash); they only steer the
work, every row is indexed and every result is exact.

Defined cases: rows whose label, id or vector is NULL, or whose vector is empty or holds NULL or non-finite components, take
no part; vectors of different lengths have no inner product and are not compared; the zero vector scores 0 with all;
rows that repeat an id are rows each, but never positives or negatives of an anchor with that id, and each anchor row
has its own lists; equal scores go by smaller id, repeated ids of equal score in any order; an anchor without positives, or a positive
without negatives, has no row; an empty table gives an empty result; further columns are ignored.  Scores beyond the long range raise.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from recsmith.llm.common import read_table
from recsmith.operators.split import with_global_index
from recsmith.session import materialize

POSITIVES, NEGATIVES, SCALE = 5, 3, 256
LOWER, UPPER = 50, 95  # a negative's score in percent of the positive's
REFERENCES, SAMPLE = 16, 1024
SLICE, BLOCK, CHUNK = 4096, 4096, 256
SALTS = 64
#: More than the arc cosine of a rounded cosine can be off (about 1.5e-8 next to 0 and pi), and than rounding adds to a score.
ANGLE_SLACK, SCORE_SLACK = 1e-7, 1e-9
_EXACT, _LONG = 2.0 ** 53, 2 ** 63


def whole_rows(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """vectors (vec_id, embedding, label, ..) -> vec_id, label, v array<double> of floor(scale * x), dim, norm; unusable rows go."""
    x = F.col("embedding")
    fine = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & x.isNotNull() & (F.size(x) > 0) & F.forall(
        x, lambda c: F.coalesce(~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))), F.lit(False)))
    v = F.transform(x, lambda c: F.floor(F.lit(float(scale)) * c.cast("double")).cast("double"))
    out = vectors.where(fine).select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), v.alias("v"))
    square = F.aggregate("v", F.lit(0.0), lambda s, c: s + c * c)
    return out.select("vec_id", "label", "v", F.size("v").alias("dim"), F.sqrt(square).alias("norm"))


# ---- references and angles -------------------------------------------------

def spread_directions(unit: np.ndarray, n: int) -> np.ndarray:
    """n of the rows, each the one furthest in angle from those before it."""
    chosen = [0]
    nearest = unit @ unit[0]
    while len(chosen) < min(n, len(unit)):
        chosen.append(int(np.argmin(nearest)))
        nearest = np.maximum(nearest, unit @ unit[chosen[-1]])
    return unit[chosen]


def references(rows: DataFrame, n: int = REFERENCES, sample: int = SAMPLE) -> dict[int, np.ndarray]:
    """Unit reference directions by vector length; always n of them (repeated if the sample has fewer directions)."""
    nth = Window.partitionBy("dim").orderBy(F.xxhash64("vec_id", "v"), "vec_id", "v")
    few = rows.where(F.col("norm") > 0).select("dim", "vec_id", "v").withColumn("nth", F.row_number().over(nth)).where(F.col("nth") <= sample)
    found: dict[int, list] = {}
    for r in few.orderBy("dim", "nth").toLocalIterator():  # at most ``sample`` rows a vector length
        found.setdefault(r["dim"], []).append(r["v"])
    out = {}
    for dim, vs in found.items():
        x = np.array(vs)
        spread = spread_directions(x / np.linalg.norm(x, axis=1, keepdims=True), n)
        out[dim] = np.resize(spread, (n, dim))
    return out


def with_angles(rows: DataFrame, refs: dict[int, np.ndarray], n: int = REFERENCES) -> DataFrame:
    """rows + angles array<double> to the references of their length (0 for the zero vector, whose scores are 0 anyway)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            dims, norms = np.asarray(b.column("dim")), np.asarray(b.column("norm"))
            for d in np.unique(dims):
                at = np.flatnonzero(dims == d)
                part = b.take(pa.array(at))
                x, size = np.asarray(part.column("v").flatten(), np.float64).reshape(-1, d), norms[at]
                angles = np.zeros((len(at), n))
                if d in refs:
                    angles = np.arccos(np.clip(x / np.maximum(size, 1e-300)[:, None] @ refs[d].T, -1, 1))
                    angles[size == 0] = 0
                flat = pa.ListArray.from_arrays(pa.array(np.arange(0, angles.size + 1, n), pa.int32()), pa.array(angles.ravel()))
                yield pa.RecordBatch.from_arrays([*part.columns, flat], names=[*part.schema.names, "angles"])

    head = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields)
    return rows.mapInArrow(run, f"{head}, angles array<double>")


# ---- one slice -------------------------------------------------------------

class Slice:
    """The rows of one slice, in order of each reference's angle."""

    def __init__(self, ids, labels, pos, v, norm, angles):
        self.ids, self.labels, self.pos, self.v, self.norm, self.angles = ids, labels, pos, v, norm, angles
        self.order = np.argsort(angles, axis=0, kind="stable")
        self.sorted = np.take_along_axis(angles, self.order, axis=0)
        self.longest, self.shortest = float(norm.max()), float(norm.min())
        self.largest = float(np.abs(v).max())

    def score(self, q: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Exact inner products of whole numbers."""
        if self.v.shape[1] * self.largest * float(np.abs(q).max()) < _EXACT:
            return (self.v[at] @ q).astype(np.int64)
        out = [sum(int(a) * int(b) for a, b in zip(x, q)) for x in self.v[at]]
        if any(not -_LONG <= s < _LONG for s in out):
            raise OverflowError("a score beyond the long range")
        return np.array(out, np.int64)

    def intervals(self, angles: np.ndarray, norm: float, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(lower, upper) bounds of the scores of rows ``at`` with a vector of these angles and norm."""
        near = np.abs(self.angles[at] - angles).max(axis=1)
        both = self.angles[at] + angles
        far = np.minimum(both, 2 * np.pi - both).min(axis=1)
        size = self.norm[at] * norm
        pad = SCORE_SLACK * (size + 1)
        return (size * np.cos(np.minimum(np.pi, far + ANGLE_SLACK)) - pad, size * np.cos(np.maximum(0, near - ANGLE_SLACK)) + pad)

    def candidates(self, angles: np.ndarray, norm: float, low: float, high: float) -> tuple[np.ndarray, np.ndarray]:
        """Rows whose score interval meets [low, high], and their upper bounds, in falling order of these."""
        size = norm * (self.longest if low > 0 else self.shortest)
        at = None
        if low > -np.inf and size > 0:
            least = (low - SCORE_SLACK * (size + 1)) / size  # no cosine below this can do
            if least > 1:
                return np.zeros(0, np.int64), np.zeros(0)
            if least > -1:
                reach = np.arccos(least) + 2 * ANGLE_SLACK
                windows = [(np.searchsorted(s, a - reach, "left"), np.searchsorted(s, a + reach, "right")) for s, a in zip(self.sorted.T, angles)]
                r = min(range(len(windows)), key=lambda i: windows[i][1] - windows[i][0])
                at = self.order[windows[r][0]:windows[r][1], r]
        at = np.arange(len(self.ids)) if at is None else at
        lower, upper = self.intervals(angles, norm, at)
        keep = (upper >= low) & (lower <= high)
        at, upper = at[keep], upper[keep]
        falling = np.argsort(-upper, kind="stable")
        return at[falling], upper[falling]

    def _best(self, at: np.ndarray, score: np.ndarray, k: int) -> np.ndarray:
        return np.lexsort((self.pos[at], self.ids[at], -score))[:k]

    def positives(self, anchor: dict, k: int) -> list[tuple]:
        """(id, position, score) of the k best rows of the anchor's label that reach its bar."""
        q, low = anchor["v"], anchor["bar"]
        at, upper = self.candidates(anchor["angles"], anchor["norm"], low, np.inf)
        mine = (self.labels[at] == anchor["label"]) & (self.ids[at] != anchor["vec_id"])
        at, upper = at[mine], upper[mine]
        best, got = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for lo in range(0, len(at), CHUNK):
            if upper[lo] < low:
                break
            best, got = np.concatenate([best, at[lo:lo + CHUNK]]), np.concatenate([got, self.score(q, at[lo:lo + CHUNK])])
            keep = self._best(best, got, k)
            best, got = best[keep], got[keep]
            if len(got) == k:
                low = max(low, float(got[-1]) - SCORE_SLACK * abs(float(got[-1])))
        return [(int(self.ids[i]), int(self.pos[i]), int(s)) for i, s in zip(best, got)]

    def negatives(self, anchor: dict, k: int) -> list[tuple]:
        """(window, id, position, score) of the k best rows of other labels in each window [low, high] of the anchor."""
        q = anchor["v"]
        lows, highs = [int(x) for x in anchor["lows"]], [int(x) for x in anchor["highs"]]
        live = [i for i, (a, b) in enumerate(zip(lows, highs)) if a <= b]
        if not live:
            return []
        at, upper = self.candidates(anchor["angles"], anchor["norm"], float(min(lows[i] for i in live)), float(max(highs[i] for i in live)))
        other = (self.labels[at] != anchor["label"]) & (self.ids[at] != anchor["vec_id"])
        at, upper = at[other], upper[other]
        best = {i: (np.zeros(0, np.int64), np.zeros(0, np.int64)) for i in live}
        for lo in range(0, len(at), CHUNK):
            if upper[lo] < min(lows[i] for i in live):
                break
            rows = at[lo:lo + CHUNK]
            score = self.score(q, rows)
            for i in live:
                fits = (score >= lows[i]) & (score <= highs[i])
                if fits.any():
                    found, got = (np.concatenate(x) for x in zip(best[i], (rows[fits], score[fits])))
                    keep = self._best(found, got, k)
                    best[i] = found[keep], got[keep]
                    if len(keep) == k:
                        lows[i] = max(lows[i], int(best[i][1][-1]))
        return [(i, int(self.ids[r]), int(self.pos[r]), int(s)) for i in live for r, s in zip(*best[i])]


# ---- blocks against slices -------------------------------------------------

def _spans(rows: DataFrame, keys: list[str], side: str, n: int) -> DataFrame:
    """Least and greatest norm, label and angle to each of n references of every group."""
    angle = lambda f: F.array(*[f(F.col("angles")[r]) for r in range(n)])
    return rows.groupBy(*keys).agg(*[f(c).alias(f"{side}_{c}_{name}") for c in ("norm", "label") for f, name in ((F.min, "min"), (F.max, "max"))],
                                   angle(F.min).alias(f"{side}_angle_min"), angle(F.max).alias(f"{side}_angle_max"))


def _score_bounds() -> tuple[Column, Column]:
    """(lower, upper) bounds of the scores between a block b and a slice s, from their spans."""
    apart = F.zip_with(F.zip_with("s_angle_min", "b_angle_max", lambda x, y: x - y), F.zip_with("b_angle_min", "s_angle_max", lambda x, y: x - y),
                       lambda x, y: F.greatest(x, y))
    near = F.greatest(F.lit(0.0), F.array_max(apart) - ANGLE_SLACK)
    reach = F.zip_with(F.zip_with("s_angle_max", "b_angle_max", lambda x, y: x + y),
                       F.zip_with("s_angle_min", "b_angle_min", lambda x, y: F.lit(2 * np.pi) - x - y),
                       lambda x, y: F.least(x, y))
    far = F.least(F.lit(np.pi), F.array_min(reach) + ANGLE_SLACK)
    most, least = F.col("b_norm_max") * F.col("s_norm_max"), F.col("b_norm_min") * F.col("s_norm_min")
    pad = SCORE_SLACK * (most + 1)
    lower = F.cos(far) * F.when(F.cos(far) >= 0, least).otherwise(most) - pad
    upper = F.cos(near) * F.when(F.cos(near) >= 0, most).otherwise(least) + pad
    return lower, upper


def _pairs(blocks: DataFrame, slices: DataFrame) -> DataFrame:
    """Every block with every slice of its vector length, with the bounds of their scores: summaries only, one row for
    4096 anchors and one for 4096 rows, dealt over ``SALTS`` tasks."""
    lower, upper = _score_bounds()
    dealt = slices.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    both = blocks.withColumn("salt", F.pmod(F.col("block"), F.lit(SALTS)).cast("int")).join(dealt, ["dim", "salt"])
    return both.withColumn("lower", lower).withColumn("upper", upper)


def _anchor(row) -> dict:
    return {**row, "v": np.asarray(row["v"], np.float64), "angles": np.asarray(row["angles"], np.float64)}


def _slice(pdf: pd.DataFrame, prefix: str = "") -> Slice:
    col = lambda c: pdf[prefix + c]
    return Slice(col("vec_id").to_numpy(), col("label").to_numpy(), col("pos").to_numpy(), np.stack(col("v").to_numpy()).astype(np.float64),
                 col("norm").to_numpy(), np.stack(col("angles").to_numpy()).astype(np.float64))


def _meet(anchors: DataFrame, pairs: DataFrame, rows: DataFrame, find, schema: str) -> DataFrame:
    """find(anchor, slice) over the anchors (.., block) and rows (.., dim, slice) of each pair (block, slice)."""
    asked = anchors.join(pairs.select("block", F.col("slice").alias("with")), "block")
    own = rows.select(*[F.col(c).alias(f"c_{c}") for c in ("vec_id", "label", "pos", "v", "norm", "angles", "slice")])
    dealt = own.join(pairs.select(F.col("block").alias("c_block"), F.col("slice").alias("c_slice")), "c_slice")
    names = [f.split(" ")[0] for f in schema.split(", ")]

    def meet(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(left) and len(right):
            s = _slice(right, "c_")
            for row in left.to_dict("records"):
                out += [(row["pos"], *found) for found in find(_anchor(row), s)]
        return pd.DataFrame(out, columns=names).astype("int64")

    return asked.groupBy("block", "with").cogroup(dealt.groupBy("c_block", "c_slice")).applyInPandas(meet, schema)


def indexed(rows: DataFrame, is_anchor: Column) -> DataFrame:
    """rows of whole_rows -> written with angles, global position, slice (dim * 2^40 + number) and the flag ``anchor``."""
    rows = materialize(rows)
    rows = with_angles(rows, references(rows))
    order = [F.col("dim").asc(), F.col("label").asc(), F.array_position("angles", F.array_min("angles")).asc(), F.array_min("angles").asc(),
             F.col("vec_id").asc(), F.col("v").asc()]
    ranked = with_global_index(rows, order, "pos")
    number = F.col("dim").cast("long") * F.lit(1 << 40) + F.floor(F.col("pos") / SLICE)
    return materialize(ranked.withColumn("slice", number).withColumn("anchor", F.coalesce(is_anchor, F.lit(False))))


def mine(vectors: DataFrame, is_anchor: Column, positives: int = POSITIVES, negatives: int = NEGATIVES, scale: int = SCALE,
         lower: int = LOWER, upper: int = UPPER) -> DataFrame:
    """vectors (vec_id, embedding, label, ..) -> anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``is_anchor`` is a condition on vec_id; a negative's score is at least ``lower`` and at most ``upper`` percent of its positive's."""
    rows = indexed(whole_rows(vectors, scale), is_anchor)
    # anchors of neighbouring slices make a block of about BLOCK: one row a slice goes through this window
    per_slice = rows.groupBy("dim", "slice").agg(F.count(F.when(F.col("anchor"), 1)).alias("n"))
    before = Window.partitionBy("dim").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    block = F.col("dim").cast("long") * F.lit(1 << 40) + F.floor(F.coalesce(F.sum("n").over(before), F.lit(0)) / BLOCK)
    blocks_of = per_slice.where("n > 0").select("dim", "slice", block.alias("block"))
    anchors = materialize(rows.where("anchor").join(blocks_of.drop("dim"), "slice"))
    slices = materialize(_spans(rows, ["dim", "slice"], "s", REFERENCES))
    blocks = materialize(_spans(anchors, ["dim", "block"], "b", REFERENCES))

    # positives: the anchors' own slices, then all that can reach their bars
    schema = "pos long, positive_id long, positive_pos long, score long"

    def at_home(pdf: pd.DataFrame) -> pd.DataFrame:
        out, here = [], _slice(pdf)
        for row in pdf[pdf["anchor"]].to_dict("records"):
            out += [(row["pos"], *found) for found in here.positives({**_anchor(row), "bar": -np.inf}, positives)]
        return pd.DataFrame(out, columns=["pos", "positive_id", "positive_pos", "score"]).astype("int64")

    nth = Window.partitionBy("pos").orderBy(F.col("score").desc(), "positive_id", "positive_pos")
    start = materialize(rows.groupBy("slice").applyInPandas(at_home, schema))
    bars = start.withColumn("nth", F.row_number().over(nth)).where(F.col("nth") == positives).select("pos", F.col("score").cast("double").alias("_bar"))
    open_anchors = materialize(anchors.join(bars, "pos", "left").withColumn("bar", F.coalesce("_bar", F.lit(float("-inf")))).drop("_bar"))
    needs = open_anchors.groupBy("block").agg(F.min("bar").alias("least"))
    all_pairs = materialize(_pairs(blocks, slices).select("block", "slice", "lower", "upper", "b_label_min", "b_label_max", "s_label_min", "s_label_max"))
    reach = (all_pairs.join(needs, "block").where((F.col("upper") >= F.col("least")) & (F.col("s_label_min") <= F.col("b_label_max"))
                                                  & (F.col("b_label_min") <= F.col("s_label_max"))).select("block", "slice"))

    def other_slices(anchor: dict, s: Slice) -> list[tuple]:
        return [] if anchor["slice"] == anchor["with"] else s.positives(anchor, positives)

    more = _meet(open_anchors, reach, rows, other_slices, schema)
    best = materialize(start.unionByName(more).withColumn("nth", F.row_number().over(nth)).where(F.col("nth") <= positives))

    # negatives: per positive a window of whole scores
    s = F.col("score").cast("decimal(38,0)")
    low = F.ceil(s * lower / 100).cast("long")
    high = F.floor(s * upper / 100).cast("long")
    windows = (best.groupBy("pos").agg(F.array_sort(F.collect_list(F.struct("nth", low.alias("low"), high.alias("high")))).alias("w"))  # at most ``positives``
               .select("pos", F.col("w.low").alias("lows"), F.col("w.high").alias("highs")))
    asked = materialize(anchors.join(windows, "pos"))
    schema = "pos long, window long, negative_id long, negative_pos long, score long"
    find = lambda anchor, s: s.negatives(anchor, negatives)

    def wanted(asked: DataFrame, pairs: DataFrame) -> DataFrame:
        """The pairs whose score interval meets a window of the block's anchors."""
        each = asked.select("block", F.explode(F.arrays_zip("lows", "highs")).alias("w")).where(F.col("w.lows") <= F.col("w.highs"))
        need = each.groupBy("block").agg(F.min("w.lows").alias("least"), F.max("w.highs").alias("most"))
        return pairs.join(need, "block").where((F.col("upper") >= F.col("least")) & (F.col("lower") <= F.col("most")))

    other = ~((F.col("s_label_min") == F.col("s_label_max")) & (F.col("b_label_min") == F.col("b_label_max")) & (F.col("s_label_min") == F.col("b_label_min")))
    pairs = materialize(wanted(asked, all_pairs.where(other)).select("block", "slice", "lower", "upper"))
    highest = Window.partitionBy("block").orderBy(F.col("upper").desc(), "slice")
    first = materialize(pairs.withColumn("nth", F.row_number().over(highest)).where(F.col("nth") == 1).select("block", "slice"))
    found = materialize(_meet(asked, first, rows, find, schema))
    rank = Window.partitionBy("pos", "window").orderBy(F.col("score").desc(), "negative_id", "negative_pos")
    # a full list's worst score is the least that still matters in its window
    full = (found.withColumn("nth", F.row_number().over(rank)).where(F.col("nth") == negatives)
            .groupBy("pos").agg(F.map_from_entries(F.collect_list(F.struct("window", "score"))).alias("worst")))
    raised = F.transform("lows", lambda x, i: F.greatest(x, F.coalesce(F.element_at("worst", i.cast("long")), x)))
    asked = materialize(asked.join(full, "pos", "left").withColumn("lows", F.coalesce(raised, F.col("lows"))).drop("worst"))
    rest = wanted(asked, pairs.join(first, ["block", "slice"], "left_anti")).select("block", "slice")
    found = found.unionByName(_meet(asked, rest, rows, find, schema))
    top = found.withColumn("rank", F.row_number().over(rank)).where(F.col("rank") <= negatives)
    named = best.select("pos", (F.col("nth") - 1).cast("long").alias("window"), "positive_id", F.col("score").alias("positive_score"))
    who = anchors.select("pos", F.col("vec_id").alias("anchor_id"))
    return (top.join(named, ["pos", "window"]).join(who, "pos")
            .select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score",
                    F.col("score").alias("negative_score")))


ANCHOR_STEP, RELABEL_STEP, LABELS = 50, 7, 10


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score for the rows whose vec_id is divisible by 50."""
    table = read_table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % RELABEL_STEP == 0, (F.col("label") + 1) % LABELS).otherwise(F.col("label"))
    return mine(table.withColumn("label", label), F.col("vec_id") % ANCHOR_STEP == 0)


ORACLE = """
WITH e AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
             [floor(256::DOUBLE * x::DOUBLE)::BIGINT FOR x IN embedding] AS v FROM embeddings
           WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
n AS (SELECT *, row_number() OVER () AS row FROM e),
s AS (SELECT a.row, a.vec_id AS anchor_id, c.row AS other, c.vec_id, a.label = c.label AS same,
        list_sum([p[1] * p[2] FOR p IN [[a.v[i], c.v[i]] FOR i IN range(1, len(a.v) + 1)]])::BIGINT AS score
      FROM n a JOIN n c ON a.vec_id % 50 = 0 AND c.vec_id <> a.vec_id AND len(a.v) = len(c.v)),
p AS (SELECT row, anchor_id, other, vec_id AS positive_id, score AS positive_score FROM s WHERE same
      QUALIFY row_number() OVER (PARTITION BY row ORDER BY score DESC, vec_id, other) <= 5)
SELECT p.anchor_id, positive_id, row_number() OVER (PARTITION BY p.row, p.other ORDER BY score DESC, vec_id, s.other)::INTEGER AS rank,
  vec_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s ON p.row = s.row AND NOT s.same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
QUALIFY row_number() OVER (PARTITION BY p.row, p.other ORDER BY score DESC, vec_id, s.other) <= 3
"""
