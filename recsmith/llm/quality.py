"""Quality classifier: random Fourier features of document statistics, ridge regression, isotonic calibration.

1. Every whole text is reduced to a fixed row of statistics (character classes, word lengths, repetition, lines).
2. The statistics are standardised by the mean and deviation of the training rows and mapped to random Fourier features,
   whose inner products approximate a Gaussian kernel.
3. Normal equations are summed within each partition, then pairwise over partitions (a few hundred numbers squared,
   whatever the input size); their ridge solution scores every document.
4. Scores of a calibration fold are counted on a fine grid and made monotone by pooling adjacent violators, which
   turns a score into the probability of label 1.

Only rows whose crc32(doc_id as text) mod 5 is not 0 are learned from: 1, 2, 3 for the ridge, 4 for the calibration.  All
labelled rows of these folds are used.

Defined cases: NULL counts as the empty text, which has its own statistics row (all zero); labels that are NULL or
without a document are ignored; a document labelled more than once has the mean label; no label of either class gives the score
0.5 for every document; repeated rows are scored alike; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from recsmith.llm.common import held_out, in_slices, read_table, training_row, worker_tables
from recsmith.session import materialize

FEATURES, GAMMA, RIDGE, SEED = 256, 0.02, 1e-3, 7
THRESHOLD = 0.3
GRID = 2048

# Character classes by byte value; every byte of a multi-byte character counts as a letter.
_CLASSES = {
    "lower": bytes(range(97, 123)), "upper": bytes(range(65, 91)), "digit": b"0123456789", "high": bytes(range(128, 256)),
    "space": b" ", "line": b"\n", "tab": b"\t\r\x0b\x0c", "stop": b".", "comma": b",;:", "quote": b"'\"`", "shout": b"!?",
    "bracket": b"()[]{}<>", "money": b"$%&*#@^~", "bar": b"|\\/", "dash": b"-_=+",
}
_INDEX = np.full(256, len(_CLASSES), np.int64)
for _i, _chars in enumerate(_CLASSES.values()):
    _INDEX[list(_chars)] = _i
N_STATS = len(_CLASSES) + 1 + 9


def text_statistics(text: str | None) -> np.ndarray:
    """Statistics of one whole text; zeros for an empty one."""
    out = np.zeros(N_STATS)
    data = (text or "").encode("utf-8")
    if not data:
        return out
    k = len(_CLASSES) + 1
    counts = np.bincount(_INDEX, np.bincount(np.frombuffer(data, np.uint8), minlength=256), minlength=k)
    share = counts / len(data)
    out[:k] = np.sqrt(share)
    words = data.split()
    lines = data.splitlines()
    n = max(1, len(words))
    distinct = len(set(words))
    sizes = np.fromiter(map(len, words), np.float64, len(words)) if words else np.zeros(1)
    letters = max(1.0, counts[0] + counts[1])
    alnum = share[0] + share[1] + share[2] + share[3]
    out[k:] = (np.log1p(len(words)), sizes.mean() / 8, sizes.std() / 8, distinct / n, np.log(max(1, distinct)) / np.log(n + 1),
               len(set(lines)) / max(1, len(lines)), counts[1] / letters, 1 - alnum - share[4] - share[5],
               np.log1p(n / max(1, len(lines))))
    return out


def statistics(docs: DataFrame) -> DataFrame:
    """docs (doc_id, text, ..) -> doc_id, stats array<float> of every row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker_tables("quality")
        for b in in_slices(batches):
            rows = [text_statistics(t).astype(np.float32) for t in b.column(1).to_pylist()]
            flat = np.concatenate(rows) if rows else np.zeros(0, np.float32)
            stats = pa.ListArray.from_arrays(np.arange(0, len(flat) + 1, N_STATS, dtype=np.int32), pa.array(flat))
            yield pa.RecordBatch.from_arrays([b.column(0), stats], names=["doc_id", "stats"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text")).mapInArrow(
        run, "doc_id long, stats array<float>")


def _matrix(column: pa.Array) -> np.ndarray:
    return np.asarray(column.flatten(), np.float64).reshape(len(column), -1)


class Kernel:
    """x -> sqrt(2/D) cos(W (x - mean) / std + phase): E[z(x) z(y)] = exp(-gamma |x - y|^2)."""

    def __init__(self, mean: np.ndarray, std: np.ndarray, features: int = FEATURES, gamma: float = GAMMA, seed: int = SEED):
        rng = np.random.default_rng(seed)
        self.mean, self.std = mean, np.where(std > 1e-9, std, 1.0)
        self.w = rng.normal(0, np.sqrt(2 * gamma), (len(mean), features))
        self.phase = rng.uniform(0, 2 * np.pi, features)

    def __call__(self, x: np.ndarray) -> np.ndarray:
        # beyond 6 deviations a statistic says no more: keeps far outliers on the kernel's map
        x = np.clip((x - self.mean) / self.std, -6, 6)
        z = np.sqrt(2 / len(self.phase)) * np.cos(x @ self.w + self.phase)
        return np.hstack([np.ones((len(z), 1)), z])


def summed(rows: DataFrame, part, shape: tuple[int, ...]) -> np.ndarray:
    """Sum over all partitions of part(stats, label): one array of fixed size per partition, added up in a tree of tasks."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(shape)
        for b in batches:
            if len(b):
                total += part(_matrix(b.column("stats")), np.asarray(b.column("y"), np.float64))
        yield pa.RecordBatch.from_pydict({"sum": [total.tobytes()]})

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(shape)
        for b in batches:
            for s in b.column(0).to_pylist():
                total += np.frombuffer(s).reshape(shape)
        yield pa.RecordBatch.from_pydict({"sum": [total.tobytes()]})

    sums = rows.select("stats", "y").mapInArrow(run, "sum binary")
    n = sums.rdd.getNumPartitions()
    while n > 8:
        n = max(8, n // 8)
        sums = sums.repartition(n).mapInArrow(add, "sum binary")
    return sum((np.frombuffer(r[0]).reshape(shape) for r in sums.toLocalIterator()), np.zeros(shape))


def pool_adjacent(weight: np.ndarray, total: np.ndarray) -> np.ndarray:
    """Isotonic fit of total / weight over a grid; cells without weight take the level to their left."""
    blocks: list[list[float]] = []
    for w, t, i in zip(weight, total, range(len(weight))):
        if w > 0:
            blocks.append([w, t, i])
            while len(blocks) > 1 and blocks[-2][1] * blocks[-1][0] >= blocks[-1][1] * blocks[-2][0]:
                w1, t1, _ = blocks.pop()
                blocks[-1][0] += w1
                blocks[-1][1] += t1
    out = np.zeros(len(weight))
    starts = [int(b[2]) for b in blocks] + [len(weight)]
    for (w, t, _), lo, hi in zip(blocks, starts, starts[1:]):
        out[lo:hi] = t / w
    if blocks:
        out[:starts[0]] = blocks[0][1] / blocks[0][0]
    return out


class Model:
    """Scores of statistics rows; ``levels`` maps the grid of raw scores to probabilities."""

    def __init__(self, kernel: Kernel | None, weights: np.ndarray | None, levels: np.ndarray | None):
        self.kernel, self.weights, self.levels = kernel, weights, levels

    def cell(self, raw: np.ndarray) -> np.ndarray:
        return np.clip(((raw + 0.5) / 2 * GRID).astype(np.int64), 0, GRID - 1)

    def raw(self, x: np.ndarray) -> np.ndarray:
        return self.kernel(x) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.kernel is None:
            return np.full(len(x), 0.5)
        raw = self.raw(x)
        # the raw score breaks ties inside a calibration level without leaving it
        return np.clip(self.levels[self.cell(raw)] * 0.998 + 0.002 * np.clip((raw + 0.5) / 2, 0, 1), 0, 1)


def fit(stats: DataFrame, labels: DataFrame, label: str = "quality", ridge: float = RIDGE) -> Model:
    """stats (doc_id, stats; stored), labels (doc_id, label) -> model, from the training folds only."""
    known = (labels.where(F.col(label).isNotNull()).groupBy(F.col("doc_id").cast("long").alias("doc_id"))
             .agg(F.avg(F.col(label).cast("double")).alias("y")))
    rows = materialize(stats.join(known.where(training_row(F.col("doc_id"))), "doc_id")
                       .select("stats", "y", (F.crc32(F.col("doc_id").cast("string")) % 5 == 4).alias("calibrate")))
    fold, other = rows.where(~F.col("calibrate")), rows.where("calibrate")
    moments = summed(fold, lambda x, y: np.vstack([np.ones(x.shape[1]) * len(x), x.sum(0), (x * x).sum(0), y.sum() * np.ones(x.shape[1])]),
                     (4, N_STATS))
    n = moments[0, 0]
    if n == 0 or moments[3, 0] in (0, n):
        return Model(None, None, None)
    mean = moments[1] / n
    kernel = Kernel(mean, np.sqrt(np.maximum(moments[2] / n - mean * mean, 0)))
    d = FEATURES + 1

    def normal(x: np.ndarray, y: np.ndarray) -> np.ndarray:
        z = kernel(x)
        return np.hstack([z.T @ z, (z.T @ y)[:, None]])

    eq = summed(fold, normal, (d, d + 1))
    model = Model(kernel, np.linalg.solve(eq[:, :d] + ridge * n / d * np.eye(d), eq[:, d]), None)

    def counted(x: np.ndarray, y: np.ndarray) -> np.ndarray:
        c = model.cell(model.raw(x))
        return np.vstack([np.bincount(c, minlength=GRID), np.bincount(c, y, minlength=GRID)])

    counts = summed(other, counted, (2, GRID))
    if counts[0].sum() == 0:
        counts = summed(fold, counted, (2, GRID))
    model.levels = pool_adjacent(counts[0], counts[1])
    return model


def scores(stats: DataFrame, model: Model) -> DataFrame:
    """stats (doc_id, stats) -> doc_id, score."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = model.score(_matrix(b.column(1))) if len(b) else np.zeros(0)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(got, pa.float64())], names=["doc_id", "score"])

    return stats.mapInArrow(run, "doc_id long, score double")


def decided(score: DataFrame, threshold: float) -> DataFrame:
    predicted: Column = (F.col("score") >= threshold).cast("int")
    return score.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", predicted.alias("predicted"))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, held_out, score, predicted for every document."""
    stats = materialize(statistics(read_table(spark, sf_dir, "documents")))
    model = fit(stats, read_table(spark, sf_dir, "labels"))
    return decided(scores(stats, model), THRESHOLD)


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The documents whose score reaches the threshold, all columns; every row is scored on its own text."""
    model = fit(materialize(statistics(docs)), labels)
    cols = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker_tables("quality")
        for b in in_slices(batches):
            x = np.array([text_statistics(t) for t in b.column("text").to_pylist()]).reshape(len(b), N_STATS)
            good = model.score(x.astype(np.float32).astype(np.float64)) >= threshold
            yield b.filter(pa.array(good))

    return docs.select(*cols).mapInArrow(run, docs.schema)
