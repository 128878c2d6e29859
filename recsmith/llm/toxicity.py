"""Toxicity: a weighted lexicon matched by Aho-Corasick on folded text.

Folding undoes disguises: letter case, look-alike letters of other scripts, accents, full-width forms, digits and signs
that stand for letters, and invisible characters.  Letters that look alike in any of these fall together (i, l, 1), so a
folded text is a skeleton, not a spelling.  Every other sign becomes a space.

The lexicon holds word beginnings.  It is learned from labelled texts: a beginning is an entry when significantly more
toxic than clean texts contain it (log-likelihood ratio against the number of beginnings tried); its weight is the smoothed log ratio
of its rates per word in toxic and in clean texts.  A few common insults start with a prior.  Exception phrases are two-word phrases in which an entry is harmless: a given list, and
phrases around an entry that clean texts use and toxic ones do not.  An entry inside an exception does not count.

A text's weight is the sum of its entries' weights.  Length enters twice: the weight per word, and the weight less what a
text of this length holds more when toxic (the Poisson log ratio).  A logistic curve over these is fitted on the same labelled texts.  They are a sample of at most about ``SAMPLE`` labelled rows (chosen by a hash of the id) with
crc32(doc_id as text) mod 5 not 0.

Defined cases: NULL counts as the empty text, which scores as a text without entries; labels that are NULL or without a document are
ignored; a document labelled more than once has the mean label; without labels of both classes the priors alone decide;
repeated rows are scored alike; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import math
import re
import sys
import unicodedata
from collections import Counter
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recsmith.llm.common import in_slices, read_table, training_row
from recsmith.llm.quality import decided
from recsmith.session import materialize

SAMPLE = 20_000
PREFIXES = range(4, 9)
THRESHOLD = 0.5
SEEDS = ("idiot", "moron", "stupid", "loser", "scum", "worthless", "pathetic", "disgusting")
SEED_PRIOR = 2.0  # a seed counts as seen in so many toxic texts before any label
EXCEPTIONS = ("stupid question", "idiot proof", "trash can", "trash bin", "class clown", "clown fish", "pond scum")

# Letters of other scripts and signs that look like a Latin letter.
LOOKALIKES = {
    "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x", "і": "i", "ј": "j", "ѕ": "s", "к": "k", "м": "m",
    "т": "t", "н": "h", "в": "b", "ԁ": "d", "ӏ": "l", "α": "a", "ο": "o", "ε": "e", "ι": "i", "κ": "k", "ν": "v", "ρ": "p",
    "τ": "t", "υ": "u", "χ": "x", "ı": "i", "ℓ": "l", "ø": "o", "ß": "ss", "æ": "ae", "œ": "oe",
    "0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s",
}
SAME = {"l": "i"}  # after the above: letters of one skeleton class


def _fold_table() -> dict[int, str | None]:
    table: dict[int, str | None] = {}
    for c in range(sys.maxunicode + 1):
        if 0xD800 <= c <= 0xDFFF or (c > 0x2FFF and not 0xFE00 <= c <= 0xFFEF and not 0x1D400 <= c <= 0x1D7FF):
            continue  # other scripts stand for themselves
        ch = chr(c)
        if ch in LOOKALIKES:
            to = LOOKALIKES[ch]
        elif unicodedata.category(ch) in ("Cf", "Mn", "Me"):
            table[c] = None
            continue
        else:
            to = "".join(x for x in unicodedata.normalize("NFKD", ch).lower() if unicodedata.category(x) not in ("Mn", "Me", "Cf"))
            to = "".join(LOOKALIKES.get(x, x) for x in to)
        to = "".join(SAME.get(x, x) if x.isalnum() else " " for x in to) or None
        if to != ch:
            table[c] = to
    return table


_table: dict[int, str | None] = {}


def fold(text: str) -> str:
    """The skeleton of a text, with a space before its first word."""
    if not _table:
        _table.update(_fold_table())
    return (" " + text.lower() + " ").translate(_table)


def beginnings(word: str) -> Iterator[str]:
    yield from (word[:n] for n in PREFIXES if n <= len(word))


def llr(k1: float, n1: float, k2: float, n2: float) -> float:
    """Log-likelihood ratio (2 ln) of two proportions being one; negative if the first is the smaller."""
    def part(k: float, n: float, p: float) -> float:
        return (k * math.log(p) if k else 0.0) + ((n - k) * math.log(1 - p) if n - k else 0.0)
    p = (k1 + k2) / (n1 + n2)
    if p in (0.0, 1.0):
        return 0.0
    g = 2 * (part(k1, n1, k1 / n1) + part(k2, n2, k2 / n2) - part(k1, n1, p) - part(k2, n2, p))
    return g if k1 / n1 >= k2 / n2 else -g


class Lexicon:
    """Entries (folded beginning -> weight), exceptions (folded phrases) and the logistic curve."""

    def __init__(self, entries: dict[str, float], exceptions=(), curve=(-4.0, 2.0, 1.0, 0.0), drift: float = 0.0):
        self.entries, self.exceptions, self.curve = dict(entries), tuple(exceptions), np.asarray(curve, float)
        self.drift = drift  # entries per word that toxic texts hold more
        self._automaton = None

    def __getstate__(self):
        return self.entries, self.exceptions, self.curve, self.drift

    def __setstate__(self, state):
        self.__init__(*state)

    def automaton(self):
        if self._automaton is None:
            a = ahocorasick.Automaton()
            for e, w in self.entries.items():
                a.add_word(" " + e, (len(e), e))
            for p in self.exceptions:
                a.add_word(" " + p, (len(p), None))
            a.make_automaton()
            self._automaton = a
        return self._automaton

    def found(self, text: str | None) -> list[str]:
        """The entries in a text, outside exceptions; of nested entries the longest."""
        if not text or not (self.entries or self.exceptions):
            return []
        best: dict[int, str] = {}
        spans: list[tuple[int, int]] = []
        for end, (n, entry) in self.automaton().iter(fold(text)):
            if entry is None:
                spans.append((end - n, end))
            elif n > len(best.get(end - n, "")):
                best[end - n] = entry
        if not spans or not best:
            return list(best.values())
        spans.sort()
        out, at, open_end = [], 0, -1  # open_end: the furthest end of the exceptions that began so far
        for start in sorted(best):
            while at < len(spans) and spans[at][0] <= start:
                open_end = max(open_end, spans[at][1])
                at += 1
            if start > open_end:
                out.append(best[start])
        return out

    def weigh(self, text: str | None) -> tuple[float, int]:
        """Sum of the weights of the entries, and the words of the text."""
        return sum(map(self.entries.__getitem__, self.found(text))), len((text or "").split())

    def features(self, weight: np.ndarray, words: np.ndarray) -> np.ndarray:
        ratio = np.clip(weight - self.drift * words, -20, 20) / 5
        return np.stack([np.ones(len(weight)), np.log1p(weight), np.log1p(100 * weight / (words + 20)), ratio], axis=1)

    def score(self, texts: list[str | None]) -> np.ndarray:
        if not texts:
            return np.zeros(0)
        w, n = map(np.asarray, zip(*map(self.weigh, texts)))
        return 1 / (1 + np.exp(-np.clip(self.features(w.astype(float), n.astype(float)) @ self.curve, -30, 30)))


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.05) -> np.ndarray:
    """Ridge logistic regression by Newton's method; classes weigh as they occur."""
    b = np.zeros(x.shape[1])

    def loss(c: np.ndarray) -> float:
        z = x @ c
        return float((np.logaddexp(0, z) - y * z).sum() + ridge / 2 * (c * c).sum())

    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ b, -500, 500)))
        grad = x.T @ (p - y) + ridge * b
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(b)), grad)
        now = loss(b)
        while loss(b - step) > now and np.abs(step).max() > 1e-12:  # a full step may overshoot
            step = step / 2
        b = b - step
        if np.abs(step).max() < 1e-8:
            break
    return b


def _tally(sample: DataFrame, items) -> DataFrame:
    """sample (text, y) -> item, toxic, clean: how often each item occurs in items(text), a set or a Counter, by class."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            toxic, clean = Counter(), Counter()
            for text, y in zip(*(b.column(c).to_pylist() for c in ("text", "y"))):
                (toxic if y else clean).update(items(text or ""))
            keys = list(toxic.keys() | clean.keys())
            yield pa.RecordBatch.from_pydict({"item": pa.array(keys, pa.string()), "toxic": pa.array([toxic[k] for k in keys], pa.int64()),
                                              "clean": pa.array([clean[k] for k in keys], pa.int64())})

    return (sample.mapInArrow(run, "item string, toxic long, clean long").groupBy("item")
            .agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")))


def _text_beginnings(text: str) -> set[str]:
    return {p for w in set(fold(text).split()) for p in beginnings(w)}


def learn(docs: DataFrame, labels: DataFrame, label: str = "toxic", sample: int = SAMPLE) -> Lexicon:
    """docs (doc_id, text), labels (doc_id, label) -> lexicon, from at most about ``sample`` labelled ids, one row each."""
    seeds = {fold(s).strip(): s for s in SEEDS}
    given = [" ".join(fold(p).split()) for p in EXCEPTIONS]
    known = (labels.where(F.col(label).isNotNull() & training_row(F.col("doc_id")))
             .groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg((F.avg(F.col(label).cast("double")) >= 0.5).alias("y")))
    n = known.count()
    slots = 1 << 20
    chosen = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(slots)) < math.ceil(slots * min(1.0, sample / max(1, n))))
    # at most about ``sample`` ids and a flag; of an id's rows one stays (by a hash of its text), so an id on many rows counts once
    rows = materialize(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(chosen), "doc_id")
                       .groupBy("doc_id", "y").agg(F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("text"))
                       .select("text", "y").repartition(16))
    size = rows.agg(F.count(F.when(F.col("y"), 1)), F.count(F.when(~F.col("y"), 1))).first()
    n_tox, n_clean = float(size[0]), float(size[1])
    if not n_tox or not n_clean:
        return Lexicon({s: 3.0 for s in seeds}, given)
    least = max(3, math.ceil(0.003 * n_tox))
    # at least 0.3 % of the toxic texts hold each of these: their number is bounded by the beginnings in 333 texts
    tried = materialize(_tally(rows, _text_beginnings).where(F.col("toxic") >= least))
    n_tried = tried.count()
    found = {r["item"]: (r["toxic"], r["clean"]) for r in tried.where(F.col("toxic") * n_clean > 4 * F.col("clean") * n_tox).toLocalIterator()}
    bar = 2 * math.log(max(2, n_tried)) + 6

    def weight(toxic: float, clean: float) -> float:
        return math.log((toxic + 0.5) / (n_tox + 1)) - math.log((clean + 0.5) / (n_clean + 1))

    entries: dict[str, float] = {}
    for item, (toxic, clean) in sorted(found.items(), key=lambda x: (len(x[0]), x[0])):
        w = weight(toxic, clean)
        inner = max((entries[item[:k]] for k in PREFIXES if item[:k] in entries and k < len(item)), default=None)
        if llr(toxic, n_tox, clean, n_clean) >= bar and w > 1.5 and (inner is None or w > inner + 1):
            entries[item] = w
    for s in seeds:
        if not any(s.startswith(e) for e in entries):
            toxic, clean = found.get(s[:PREFIXES[-1]], (0, 0))
            entries[s] = max(0.5, weight(toxic + SEED_PRIOR, clean))
    plain = Lexicon(entries, given)
    rates = _tally(rows, lambda text: Counter(plain.found(text)) + Counter({"": len(text.split())}))
    hits = {r["item"]: (r["toxic"], r["clean"]) for r in rates.toLocalIterator()}  # one row per entry
    words_toxic, words_clean = (max(1, x) for x in hits.pop("", (1, 1)))
    drift = 0.0
    for e in entries:
        toxic, clean = hits.get(e, (0, 0))
        toxic += SEED_PRIOR * any(x.startswith(e) or e.startswith(x) for x in seeds)
        entries[e] = min(8.0, max(0.05, math.log((toxic + 0.5) / words_toxic) - math.log((clean + 0.5) / words_clean)))
        drift += toxic / words_toxic - clean / words_clean
    matcher = re.compile(r"(?<= )(?:" + "|".join(sorted(map(re.escape, entries), key=len, reverse=True)) + r")\S*")

    def around(text: str) -> set[str]:
        folded = " " + " ".join(fold(text).split()) + " "
        out = set()
        for m in matcher.finditer(folded):
            before, after = folded[:m.start()].rsplit(" ", 2)[-2:-1], folded[m.end():].split(" ", 2)[1:2]
            out.update([f"{before[0]} {m[0]}"] * bool(before and before[0]) + [f"{m[0]} {after[0]}"] * bool(after and after[0]))
        return out

    phrases = _tally(rows, around).where((F.col("clean") >= 3) & (F.col("clean") * n_tox > 2 * F.col("toxic") * n_clean))
    learned = [r["item"] for r in phrases.toLocalIterator() if llr(r["clean"], n_clean, r["toxic"], n_tox) >= 4]
    lexicon = Lexicon(entries, [*given, *learned], drift=max(0.0, drift))

    def weighed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            w, k = zip(*map(lexicon.weigh, b.column("text").to_pylist())) if len(b) else ((), ())
            yield pa.RecordBatch.from_arrays([pa.array(w, pa.float64()), pa.array(k, pa.float64()), b.column("y")], names=["w", "k", "y"])

    # at most about ``sample`` rows of three numbers
    got = np.array([tuple(map(float, r)) for r in rows.mapInArrow(weighed, "w double, k double, y boolean").toLocalIterator()])
    lexicon.curve = _logistic(lexicon.features(got[:, 0], got[:, 1]), got[:, 2])
    return lexicon


def scores(docs: DataFrame, lexicon: Lexicon) -> DataFrame:
    """docs (doc_id, text, ..) -> doc_id, score."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in in_slices(batches):
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(lexicon.score(b.column(1).to_pylist()), pa.float64())],
                                             names=["doc_id", "score"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text")).mapInArrow(run, "doc_id long, score double")


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, held_out, score, predicted for every document."""
    docs = read_table(spark, sf_dir, "documents")
    return decided(scores(docs, learn(docs, read_table(spark, sf_dir, "labels"))), THRESHOLD)
