"""Secret scans: base patterns, and a character convolutional network over every candidate and its surroundings.

Base findings come from three patterns (assignments to a password, secret, token or key; access key ids; long hexadecimal
runs).  Candidates are all runs of 16 or more key characters; of a run that touches base findings, the parts of 16 or more beside
them are candidates too.  The network slides over the candidate in overlapping windows and reads each with the
characters around the run: character embeddings, one convolution, maxima over the part before, the window and the part
behind, the mean over the window, a logistic output; a candidate has the highest output of its windows.  It is trained with numpy on candidates labelled by the base findings
(half of them with their surroundings blanked, so that it learns what a secret itself looks like) and on random keys of alphabets
that no base pattern names.  Every distinct candidate window teaches: up to ``SAMPLE`` of each label in one list, more
in parts of about ``PART_ROWS`` that tasks train on at the same time, all from the same weights, which are averaged after every
round over the whole; calibration and threshold are sums and exact order statistics over all of them.
Networks of one half score the other; these scores calibrate the output to probabilities and
set the threshold: the highest that still finds ``RECALL`` of the secrets, raised where it takes more than ``TAKE`` of the rest.  Candidates that reach it and touch
no base finding are added as findings of kind "cnn"; base findings always stay.

Defined cases: NULL counts as the empty text; positions are code points, ends exclusive; without labelled candidates of both
kinds nothing is added; repeated rows and ids are scanned each; an empty table gives an empty result; further
columns are ignored.  Very long texts and candidates are scanned whole.
"""

from __future__ import annotations

import hashlib
import math
import re
from bisect import bisect_left
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recsmith.llm.common import in_slices, read_table, worker_tables
from recsmith.operators.split import with_global_index
from recsmith.session import materialize

KINDS = ("assign", "access", "hex", "cnn")
BEFORE, BODY, BEHIND = 24, 40, 8
STEP = 8  # from one window of a long candidate to the next
SAMPLE, RECALL, SEED = 2048, 0.99, 5
#: Windows a task trains on, rounds over all of them, and batches that small parts repeat their windows for.
PART_ROWS, ROUNDS, STEPS, BATCH = 16_384, 4, 1024, 64
TAKE, LEAST_RECALL = 0.01, 0.9  # of the candidates without a label at most this share is taken; below this recall nothing is added

# The base patterns.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
# Alphabets of keys that no base pattern names (base64, letters and digits, upper-case hexadecimal, lower case and digits).
LETTERS = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ"
ALPHABETS = (LETTERS + "0123456789+/", LETTERS + "0123456789", "0123456789ABCDEF", LETTERS[:26] + "0123456789")
_KEYWORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
#: Access ids and long hexadecimal runs lie inside runs of 16 or more key characters.
LEAST = 16
RUN = re.compile(r"(?<![A-Za-z0-9+/_.=-])[A-Za-z0-9+/_.=-]{%d,}" % LEAST)
PART = re.compile(r"[A-Za-z0-9+_-]{%d,}" % LEAST)

Span = tuple[int, int, int]  # start, place of the kind in KINDS, end


def base_findings(text: str, runs: list[re.Match] | None = None) -> list[Span]:
    """Base findings by start, then kind."""
    out: list[Span] = []
    if "=" in text or ":" in text:
        low = text.lower()
        if any(k in low for k in _KEYWORDS):
            out += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    for r in RUN.finditer(text) if runs is None else runs:
        out += [(r.start() + m.start(), 1, r.start() + m.end()) for m in ACCESS.finditer(r[0]) if len(m[0]) >= 20]
        out += [(r.start() + m.start(), 2, r.start() + m.end()) for m in HEX.finditer(r[0]) if len(m[0]) >= 24]
    return sorted(out)


def window(text: str, start: int, end: int, at: int | None = None, to: int | None = None) -> str:
    """BEFORE characters before start, the first BODY from ``at`` to ``to`` and BEHIND characters from end on, filled up with NULs."""
    at, to = start if at is None else at, end if to is None else to
    before, body, behind = text[max(0, start - BEFORE):start], text[at:min(to, at + BODY)], text[end:end + BEHIND]
    return before.rjust(BEFORE, "\0") + body.ljust(BODY, "\0") + behind.ljust(BEHIND, "\0")


def windows(text: str, run: tuple[int, int], start: int, end: int) -> Iterator[tuple[int, int, str]]:
    """(start, end, window) of the stretches of BODY characters that cover a candidate, STEP apart, and
    of the parts of a longer one between slashes, points and equals signs; the surroundings are those of its run, as in training."""
    own = [(start, end)]
    if end - start > BODY:
        own += [m.span() for m in PART.finditer(text, start, end) if m.span() != (start, end)]
    for first, end in own:
        last = max(first, end - BODY)
        for at in [*range(first, last, STEP), last]:
            to = min(end, at + BODY)
            yield at, to, window(text, *run, at, to)


def scan(text: str | None) -> tuple[list[Span], list[tuple[int, int, bool, str]]]:
    """Base findings, and the candidates (start, end, touches a base finding, window), one for each of their windows."""
    text = text or ""
    runs = list(RUN.finditer(text))
    base = base_findings(text, runs)
    cands = []
    near: list[tuple[int, int]] = []  # findings not yet behind, by start; runs and findings are both met in order
    todo = 0
    for r in runs:
        start, end = r.span()
        while todo < len(base) and base[todo][0] < end:
            near.append((base[todo][0], base[todo][2]))
            todo += 1
        met = near = [f for f in near if start < f[1]]
        if not met:
            cands += [(start, end, False, w) for _, _, w in windows(text, r.span(), start, end)]
            continue
        starts, furthest = [f[0] for f in met], list(accumulate((f[1] for f in met), max))
        for a, b, w in windows(text, r.span(), start, end):
            before = bisect_left(starts, b)  # findings that begin before the window ends
            if before and a < furthest[before - 1]:
                cands.append((start, end, True, w))
        at = start
        for s, e in [*met, (end, end)]:  # by start
            if s - at >= LEAST:
                cands += [(at, s, False, w) for _, _, w in windows(text, r.span(), at, s)]
            at = max(at, e)
    return base, cands


# ---- the network -----------------------------------------------------------

_WIDTH, _EMBED, _FILTERS, _SIGNS = 5, 8, 24, 97


def signs(windows: list[str]) -> np.ndarray:
    """Sign numbers: 0 for filling, 1..95 printable ASCII, 96 anything else."""
    n = BEFORE + BODY + BEHIND
    codes = np.frombuffer("".join(windows).encode("utf-32-le"), "<u4").reshape(-1, n).astype(np.int64)
    return np.where(codes == 0, 0, np.where((codes >= 32) & (codes < 127), codes - 31, _SIGNS - 1))


class Network:
    """Weights of the network; ``logits`` for windows, ``train`` by Adam."""

    def __init__(self, seed: int = SEED):
        rng = np.random.default_rng(seed)
        self.rng = rng
        self.p = {"e": rng.normal(0, 0.3, (_SIGNS, _EMBED)), "w": rng.normal(0, 0.2, (_WIDTH * _EMBED, _FILTERS)),
                  "b": np.zeros(_FILTERS), "v": rng.normal(0, 0.1, 4 * _FILTERS), "c": np.zeros(1)}
        self.m, self.s, self.step = {k: np.zeros_like(v) for k, v in self.p.items()}, {k: np.zeros_like(v) for k, v in self.p.items()}, 0
        edge = _WIDTH // 2
        self.parts = [slice(0, BEFORE - edge), slice(BEFORE - edge, BEFORE + BODY - edge), slice(BEFORE + BODY - edge, None)]

    def state(self) -> np.ndarray:
        """Weights, Adam's sums and the number of steps in one row of numbers."""
        return np.concatenate([v.ravel() for d in (self.p, self.m, self.s) for v in d.values()] + [[float(self.step)]])

    def load(self, state: np.ndarray) -> Network:
        at = 0
        for d in (self.p, self.m, self.s):
            for k, v in d.items():
                d[k] = state[at:at + v.size].reshape(v.shape).copy()
                at += v.size
        self.step = int(state[at])
        return self

    def forward(self, x: np.ndarray):
        p, n = self.p, x.shape[1] - _WIDTH + 1
        emb = p["e"][x] * (x > 0)[:, :, None]
        cols = np.concatenate([emb[:, i:i + n] for i in range(_WIDTH)], axis=2)
        h = np.maximum(cols @ p["w"] + p["b"], 0)
        tops = [h[:, s].argmax(axis=1) for s in self.parts]
        body = (x[:, BEFORE:BEFORE + BODY] > 0)[:, :, None]
        size = np.maximum(1, body.sum(axis=1))
        mean = (h[:, self.parts[1]] * body).sum(axis=1) / size
        feats = np.concatenate([np.take_along_axis(h[:, s], t[:, None], 1)[:, 0] for s, t in zip(self.parts, tops)] + [mean], axis=1)
        return feats @ p["v"] + p["c"], (cols, h, tops, body, size, feats)

    def logits(self, x: np.ndarray) -> np.ndarray:
        return np.concatenate([self.forward(x[i:i + 1024])[0] for i in range(0, len(x), 1024)]) if len(x) else np.zeros(0)

    def gradient(self, x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> dict[str, np.ndarray]:
        z, (cols, h, tops, body, size, feats) = self.forward(x)
        d = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y) * weight / len(y)
        g = {"v": feats.T @ d, "c": np.array([d.sum()])}
        back = d[:, None] * self.p["v"]
        dh = np.zeros_like(h)
        f = _FILTERS
        for k, (s, t) in enumerate(zip(self.parts, tops)):
            np.put_along_axis(dh[:, s], t[:, None], back[:, None, k * f:(k + 1) * f], 1)
        dh[:, self.parts[1]] += (back[:, 3 * f:] / size)[:, None] * body
        dh *= h > 0
        g["w"] = np.tensordot(cols, dh, ([0, 1], [0, 1]))
        g["b"] = dh.sum(axis=(0, 1))
        dcols = dh @ self.p["w"].T
        n = dcols.shape[1]
        demb = np.zeros((*x.shape, _EMBED))
        for i in range(_WIDTH):
            demb[:, i:i + n] += dcols[:, :, i * _EMBED:(i + 1) * _EMBED]
        demb *= (x > 0)[:, :, None]
        g["e"] = np.stack([np.bincount(x.ravel(), demb[:, :, j].ravel(), minlength=_SIGNS) for j in range(_EMBED)], axis=1)
        return g

    def train(self, x: np.ndarray, y: np.ndarray, epochs: int = 12, batch: int = BATCH, rate: float = 3e-3) -> None:
        m, s = self.m, self.s
        weight = np.where(y > 0, 0.5 / max(1e-9, y.mean()), 0.5 / max(1e-9, 1 - y.mean()))
        for _ in range(epochs):
            order = self.rng.permutation(len(y))
            for i in range(0, len(order), batch):
                at = order[i:i + batch]
                xs = x[at].copy()
                blank = self.rng.random(len(at)) < 0.5
                xs[blank, :BEFORE] = 0
                xs[blank, BEFORE + BODY:] = 0
                self.step += 1
                for k, g in self.gradient(xs, y[at], weight[at]).items():
                    m[k] = 0.9 * m[k] + 0.1 * g
                    s[k] = 0.999 * s[k] + 0.001 * g * g
                    self.p[k] -= rate * (m[k] / (1 - 0.9 ** self.step)) / (np.sqrt(s[k] / (1 - 0.999 ** self.step)) + 1e-8)


class Detector:
    """A trained network, its calibration (probability = logistic(a logit + b)) and threshold."""

    def __init__(self, net: Network | None = None, a: float = 1.0, b: float = 0.0, threshold: float = 2.0):
        self.net, self.a, self.b, self.threshold = net, a, b, threshold

    def probability(self, windows: list[str]) -> np.ndarray:
        if self.net is None or not windows:
            return np.zeros(len(windows))
        z = np.concatenate([self.net.logits(signs(windows[i:i + 8192])) for i in range(0, len(windows), 8192)])
        return 1 / (1 + np.exp(-np.clip(self.a * z + self.b, -30, 30)))

    def added(self, scans: list) -> list[list[Span]]:
        """For each text's scan, the findings the network adds."""
        todo = [(i, c) for i, (_, cands) in enumerate(scans) for c in cands if not c[2]]
        out: list[list[Span]] = [[] for _ in scans]
        for (i, c), p in zip(todo, self.probability([c[3] for _, c in todo])):
            if p >= self.threshold and (not out[i] or out[i][-1] != (c[0], 3, c[1])):  # windows of a candidate follow each other
                out[i].append((c[0], 3, c[1]))
        return out


def redrawn(windows: list[str], others: list[str], n: int, rng: np.random.Generator) -> list[str]:
    """n windows whose candidate is a random key of another alphabet, in the surroundings of labelled and of other windows:
    the network learns the shape of keys that no base pattern names."""
    out = []
    for i in range(n):
        around = windows[i % len(windows)] if i % 2 else others[int(rng.integers(len(others)))]
        signs = ALPHABETS[i % len(ALPHABETS)]
        lead = "".join(rng.choice(list(LETTERS), int(rng.integers(2, 5)))) + "_-"[int(rng.integers(2))] if rng.random() < 0.4 else ""
        key = lead + "".join(rng.choice(list(signs), int(rng.integers(20, BODY + 1))))
        out.append(around[:BEFORE] + key[:BODY].ljust(BODY, "\0") + around[BEFORE + BODY:])
    return out


def platt(z: np.ndarray, t: np.ndarray) -> tuple[float, float]:
    """(a, b) of the probability logistic(a z + b), by Newton steps that are halved until the loss falls.

    The targets are smoothed, so the loss has its minimum at finite values even where the scores separate perfectly."""
    goal = np.where(t > 0, (t.sum() + 1) / (t.sum() + 2), 1 / ((1 - t).sum() + 2))
    scale = max(1e-9, float(np.abs(z).max()))
    x = np.stack([z / scale, np.ones(len(z))], axis=1)
    ab = np.zeros(2)

    def loss(c: np.ndarray) -> float:
        m = x @ c
        return float((np.logaddexp(0, m) - goal * m).sum() + 5e-4 * (c * c).sum())

    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ ab, -500, 500)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2), x.T @ (p - goal) + 1e-3 * ab)
        now = loss(ab)
        while loss(ab - step) > now and np.abs(step).max() > 1e-12:
            step = step / 2
        ab = ab - step
        if np.abs(step).max() < 1e-10:
            break
    return float(ab[0] / scale), float(ab[1])


def fit(windows: list[str], labels: list[bool], recall: float = RECALL, take: float = TAKE) -> Detector:
    """The network on all windows; calibration and threshold from networks that did not see the window they score.

    The threshold is the highest that finds ``recall`` of the secrets, or the lowest above it that takes at most ``take`` of the
    other candidates; a detector that then finds less than ``LEAST_RECALL``, or whose score falls where secrets are, adds nothing."""
    y = np.asarray(labels, float)
    if not 0 < y.sum() < len(y):
        return Detector()
    rng = np.random.default_rng(SEED)
    known, others = [w for w, t in zip(windows, labels) if t], [w for w, t in zip(windows, labels) if not t]
    made = redrawn(known, others, max(len(known), len(others) // 2), rng)
    x = signs(windows + made)
    y = np.concatenate([y, np.ones(len(made))])
    real = np.arange(len(y)) < len(windows)
    fold = np.zeros(len(y), int)
    for part in (real & (y > 0), real & (y == 0), ~real):  # each kind is halved
        fold[part] = np.arange(part.sum()) % 2
    z = np.zeros(len(y))
    for f in (0, 1):
        own = fold == f
        if not 0 < y[~own].sum() < (~own).sum():
            own = np.ones(len(y), bool)
        net = Network()
        net.train(x[~own] if not own.all() else x, y[~own] if not own.all() else y)
        z[fold == f] = net.logits(x[fold == f])
    a, b = platt(z, y)
    if not a > 0:
        return Detector()
    whole = Network()
    whole.train(x, y)
    detector = Detector(whole, a, b)
    p = 1 / (1 + np.exp(-np.clip(a * z + b, -30, 30)))
    # labelled secrets and redrawn keys alike: what a base pattern has found needs no network
    found = np.sort(p[y > 0])
    rest = np.sort(p[y == 0])[::-1]
    detector.threshold = max(1e-9, float(found[int(np.floor((1 - recall) * len(found)))]), float(np.nextafter(rest[int(take * len(rest))], 2)))
    return detector if np.mean(found >= detector.threshold) >= LEAST_RECALL else Detector()


# ---- on tables -------------------------------------------------------------

_SPAN = pa.list_(pa.struct([("start", pa.int64()), ("kind", pa.int64()), ("end", pa.int64())]))
_CAND = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("base", pa.bool_()), ("window", pa.string())]))


def scans(docs: DataFrame) -> DataFrame:
    """docs (doc_id, text, ..) -> doc_id, base, cands of every row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker_tables("secrets")
        for b in in_slices(batches):
            found = [scan(t) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([
                b.column(0), pa.array([[dict(zip(("start", "kind", "end"), s)) for s in f[0]] for f in found], _SPAN),
                pa.array([[dict(zip(("start", "end", "base", "window"), c)) for c in f[1]] for f in found], _CAND)], names=["doc_id", "base", "cands"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, "doc_id long, base array<struct<start:long,kind:long,end:long>>, "
             "cands array<struct<start:long,end:long,base:boolean,window:string>>")


def train(found: DataFrame, whole: int = SAMPLE, part_rows: int = PART_ROWS) -> Detector:
    """Rows of scans() -> detector, from every distinct candidate window."""
    # the same text in many copies teaches once
    each = found.select(F.explode("cands").alias("c")).select("c.base", "c.window").distinct()
    each = materialize(each.withColumn("h", F.xxhash64("window")))
    n = {r[0]: r[1] for r in each.groupBy("base").count().collect()}
    known, others = n.get(True, 0), n.get(False, 0)
    if not known or not others:
        return Detector()
    if max(known, others) <= whole:
        rows = sorted((r["h"], r["window"], r["base"]) for r in each.collect())  # at most ``whole`` of each label
        return fit([r[1] for r in rows], [r[2] for r in rows])
    return fit_in_parts(each, known, others, part_rows)


def _part(pdf: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(signs, labels, folds) of a part's windows and of the keys redrawn in their surroundings, as many as ``fit`` takes."""
    pdf = pdf.sort_values(["h", "base", "window"])
    windows, base, h = pdf["window"].tolist(), pdf["base"].to_numpy(bool), pdf["h"].to_numpy()
    known, others = [w for w, t in zip(windows, base) if t], [w for w, t in zip(windows, base) if not t]
    rng = np.random.default_rng([SEED, int(pdf["part"].iloc[0])])
    made = redrawn(known or others, others or known, max(len(known), len(others) // 2), rng)
    return (signs(windows + made), np.concatenate([base.astype(float), np.ones(len(made))]),
            np.concatenate([(h >> 40) & 1, np.arange(len(made)) % 2]))


def fit_in_parts(each: DataFrame, known: int, others: int, part_rows: int = PART_ROWS, recall: float = RECALL, take: float = TAKE) -> Detector:
    """``fit`` for windows (base, window, h) of any number: three networks (without either half, and on all) train on hashed parts
    side by side; after every round their weights and Adam's sums are averaged by rows.  Only these numbers reach the driver."""
    parts = max(1, -(-(known + others) // part_rows))
    rows = (known + others + max(known, others // 2)) / parts
    epochs = max(1, math.ceil(STEPS * BATCH / rows / ROUNDS))
    dealt = materialize(each.withColumn("part", F.pmod("h", F.lit(parts)).cast("int")).repartition(parts, "part"))
    nets = [Network().state() for _ in range(3)]

    def learned(state: list, round_: int):
        def run(pdf: pd.DataFrame) -> pd.DataFrame:
            worker_tables("secrets")
            x, y, fold = _part(pdf)
            out, rows = [], []
            for i, start in enumerate(state):
                mine = fold != i  # the third network has no fold left out
                net = Network(SEED + 7 * round_ + 1000 * int(pdf["part"].iloc[0]))
                if 0 < y[mine].sum() < mine.sum():
                    net.load(start)
                    net.train(x[mine], y[mine], epochs)
                    out.append(net.state().tolist())
                    rows.append(int(mine.sum()))
                else:
                    out.append([])
                    rows.append(0)
            return pd.DataFrame({"part": [pdf["part"].iloc[0]], "rows": [rows], "state": [out]})

        got = dealt.groupBy("part").applyInPandas(run, "part int, rows array<long>, state array<array<double>>")
        return sorted(got.collect(), key=lambda r: r["part"])  # a few thousand numbers a part

    for round_ in range(ROUNDS):
        got = learned(nets, round_)
        for i in range(3):
            weights = [r["rows"][i] for r in got]
            if sum(weights):
                nets[i] = sum(w / sum(weights) * np.asarray(r["state"][i]) for w, r in zip(weights, got) if w)

    def score(pdf: pd.DataFrame) -> pd.DataFrame:
        x, y, fold = _part(pdf)
        z = np.zeros(len(y))
        for i in (0, 1):
            z[fold == i] = Network().load(nets[i]).logits(x[fold == i])
        return pd.DataFrame({"z": z, "y": y})

    scored = materialize(dealt.groupBy("part").applyInPandas(score, "z double, y double"))
    a, b = platt_of(scored)
    if not a > 0:
        return Detector()
    detector = Detector(Network().load(nets[2]), a, b)

    def at(rows: DataFrame, order, place: int) -> float:
        return with_global_index(rows, [order], "_n").where(F.col("_n") == place).first()["z"]

    secrets, rest = scored.where("y > 0").select("z"), scored.where("y = 0").select("z")
    count = secrets.count()
    least, most = at(secrets, F.col("z").asc(), int(np.floor((1 - recall) * count))), at(rest, F.col("z").desc(), int(take * rest.count()))
    p_least, p_most = (float(1 / (1 + np.exp(-np.clip(a * z + b, -30, 30)))) for z in (least, most))
    detector.threshold = max(1e-9, p_least, float(np.nextafter(p_most, 2)))
    reached = secrets.where(F.col("z") > most if p_most >= p_least else F.col("z") >= least).count()
    return detector if reached / count >= LEAST_RECALL else Detector()


def platt_of(scored: DataFrame) -> tuple[float, float]:
    """``platt`` of a table (z, y): each Newton step is one row of sums."""
    first = scored.agg(F.max(F.abs("z")).alias("scale"), F.sum("y").alias("t"), F.count("*").alias("n")).first()
    scale, t, n = max(1e-9, float(first["scale"])), float(first["t"]), int(first["n"])
    goal = F.when(F.col("y") > 0, F.lit((t + 1) / (t + 2))).otherwise(F.lit(1 / (n - t + 2)))
    x = F.col("z") / F.lit(scale)

    def sums(ab: np.ndarray):
        m = x * F.lit(float(ab[0])) + F.lit(float(ab[1]))
        p = 1 / (1 + F.exp(-m))
        loss = F.greatest(m, F.lit(0.0)) + F.log1p(F.exp(-F.abs(m))) - goal * m
        r = scored.agg(F.sum(loss), F.sum((p - goal) * x), F.sum(p - goal), F.sum(p * (1 - p) * x * x), F.sum(p * (1 - p) * x), F.sum(p * (1 - p))).first()
        return r[0] + 5e-4 * float(ab @ ab), np.array([r[1], r[2]]) + 1e-3 * ab, np.array([[r[3], r[4]], [r[4], r[5]]]) + 1e-3 * np.eye(2)

    ab = np.zeros(2)
    now = sums(ab)
    for _ in range(100):
        step = np.linalg.solve(now[2], now[1])
        new = sums(ab - step)
        while new[0] > now[0] and np.abs(step).max() > 1e-12:
            step = step / 2
            new = sums(ab - step)
        ab, now = ab - step, new
        if np.abs(step).max() < 1e-8:
            break
    return float(ab[0] / scale), float(ab[1])


def named(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in sorted(spans))


def findings(found: DataFrame, detector: Detector) -> DataFrame:
    """Rows of scans() -> doc_id, n_assign, n_access, n_hex, n_cnn, base_sha256, spans."""
    schema = pa.schema([("doc_id", pa.int64()), *[(f"n_{k}", pa.int64()) for k in KINDS], ("base_sha256", pa.string()), ("spans", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            base = [[(s["start"], s["kind"], s["end"]) for s in r] for r in b.column(1).to_pylist()]
            cands = [[(c["start"], c["end"], c["base"], c["window"]) for c in r] for r in b.column(2).to_pylist()]
            more = detector.added(list(zip(base, cands)))
            every = [x + y for x, y in zip(base, more)]
            counts = [[sum(s[1] == k for s in r) for r in every] for k in range(len(KINDS))]
            yield pa.RecordBatch.from_arrays([b.column(0), *[pa.array(c, pa.int64()) for c in counts],
                                              pa.array([hashlib.sha256(named(r).encode()).hexdigest() for r in base], pa.string()),
                                              pa.array([named(r) for r in every], pa.string())], schema=schema)

    return found.mapInArrow(run, "doc_id long, n_assign long, n_access long, n_hex long, n_cnn long, base_sha256 string, spans string")


def op10_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, n_cnn, base_sha256, spans for every document."""
    found = materialize(scans(read_table(spark, sf_dir, "documents")))
    return findings(found, train(found))


def redacted(text: str, spans: list[Span], mark: str = "[SECRET]") -> str:
    """The text with every finding, or run of overlapping findings, replaced by the mark."""
    out, at, open_end = [], 0, -1
    for start, _, end in sorted(spans):
        if start >= open_end:
            out += [text[at:start], mark]
        open_end = max(open_end, end)
        at = open_end
    return "".join(out) + text[at:]


def redact(docs: DataFrame) -> DataFrame:
    """docs -> the same rows and columns with secrets replaced in text, and n_chars as the text now has."""
    detector = train(scans(docs))
    schema = docs.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker_tables("secrets")
        for b in in_slices(batches):
            texts = b.column("text").to_pylist()
            seen = [scan(t) for t in texts]
            new = [t if t is None else redacted(t, s[0] + m) for t, s, m in zip(texts, seen, detector.added(seen))]
            cols = {n: b.column(n) for n in b.schema.names} | {"text": pa.array(new, pa.string())}
            if "n_chars" in cols:
                old = cols["n_chars"].to_pylist()
                cols["n_chars"] = pa.array([o if t == u else len(u) for o, t, u in zip(old, texts, new)], b.schema.field("n_chars").type)
            yield pa.RecordBatch.from_arrays(list(cols.values()), names=list(cols))

    return docs.mapInArrow(run, schema)
