"""Quality classifier: random Fourier features of document statistics, ridge regression, isotonic calibration.

Each text becomes ``STATISTICS``; standardised, they are mapped to ``N_FEATURES`` random cosines, whose inner
products approximate a Gaussian kernel. Every partition sums its part of the normal equations, the parts
are added up, and one small system gives the ridge weights. The raw scores of the training rows, binned
to a fixed grid, are calibrated by isotonic regression (pool adjacent violators); between the centres of
its blocks the calibration is linear, so order is kept.

All labelled rows that are not held out are used; nothing is sampled. Only sums of fixed size reach the driver.
Defined results: null and empty texts have all statistics 0 and get a score like any text. Labels that are
null are ignored, a document labelled twice counts with its mean label. With no labelled row every score
is 0.5 (predicted 1). Ids that are null are never learned from. Repeated rows are scored each for itself.
Other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import held_out, texts
from ledgerline.llm.line_crf import _DIGITS, _LETTERS, _MARKS, _UPPERS, MIN_WORDS, SYMBOLS, measure

STATISTICS = ("words", "word_length", "symbols", "upper", "digits", "marks", "bars", "letters", "dup_lines", "repeated", "distinct", "lines", "line_words", "ended", "short_text")
N_FEATURES, BANDWIDTH, RIDGE, SEED = 256, 4.0, 1e-3, 7
#: The calibration's grid of raw scores: this many bins of 0.001 from LOWEST on.
BINS, LOWEST, STEP = 3000, -1.0, 0.001


def statistics(text: str) -> tuple[float, ...]:
    base, lines, sizes, _ = measure(text)
    n = base.n_words
    if not n:
        return (0.0,) * len(STATISTICS)
    raw = text.encode("utf-8", "surrogatepass")
    size = sum(map(len, lines))
    without = lambda kind: (len(raw) - len(raw.translate(None, kind)))
    letters = without(_LETTERS)
    return (
        np.log1p(n), base.word_chars / n, base.n_symbols / size, without(_UPPERS) / max(1, letters), without(_DIGITS) / size, without(_MARKS) / n, raw.count(b"|") / n, letters / size,
        base.n_dup_lines / len(lines), base.n_repeat_words / n, len(set(raw.split())) / n, np.log1p(len(lines)), np.log1p(n / len(lines)), sum(x.rstrip()[-1:] in b".!?" for x in lines) / len(lines), float(n < MIN_WORDS),
    )


def measured(docs: DataFrame) -> DataFrame:
    """doc_id and x, the statistics of its text."""
    kind = pa.list_(pa.float64())

    def run(parts):
        for batch in parts:
            x = [statistics(t) for t in texts(batch)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(x, kind)], names=["doc_id", "x"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, x array<double>")


@dataclass
class Model:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    at: np.ndarray  # calibration: raw scores, rising
    value: np.ndarray  # and what they stand for

    def features(self, x: np.ndarray) -> np.ndarray:
        return cosines((x - self.mean) / self.scale)

    def score(self, x: np.ndarray) -> np.ndarray:
        if not len(self.weights):
            return np.full(len(x), 0.5)
        return np.clip(np.interp(self.features(x) @ self.weights, self.at, self.value), 0, 1)


def cosines(x: np.ndarray) -> np.ndarray:
    """Random Fourier features of standardised rows, and a constant."""
    rng = np.random.default_rng(SEED)
    w = rng.standard_normal((x.shape[1], N_FEATURES)) / BANDWIDTH
    b = rng.uniform(0, 2 * np.pi, N_FEATURES)
    return np.c_[np.sqrt(2 / N_FEATURES) * np.cos(np.clip(x, -8, 8) @ w + b), np.ones(len(x))]


def isotonic(value: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """The rising sequence nearest to ``value`` in weighted squares (pool adjacent violators)."""
    blocks: list[list[float]] = []
    for v, w in zip(value, weight):
        blocks.append([v, w, 1])
        while len(blocks) > 1 and blocks[-2][0] >= blocks[-1][0]:
            v2, w2, n2 = blocks.pop()
            v1, w1, n1 = blocks.pop()
            blocks.append([(v1 * w1 + v2 * w2) / (w1 + w2), w1 + w2, n1 + n2])
    return np.repeat([b[0] for b in blocks], [int(b[2]) for b in blocks])


def _sums(rows: DataFrame, parts) -> np.ndarray | None:
    """Adds up the arrays that ``parts`` makes of the partitions: in some tasks first, then of those few here."""

    def add(blobs):
        total = None
        for batch in blobs:
            for raw in batch.column("sums").to_pylist():
                x = np.frombuffer(raw)
                total = x if total is None else total + x
        if total is not None:
            yield pa.RecordBatch.from_pydict({"sums": [total.tobytes()]})

    made = rows.mapInArrow(parts, "sums binary").repartition(16).mapInArrow(add, "sums binary").collect()
    return sum(np.frombuffer(r.sums) for r in made) if made else None


def _columns(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    x = np.array(batch.column("x").to_pylist(), float).reshape(-1, len(STATISTICS))
    return x, np.array(batch.column("y").to_pylist(), float)


def fit(stats: DataFrame, labels: DataFrame) -> Model:
    """The model of all labelled rows that are not held out. stats: see ``measured``."""
    known = (
        labels.select("doc_id", "quality").filter(F.col("doc_id").isNotNull() & F.col("quality").isNotNull() & ~held_out(F.col("doc_id")))
        .groupBy("doc_id").agg(F.avg("quality").alias("y"))
    )
    rows = stats.join(known, "doc_id").select("x", "y")
    n = len(STATISTICS)
    none = Model(np.zeros(n), np.ones(n), np.zeros(0), np.zeros(0), np.zeros(0))

    def moments(parts):
        for batch in parts:
            x, _ = _columns(batch)
            if len(x):
                yield pa.RecordBatch.from_pydict({"sums": [np.r_[len(x), x.sum(0), (x**2).sum(0)].tobytes()]})

    found = _sums(rows, moments)
    if found is None:
        return none
    count, mean = found[0], found[1 : n + 1] / found[0]
    scale = np.sqrt(np.maximum(found[n + 1 :] / count - mean**2, 0))
    model = Model(mean, np.where(scale > 1e-9, scale, 1.0), np.zeros(0), np.zeros(0), np.zeros(0))

    def normal(parts):
        total = None
        for batch in parts:
            x, y = _columns(batch)
            z = model.features(x)
            part = np.c_[z.T @ z, z.T @ y]
            total = part if total is None else total + part
        if total is not None:
            yield pa.RecordBatch.from_pydict({"sums": [total.ravel().tobytes()]})

    a = _sums(rows, normal).reshape(N_FEATURES + 1, N_FEATURES + 2)
    model.weights = np.linalg.solve(a[:, :-1] + RIDGE * count * np.diag(np.r_[np.ones(N_FEATURES) / N_FEATURES, 1e-9]), a[:, -1])

    def binned(parts):
        total = np.zeros((2, BINS))
        for batch in parts:
            x, y = _columns(batch)
            k = np.clip(((model.features(x) @ model.weights - LOWEST) / STEP).astype(int), 0, BINS - 1)
            total += [np.bincount(k, minlength=BINS), np.bincount(k, y, minlength=BINS)]
        yield pa.RecordBatch.from_pydict({"sums": [total.ravel().tobytes()]})

    weight, good = _sums(rows, binned).reshape(2, BINS)
    full = np.flatnonzero(weight)
    centre = LOWEST + (full + 0.5) * STEP
    level = isotonic(good[full] / weight[full], weight[full])
    # one point for each block, at the mean of its raw scores; beyond the ends half a part in a thousand is left, so order stays
    starts = np.flatnonzero(np.r_[True, np.diff(level) > 0])
    mass = np.add.reduceat(weight[full], starts)
    at = np.add.reduceat(weight[full] * centre, starts) / mass
    model.at, model.value = np.r_[-1e3, LOWEST, at, LOWEST + BINS * STEP, 1e3], np.r_[0, 0, np.clip(level[starts], 0.0005, 0.9995), 1, 1]
    model.at, keep = np.unique(model.at, return_index=True)
    model.value = np.maximum.accumulate(model.value[keep])
    return model


def scored(stats: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, score and predicted of every row of ``stats``."""

    def run(parts):
        for batch in parts:
            score = model.score(np.array(batch.column("x").to_pylist(), float).reshape(-1, len(STATISTICS)))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(score, pa.float64()), pa.array((score >= 0.5).astype(np.int32))], names=["doc_id", "score", "predicted"])

    out = stats.mapInArrow(run, "doc_id long, score double, predicted int")
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")
