"""Quality rules by line labels: a linear-chain CRF marks each line as content or boilerplate.

A document is split at ``\\n``; every line with a word becomes one position of a two-label chain.
The CRF's weights are fitted by maximum likelihood on a bounded sample of labelled documents (the
lines of a good document count as content, those of a bad one as boilerplate); Viterbi decoding
labels the lines of all documents and the share of words in content lines decides retention.

Defined results: a null or empty text has no words, fails the base rule and is not kept. Repeated
rows are judged each for itself. Columns other than ``doc_id`` and ``text`` are ignored. Without
any labelled document (or with labels of one class only) every line counts as content. Ties in
decoding go to content. A label given twice counts with its mean, ties as good.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import batches, held_out, texts

SPACE = b" \t\n\x0b\x0c\r"
SYMBOLS = b"#*$%&|<>"
#: The base rule: fewer words than this, or a larger percentage of repeated words, fail.
MIN_WORDS, MAX_REPEAT_PERCENT, REPEAT_WINDOW = 20, 30, 8
#: Labelled documents that the fit may use, of each class, and the lines of one training chain.
TRAIN_DOCS, TRAIN_CHAIN = 1000, 64
MIN_CONTENT_SHARE = 0.5
FEATURES = ("bias", "words", "symbols", "upper", "digits", "marks", "bars", "letters", "ends", "repeated", "in_repeat", "short")

_UPPERS = bytes(range(65, 91))
_DIGITS = bytes(range(48, 58))
_MARKS = b"!?;:"
_LETTERS = bytes([*range(65, 91), *range(97, 123), *range(128, 256)])
_WINDOW = np.random.default_rng(11).integers(1, 2**63, REPEAT_WINDOW, dtype=np.uint64) | np.uint64(1)


def repeated_words(words: list[bytes], n: int = REPEAT_WINDOW) -> np.ndarray | None:
    """Which words lie in an ``n``-word window that the text holds twice or more; None: no word does."""
    m = len(words) - n + 1
    if m < 2:
        return None
    h = np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)
    window = np.zeros(m, np.uint64)
    for k in range(n):
        window += (h[k : k + m] ^ (h[k : k + m] >> np.uint64(29))) * _WINDOW[k]
    order = np.sort(window)
    twice = order[1:][order[1:] == order[:-1]]
    if not len(twice):
        return None
    step = np.zeros(len(words) + 1, np.int64)
    at = np.flatnonzero(np.isin(window, twice))
    np.add.at(step, at, 1)
    np.add.at(step, at + n, -1)
    return np.cumsum(step)[:-1] > 0


@dataclass
class Base:
    n_words: int
    word_chars: int
    n_symbols: int
    n_dup_lines: int
    n_repeat_words: int

    @property
    def failed(self) -> bool:
        return self.n_words < MIN_WORDS or 100 * self.n_repeat_words > MAX_REPEAT_PERCENT * self.n_words


def measure(text: str) -> tuple[Base, list[bytes], list[int], np.ndarray | None]:
    """Base counts of a whole text, its lines with a word, their word counts, and the repeated words."""
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()
    lines, sizes = [], []
    for line in raw.split(b"\n"):
        if k := len(line.split()):
            lines.append(line)
            sizes.append(k)
    covered = repeated_words(words)
    spaces = len(raw) - len(raw.translate(None, SPACE))
    symbols = len(raw) - len(raw.translate(None, SYMBOLS))
    base = Base(len(words), len(text) - spaces, symbols, len(lines) - len(set(lines)), 0 if covered is None else int(covered.sum()))
    return base, lines, sizes, covered


def line_features(lines: list[bytes], sizes: list[int], covered: np.ndarray | None) -> np.ndarray:
    """One row of ``FEATURES`` for each line, all between 0 and about 1."""
    out = np.zeros((len(lines), len(FEATURES)))
    seen: dict[bytes, int] = {}
    for line in lines:
        seen[line] = seen.get(line, 0) + 1
    start = 0
    for i, (line, k) in enumerate(zip(lines, sizes)):
        n = len(line)
        letters = n - len(line.translate(None, _LETTERS))
        out[i] = (
            1, min(1, np.log1p(k) / 5), (n - len(line.translate(None, SYMBOLS))) / n, (n - len(line.translate(None, _UPPERS))) / max(1, letters),
            (n - len(line.translate(None, _DIGITS))) / n, min(1, 4 * (n - len(line.translate(None, _MARKS))) / n), min(1, line.count(b"|") / k), letters / n,
            line.rstrip()[-1:] in b".!?", seen[line] > 1, 0 if covered is None else covered[start : start + k].mean(), k <= 3,
        )
        start += k
    return out


@dataclass
class Chain:
    """Weights of a two-label chain (0 content, 1 boilerplate): ``unary`` favours 1, ``pair[a, b]`` scores a then b."""

    unary: np.ndarray
    pair: np.ndarray

    def viterbi(self, features: np.ndarray) -> list[int]:
        """The best label sequence; ties go to content."""
        if not len(features):
            return []
        (p00, p01), (p10, p11) = self.pair.tolist()
        score = (features @ self.unary).tolist()
        a, b, back = 0.0, score[0], []
        for s in score[1:]:
            from_a, from_b = a + p00 < b + p10, a + p01 < b + p11
            back.append((from_a, from_b))
            a, b = (b + p10 if from_a else a + p00), (b + p11 if from_b else a + p01) + s
        at = int(b > a)
        out = [at]
        for step in reversed(back):
            at = int(step[at])
            out.append(at)
        return out[::-1]


def fit_chain(chains: list[tuple[np.ndarray, int]], rounds: int = 100, ridge: float = 1e-3) -> Chain:
    """Maximum likelihood by forward-backward gradients. chains: line features and their common label.

    Classes weigh the same. Without both classes the result calls every line content.
    """
    zero = Chain(np.r_[-1.0, np.zeros(len(FEATURES) - 1)], np.zeros((2, 2)))
    chains = [(x[i : i + TRAIN_CHAIN], y) for x, y in chains for i in range(0, len(x), TRAIN_CHAIN)]
    if len({y for _, y in chains}) < 2:
        return zero
    longest = max(len(x) for x, _ in chains)
    x = np.zeros((len(chains), longest, len(FEATURES)))
    on = np.zeros((len(chains), longest))
    y = np.array([y for _, y in chains], float)
    for i, (f, _) in enumerate(chains):
        x[i, : len(f)], on[i, : len(f)] = f, 1
    weight = np.where(y > 0, 0.5 / (on.sum(1) * y).sum(), 0.5 / (on.sum(1) * (1 - y)).sum())
    theta = np.zeros(len(FEATURES) + 4)
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    for t in range(1, rounds + 1):
        unary, pair = theta[: len(FEATURES)], theta[len(FEATURES) :].reshape(2, 2)
        s = np.stack([np.zeros(on.shape), x @ unary], -1)
        alpha, beta = s.copy(), np.zeros_like(s)
        for k in range(1, longest):
            alpha[:, k] = np.where(on[:, k, None] > 0, np.logaddexp(alpha[:, k - 1, :1] + pair[0], alpha[:, k - 1, 1:] + pair[1]) + s[:, k], alpha[:, k - 1])
            j = longest - 1 - k
            beta[:, j] = np.where(on[:, j + 1, None] > 0, np.logaddexp((pair[:, 0] + (s[:, j + 1, :1] + beta[:, j + 1, :1])), (pair[:, 1] + (s[:, j + 1, 1:] + beta[:, j + 1, 1:]))), 0)
        z = np.logaddexp(alpha[:, -1, 0], alpha[:, -1, 1])
        p1 = np.exp(alpha[..., 1] + beta[..., 1] - z[:, None]) * on
        grad = np.empty_like(theta)
        grad[: len(FEATURES)] = np.einsum("i,ik,ikf->f", weight, on * y[:, None] - p1, x)
        both = on[:, 1:]
        for a in (0, 1):
            for b in (0, 1):
                p = np.exp(alpha[:, :-1, a] + pair[a, b] + s[:, 1:, b] + beta[:, 1:, b] - z[:, None])
                grad[len(FEATURES) + 2 * a + b] = (weight[:, None] * both * ((y[:, None] == a) * (a == b) - p)).sum()
        grad -= ridge * theta
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad**2
        theta = theta + 0.1 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-9)
    return Chain(theta[: len(FEATURES)], theta[len(FEATURES) :].reshape(2, 2))


def training_sample(docs: DataFrame, labels: DataFrame, per_class: int = TRAIN_DOCS) -> DataFrame:
    """(doc_id, text, y) of at most ``per_class`` labelled documents of each class, first by a hash of the id.

    y is 1 for bad quality. The sample of ids is bounded, so it may be broadcast; texts are not shuffled.
    Held-out documents are left out.
    """
    known = (
        labels.filter(F.col("doc_id").isNotNull() & F.col("quality").isNotNull() & ~held_out(F.col("doc_id")))
        .groupBy("doc_id").agg((F.avg("quality") < 0.5).cast("int").alias("y")).withColumn("h", F.xxhash64("doc_id"))
    )
    chosen = [known.filter(F.col("y") == y).orderBy("h", "doc_id").limit(per_class) for y in (0, 1)]
    return docs.select("doc_id", "text").join(F.broadcast(chosen[0].unionByName(chosen[1]).select("doc_id", "y")), "doc_id")


def fit(docs: DataFrame, labels: DataFrame, per_class: int = TRAIN_DOCS) -> Chain:
    """The chain of the labelled sample. Only line features of the sample come to the driver: of a document
    with more lines, its first, middle and last chains (``TRAIN_CHAIN`` lines each)."""

    def chains(parts):
        schema = pa.schema([("doc_id", pa.int64()), ("y", pa.int32()), ("features", pa.binary())])
        for batch in parts:
            rows: dict[str, list] = {"doc_id": [], "y": [], "features": []}
            for i, y, text in zip(batch.column("doc_id").to_pylist(), batch.column("y").to_pylist(), texts(batch)):
                _, lines, sizes, covered = measure(text)
                x = line_features(lines, sizes, covered)
                if len(x) > 3 * TRAIN_CHAIN:
                    mid = len(x) // 2
                    x = np.concatenate([x[:TRAIN_CHAIN], x[mid : mid + TRAIN_CHAIN], x[-TRAIN_CHAIN:]])
                if len(x):
                    rows["doc_id"].append(i), rows["y"].append(y), rows["features"].append(x.astype(np.float32).tobytes())
            yield from batches(rows, schema)

    got = training_sample(docs, labels, per_class).mapInArrow(chains, "doc_id long, y int, features binary").collect()
    got.sort(key=lambda r: (r.doc_id, r.features))
    return fit_chain([(np.frombuffer(r.features, np.float32).reshape(-1, len(FEATURES)).astype(float), r.y) for r in got])


OUT = "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean, content_share double, n_lines long, n_boilerplate long"


def judge(docs: DataFrame, chain: Chain, min_share: float = MIN_CONTENT_SHARE, with_text: bool = False) -> DataFrame:
    """One row for each document: base counts, content share, verdict; ``with_text`` adds ``content``, the
    text's content lines joined by ``\\n``."""
    names = [x.split()[0] for x in OUT.split(", ")] + ["content"] * with_text
    kinds = {"long": pa.int64(), "boolean": pa.bool_(), "double": pa.float64()}
    schema = pa.schema([(x.split()[0], kinds[x.split()[1]]) for x in OUT.split(", ")] + [("content", pa.string())] * with_text)

    def run(parts):
        for batch in parts:
            rows: dict[str, list] = {n: [] for n in names}
            for i, text in zip(batch.column("doc_id").to_pylist(), texts(batch)):
                base, lines, sizes, covered = measure(text)
                labels = chain.viterbi(line_features(lines, sizes, covered))
                good = sum(k for k, y in zip(sizes, labels) if not y)
                share = good / base.n_words if base.n_words else 0.0
                values = (i, base.n_words, base.word_chars, base.n_symbols, base.n_dup_lines, base.n_repeat_words, base.failed, not base.failed and share >= min_share, share, len(lines), sum(labels))
                if with_text:
                    values += (b"\n".join(x for x, y in zip(lines, labels) if not y).decode("utf-8", "replace"),)
                for n, value in zip(names, values):
                    rows[n].append(value)
            yield from batches(rows, schema)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, OUT + ", content string" * with_text)
