"""Spelling variants: words one edit apart, found by Gram matrices of letter counts in adjacent length blocks.

A word is a run of letters, A-Z lowered; one occurrence in ``ODDS`` loses a letter, chosen by a checksum of its document and
itself (the planted slips of the contract). Words of ``MIN_LENGTH`` letters at least and ``MIN_COUNT`` occurrences at least take part.

A block has the words of ``base`` and of ``base + 1`` letters. For vectors of letter counts a dropped letter makes a squared distance
of 1 and a replaced one makes 2, so a block's products ``|x|^2 + |y|^2 - 2 x.y`` leave few pairs, whose edit is then verified letter by
letter. A block of more than ``BLOCK`` words is cut before that: one edit leaves either the first or the second half of the
word as it is, so the block's words are dealt by their first half (blocks in which only the second may differ) and by their second half.
Halving goes on until a block is small enough or a single letter may differ; then it has at most 91 + 91^2 words. So no block grows with the vocabulary.
Of the blocks in which a pair meets, only the one of its leftmost edit counts it.

A word's form is the near word with the most occurrences (ties: the smallest in code-point order), if these are at least ``RATIO``
times its own. A root follows forms to the last one. Occurrences rise with each step by that factor, so there are no cycles, and
with jumps of doubled length the rounds are few.

Defined results: null and empty texts have no words; an empty table gives no rows; the checksum takes a null id for the empty string. Repeated rows
count as often as they occur. Very long runs are words like any other. Other columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import batches, save, texts
from ledgerline.llm.hot import join_unique

MIN_LENGTH, MIN_COUNT, RATIO, ODDS = 6, 5, 5, 199
#: Words of a block beyond which it is cut; rows of a tile, the unit of the products; kept words of a task before they are handed on.
BLOCK, TILE, KEPT = 2048, 512, 500_000
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_RUNS = re.compile("[a-zÀ-ÿ]+").findall
_LETTERS = 26 + 64
_CELL = ["base", "low", "high", "cell"]


def words(doc_id: int | None, text: str) -> Counter:
    """The words of a text and their occurrences, slips included."""
    found: Counter = Counter()
    start = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
    for run, n in Counter(_RUNS(text.encode("utf-8", "surrogatepass").translate(_LOWER).decode("utf-8", "surrogatepass"))).items():
        if len(run) >= MIN_LENGTH:
            h = zlib.crc32(run.encode(), start)
            if h % ODDS == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            if len(run) >= MIN_LENGTH:
                found[run] += n
    return found


def vocabulary(docs: DataFrame) -> DataFrame:
    """word and n of every word with enough occurrences; counted in the tasks first."""
    schema = pa.schema([("word", pa.string()), ("n", pa.int64())])

    def count(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: Counter = Counter()
        for batch in parts:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), texts(batch)):
                kept.update(words(doc_id, text))
                if len(kept) > KEPT:
                    yield from batches({"word": list(kept), "n": list(kept.values())}, schema)
                    kept = Counter()
        yield from batches({"word": list(kept), "n": list(kept.values())}, schema)

    counts = docs.select(F.col("doc_id").cast("string"), "text").mapInArrow(count, "word string, n long")
    return counts.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= MIN_COUNT)


def _cell() -> Column:
    """What the words of a block have in common: the letters before ``low`` and those from ``high`` on, counted from base's end."""
    return F.xxhash64("base", "low", "high", F.left("word", F.col("low")), F.right("word", F.col("base") - F.col("high")))


def blocks(vocab: DataFrame, limit: int = BLOCK) -> DataFrame:
    """word, n and block (base, low, high, cell) of every block in which a word may meet a near one."""
    length = F.length("word")
    bases = F.when(length > MIN_LENGTH, F.array(length, length - 1)).otherwise(F.array(length))
    rows = vocab.select("word", "n", F.explode(bases).alias("base")).withColumns({"low": F.lit(0), "high": F.col("base")}).withColumn("cell", _cell())
    done = []
    while True:
        rows = save(rows, "spelling-blocks")
        # a block needs two words, one of them of its own length
        sizes = rows.groupBy(*_CELL).agg(F.count(F.lit(1)).alias("size"), F.count_if(F.length("word") == F.col("base")).alias("own"))
        live = sizes.filter((F.col("size") > 1) & (F.col("own") > 0)).drop("own")
        placed = save(join_unique(rows, live, _CELL), "spelling-sizes")
        large = (F.col("size") > limit) & (F.col("high") - F.col("low") > 1)
        done.append(placed.filter(~large).drop("size"))
        if placed.filter(large).isEmpty():
            return reduce(DataFrame.unionByName, done)
        middle = F.floor((F.col("low") + F.col("high")) / 2).cast("int")
        halves = F.array(F.struct(F.col("low"), middle.alias("high")), F.struct(middle.alias("low"), F.col("high")))
        rows = placed.filter(large).withColumn("half", F.explode(halves)).select("word", "n", "base", "half.low", "half.high").withColumn("cell", _cell())


def one_edit(x: str, y: str) -> int:
    """The leftmost place of the one edit that makes x into y (as long, or longer by one); -1 if there is none."""
    at = next((i for i, (a, b) in enumerate(zip(x, y)) if a != b), len(x))
    if len(x) == len(y):
        return at if at < len(x) and x[at + 1 :] == y[at + 1 :] else -1
    if x[at:] != y[at + 1 :]:
        return -1
    c = y[at]
    while at and x[at - 1] == c:
        at -= 1
    return at


def letter_counts(found: list[str]) -> np.ndarray:
    """One row of letter counts for each word; of a kind whose products are exact for these lengths."""
    sizes = np.array([len(w) for w in found])
    codes = np.frombuffer("".join(found).encode("utf-32-le"), np.uint32).astype(np.int64)
    column = np.where(codes < 128, codes - 97, codes - 0xC0 + 26)
    cells = np.repeat(np.arange(len(found)), sizes) * _LETTERS + column
    kind = np.float32 if sizes.max() < 4096 else np.float64
    return np.bincount(cells, minlength=len(found) * _LETTERS).reshape(-1, _LETTERS).astype(kind)


def near_pairs(found: list[str], group: np.ndarray, base: np.ndarray) -> Iterator[tuple[int, int]]:
    """Pairs of rows of one group whose letter counts allow one edit; the first is of the base's length, the second not shorter."""
    x = letter_counts(found)
    square = (x * x).sum(1)
    longer = np.array([len(w) for w in found]) - base
    own = np.flatnonzero(longer == 0)
    for k in range(0, len(own), TILE):
        rows = own[k : k + TILE]
        distance = square[rows, None] + square[None, :] - 2 * (x[rows] @ x.T)
        meet = (distance == np.where(longer == 0, 2, 1)[None, :]) & (group[rows, None] == group[None, :])
        for at in np.flatnonzero(meet).tolist():
            i, j = int(rows[at // len(found)]), at % len(found)
            if longer[j] or i < j:
                yield i, j


def _matched(found: list[str], n: list[int], cells: list[tuple]) -> dict[str, list]:
    """word, n_near, form_n and form: what these whole blocks say on their words."""
    group = np.cumsum([0] + [a != b for a, b in zip(cells, cells[1:])])
    base = np.array([c[0] for c in cells])
    near, best = [0] * len(found), [(0, "")] * len(found)
    for i, j in near_pairs(found, group, base):
        at = one_edit(found[i], found[j])
        _, low, high, _ = cells[i]
        if at < 0 or len(found[i]) < len(found[j]) and not (low < at <= high or at == low == 0):
            continue
        for a, b in ((i, j), (j, i)):
            near[a] += 1
            if (-n[b], found[b]) < (-best[a][0], best[a][1]):
                best[a] = (n[b], found[b])
    hit = [k for k, m in enumerate(near) if m]
    return {"word": [found[k] for k in hit], "n_near": [near[k] for k in hit], "form_n": [best[k][0] for k in hit], "form": [best[k][1] for k in hit]}


def neighbours(dealt: DataFrame) -> DataFrame:
    """word, n_near, form_n and form (the best near word, whatever its count) of the words that have near ones. dealt: see ``blocks``."""
    schema = pa.schema([("word", pa.string()), ("n_near", pa.int64()), ("form_n", pa.int64()), ("form", pa.string())])

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, n, cells = [], [], []
        for batch in parts:
            for word, count, *cell in zip(*(batch.column(c).to_pylist() for c in ("word", "n", *_CELL))):
                # whole blocks, put together up to a tile: a block is never cut, a large one stands alone
                if len(found) >= TILE and tuple(cell) != cells[-1]:
                    yield from batches(_matched(found, n, cells), schema)
                    found, n, cells = [], [], []
                found.append(word), n.append(count), cells.append(tuple(cell))
        if found:
            yield from batches(_matched(found, n, cells), schema)

    # the work is in the products, not in the bytes: a fixed number of partitions
    tasks = int(dealt.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    each = dealt.repartition(tasks, *_CELL).sortWithinPartitions(*_CELL).mapInArrow(run, "word string, n_near long, form_n long, form string")
    best = F.min(F.struct(-F.col("form_n"), F.col("form")))
    return each.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("best")).select("word", "n_near", (-F.col("best.col1")).alias("form_n"), "best.form")


def roots(forms: DataFrame) -> DataFrame:
    """word and root (the last form) of every word that has a form. forms: word and form, without nulls."""
    found = save(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        step = found.select(F.col("word").alias("root"), F.col("root").alias("next"))
        further = found.join(step, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved"))
        further = save(further, "spelling-roots")
        found = further.drop("moved")
        if further.filter("moved").isEmpty():
            return found


def variants(docs: DataFrame, limit: int = BLOCK) -> DataFrame:
    """word, form, root, n, n_near and form_n of every word of the texts."""
    vocab = save(vocabulary(docs), "vocabulary")
    near = save(neighbours(blocks(vocab, limit)), "neighbours")
    enough = F.col("form_n") >= RATIO * F.col("n")
    known = vocab.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(enough, F.col("form")).alias("form"), F.when(enough, F.col("form_n")).alias("form_n")
    )
    known = save(known, "forms")
    last = known.join(roots(known.filter(F.col("form").isNotNull())), "word", "left")
    return last.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
