"""Benchmark decontamination by spaced seeds: masked word windows of test items are joined with those of documents.

Words are lower-case runs of letters and digits. A mask such as ``1111011`` hashes the words at its ones and
ignores those at its zeros, so a window still hits when an ignored word was substituted. The hashes of all
windows of the test items are joined with those of every document. Around each hit the two texts are
laid side by side (same distance between positions) and of the stretches in which ``min_identity`` of the words are equal, the one
with most equal words is the overlap. It counts if it has ``min_words`` equal words (or as many as the item's share ``min_share``
asks for, if that is less). The masks hit every stretch with at most a fifth of its words substituted, wherever these are, that is long enough to count.

The items go to the tasks in blocks of bounded size (``BLOCK_WORDS``), one scan of the documents for each block;
documents are never shuffled. Defined results: null or empty texts, and items with fewer words than the
longest mask, overlap with nothing. Of several overlaps of a document and an item the one with most equal words is
returned, then the first in the document. Repeated documents and items each get their rows. Other columns
are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import batches, in_slices, texts

#: Found by search: no pattern of up to a fifth of substitutions in 8 words or more escapes all three (the tests go through them).
MASKS = ("101111", "1110011", "11101001")
MIN_WORDS, MIN_SHARE, MIN_IDENTITY = 13, 0.8, 0.8
#: Words of the items that one scan of the documents takes along.
BLOCK_WORDS = 2_000_000

WORDS = re.compile(r"[^\W_]+").findall
_MULTIPLIERS = np.random.default_rng(23).integers(1, 2**63, 64, dtype=np.uint64) | np.uint64(1)


def windows(ids: np.ndarray, mask: str) -> tuple[np.ndarray, np.ndarray]:
    """Positions whose cared-for words are all known (id above 0), and the hashes of those windows."""
    n = len(ids) - len(mask) + 1
    if n < 1:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    ones = [k for k, c in enumerate(mask) if c == "1"]
    fits = ids[ones[0] : ones[0] + n] > 0
    for k in ones[1:]:
        fits &= ids[k : k + n] > 0
    at = np.flatnonzero(fits)
    h = np.zeros(len(at), np.uint64)
    for j, k in enumerate(ones):
        x = ids[at + k].astype(np.uint64) * _MULTIPLIERS[j]
        h += x ^ (x >> np.uint64(31))
    return at, h


class Items:
    """A block of test items: vocabulary, word ids, and the sorted hashes of all masked windows."""

    def __init__(self, items: list[tuple[int | None, str]], masks: tuple[str, ...] = MASKS):
        self.masks, self.names, self.ids = masks, [], []
        self.vocabulary: dict[str, int] = {}
        longest = max(map(len, masks))
        for name, text in items:
            words = WORDS(text.lower())
            if len(words) >= longest:
                self.names.append(name)
                self.ids.append(np.array([self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words], np.int64))
        self.tables = []
        for mask in masks:
            h, item, at = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
            for k, ids in enumerate(self.ids):
                p, x = windows(ids, mask)
                h.append(x), item.append(np.full(len(p), k)), at.append(p)
            hashes = np.concatenate(h)
            order = np.argsort(hashes, kind="stable")
            self.tables.append((hashes[order], np.concatenate(item)[order], np.concatenate(at)[order]))

    def hits(self, ids: np.ndarray) -> set[tuple[int, int]]:
        """(item, its distance to the document's positions) of every window hash that both have."""
        out: set[tuple[int, int]] = set()
        for mask, (hashes, item, start) in zip(self.masks, self.tables):
            at, h = windows(ids, mask)
            if not len(h) or not len(hashes):
                continue
            lo = np.searchsorted(hashes, h, "left")
            many = np.searchsorted(hashes, h, "right") - lo
            for k in np.flatnonzero(many):
                rows = slice(lo[k], lo[k] + many[k])
                out.update(zip(item[rows].tolist(), (at[k] - start[rows]).tolist()))
        return out

    def overlaps(self, text: str, min_words: int, min_share: float, min_identity: float) -> Iterator[tuple]:
        """(item, document word, item word, words, equal words, equal share of the item), best of each item."""
        words = WORDS(text.lower())
        known = self.vocabulary.get
        ids = np.fromiter((known(w, 0) for w in words), np.int64, len(words))
        best: dict[int, tuple] = {}
        for k, shift in sorted(self.hits(ids)):
            item = self.ids[k]
            first = max(0, -shift)
            size = min(len(item), len(ids) - shift) - first
            equal = item[first : first + size] == ids[first + shift : first + shift + size]
            a, b = best_stretch(equal, min_identity)
            n = int(equal[a:b].sum())
            enough = min(min_words, int(np.ceil(min_share * len(item))))
            if n >= enough and n >= min_identity * (b - a):
                found = (n, -(first + shift + a), first + a, b - a, len(item))
                best[k] = max(best.get(k, found), found)
        for k, (n, at, start, size, whole) in sorted(best.items()):
            yield self.names[k], -at, start, size, n, n / whole


def best_stretch(equal: np.ndarray, min_identity: float = MIN_IDENTITY) -> tuple[int, int]:
    """Of the stretches with a share of ``min_identity`` equal words the one with most of them, then the shortest, the first of such."""
    total = np.r_[0, np.cumsum(equal)]
    gain = total - min_identity * np.arange(len(total))
    # only a start lower than all before it can be the earliest for some end
    low = np.minimum.accumulate(gain)
    first = np.searchsorted(-low, -gain - 1e-9)
    n = total - total[first]
    end = int(np.argmax(n))
    if not n[end]:
        return 0, 0
    inside = np.flatnonzero(equal[first[end] : end]) + first[end]
    return int(inside[0]), int(inside[-1]) + 1


def blocks(items: DataFrame, block_words: int = BLOCK_WORDS) -> Iterator[list[tuple[int | None, str]]]:
    """The items in blocks of about ``block_words`` words, dealt by a hash of id and text."""
    kept = items.select("item_id", "text").filter(F.col("text").isNotNull())
    n_words = kept.agg(F.sum(F.length("text"))).first()[0] or 0
    n = max(1, -(-n_words // (6 * block_words)))
    for k in range(n):
        part = kept.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == k) if n > 1 else kept
        if got := sorted(((r.item_id, r.text) for r in part.collect()), key=lambda r: (r[0] is None, r[0] or 0, r[1])):
            yield got


OUT = "doc_id long, item_id long, doc_word long, item_word long, n_words long, n_equal long, item_share double"


def contaminated(docs: DataFrame, items: DataFrame, masks: tuple[str, ...] = MASKS, min_words: int = MIN_WORDS, min_share: float = MIN_SHARE, min_identity: float = MIN_IDENTITY, block_words: int = BLOCK_WORDS) -> DataFrame:
    """A row for each document and item that overlap: where, how many words, how many equal."""
    schema = pa.schema([(n, pa.float64() if kind == "double" else pa.int64()) for n, kind in (x.split() for x in OUT.split(", "))])
    spark = docs.sparkSession
    found = spark.createDataFrame([], OUT)
    for block in blocks(items, block_words):
        shared = spark.sparkContext.broadcast(block)  # of bounded size

        def run(parts, shared=shared):
            index = Items(shared.value, masks)
            for batch in parts:
                rows: dict[str, list] = {n: [] for n in schema.names}
                for doc_id, text in zip(batch.column("doc_id").to_pylist(), texts(batch)):
                    for overlap in index.overlaps(text, min_words, min_share, min_identity):
                        for n, x in zip(schema.names, (doc_id, *overlap)):
                            rows[n].append(x)
                yield from batches(rows, schema)

        found = found.unionByName(docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, OUT))
    return found


def uncontaminated(docs: DataFrame, items: DataFrame, **how) -> DataFrame:
    """The documents, all their columns, that overlap with no item, in one scan for each block of items.

    Unlike a join on ids this also holds for null and repeated ids."""
    spark, left = docs.sparkSession, docs
    for block in blocks(items, how.get("block_words", BLOCK_WORDS)):
        shared = spark.sparkContext.broadcast(block)

        def run(parts, shared=shared):
            index = Items(shared.value, how.get("masks", MASKS))
            for batch in in_slices(parts):
                clean = [next(index.overlaps(t, how.get("min_words", MIN_WORDS), how.get("min_share", MIN_SHARE), how.get("min_identity", MIN_IDENTITY)), None) is None for t in texts(batch)]
                yield batch.filter(pa.array(clean, pa.bool_()))

        left = left.mapInArrow(run, docs.schema)
    return left
