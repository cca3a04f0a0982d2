"""Jaccard join of word shingles by token-combination prefixes, and the groups that its links make.

Tokens are the hashed shingles of a document's set, of 4 words, with a similarity of 85% unless ``size`` and ``percent`` say otherwise. They are ordered from rare to frequent by a count sketch of fixed size
(2^22 cells, summed over all documents; broadcast as one byte a cell), then by hash. Two sets of sizes up to n that are similar
share ``o = ceil(percent/100 n)`` tokens at least, so their first ``n - o + 1`` tokens meet, and their first ``n - o + 1 + CLASSES``
tokens share ``CLASSES + 1``. Hence the keys of a document:

* each rare token of the short prefix by itself;
* for the frequent tokens, the prefix extended by ``CLASSES``: they are dealt by hash into ``CLASSES`` classes, and each pair of
  one class is a key (of ``CLASSES + 1`` shared tokens two fall into one class);
* where ``o`` is at most ``CLASSES``, the frequent tokens of the short prefix by themselves too.

Sets that share a key, and are near in size, are candidates; they are verified key by key, and only verified links are closed transitively.
First each set meets the least set of the keys it shares, the one with most keys in common (linear in the rows); what links is contracted. Then
the keys that still hold several components are left; of keys with the same sets one is kept. There, pairs of different components are
tested by parity bitmaps (the bits in which two sets differ are at most the tokens in which they differ, so the test never drops a link; sets of more than
2,048 tokens by 128 values of a one-permutation sketch, which drops a link with a probability of 1e-9), and
the texts of sets with a pair that passes are sent to the key and compared exactly, until what is connected is known. Keys with many sets are
worked through in blocks of bounded size. No pair list of a group is ever made.

Defined results: the null and the empty text have the empty set and link with nothing (component: the own id). Fewer words than a shingle has
are one token. Equal sets link, copies and repeated rows included; they count as one set all along, known by 126 bits. A null id is ignored when
a component's smallest id is taken; a component of null ids only has a null one. Other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm.common import WORD, batches, in_slices, let_go, save, texts
from ledgerline.llm.components import components
from ledgerline.llm.hot import join_unique
from ledgerline.llm.minhash import SIG, dealt_by, decimals, grouped_rows, in_blocks, signature, sketch, text_key, verified_doubts, verified_stars, wanted_sets
from ledgerline.llm.shingles import SIZE, mix, shingles

#: Similarity in percent, classes of frequent tokens, cells of the sketch (a power of two) and of a filter of sets.
PERCENT, CLASSES, CELL_BITS, FILTER_BITS = 85, 16, 22, 25
#: Keys that a set shares with its star's center to be verified there first; sets and bytes of a block of bitmaps.
STAR_KEYS, BLOCK_SETS, BLOCK_BYTES = 2, 2048, 16_000_000
#: Tokens beyond which a set has a sketch instead of a bitmap (a power of two), and the values of that.
LONG, LONG_BINS = 2048, 128
_SLICE = 1 << 16
#: Sets that a task remembers, to send equal ones once.
SEEN_SETS = 10_000


def _cells(tokens: np.ndarray, bits: int) -> np.ndarray:
    return (tokens >> np.uint64(64 - bits)).astype(np.int64)


def _sum_slices(rows: DataFrame, make, cells: int, kind, join) -> np.ndarray:
    """The sum (or union) of one array for each partition: dealt by slices, added up slice by slice, then put together.

    make: an iterator of batches to an array of ``cells`` numbers. What reaches the driver has fixed size."""
    step = min(_SLICE, cells)

    def partial(parts):
        total = make(parts)
        if total is not None:
            for k in range(0, cells, step):
                if total[k : k + step].any():
                    yield pa.RecordBatch.from_pydict({"slice": [k // step], "part": [zlib.compress(total[k : k + step].tobytes(), 1)]})

    def add(parts):
        sums: dict[int, np.ndarray] = {}
        for batch in parts:
            for k, raw in zip(batch.column("slice").to_pylist(), batch.column("part").to_pylist()):
                x = np.frombuffer(zlib.decompress(raw), kind)
                sums[k] = join(sums[k], x) if k in sums else x
        for k, x in sums.items():
            yield pa.RecordBatch.from_pydict({"slice": [k], "part": [zlib.compress(x.tobytes(), 1)]})

    out = np.zeros(cells, kind)
    schema = "slice long, part binary"
    for r in rows.mapInArrow(partial, schema).repartition("slice").mapInArrow(add, schema).toLocalIterator():
        out[r.slice * step : (r.slice + 1) * step] = np.frombuffer(zlib.decompress(r.part), kind)
    return out


def frequency_levels(docs: DataFrame, bits: int = CELL_BITS, size: int = SIZE) -> np.ndarray:
    """A level for each cell of the sketch, rising with its count; 128 and more: frequent."""

    def count(parts):
        let_go()
        total = None
        for batch in in_slices(parts):
            if total is None:
                total = np.zeros(1 << bits, np.uint32)
            np.add.at(total, np.concatenate([_cells(shingles(t, size), bits) for t in texts(batch)]), np.uint32(1))
        return total

    counts = _sum_slices(docs.select("text"), count, 1 << bits, np.uint32, lambda a, b: a + b).astype(float)
    load = counts.mean()
    return (np.minimum(2 * np.log2(counts + 1), 100) + np.where(counts >= load + 8 * load**0.5 + 32, 128, 0)).astype(np.uint8)


def keys(tokens: np.ndarray, levels: np.ndarray, percent: int = PERCENT, classes: int = CLASSES) -> np.ndarray:
    """The index keys of one set."""
    n = len(tokens)
    if not n:
        return tokens
    level = levels[_cells(tokens, len(levels).bit_length() - 1)]
    order = np.lexsort((tokens, level))
    tokens, frequent = tokens[order], level[order] >= 128
    shared = -(-percent * n // 100)
    short, long = n - shared + 1, min(n, n - shared + 1 + classes)
    out = [tokens[:short] if shared <= classes else tokens[:short][~frequent[:short]]]
    often = tokens[:long][frequent[:long]]
    if len(often) > 1:
        often = np.sort(often)
        of = often % np.uint64(classes)
        a, b = np.triu_indices(len(often), 1)
        same = of[a] == of[b]
        out.append(mix(often[a[same]] * np.uint64(0x9E3779B97F4A7C15) + often[b[same]]))
    return np.unique(np.concatenate(out))


def bitmap(tokens: np.ndarray) -> bytes:
    """The set's size (8 bytes) and its parity bitmap: each token flips one bit of 256, or of as many as the set has tokens, rounded up to a power of two.
    A set of more than ``LONG`` tokens has ``LONG_BINS`` values of its one-permutation sketch instead, as long texts have many keys.

    Of a bit a token, sets of a similarity of 0.7 differ in a quarter; those of 0.85 may in a sixth at most."""
    if len(tokens) > LONG:
        return len(tokens).to_bytes(8, "little") + sketch(tokens)[:LONG_BINS].astype(np.uint8).tobytes()
    bits = max(256, 1 << (len(tokens) - 1).bit_length()) if len(tokens) else 256
    at = (mix(tokens) & np.uint64(bits - 1)).astype(np.int64)
    flips = np.bincount(at, minlength=bits).astype(np.uint8) & 1
    return len(tokens).to_bytes(8, "little") + np.packbits(flips).tobytes()


def _least_alike(percent: int) -> int:
    """Equal values that two sketches of linked sets have, but for a chance of 1e-9: 6.5 deviations below the mean."""
    p = percent / 100
    return int(LONG_BINS * p - 6.5 * (LONG_BINS * p * (1 - p)) ** 0.5)


def may_link(a: bytes, b: bytes, percent: int) -> bool:
    """Whether two sets' bitmaps leave it open that they are similar: the bits in which they differ are at most the tokens in which they do."""
    n, m = (int.from_bytes(x[:8], "little") for x in (a, b))
    if max(n, m) > LONG:
        alike = np.count_nonzero(np.frombuffer(a[8:], np.uint8) == np.frombuffer(b[8:], np.uint8)) if min(n, m) > LONG else LONG_BINS
        return 100 * min(n, m) >= percent * max(n, m) and bool(alike >= _least_alike(percent))
    a, b = sorted((a[8:], b[8:]), key=len)
    x, y = int.from_bytes(a, "big"), int.from_bytes(b, "big")
    half = 4 * len(b)
    while half >= 8 * len(a):  # a token's bit in a table of half the size is its place modulo that size
        y = (y >> half) ^ (y & (1 << half) - 1)
        half //= 2
    return 100 * min(n, m) >= percent * max(n, m) and (x ^ y).bit_count() * (100 + percent) <= (100 - percent) * (n + m)


def open_pairs(bitmaps: list[bytes], component: list, own: list, i: int, j: int, percent: int) -> Iterator[tuple[int, int]]:
    """Pairs of rows that belong to different components and whose bitmaps do not rule a link out; of two different blocks i and j only across them."""
    n = np.array([int.from_bytes(b[:8], "little") for b in bitmaps])
    words = np.where(n > LONG, 0, [(len(b) - 8) // 8 for b in bitmaps])  # 0: sketches
    code: dict = {}
    of = np.array([code.setdefault(c, len(code)) for c in component])
    block = np.array(own)
    table, folded = {}, {}
    for w in np.unique(words).tolist():
        rows = np.flatnonzero(words == w)
        kind = np.uint64 if w else np.uint8
        full = np.frombuffer(b"".join(bitmaps[r][8:] for r in rows), kind).reshape(len(rows), -1)
        table[w] = rows, full
        if w > 4:  # a token's bit in the table of half the size is its place modulo that size: fold the halves
            folded[w] = full[:, : w // 2] ^ full[:, w // 2 :]
    for w, (rows, full) in table.items():
        for other_w, (others, against) in table.items():
            # similar sets differ in size by less than a factor of two, so their tables are of the same or of neighbouring sizes
            if other_w not in (w, w // 2 if w > 4 else w, LONG // 64 if not w else w):
                continue
            mine = full if other_w == w or not w else folded[w]
            for k, r in enumerate(rows.tolist()):
                at = (of[others] != of[r]) & ((block[others] == (j if block[r] == i else i)) if i != j else True)
                if other_w == w:
                    at &= others > r
                at &= 100 * np.minimum(n[others], n[r]) >= percent * np.maximum(n[others], n[r])
                close = np.flatnonzero(at)
                if not w and len(close):  # a sketch: against another one, or against a bitmap, which says nothing
                    if other_w == 0:
                        close = close[(against[close] == mine[k]).sum(1) >= _least_alike(percent)]
                    for m in close.tolist():
                        yield r, int(others[m])
                elif len(close):
                    apart = np.bitwise_count(against[close] ^ mine[k]).sum(1, dtype=np.int64)
                    for m in close[apart * (100 + percent) <= (100 - percent) * (n[others[close]] + n[r])].tolist():
                        yield r, int(others[m])


def indexed(docs: DataFrame, levels: np.ndarray, size: int = SIZE, percent: int = PERCENT) -> DataFrame:
    """doc_id, n, sig, t1, t2 (the text's name), keys and sketch (bitmap) of every document; of equal sets in a batch only the first carries the last two."""
    shared = docs.sparkSession.sparkContext.broadcast(levels)

    def run(parts):
        seen = set()
        for batch in in_slices(parts):
            n, sigs, own_keys, bitmaps = [], [], [], []
            if len(seen) > SEEN_SETS:
                seen.clear()
            for text in texts(batch):
                tokens = shingles(text, size)
                sig = signature(tokens)
                first = sig not in seen and len(tokens)
                n.append(len(tokens)), sigs.append(sig)
                own_keys.append(keys(tokens, shared.value, percent).view(np.int64) if first else [])
                bitmaps.append(bitmap(tokens) if first else None)
                seen.add(sig)
            columns = [batch.column("doc_id"), pa.array(n, pa.int64()), decimals(b"".join(sigs)), batch.column("t1"), batch.column("t2"), pa.array(own_keys, pa.list_(pa.int64())), pa.array(bitmaps, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n", "sig", "t1", "t2", "keys", "sketch"])

    return text_key(docs).mapInArrow(run, "doc_id long, n long, sig decimal(38,0), t1 long, t2 long, keys array<long>, sketch binary")


def _member_sums() -> list:
    """Two sums of hashes that keys of the same sets (rows: key, sig) have in common."""
    return [F.sum(F.xxhash64(F.lit(k), "sig").cast("decimal(38,0)")).alias(f"sum{k}") for k in range(2)]


def candidates(index: DataFrame, percent: int = PERCENT) -> DataFrame:
    """key, sig, low and keys of all sets that share a key with another of similar size; low: the key's least set; keys: how many keys it stands for.

    Keys of the same sets are one (two documents with a passage in common have many such keys)."""
    tasks = int(index.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # dealt by key once, for the count and for the join (which is why both read all columns); no key has more rows than there are sets, of which each has many keys
    postings = index.select(F.explode("keys").alias("key"), "sig", "n").filter(F.col("key").isNotNull()).repartition(tasks, "key")
    several = postings.groupBy("key").agg(F.min("sig").alias("low"), F.max("sig").alias("high"), F.max("n").alias("most"), F.count(F.lit(1)).alias("sets"), *_member_sums())
    several = several.filter((F.col("low") < F.col("high")) & (F.col("most") > 0))
    kept = several.groupBy("sets", "sum0", "sum1").agg(F.min("key").alias("key"), F.count(F.lit(1)).alias("keys")).select("key", "keys")
    active = save(postings.join(kept, "key"), "active-postings")
    # sizes: similar sets differ by at most one class, so each set is listed under its own and the next
    size = F.floor(F.log(F.col("n").cast("double")) / float(np.log(100 / percent)) + F.lit(1e-9))
    listed = active.withColumn("size", F.explode(F.array(size, size + 1))).select("sig", F.xxhash64("key", "size").alias("key"), "keys")
    hubs = listed.groupBy("key").agg(F.min("sig").alias("low"), F.max("sig").alias("high")).filter(F.col("low") < F.col("high")).select("key", "low")
    return listed.join(hubs, "key").distinct()


def _filter_of(sigs: DataFrame, bits: int = FILTER_BITS) -> np.ndarray:
    """A bit table of fixed size that has all sigs (and lets others through by chance)."""

    def mark(parts):
        total = None
        for batch in parts:
            if total is None:
                total = np.zeros(1 << bits - 3, np.uint8)
            at = _cells(mix(batch.column("sig").to_numpy(zero_copy_only=False).view(np.uint64)), bits)
            np.bitwise_or.at(total, at >> 3, (1 << (at & 7)).astype(np.uint8))
        return total

    return _sum_slices(sigs.select("sig"), mark, 1 << bits - 3, np.uint8, lambda a, b: a | b)


def leftover_links(docs: DataFrame, index: DataFrame, active: DataFrame, found: DataFrame, size: int = SIZE, percent: int = PERCENT) -> DataFrame:
    """a and b: links between different components of a key. active: key and sig; found: node and component."""
    placed = active.join(found.select(F.col("node").alias("sig"), "component"), "sig", "left").withColumn("component", F.coalesce("component", "sig"))
    placed = save(placed, "key-components")
    # by sizes, keys of the same sets may have come up again
    several = placed.groupBy("key").agg(F.min("component").alias("x"), F.max("component").alias("y"), F.count(F.lit(1)).alias("sets"), *_member_sums()).filter(F.col("x") < F.col("y"))
    kept = several.groupBy("sets", "sum0", "sum1").agg(F.min("key").alias("key")).select("key")
    rows = save(placed.join(kept, "key", "left_semi"), "open-keys")
    facts = save(wanted_sets(index, rows), "open-sets")

    def pairs(key: int, i: int, j: int, group: dict[str, list]) -> Iterator[tuple[int, int]]:
        return open_pairs(group["sketch"], group["component"], group["own"], i, j, percent)

    def doubtful(parts):
        schema = pa.schema([("key", pa.int64()), ("sig", SIG)])
        for (key, i, j), group in grouped_rows(parts, ["key", "i", "j"]):
            at = {x for pair in pairs(key, i, j, group) for x in pair}
            yield from batches({"key": [key] * len(at), "sig": [group["sig"][k] for k in at]}, schema)

    full = save(rows.join(facts.select("sig", "sketch"), "sig"), "key-bitmaps")
    blocks = full.groupBy("key").agg(F.greatest(F.ceil(F.count(F.lit(1)) / BLOCK_SETS), F.ceil(F.sum(F.length("sketch")) / BLOCK_BYTES)).cast("int").alias("blocks"))
    doubts = save(dealt_by(in_blocks(full, blocks), ["key", "i", "j"], ["sig"], doubtful, "key long, sig decimal(38,0)").distinct(), "doubtful-sets")
    return verified_doubts(docs, rows, facts, doubts, pairs, size, percent)


def _tested(pairs: DataFrame, facts: DataFrame, percent: int) -> DataFrame:
    """The pairs (sig, low) whose bitmaps do not rule a link out: only their texts are sent. facts: sig and sketch, once each."""

    def test(parts):
        for batch in in_slices(parts):
            a, b = (batch.column(c).to_pylist() for c in ("sketch", "center"))
            kept = batch.filter(pa.array([may_link(x, y, percent) for x, y in zip(a, b)], pa.bool_()))
            yield kept.select(["sig", "low"])

    both = pairs.join(facts.select("sig", "sketch"), "sig").join(facts.select(F.col("sig").alias("low"), F.col("sketch").alias("center")), "low")
    return both.select("sig", "low", "sketch", "center").mapInArrow(test, "sig decimal(38,0), low decimal(38,0)")


def set_components(docs: DataFrame, index: DataFrame, size: int = SIZE, percent: int = PERCENT) -> DataFrame:
    """node (a set's signature) and component of the sets that link with others."""
    active = save(candidates(index, percent), "candidates")
    best = F.max(F.struct("shared", "low")).alias("best")
    stars = active.filter(F.col("sig") != F.col("low")).groupBy("sig", "low").agg(F.sum("keys").alias("shared")).filter(F.col("shared") >= STAR_KEYS)
    stars = save(stars.groupBy("sig").agg(best).select("sig", "best.low"), "stars")
    facts = save(wanted_sets(index, stars.select("sig").unionByName(stars.select(F.col("low").alias("sig")))).select("sig", "sketch"), "star-bitmaps")
    stars = save(_tested(stars, facts, percent), "open-stars")
    first = save(verified_stars(docs, index, stars, size, percent), "star-links")
    rest = leftover_links(docs, index, active.select("key", "sig"), components(first), size, percent)
    return components(first.unionByName(rest))


def one_of_each(docs: DataFrame, size: int = SIZE, percent: int = PERCENT) -> DataFrame:
    """The documents, all their columns, of which each group of linked ones keeps one: the smallest id, then the least set, then the least text.

    A document that is its group's representative is told by its id and its text's name, by which the index knows its set: no set is made again.
    Groups are known by their component, as several may have the same smallest id, or null ids only. Empty sets stay."""
    index, sets = _sets(docs, size, percent)
    least = F.min(F.struct(F.col("least").isNull().alias("unnamed"), F.col("least").alias("c"), F.col("sig").alias("s")))
    first = sets.groupBy("component").agg(least.alias("least")).select("least.c", "least.s")
    named = index.join(first, (F.col("sig") == F.col("s")) & F.col("doc_id").eqNullSafe(F.col("c")), "left_semi")
    rows = F.count(F.lit(1)).over(Window.partitionBy("doc_id", "sig"))
    named = named.select("sig", "t1", "t2", F.col("doc_id").alias("own_id"), rows.alias("rows")).distinct()
    # the row goes along as one struct, so that none of its columns can clash with those added here
    packed = docs.select(F.struct(*docs.columns).alias("row"), F.xxhash64("text").alias("t1"), F.xxhash64(F.lit(1), "text").alias("t2"))
    has_words = F.coalesce(F.col("row.text"), F.lit("")).rlike(WORD)
    kept = packed.filter(has_words).join(named, F.col("row.doc_id").eqNullSafe(F.col("own_id")) & (packed["t1"] == named["t1"]) & (packed["t2"] == named["t2"]))
    # equal rows of an id and set: one of them; the others are not dealt once more
    order = Window.partitionBy("row.doc_id", "sig").orderBy("row.text")
    one = kept.filter("rows > 1").select("row", "sig").withColumn("rank", F.row_number().over(order)).filter(F.col("rank") == 1)
    whole = packed.filter(~has_words).select("row.*").unionByName(kept.filter("rows = 1").select("row.*"))
    return whole.unionByName(one.select("row.*"))


def grouped(docs: DataFrame, size: int = SIZE, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id and sig of every document."""
    index, sets = _sets(docs, size, percent)
    ids = sets.groupBy("component").agg(F.min("least").alias("component_id"))
    named = save(join_unique(sets, ids, ["component"]).select("sig", "component_id"), "set-ids")
    rows = index.select("doc_id", F.col("n").alias("n_shingles"), "sig")
    full = join_unique(rows.filter(F.col("n_shingles") > 0), named, ["sig"]).select("doc_id", "n_shingles", "component_id", "sig")
    none = rows.filter(F.col("n_shingles") == 0).select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"), "sig")
    return full.unionByName(none)


def _sets(docs: DataFrame, size: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """The index; and sig, component and least (document id, nulls aside) of every set that is not empty."""
    index = save(indexed(docs, frequency_levels(docs, size=size), size, percent), "shingle-index")
    found = set_components(docs, index, size, percent)
    sets = index.filter(F.col("n") > 0).groupBy("sig").agg(F.min("doc_id").alias("least"))
    return index, save(sets.join(found.select(F.col("node").alias("sig"), "component"), "sig", "left").withColumn("component", F.coalesce("component", "sig")), "sets")
