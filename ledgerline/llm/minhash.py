"""Near copies by one-permutation hashing: one hash a shingle, bins, optimal densification, bands, star-shaped candidates.

A document's set has the hashed shingles of ``SIZE`` words. The range of the hash is cut into ``BANDS * ROWS`` bins and a bin keeps its least
hash, so one hash a shingle makes the whole sketch. An empty bin takes the value of the first filled bin in an order of its own (a fixed
random permutation for each bin), which keeps the chance of equal values at the Jaccard similarity for sets of any size. Four bins make a
band, and sets that agree in a band share a bucket: with 40 bands a pair of similarity 0.8 has no common bucket with probability 7e-10.

Candidates are stars, not pairs: each set of a bucket meets the bucket's least one, and of its stars a set takes the one that shares most bands.
Those are verified on the full sets and contracted to components. What is left are buckets that hold several components: there,
pairs of different components whose sketches agree in at least ``LEAST_EQUAL`` bins (a pair of similarity 0.8 has fewer with probability 1e-8) are verified too,
each in the first of its common buckets only; texts are sent to a bucket only for sets that have such a pair. The links found go into the
components once more. No list of a bucket's pairs is ever made, buckets are compared in blocks of bounded size, and none of them holds more than a
40th of all entries, as each set has one in each band.

Defined results: null and empty texts have the empty set and link with nothing (component: the own id, kept). Fewer words than a shingle has are one shingle.
Equal sets link, repeated rows included; they count as one set all along. A null id is ignored when a component's smallest id is taken; a component of null
ids only has a null one and keeps them. An empty table gives no rows. Very long texts are sets like others. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.bits import may_have
from ledgerline.llm.common import batches, in_slices, save, texts
from ledgerline.llm.components import components
from ledgerline.llm.hot import join_unique
from ledgerline.llm.shingles import SIZE, mix, shingles

PERCENT, ROWS, BANDS = 80, 4, 40
BINS = ROWS * BANDS
#: Equal bins that a pair needs to be verified; bands that a star needs to be verified first (the others are left to the second step).
LEAST_EQUAL, STAR_BANDS = 98, 6
#: Sets of a star a task; sets of a block of sketches; sets and characters of a block of texts.
STAR_SETS, BLOCK_SETS, BLOCK_TEXTS, BLOCK_CHARS = 1024, 2048, 512, 16_000_000
SIG = pa.decimal128(38, 0)
EDGES = pa.schema([("a", SIG), ("b", SIG)])
_BOUNDS = np.array([(k << 64) // BINS for k in range(BINS)], np.uint64)
_ORDER = np.argsort(np.random.default_rng(13).random((BINS, BINS)), axis=1)


def sketch(tokens: np.ndarray) -> np.ndarray:
    """16 bits for each bin of a set that is not empty. tokens: sorted distinct hashes."""
    first = np.searchsorted(tokens, _BOUNDS)
    filled = first < np.append(first[1:], len(tokens))
    values = tokens[np.minimum(first, len(tokens) - 1)]
    empty = np.flatnonzero(~filled)
    if len(empty):
        order = _ORDER[empty]
        values[empty] = values[order[np.arange(len(empty)), filled[order].argmax(1)]]
    return values.astype(np.uint16)


def band_keys(sketches: np.ndarray) -> np.ndarray:
    """The bucket of each band. sketches: rows of ``BINS`` 16-bit values; a band's four are one 64-bit number."""
    number = np.arange(BANDS, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return mix(np.ascontiguousarray(sketches).view(np.uint64).reshape(-1, BANDS) + number)


def signature(tokens: np.ndarray) -> bytes:
    """126 bits of a set's hash, as a little-endian decimal of at most 38 digits."""
    return (xxhash.xxh3_128_intdigest(tokens.tobytes()) >> 2).to_bytes(16, "little")


def decimals(raw: bytes) -> pa.Array:
    return pa.Array.from_buffers(SIG, len(raw) // 16, [None, pa.py_buffer(raw)])


def raw_sigs(column: pa.Array) -> np.ndarray:
    return np.frombuffer(column.buffers()[1], np.uint64).reshape(-1, 2)[column.offset : column.offset + len(column)]


def _sketches(column: pa.Array | list) -> np.ndarray:
    rows = column if isinstance(column, list) else column.to_pylist()
    return np.frombuffer(b"".join(rows), np.uint16).reshape(-1, BINS)


def text_key(docs: DataFrame) -> DataFrame:
    """doc_id, text and t1, t2: 128 bits that name the text."""
    return docs.select(F.col("doc_id").cast("long"), "text", F.xxhash64("text").alias("t1"), F.xxhash64(F.lit(1), "text").alias("t2"))


def indexed(docs: DataFrame, size: int = SIZE) -> DataFrame:
    """doc_id, n, sig, t1, t2 and sketch of every document; of equal sets in a batch only the first carries its sketch."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            n, sigs, sketches, seen = [], [], [], set()
            for text in texts(batch):
                tokens = shingles(text, size)
                sig = signature(tokens)
                n.append(len(tokens)), sigs.append(sig)
                sketches.append(None if sig in seen or not len(tokens) else sketch(tokens).tobytes())
                seen.add(sig)
            columns = [batch.column("doc_id"), pa.array(n, pa.int64()), decimals(b"".join(sigs)), batch.column("t1"), batch.column("t2"), pa.array(sketches, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n", "sig", "t1", "t2", "sketch"])

    return text_key(docs).mapInArrow(run, "doc_id long, n long, sig decimal(38,0), t1 long, t2 long, sketch binary")


def postings(index: DataFrame) -> DataFrame:
    """key (a band's bucket) and sig of every sketch."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            if len(batch):
                keys = band_keys(_sketches(batch.column("sketch")))
                yield pa.RecordBatch.from_arrays([pa.array(keys.ravel().view(np.int64)), decimals(np.repeat(raw_sigs(batch.column("sig")), BANDS, axis=0).tobytes())], names=["key", "sig"])

    return index.filter(F.col("sketch").isNotNull()).select("sig", "sketch").mapInArrow(run, "key long, sig decimal(38,0)")


def wanted_sets(index: DataFrame, sigs: DataFrame) -> DataFrame:
    """sig, t1, t2 and sketch of the sets in ``sigs``, one row each."""
    return index.filter(F.col("sketch").isNotNull()).join(sigs.select("sig").distinct(), "sig", "left_semi").select("sig", "t1", "t2", "sketch").dropDuplicates(["sig"])


def texts_of(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """sig and text of the sets in ``wanted`` (sig, t1, t2): only these texts are moved."""
    rows = may_have(text_key(docs).drop("doc_id"), wanted.select("t1"), "t1").dropDuplicates(["t1", "t2"])
    return rows.join(wanted.select("sig", "t1", "t2"), ["t1", "t2"]).select("sig", "text")


def linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    least, most = sorted((len(a), len(b)))
    if 100 * least < percent * most:
        return False
    common = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * common >= percent * (least + most - common)


def grouped_rows(parts: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[tuple, dict[str, list]]]:
    """The rows of sorted batches by groups of equal ``keys``, one group in memory at a time."""
    at, rows = None, {}
    for batch in parts:
        columns = batch.to_pydict()
        for k, key in enumerate(zip(*(columns[c] for c in keys))):
            if key != at:
                if rows:
                    yield at, rows
                at, rows = key, {c: [] for c in columns}
            for c, values in columns.items():
                rows[c].append(values[k])
    if rows:
        yield at, rows


def dealt_by(rows: DataFrame, by: list[str], then: list[str], run: Callable, schema: str) -> DataFrame:
    # the work is in the comparisons, not in the bytes: a fixed number of partitions
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(tasks, *by).sortWithinPartitions(*by, *then).mapInArrow(lambda parts: run(in_slices(parts)), schema)


def verified_stars(docs: DataFrame, index: DataFrame, stars: DataFrame, size: int = SIZE, percent: int = PERCENT) -> DataFrame:
    """a and b: the stars (sig, low) that link. A center with many sets is repeated, its sets are dealt over parts."""
    centers = stars.groupBy("low").agg(F.ceil(F.count(F.lit(1)) / STAR_SETS).cast("int").alias("parts"))
    members = join_unique(stars, centers, ["low"]).select("low", F.pmod(F.xxhash64("sig"), F.col("parts")).cast("int").alias("part"), F.lit(1).alias("role"), "sig")
    hubs = centers.select("low", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.lit(0).alias("role"), F.col("low").alias("sig"))
    found = save(texts_of(docs, wanted_sets(index, stars.select("sig").unionByName(stars.select(F.col("low").alias("sig"))))), "star-texts")

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, center = None, None
        for batch in parts:
            a, b = [], []
            for low, part, role, sig, text in zip(*(batch.column(c).to_pylist() for c in ("low", "part", "role", "sig", "text"))):
                if role == 0:
                    at, center = (low, part), shingles(text, size)
                elif at == (low, part) and linked(center, shingles(text, size), percent):
                    a.append(sig), b.append(low)
            yield from batches({"a": a, "b": b}, EDGES)

    rows = join_unique(save(members.unionByName(hubs), "star-rows"), found, ["sig"])
    return dealt_by(rows, ["low", "part"], ["role"], run, "a decimal(38,0), b decimal(38,0)")


def open_pairs(sketches: np.ndarray, component: list, key: int, own: list, i: int, j: int) -> Iterator[tuple[int, int]]:
    """Pairs of one bucket's rows that belong to different components, may be similar, and have this bucket as their first common one.

    own: the block of each row; of two different blocks i and j only pairs across them count."""
    keys = band_keys(sketches).view(np.int64)
    band = int(np.flatnonzero(keys[0] == key)[0])
    code: dict = {}
    components_ = np.array([code.setdefault(c, len(code)) for c in component])
    block = np.array(own)
    for k in range(len(sketches)):
        if block[k] != i:
            continue
        other = np.flatnonzero((block == j) & (components_ != components_[k]))
        other = other[other > k] if i == j else other
        if not len(other):
            continue
        other = other[np.count_nonzero(sketches[other] == sketches[k], axis=1) >= LEAST_EQUAL]
        if band and len(other):
            other = other[~(keys[other, :band] == keys[k, :band]).any(1)]
        for m in other.tolist():
            yield k, m


def in_blocks(rows: DataFrame, blocks: DataFrame) -> DataFrame:
    """Each row for each pair of blocks (i, j) of its key that its own block is in. blocks: key and the number of its blocks."""
    dealt = rows.join(blocks, "key").withColumn("own", F.pmod(F.xxhash64("sig"), F.col("blocks")).cast("int"))
    met = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).drop("blocks")
    return met.withColumns({"i": F.least("own", "other"), "j": F.greatest("own", "other")}).drop("other")


def verified_doubts(docs: DataFrame, placed: DataFrame, facts: DataFrame, doubts: DataFrame, pairs: Callable, size: int, percent: int) -> DataFrame:
    """a and b: links among the doubtful sets of each bucket, only as many as connect what is connected.

    placed: key, sig, component; facts: sig, t1, t2, sketch; doubts: key, sig; pairs(key, i, j, rows): the pairs that may link."""

    def verify(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (key, i, j), group in grouped_rows(parts, ["key", "i", "j"]):
            sets: dict[int, np.ndarray] = {}
            root: dict = {}

            def find(c):
                while (up := root.get(c, c)) != c:
                    root[c] = c = root.get(up, up)
                return c

            a, b = [], []
            for x, y in pairs(key, i, j, group):
                p, q = find(group["component"][x]), find(group["component"][y])
                if p != q:  # what is connected by now needs no further link
                    for k in (x, y):
                        if k not in sets:
                            sets[k] = shingles(group["text"][k], size)
                    if linked(sets[x], sets[y], percent):
                        root[p] = q
                        a.append(group["sig"][x]), b.append(group["sig"][y])
            yield from batches({"a": a, "b": b}, EDGES)

    with_texts = texts_of(docs, facts.join(doubts.select("sig").distinct(), "sig", "left_semi"))
    full = doubts.join(placed, ["key", "sig"]).join(facts.select("sig", "sketch"), "sig").join(with_texts, "sig")
    full = save(full, "doubtful-texts")
    size_of = full.groupBy("key").agg(F.greatest(F.ceil(F.count(F.lit(1)) / BLOCK_TEXTS), F.ceil(F.sum(F.length("text")) / BLOCK_CHARS)).cast("int").alias("blocks"))
    return dealt_by(in_blocks(full, size_of), ["key", "i", "j"], ["sig"], verify, "a decimal(38,0), b decimal(38,0)")


def leftover_links(docs: DataFrame, index: DataFrame, active: DataFrame, found: DataFrame, size: int = SIZE, percent: int = PERCENT) -> DataFrame:
    """a and b: links between different components in a bucket. active: key and sig; found: node and component."""
    placed = active.join(found.select(F.col("node").alias("sig"), "component"), "sig", "left").withColumn("component", F.coalesce("component", "sig"))
    placed = save(placed, "bucket-components")
    several = placed.groupBy("key").agg(F.min("component").alias("x"), F.max("component").alias("y"), F.count(F.lit(1)).alias("sets")).filter(F.col("x") < F.col("y"))
    several = several.select("key", F.ceil(F.col("sets") / BLOCK_SETS).cast("int").alias("blocks"))
    rows = placed.join(several.select("key"), "key", "left_semi")
    facts = save(wanted_sets(index, rows), "open-sets")

    def doubtful(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("key", pa.int64()), ("sig", SIG)])
        for (key, i, j), group in grouped_rows(parts, ["key", "i", "j"]):
            at = {x for pair in pairs(key, i, j, group) for x in pair}
            yield from batches({"key": [key] * len(at), "sig": [group["sig"][k] for k in at]}, schema)

    def pairs(key: int, i: int, j: int, group: dict[str, list]) -> Iterator[tuple[int, int]]:
        return open_pairs(_sketches(group["sketch"]), group["component"], key, group["own"], i, j)

    sketched = in_blocks(rows.join(facts.select("sig", "sketch"), "sig"), several)
    doubts = save(dealt_by(sketched, ["key", "i", "j"], ["sig"], doubtful, "key long, sig decimal(38,0)").distinct(), "doubtful-sets")
    return verified_doubts(docs, placed, facts, doubts, pairs, size, percent)


def set_components(docs: DataFrame, index: DataFrame, size: int = SIZE, percent: int = PERCENT) -> DataFrame:
    """node (a set's signature) and component of the sets that link with others."""
    entries = postings(index)
    buckets = entries.groupBy("key").agg(F.min("sig").alias("low"), F.max("sig").alias("high")).filter(F.col("low") < F.col("high")).select("key", "low")
    active = save(entries.join(buckets, "key").distinct(), "bucket-entries")
    best = F.max(F.struct("bands", "low")).alias("best")
    stars = active.filter(F.col("sig") != F.col("low")).groupBy("sig", "low").agg(F.count(F.lit(1)).alias("bands")).filter(F.col("bands") >= STAR_BANDS)
    stars = save(stars.groupBy("sig").agg(best).select("sig", "best.low"), "stars")
    first = save(verified_stars(docs, index, stars, size, percent), "star-links")
    rest = leftover_links(docs, index, active.select("key", "sig"), components(first), size, percent)
    return components(first.unionByName(rest))


def near_copies(docs: DataFrame, size: int = SIZE, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every document."""
    index = save(indexed(docs, size), "sketches")
    found = set_components(docs, index, size, percent)
    sets = index.filter(F.col("n") > 0).groupBy("sig").agg(F.min("doc_id").alias("least"))
    sets = save(sets.join(found.select(F.col("node").alias("sig"), "component"), "sig", "left").withColumn("component", F.coalesce("component", "sig")), "sets")
    ids = sets.groupBy("component").agg(F.min("least").alias("component_id"))
    named = save(join_unique(sets, ids, ["component"]).select("sig", "component_id"), "set-ids")
    rows = index.select("doc_id", F.col("n").alias("n_shingles"), "sig")
    full = join_unique(rows.filter(F.col("n_shingles") > 0), named, ["sig"]).select("doc_id", "n_shingles", "component_id")
    none = rows.filter(F.col("n_shingles") == 0).select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return full.unionByName(none).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
