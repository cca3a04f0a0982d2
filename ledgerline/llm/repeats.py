"""Repeated byte strings: maximal repeats from enhanced suffix arrays over sampled positions, and what they cover.

Every string of ``LENGTH`` bytes holds an anchor: a position whose hash of ``GRAM`` bytes is the least among the string's (all such
positions, on ties). The choice depends on the bytes alone, so equal strings have anchors at equal offsets, and only anchors
with equal grams need to meet. An anchor's context is what strings around it can reach: ``BACK`` bytes before and ``LENGTH`` from it on.

1. Anchors are counted by gram hash; only those that occur twice stay.
2. Contexts that occur twice or more are covered whole. One of each goes on as their representative.
3. Groups with other contexts fetch the bytes. A task sorts a group's contexts from the anchor on: an enhanced suffix array over the
   sampled suffixes. A stack scan over the common-prefix lengths gives the interval tree; in each interval (common length r to
   the right), the contexts are ordered by their reversed left sides, and where they agree over l >= LENGTH - r bytes and then
   differ (left-extension diversity), the l + r bytes are a maximal repeat with all its occurrences, not only neighbours.
4. Groups above ``GROUP`` contexts are not taken into a task: their strings are counted by hash, range by range (``covered_by_halving``).

Texts are told apart by 128-bit, contexts by 64-bit hashes; grams by 64 bits, corrected by comparing bytes.
Defined results: a null text is empty; nothing is removed from texts under ``LENGTH`` bytes. Copies and repeated rows are occurrences of
each other, so they are removed whole. Matches never cross texts. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import batches, save, texts
from ledgerline.llm.shingle_join import FILTER_BITS, _cells, _filter_of
from ledgerline.llm.shingles import mix

LENGTH, GRAM = 400, 128
BACK = LENGTH - GRAM
#: Contexts that a task takes as one group.
GROUP = 16_384
_BASE = 0x9E3779B97F4A7C15


def _sliding(x: np.ndarray, n: int, least) -> np.ndarray:
    """``least`` of each ``n`` values in a row, by doubling."""
    size = 1
    while 2 * size <= n:
        x = least(x[: len(x) - size], x[size:])
        size *= 2
    return least(x[: len(x) - (n - size)], x[n - size :]) if n > size else x


def anchors(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Positions and gram hashes of a text's anchors."""
    if len(raw) < LENGTH:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    h = np.frombuffer(raw, np.uint8).astype(np.uint64) + np.uint64(1)
    size, power = 1, _BASE
    while size < GRAM:
        h = h[: len(h) - size] * np.uint64(power) + h[size:]
        size *= 2
        power = power * power % (1 << 64)
    low = mix(h)
    least = _sliding(low, BACK + 1, np.minimum)  # of each string
    most = np.concatenate([np.zeros(BACK, np.uint64), least, np.zeros(BACK, np.uint64)])
    at = np.flatnonzero(_sliding(most, BACK + 1, np.maximum) == low)
    return at, low[at]


def text_key(raw: bytes) -> bytes:
    return xxhash.xxh3_128_digest(raw)


def _context(raw: bytes, at: int) -> tuple[int, int]:
    return max(0, at - BACK), min(len(raw), at + LENGTH)


def anchor_rows(docs: DataFrame) -> DataFrame:
    """gram, context (its hash), key (of the text), at and copies (of the text in its batch) of all anchors."""
    schema = pa.schema([("gram", pa.int64()), ("context", pa.int64()), ("key", pa.binary()), ("at", pa.int32()), ("copies", pa.int64())])

    def run(parts):
        for batch in parts:
            seen: dict[bytes, list] = {}
            for text in texts(batch):
                raw = text.encode("utf-8", "surrogatepass")
                if len(raw) >= LENGTH:
                    seen.setdefault(text_key(raw), [raw, 0])[1] += 1
            for many in _chunks(seen.items(), 500):
                rows: dict[str, list] = {n: [] for n in schema.names}
                for key, (raw, copies) in many:
                    at, gram = anchors(raw)
                    rows["gram"] += gram.view(np.int64).tolist()
                    rows["at"] += at.tolist()
                    rows["key"] += [key] * len(at)
                    rows["copies"] += [copies] * len(at)
                    for p in at.tolist():
                        a, b = _context(raw, p)
                        x = xxhash.xxh3_64_intdigest(raw[a:b], seed=p - a)
                        rows["context"].append(x - (1 << 64) if x >> 63 else x)
                yield from batches(rows, schema)

    return docs.select("text").mapInArrow(run, "gram long, context long, key binary, at int, copies long")


def _chunks(items, n: int) -> Iterator[list]:
    out = []
    for x in items:
        out.append(x)
        if len(out) == n:
            yield out
            out = []
    if out:
        yield out


def _common(rows: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Bytes that each row shares with the next, from the start."""
    differ = rows[:-1] != rows[1:]
    first = np.where(differ.any(1), differ.argmax(1), rows.shape[1])
    return np.minimum(first, np.minimum(sizes[:-1], sizes[1:]))


def _matrix(parts: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray]:
    sizes = np.array([len(x) for x in parts], np.int64)
    return np.frombuffer(b"".join(x.ljust(width, b"\0") for x in parts), np.uint8).reshape(len(parts), width), sizes


def intervals(lcp: list[int], least: int) -> Iterator[tuple[int, int, int]]:
    """(common length, first, last) of the common-prefix interval tree's nodes with a length of ``least`` or more, by a stack scan."""
    stack = [(0, 0)]
    for i, x in enumerate([*lcp, 0], 1):
        first = i - 1
        while stack[-1][0] > x:
            length, first = stack.pop()
            if length >= least:
                yield length, first, i - 1
        if stack[-1][0] < x:
            stack.append((x, first))


def maximal_repeats(lefts: list[bytes], rights: list[bytes], length: int = LENGTH) -> Iterator[tuple[int, list[int], list[int]]]:
    """(r, members, l of each) of a group of contexts: members share r bytes from the anchor on, and each shares its l bytes before
    the anchor with another member, with l + r >= ``length``. lefts: reversed, so that they begin at the anchor."""
    order = sorted(range(len(rights)), key=rights.__getitem__)
    width = max(map(len, rights))
    right, right_size = _matrix([rights[k] for k in order], width)
    back = max(1, max(map(len, lefts)))
    left, left_size = _matrix(lefts, back)
    rank = np.empty(len(lefts), np.int64)
    rank[sorted(range(len(lefts)), key=lefts.__getitem__)] = np.arange(len(lefts))
    order = np.array(order)
    for r, first, last in intervals(_common(right, right_size).tolist(), length - back if length > back else 1):
        members = order[first : last + 1]
        members = members[np.argsort(rank[members])]
        l = _common(left[members], left_size[members])  # noqa: E741
        enough = l >= length - r
        if not enough.any():
            continue
        l = np.where(enough, l, -1)  # noqa: E741
        best = np.maximum(np.r_[-1, l], np.r_[l, -1])
        # runs of neighbours that agree far enough to the left are one repeat each
        run = np.cumsum(np.r_[True, ~enough])
        for k in np.unique(run[best >= 0]):
            of = (run == k) & (best >= 0)
            yield r, members[of].tolist(), best[of].tolist()


_GROUPED = "grp long, key binary, at int, before binary, after binary"
_COVER = "key binary, start int, stop int"


def covered_by_groups(contexts: DataFrame) -> DataFrame:
    """key, start and stop of every occurrence of a maximal repeat in the groups. contexts: grp, key, at, before (reversed), after."""
    schema = pa.schema([("key", pa.binary()), ("start", pa.int32()), ("stop", pa.int32())])

    def cover(group: list[tuple]) -> dict[str, list]:
        rows: dict[str, list] = {n: [] for n in schema.names}
        if len(group) > 1:
            found: dict[tuple[int, int], int] = {}
            for r, members, ls in maximal_repeats([g[2] for g in group], [g[3] for g in group]):
                for m, x in zip(members, ls):
                    found[m, x] = max(found.get((m, x), 0), r)
            for (m, x), r in found.items():
                for name, value in zip(schema.names, (group[m][0], group[m][1] - x, group[m][1] + r)):
                    rows[name].append(value)
        return rows

    def run(parts):
        now, group = None, []
        for batch in parts:
            for grp, *row in zip(*(batch.column(c).to_pylist() for c in ("grp", "key", "at", "before", "after"))):
                if grp != now:
                    yield from batches(cover(group), schema)
                    now, group = grp, []
                group.append(tuple(row))
        yield from batches(cover(group), schema)

    return contexts.repartition("grp").sortWithinPartitions("grp").mapInArrow(run, _COVER)


def covered_by_halving(contexts: DataFrame) -> DataFrame:
    """key, start and stop of what repeats in groups of any size, by counting alone: no task ever holds a group.

    A context stands for its strings with starts from ``s1`` to ``s2`` bytes before the anchor. If all of their bytes together occur
    twice, all are covered; if not even the bytes that they share do, none is; else the range is halved, 7 times at most."""
    out = contexts.sparkSession.createDataFrame([], _COVER)
    # starts that the text has room for; ranges are the same for all contexts (halves of ranges of 128), so that they meet.
    # All strings of a first range share LENGTH - 127 bytes or more, so contexts with only a line in common go at once.
    first, last = F.greatest(F.lit(0), LENGTH - F.length("after")), F.length("before")
    ranges = F.array(*(F.struct(F.lit(k).alias("s1"), F.lit(k + 127).alias("s2")) for k in range(0, BACK + 1, 128)))
    state = contexts.select("*", first.alias("v1"), last.alias("v2"), F.explode(ranges).alias("r")).select("*", "r.s1", "r.s2").drop("r")
    part = lambda low, high: F.xxhash64("grp", "s1", "s2", F.expr(f"substring(before, 1, {high})"), F.expr(f"substring(after, 1, {LENGTH} - {low})"))
    while True:
        within = (F.col("s1") >= F.col("v1")) & (F.col("s2") <= F.col("v2"))
        state = state.filter((F.col("s1") <= F.col("v2")) & (F.col("s2") >= F.col("v1")))
        state = save(state.withColumn("whole", F.when(within, part("s1", "s2"))).withColumn("core", part("s2", "s1")), "halving")
        if not state.limit(1).count():
            return out
        marked = state
        for name in ("whole", "core"):
            many = state.filter(F.col(name).isNotNull()).groupBy(name).agg((F.count(F.lit(1)) > 1).alias(f"{name}_repeats"))
            marked = marked.join(many, name, "left").fillna(False, [f"{name}_repeats"])
        out = out.unionByName(marked.filter("whole_repeats").select("key", (F.col("at") - F.col("s2")).alias("start"), (F.col("at") + LENGTH - F.col("s1")).alias("stop")))
        middle = F.floor((F.col("s1") + F.col("s2")) / 2).cast("int")
        halves = F.array(F.struct(F.col("s1").alias("s1"), middle.alias("s2")), F.struct((middle + 1).alias("s1"), F.col("s2").alias("s2")))
        # of equal ranges that are covered, one goes on: others may share a part of it
        open_ranges = marked.filter("core_repeats AND s1 < s2")
        open_ranges = open_ranges.filter("NOT whole_repeats").unionByName(open_ranges.filter("whole_repeats").dropDuplicates(["whole"])).withColumn("h", F.explode(halves))
        state = open_ranges.select("grp", "key", "at", "before", "after", "v1", "v2", "h.s1", "h.s2")


def _in(table: np.ndarray, key: bytes) -> bool:
    x = int(_cells(mix(np.frombuffer(key[:8], np.uint64)), FILTER_BITS)[0])
    return bool(table[x >> 3] >> (x & 7) & 1)


def _table(rows: DataFrame) -> np.ndarray:
    """The bit filter of the rows' text keys."""

    def sigs(parts):
        for batch in parts:
            yield pa.RecordBatch.from_pydict({"sig": [int.from_bytes(k[:8], "little", signed=True) for k in batch.column("key").to_pylist()]}, schema=pa.schema([("sig", pa.int64())]))

    return _filter_of(rows.select("key").mapInArrow(sigs, "sig long"))


def contexts_of(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """The bytes of the wanted contexts. wanted: grp, key, at. Each text that is wanted is shuffled once, compressed."""
    shared = docs.sparkSession.sparkContext.broadcast(_table(wanted))  # of fixed size

    def pick(parts):
        squeeze = zstandard.ZstdCompressor(level=3).compress
        for batch in parts:
            found: dict[bytes, bytes] = {}
            for text in texts(batch):
                raw = text.encode("utf-8", "surrogatepass")
                if len(raw) >= LENGTH and (key := text_key(raw)) not in found and _in(shared.value, key):
                    found[key] = squeeze(raw)
            yield from batches({"key": list(found), "packed": list(found.values())}, pa.schema([("key", pa.binary()), ("packed", pa.binary())]))

    def cut(parts):
        loosen = zstandard.ZstdDecompressor().decompress
        schema = pa.schema([("grp", pa.int64()), ("key", pa.binary()), ("at", pa.int32()), ("before", pa.binary()), ("after", pa.binary())])
        for batch in parts:
            for key, packed, places in zip(batch.column("key").to_pylist(), batch.column("packed").to_pylist(), batch.column("places").to_pylist()):
                raw, rows = loosen(packed), {n: [] for n in schema.names}
                for place in places:
                    a, b = _context(raw, at := place["at"])
                    for name, x in zip(schema.names, (place["grp"], key, at, raw[a:at][::-1], raw[at:b])):
                        rows[name].append(x)
                yield from batches(rows, schema)

    once = docs.select("text").mapInArrow(pick, "key binary, packed binary").dropDuplicates(["key"])
    places = wanted.groupBy("key").agg(F.collect_list(F.struct("grp", "at")).alias("places"))
    return once.join(places, "key").mapInArrow(cut, _GROUPED)


def covered(docs: DataFrame, group: int = GROUP) -> DataFrame:
    """key, start and stop: for each distinct text, stretches whose union is all that repeats."""
    rows = save(anchor_rows(docs), "anchors")
    twice = rows.groupBy("gram").agg(F.sum("copies").alias("n")).filter(F.col("n") > 1).select("gram")
    rows = save(rows.join(twice, "gram"), "repeated-anchors")
    own = rows.groupBy("gram", "context").agg(F.sum("copies").alias("n"), F.min(F.struct("key", "at")).alias("one"))
    own = save(own, "contexts")
    whole = rows.join(own.filter(F.col("n") > 1).select("gram", "context"), ["gram", "context"])
    # (a context is clipped at its text's ends: it then begins at 0, and its end is corrected when the text is at hand)
    whole = whole.select("key", F.greatest(F.lit(0), F.col("at") - BACK).alias("start"), (F.col("at") + LENGTH).alias("stop"))
    open_groups = own.groupBy("gram").agg(F.count(F.lit(1)).alias("m"), F.min("n").alias("least")).filter((F.col("m") > 1) & (F.col("least") == 1)).select("gram")
    wanted = save(own.join(open_groups, "gram").select(F.col("gram").alias("grp"), "one.key", "one.at"), "wanted")
    fetched = save(contexts_of(docs, wanted), "context-bytes")
    large = save(fetched.groupBy("grp").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > group).select("grp"), "large-groups")
    out = covered_by_groups(fetched.join(large, "grp", "left_anti"))
    for more in (covered_by_halving(fetched.join(large, "grp")), whole):
        out = out.unionByName(more.select("key", F.col("start").cast("int"), F.col("stop").cast("int")))
    return out


OUT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def _cut_out(raw: bytes, spans: list) -> tuple[int, int, bytes]:
    """Bytes removed, maximal removed runs, and the bytes left."""
    if not spans:
        return 0, 0, raw
    step = np.zeros(len(raw) + 1, np.int64)
    ends = np.minimum(np.array([(s["start"], s["stop"]) for s in spans], np.int64), len(raw))
    np.add.at(step, ends[:, 0], 1)
    np.add.at(step, ends[:, 1], -1)
    gone = np.cumsum(step)[:-1] > 0
    runs = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum())
    return int(gone.sum()), runs, np.frombuffer(raw, np.uint8)[~gone].tobytes()


def without_repeats(docs: DataFrame, group: int = GROUP, with_text: bool = False) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept_sha256 of every document; ``with_text`` adds the bytes left (kept)."""
    spans = save(covered(docs, group), "covered")
    shared = docs.sparkSession.sparkContext.broadcast(_table(spans))
    names = [x.split()[0] for x in OUT.split(", ")]
    kinds = [pa.int64()] * 4 + [pa.string()] + [pa.binary()] * with_text
    schema = pa.schema(list(zip([*names, *["kept"] * with_text], kinds)))
    wide = pa.schema([*schema, ("key", pa.binary()), ("packed", pa.binary())])
    out = OUT + ", kept binary" * with_text

    def result(doc_id, raw, found) -> tuple:
        removed, runs, left = _cut_out(raw, found)
        return (doc_id, len(raw), removed, runs, hashlib.sha256(left).hexdigest(), *[left] * with_text)

    def first(parts):
        squeeze = zstandard.ZstdCompressor(level=3).compress
        for batch in parts:
            rows: dict[str, list] = {n: [] for n in wide.names}
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), texts(batch)):
                raw = text.encode("utf-8", "surrogatepass")
                key = text_key(raw)
                if len(raw) >= LENGTH and _in(shared.value, key):
                    row = (doc_id, *[None] * (len(schema.names) - 1), key, squeeze(raw))
                else:
                    row = (*result(doc_id, raw, []), None, None)
                for n, x in zip(wide.names, row):
                    rows[n].append(x)
            yield from batches(rows, wide)

    def second(parts):
        loosen = zstandard.ZstdDecompressor().decompress
        for batch in parts:
            rows: dict[str, list] = {n: [] for n in schema.names}
            for doc_id, packed, found in zip(batch.column("doc_id").to_pylist(), batch.column("packed").to_pylist(), batch.column("spans").to_pylist()):
                for n, x in zip(schema.names, result(doc_id, loosen(packed), found)):
                    rows[n].append(x)
            yield from batches(rows, schema)

    sorted_out = save(docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(first, out + ", key binary, packed binary"), "sorted-out")
    of_text = spans.groupBy("key").agg(F.collect_set(F.struct("start", "stop")).alias("spans"))
    rest = sorted_out.filter(F.col("packed").isNotNull()).select("doc_id", "key", "packed").join(of_text, "key", "left").select("doc_id", "packed", "spans").mapInArrow(second, out)
    return sorted_out.filter(F.col("packed").isNull()).select(schema.names).unionByName(rest)
