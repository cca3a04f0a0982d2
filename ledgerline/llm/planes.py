"""Token ids in binary files: bit or byte planes of fixed-size blocks, each plane compressed with zstandard.

File format (all numbers little-endian)::

    "LPL1"
    blocks      for each block of up to BLOCK ids: its planes, compressed, one after another
    index       numpy arrays: blocks (offset u64, ids u32, planes u32), plane sizes (u32),
                documents (id i64, id-is-null u8, first id u64, ids u64), each with its length before it
    trailer     offset of the index (u64), "LPL1"

A block of ``n`` ids is seen as an ``n x 32`` bit matrix (or ``n x 4`` byte matrix) and transposed: plane
``k`` holds bit (byte) ``k`` of all ids. Planes above the block's highest set bit are not stored.

Every task of the range-partitioned, sorted documents writes its own files (a new file after ``FILE_IDS``
ids) and returns their names; that manifest is written as a table. A retried or speculative task writes
under another name, and files that no manifest names are never read. The folder must be one that
``pyarrow.fs`` opens (local mounts, hdfs, s3, gs); by default it lies below ``spark.checkpoint.dir``.

Defined results: a null text encodes as the empty text, so only the end id is stored. Documents are laid
out by ascending id, null ids first, equal ids by text (or as the table's files have them, ``as_stored``); repeated rows are each stored. Empty tables give
no files and no rows. Other columns are ignored.
"""

from __future__ import annotations

import re
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import regex
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm.common import batches, in_slices, kept_alone, save, shared_path, texts

MAGIC = b"LPL1"
#: Ids of a block, ids after which a task begins a new file, and the id put after each document.
BLOCK, FILE_IDS, END_ID = 1 << 16, 1 << 23, 0
#: Pieces of text, and tokens before merging, whose ids a worker keeps.
KEPT_PIECES, KEPT_TOKENS = 700_000, 1_600_000

_SPACES = re.compile(r" (?:\s|$)")
_CUT = re.compile(r"(?<=\S)(?= )|(?= \S)")
#: The split rule of the byte-level tokenizer; only used for letters up to U+024F, where all versions agree.
_TOKEN = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
_MARKS = ".,;:!?#$%&*|()"
_PLAIN = re.compile(r"[\x00-ɏ]*\Z").match


class Encoder:
    """Ids of whole texts, as little-endian u32 bytes, with the ids of pieces kept.

    The byte-level split rule always ends a token before a space that has a non-space on either side, so a text
    may be cut there and the pieces encoded apart; the library encodes each distinct piece. A text that has the literal
    of an added token (such as an end mark, which is one id of its own wherever it stands) goes to the library whole.
    ``kept`` is the share of ``KEPT_PIECES`` and ``KEPT_TOKENS`` that is kept.
    """

    def __init__(self, path: str, kept: float = 1.0):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.added = re.compile("|".join(map(re.escape, added))).search if added else lambda text: None
        self.tokens = _Kept(self._encode, int(KEPT_TOKENS * kept))
        self.words = _Kept(self._word, int(KEPT_PIECES * kept))
        self.model = self.tokenizer.model
        self.one = struct.Struct("<I").pack

    def _encode(self, piece: str) -> bytes:
        letters = piece[1:] if piece[0] == " " else piece
        if letters.isascii() and letters.isalpha():  # one token for the split rule; the model takes it as it is, a space as U+0120
            return b"".join([self.one(t.id) for t in self.model.tokenize("\u0120" + letters if piece[0] == " " else piece)])
        return self._whole(piece)

    def _whole(self, text: str) -> bytes:
        return b"".join(map(self.one, self.tokenizer.encode(text, add_special_tokens=False).ids))

    def _word(self, word: str) -> bytes:
        """A word after a space. Letters with marks behind them, and several of them with line ends between, need no pattern."""
        if not word or not (word.isascii() or _PLAIN(word)):
            return self._split(" " + word)
        out, space = [], " "
        for part in word.split("\n"):
            core = part.rstrip(_MARKS)
            if not core.isalpha():
                return self._split(" " + word)
            if not space:
                out.append(self.tokens["\n"])
            out.append(self.tokens[space + core])
            if len(core) < len(part):
                out.append(self.tokens[part[len(core) :]])
            space = ""
        return b"".join(out)

    def _split(self, piece: str) -> bytes:
        if not _PLAIN(piece):
            return self._encode(piece)
        return b"".join(map(self.tokens.__getitem__, _TOKEN.findall(piece)))

    def encode(self, text: str) -> bytes:
        if self.added(text):
            return self._whole(text)
        if _SPACES.search(text):
            return b"".join(map(self._split, filter(None, _CUT.split(text))))
        first, *rest = text.split(" ")
        self.words.trim(), self.tokens.trim()
        return (self._split(first) if first else b"") + b"".join(map(self.words.__getitem__, rest))


class _Kept(dict):
    """Values made once, in two generations: what is not asked for while a generation fills up is dropped."""

    def __init__(self, make, most: int):
        super().__init__()
        self.make, self.most, self.older = make, most, {}

    def __missing__(self, key: str) -> bytes:
        value = self.older.get(key)
        self[key] = value = self.make(key) if value is None else value
        return value

    def trim(self) -> None:
        if len(self) > self.most // 2:
            self.older = dict(self)
            self.clear()


def encoder(path: str, kept: float = 1.0) -> Encoder:
    return kept_alone((Encoder, path, kept), lambda: Encoder(path, kept))


def pack(ids: np.ndarray, planes: str = "bit", level: int = 3) -> list[bytes]:
    """The compressed planes of one block of u32 ids, lowest first."""
    ids = ids.astype("<u4", copy=False)
    top = int(ids.max()).bit_length() if len(ids) else 0
    squeeze = zstandard.ZstdCompressor(level=level).compress
    if planes == "byte":
        return [squeeze(np.ascontiguousarray(ids.view(np.uint8).reshape(-1, 4)[:, k]).tobytes()) for k in range(-(-top // 8))]
    return [squeeze(np.packbits(ids >> np.uint32(k) & np.uint32(1)).tobytes()) for k in range(top)]


def unpack(stored: list[bytes], n: int, planes: str = "bit") -> np.ndarray:
    """The ``n`` ids of a block from its compressed planes."""
    loosen = zstandard.ZstdDecompressor().decompress
    ids = np.zeros(n, np.uint32)
    for k, plane in enumerate(stored):
        raw = np.frombuffer(loosen(plane, max_output_size=n), np.uint8)
        ids |= (raw.astype(np.uint32) << np.uint32(8 * k)) if planes == "byte" else np.unpackbits(raw, count=n).astype(np.uint32) << np.uint32(k)
    return ids


class Writer:
    """One file: documents go in as bytes of u32 ids; memory holds one block and the index."""

    def __init__(self, file, planes: str = "bit", block: int = BLOCK):
        self.file, self.planes, self.block = file, planes, block
        self.file.write(MAGIC + (b"\1" if planes == "byte" else b"\0"))
        self.at, self.n_ids, self.open = 5, 0, bytearray()
        self.blocks: list[tuple[int, int, int]] = []
        self.sizes: list[int] = []
        self.docs: list[tuple[int, int, int, int]] = []

    def add(self, doc_id: int | None, ids: bytes) -> None:
        self.docs.append((doc_id or 0, doc_id is None, self.n_ids, len(ids) // 4))
        self.n_ids += len(ids) // 4
        self.open += ids
        full = len(self.open) // (4 * self.block) * 4 * self.block
        for i in range(0, full, 4 * self.block):
            self._put(self.open[i : i + 4 * self.block])
        del self.open[:full]

    def _put(self, raw: bytes) -> None:
        stored = pack(np.frombuffer(bytes(raw), "<u4"), self.planes)
        self.blocks.append((self.at, len(raw) // 4, len(stored)))
        for plane in stored:
            self.file.write(plane)
            self.sizes.append(len(plane))
            self.at += len(plane)

    def close(self) -> int:
        """Write the last block and the index; the file's size."""
        if self.open:
            self._put(self.open)
            self.open = bytearray()
        index = b""
        for kind, rows in ((_BLOCKS, self.blocks), ("<u4", self.sizes), (_DOCS, self.docs)):
            index += struct.pack("<Q", len(rows)) + np.array(rows, kind).tobytes()
        self.file.write(index + struct.pack("<Q", self.at) + MAGIC)
        self.file.close()
        return self.at + len(index) + 12


_BLOCKS = np.dtype([("at", "<u8"), ("ids", "<u4"), ("planes", "<u4")])
_DOCS = np.dtype([("doc", "<i8"), ("null", "u1"), ("first", "<u8"), ("ids", "<u8")])


class Reader:
    """One file by its index: blocks one at a time, in order or by number."""

    def __init__(self, file):
        self.file = file
        size = file.size()
        file.seek(size - 12)
        tail = file.read(12)
        if tail[8:] != MAGIC:
            raise ValueError("not a plane file, or cut short")
        (at,) = struct.unpack("<Q", tail[:8])
        file.seek(4)
        self.planes = "byte" if file.read(1) == b"\1" else "bit"
        file.seek(at)
        raw, found = file.read(size - 12 - at), []
        for kind in (_BLOCKS, np.dtype("<u4"), _DOCS):
            (n,) = struct.unpack("<Q", raw[:8])
            found.append(np.frombuffer(raw[8 : 8 + n * kind.itemsize], kind))
            raw = raw[8 + n * kind.itemsize :]
        self.blocks, self.sizes, self.docs = found
        self.first_size = np.r_[0, np.cumsum(self.blocks["planes"], dtype=np.int64)]

    def block(self, k: int) -> np.ndarray:
        sizes = self.sizes[self.first_size[k] : self.first_size[k + 1]].tolist()
        self.file.seek(int(self.blocks["at"][k]))
        return unpack([self.file.read(s) for s in sizes], int(self.blocks["ids"][k]), self.planes)

    def documents(self) -> Iterator[tuple[int | None, int, int, Iterator[np.ndarray]]]:
        """(id, first id, ids, parts) of each document; parts must be used up before the next."""
        held, left, k = np.zeros(0, np.uint32), 0, 0

        def parts(need: int) -> Iterator[np.ndarray]:
            nonlocal held, k
            while need:
                if not len(held):
                    held, k = self.block(k), k + 1
                take = held[:need]
                held, need = held[len(take) :], need - len(take)
                yield take

        for doc, null, first, n in self.docs.tolist():
            yield None if null else doc, first, n, parts(n)


def write_files(docs: DataFrame, tokenizer: str, folder: str, planes: str = "bit", end_id: int = END_ID, file_ids: int = FILE_IDS, block: int = BLOCK, kept: float = 1.0, as_stored: bool = False) -> DataFrame:
    """Encode and write all documents; the manifest: part, seq, file, n_docs, n_ids, n_bytes, start (ids before the file). kept: see ``Encoder``.

    ``as_stored``: not by id, but in the order of the table's own files, by name, and of the rows in each."""
    schema = pa.schema([("part", pa.int32()), ("seq", pa.int32()), ("file", pa.string()), ("n_docs", pa.int64()), ("n_ids", pa.int64()), ("n_bytes", pa.int64())])
    end = struct.pack("<I", end_id)

    def write(parts):
        files, base = pafs.FileSystem.from_uri(folder)
        files.create_dir(base, recursive=True)
        code, part, seq, out, name = encoder(tokenizer, kept).encode, TaskContext.get().partitionId(), 0, None, ""
        for batch in in_slices(parts):
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), texts(batch)):
                if out is None:
                    name = f"part-{part:06d}-{seq:05d}-{uuid.uuid4().hex}.lpl"
                    out = Writer(files.open_output_stream(f"{base}/{name}"), planes, block)
                out.add(doc_id, code(text) + end)
                if out.n_ids >= file_ids:
                    yield from batches({"part": [part], "seq": [seq], "file": [name], "n_docs": [len(out.docs)], "n_ids": [out.n_ids], "n_bytes": [out.close()]}, schema)
                    out, seq = None, seq + 1
        if out is not None:
            yield from batches({"part": [part], "seq": [seq], "file": [name], "n_docs": [len(out.docs)], "n_ids": [out.n_ids], "n_bytes": [out.close()]}, schema)

    if as_stored:
        placed = docs.select(F.col("doc_id").cast("long"), "text", F.col("_metadata.file_name").alias("in_file"), F.col("_metadata.row_index").alias("in_row"))
        laid = placed.repartitionByRange("in_file", "in_row").sortWithinPartitions("in_file", "in_row").select("doc_id", "text")
    else:
        laid = docs.select(F.col("doc_id").cast("long"), "text").repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    files = save(laid.mapInArrow(write, "part int, seq int, file string, n_docs long, n_ids long, n_bytes long"), "plane-files")
    # ids before each file: first over the parts (a row each), then within a part
    before = files.groupBy("part").agg(F.sum("n_ids").alias("of_part")).withColumn("base", F.sum("of_part").over(Window.orderBy("part")) - F.col("of_part"))
    within = F.sum("n_ids").over(Window.partitionBy("part").orderBy("seq")) - F.col("n_ids")
    return files.withColumn("within", within).join(before, "part").select(*files.columns, (F.col("base") + F.col("within")).alias("start"))


def read_files(manifest: DataFrame, folder: str) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document in the files, from the files alone.

    One task reads whole files, block by block; it holds one block and one file's index."""
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])

    def read(parts):
        files, base = pafs.FileSystem.from_uri(folder)
        for batch in parts:
            for name, start in zip(batch.column("file").to_pylist(), batch.column("start").to_pylist()):
                rows: dict[str, list] = {n: [] for n in schema.names}
                with files.open_input_file(f"{base}/{name}") as file:
                    for doc_id, first, n, ids in Reader(file).documents():
                        crc = 0
                        for part in ids:
                            crc = zlib.crc32(part.astype("<u4").tobytes(), crc)
                        for k, x in zip(schema.names, (doc_id, start + first, n, crc)):
                            rows[k].append(x)
                yield from batches(rows, schema)

    n = max(1, min(manifest.count(), 20_000))
    return manifest.select("file", "start").repartition(n).mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_files(docs: DataFrame, tokenizer: str, planes: str = "bit", folder: str | None = None, kept: float = 1.0, as_stored: bool = False) -> DataFrame:
    """Write the documents' ids to plane files and return what the files hold (see ``read_files``)."""
    folder = folder or shared_path(docs.sparkSession, "planes")
    return read_files(save(write_files(docs, tokenizer, folder, planes, kept=kept, as_stored=as_stored), "plane-manifest"), folder)
