"""Token ids in seekable files: one zstandard frame a document, a seek table at the end of each file.

A file, in this order:

* a skippable frame: tag, version, bytes an id, range partition and number of the file in it, number of
  documents, their ids (64-bit) and a flag for each null id
* one independent frame for each document, with its content checksum: the ids, little-endian
* a skippable frame, the seek table of the zstandard seekable format: compressed size, size and checksum
  (low half of XXH64) of every frame before it, then their number, a flag byte and the magic number
* an empty skippable frame, which is the line end that Spark's text sink writes

Any zstandard decoder reads a whole file as one stream. A reader of single documents takes the table
from the end, adds up compressed sizes, and decompresses nothing but the frames it wants. Files are
written by Spark's own sink, so a task that is repeated leaves no second copy, on any file system.
"""

from __future__ import annotations

import os
import re
import struct
import sys
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cohortloom.llm.stored import quoted, stored
from cohortloom.llm.words import slices

FILE_BYTES = 1 << 22  # a file ends with the document that reaches this size
KEPT_PIECES = 3 << 19  # encoded pieces that a worker remembers; then it starts anew
TAG, VERSION = b"TOKF", 1
# --- fixed values of the zstandard seekable format ---
HEADER_MAGIC, TABLE_MAGIC, FOOTER_MAGIC = 0x184D2A50, 0x184D2A5E, 0x8F92EAB1
WITH_CHECKSUMS = 0x80
HEAD = struct.Struct("<4sHHIIQ")  # tag, version, bytes an id, partition, number, documents
FRAME, ENTRY, FOOTER = struct.Struct("<II"), np.dtype("<u4"), struct.Struct("<IBI")
LINE_END = FRAME.pack(HEADER_MAGIC, 0)  # all of it ASCII


# Runs of which all is known without the tokenizer's normalization and pre-split: lower-case letters of ASCII and
# Latin-1 (composed, so normalization leaves them), single digits, and ASCII marks but the apostrophe. A piece that
# consists of such runs is cut into just them by the pre-split.
_RUNS = re.compile(rb"(?:[a-z]|\xc3[\x9f-\xb6\xb8-\xbf])+|[0-9]|[!-&(-/:-@\[-`{-~]+")


class Pieces:
    """Packed ids of texts. Texts are cut at ASCII white space, which this kind of tokenizer drops: words are
    tokenized one by one, and special strings hold no white space, so pieces and whole texts give the same ids. As
    the tokenizer lowers letters itself, pieces are kept in lower case, unless the text may hold a special string."""

    def __init__(self, path: str) -> None:
        self.held: dict[bytes, bytes] = {}
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.byte_level = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.width = 2 if self.tokenizer.get_vocab_size(with_added_tokens=True) <= 1 << 16 else 4
        self.code = "H" if self.width == 2 else "I"
        if sys.byteorder != "little":
            raise RuntimeError("token files are written on little-endian machines")

    def packed(self, ids: list[int]) -> bytes:
        return array(self.code, ids).tobytes()

    def encode(self, raw: bytes | None) -> bytes:
        """Ids of a text given in UTF-8."""
        raw = raw or b""
        pieces = (raw if b"<|" in raw else raw.lower()).split()
        found = list(map(self.held.get, pieces))
        if None in found:
            new = {piece for piece, ids in zip(pieces, found) if ids is None}
            if len(self.held) + len(new) > KEPT_PIECES:
                self.held.clear()
                new = set(pieces)
            self._add(new)
            found = [self.held[piece] for piece in pieces]
        return b"".join(found)

    def _run(self, run: bytes) -> bytes:
        """Ids of one pre-split run: the library's model on its byte-level form."""
        ids = self.held.get(run)
        if ids is None:
            text = run.decode()
            if not run.isascii():
                text = self.byte_level.pre_tokenize_str(text)[0][0]
            ids = self.held[run] = self.packed([token.id for token in self.tokenizer.model.tokenize(text)])
        return ids

    def _add(self, new: set[bytes]) -> None:
        others = []
        for piece in new:
            if piece.isalpha() and piece.islower():  # ASCII only
                self._run(piece)
                continue
            runs = _RUNS.findall(piece)
            if sum(map(len, runs)) == len(piece) and b"<|" not in piece:
                self.held[piece] = b"".join([self._run(run) for run in runs])
            else:
                others.append(piece)
        for at in range(0, len(others), 1000):
            some = others[at:at + 1000]
            encoded = self.tokenizer.encode_batch([piece.decode("utf-8", "replace") for piece in some], add_special_tokens=False)
            self.held.update((piece, self.packed(e.ids)) for piece, e in zip(some, encoded))


_PIECES: dict[str, Pieces] = {}


def _check(raw: bytes) -> int:
    return xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF


class FileBuilder:
    """Collects the frames of one file."""

    def __init__(self, width: int, partition: int) -> None:
        self.width, self.partition, self.number = width, partition, 0
        self.compressor = zstandard.ZstdCompressor(level=3, write_checksum=True, write_content_size=True)
        self._begin()

    def _begin(self) -> None:
        self.ids, self.frames, self.entries, self.size = [], [], [], 0

    def add(self, doc_id: int | None, raw: bytes) -> None:
        frame = self.compressor.compress(raw)
        self.ids.append(doc_id)
        self.frames.append(frame)
        self.entries.append((len(frame), len(raw), _check(raw)))
        self.size += len(frame)

    def finish(self) -> bytes:
        """The file but for its line end."""
        head = HEAD.pack(TAG, VERSION, self.width, self.partition, self.number, len(self.ids))
        head += np.array([i or 0 for i in self.ids], "<i8").tobytes() + bytes(i is None for i in self.ids)
        first = FRAME.pack(HEADER_MAGIC, len(head)) + head
        table = np.array([(len(first), 0, _check(b"")), *self.entries], ENTRY).tobytes()
        footer = FOOTER.pack(len(self.entries) + 1, WITH_CHECKSUMS, FOOTER_MAGIC)
        whole = b"".join([first, *self.frames, FRAME.pack(TABLE_MAGIC, len(table) + len(footer)), table, footer])
        self.number += 1
        self._begin()
        return whole


class DamagedFile(ValueError):
    """A file or frame does not hold what its table says."""


class TokenFile:
    """Random access to one file's content."""

    def __init__(self, content: bytes) -> None:
        end = len(content) - len(LINE_END)
        if end < FOOTER.size or content[end:] != LINE_END:
            raise DamagedFile("no line end")
        frames, flags, magic = FOOTER.unpack_from(content, end - FOOTER.size)
        start = end - FOOTER.size - 12 * frames
        if magic != FOOTER_MAGIC or flags != WITH_CHECKSUMS or start < FRAME.size or frames < 1:
            raise DamagedFile("no seek table")
        table = np.frombuffer(content, ENTRY, 3 * frames, start).reshape(frames, 3)
        self.offsets = np.concatenate([[0], np.cumsum(table[:, 0], dtype=np.int64)])
        if self.offsets[-1] != start - FRAME.size:
            raise DamagedFile("frames and seek table differ in size")
        self.content, self.sizes, self.checks = content, table[1:, 1], table[1:, 2]
        tag, version, self.width, self.partition, self.number, documents = HEAD.unpack_from(content, FRAME.size)
        if tag != TAG or version != VERSION or documents != frames - 1:
            raise DamagedFile("unknown header")
        ids = np.frombuffer(content, "<i8", documents, FRAME.size + HEAD.size)
        nulls = np.frombuffer(content, np.uint8, documents, FRAME.size + HEAD.size + 8 * documents).astype(bool)
        self.doc_ids = pa.array(ids, pa.int64(), mask=nulls)
        self.n_tokens = self.sizes.astype(np.int64) // self.width
        self.decompressor = zstandard.ZstdDecompressor()

    def tokens(self, position: int) -> np.ndarray:
        """Ids of the document at ``position``; only its frame is read and checked."""
        frame = self.content[self.offsets[position + 1]:self.offsets[position + 2]]
        try:
            raw = self.decompressor.decompress(frame)
        except zstandard.ZstdError as broken:
            raise DamagedFile(f"frame {position}: {broken}") from broken
        if len(raw) != self.sizes[position] or _check(raw) != self.checks[position]:
            raise DamagedFile(f"frame {position}: checksum differs")
        return np.frombuffer(raw, f"<u{self.width}").astype("<u4")


def write_token_files(docs: DataFrame, folder: str, path: str, *, end_id: int = 2, text: str = "text",
                      doc_id: str = "doc_id", file_bytes: int = FILE_BYTES) -> None:
    """Write the ids of every text of ``docs``, with ``end_id`` after each, to ``folder`` in ascending ``doc_id`` order.

    Null texts are empty; null ids come first; rows that share an id follow each other as Spark numbers
    them; other columns are not read. Rows are dealt out by ranges of (id, row number), so even rows of
    one id need not meet in one task, then sorted, encoded and packed as they stream by: a task holds one
    Arrow batch and one file. An empty table writes no document.
    """
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = _PIECES.get(path) or _PIECES.setdefault(path, Pieces(path))
        builder = FileBuilder(pieces.width, TaskContext.get().partitionId())
        end = pieces.packed([end_id])

        def finished() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([builder.finish()], pa.binary())], ["file"])

        for batch in batches:
            for part in slices(batch, "text"):
                texts = part.column("text").cast(pa.binary()).to_pylist()
                for key, whole in zip(part.column("doc_id").to_pylist(), texts):
                    builder.add(key, pieces.encode(whole) + end)
                    if builder.size >= file_bytes:
                        yield finished()
        if builder.ids:
            yield finished()

    keys = ["doc_id", "row"]
    rows = docs.select(quoted(doc_id).cast("bigint").alias("doc_id"), quoted(text).alias("text"),
                       F.monotonically_increasing_id().alias("row"))
    packed = rows.repartitionByRange(*keys).sortWithinPartitions(*keys).select("doc_id", "text").mapInArrow(
        pack, "file binary")
    packed.select(F.col("file").cast("string").alias("value")).write.option("lineSep", LINE_END.decode("ascii")).option(
        "maxRecordsPerFile", 1).text(folder)


INDEX = "file string, partition int, number int, position int, doc_id bigint, local_start bigint, n_tokens bigint"


def _files(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.format("binaryFile").load(folder).where("length > 0").select(F.col("path").alias("file"), "content")


def read_index(spark: SparkSession, folder: str, checked: bool = False) -> DataFrame:
    """One row per stored document: its ``file``, the file's ``partition`` and ``number`` in it, ``position`` in the
    file, ``doc_id``, ``local_start`` (ids before it in the file), ``n_tokens``. With ``checked`` every frame is
    decompressed and verified, and ``ids_crc32`` (of the ids as 32-bit integers) is added."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, content in zip(batch.column("file"), batch.column("content")):
                found = TokenFile(content.as_py())
                n = len(found.n_tokens)
                columns = {
                    "file": pa.array([file.as_py()] * n, pa.string()),
                    "partition": pa.array(np.full(n, found.partition, np.int32)),
                    "number": pa.array(np.full(n, found.number, np.int32)),
                    "position": pa.array(np.arange(n, dtype=np.int32)),
                    "doc_id": found.doc_ids,
                    "local_start": pa.array(np.cumsum(found.n_tokens) - found.n_tokens),
                    "n_tokens": pa.array(found.n_tokens)}
                if checked:
                    columns["ids_crc32"] = pa.array([zlib.crc32(found.tokens(i).tobytes()) for i in range(n)], pa.int64())
                yield pa.RecordBatch.from_pydict(columns)

    return _files(spark, folder).mapInArrow(run, INDEX + (", ids_crc32 bigint" if checked else ""))


def with_starts(index: DataFrame) -> DataFrame:
    """``index`` with ``start``: ids of all documents before each one, over all files.

    Sums go up in two steps, by file within its partition and by partition; only the totals of
    partitions, as many as Spark had partitions when writing, meet in one task. ``index`` is read
    more than once and should be stored.
    """
    files = index.groupBy("partition", "number").agg(F.sum("n_tokens").alias("held"))
    parts = files.groupBy("partition").agg(F.sum("held").alias("whole"))
    first = Window.unboundedPreceding
    earlier = parts.select("partition", F.coalesce(
        F.sum("whole").over(Window.orderBy("partition").rowsBetween(first, -1)), F.lit(0)).alias("base"))
    inner = F.coalesce(
        F.sum("held").over(Window.partitionBy("partition").orderBy("number").rowsBetween(first, -1)), F.lit(0))
    bases = files.select("partition", "number", inner.alias("inner")).join(earlier, "partition").select(
        "partition", "number", (F.col("base") + F.col("inner")).alias("base"))
    return index.join(bases, ["partition", "number"]).select(
        *index.columns, (F.col("base") + F.col("local_start")).alias("start"))


def read_documents(spark: SparkSession, folder: str, wanted: DataFrame) -> DataFrame:
    """``doc_id`` and ``ids`` of the stored documents whose id occurs in ``wanted`` (``doc_id``); all rows of an id.

    The index tells which frames are asked for; no other frame is decompressed. Repeated and unknown
    ids of ``wanted`` change nothing; null ids are not found.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content, positions in zip(batch.column("content"), batch.column("positions")):
                found, asked = TokenFile(content.as_py()), positions.as_py()
                yield pa.RecordBatch.from_arrays(
                    [found.doc_ids.take(pa.array(asked)),
                     pa.array([found.tokens(i) for i in asked], pa.list_(pa.int64()))], ["doc_id", "ids"])

    asked = read_index(spark, folder).join(wanted.select(F.col("doc_id").cast("bigint")).distinct(), "doc_id", "left_semi")
    places = asked.groupBy("file").agg(F.collect_list("position").alias("positions"))  # at most a file's documents
    return _files(spark, folder).join(places, "file").select("content", "positions").mapInArrow(
        run, "doc_id bigint, ids array<bigint>")


def token_files(docs: DataFrame, folder: str, path: str) -> DataFrame:
    """``docs`` written to ``folder`` and read back, every frame verified: ``doc_id``, ``start``, ``n_tokens``, ``ids_crc32``."""
    write_token_files(docs, folder, path)
    index = stored(read_index(docs.sparkSession, folder, checked=True), "token_index")
    return with_starts(index).select("doc_id", "start", "n_tokens", "ids_crc32")
