"""Token ids of all documents in binary files of Simple-8b words, written and read by tasks.

A file holds consecutive documents: a header, the blocks of ids one after the other (ids of one document go on in
the next block), then the tables of blocks and of documents and a trailer. The tables give each block's place, so a
reader fetches and decodes just the blocks of the documents it was asked for.

    header    magic, block size
    blocks    words, then escaped values, all unsigned 64-bit
    tables    of blocks: numbers of words, escapes and values (unsigned 32-bit);
              of documents: doc_id (signed 64-bit), whether there is one (one byte), number of ids (unsigned 64-bit)
    trailer   numbers of blocks, documents and ids, place and CRC-32 of the tables, magic

Everything is little-endian. Which files count is said by the manifest, a Parquet table that Spark commits: files that
a lost or repeated attempt of a task left are not in it.
"""

from __future__ import annotations

import json
import os
import re
import struct
import sys
import uuid
import zlib
from array import array
from collections.abc import Iterator
from types import ModuleType

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow.fs import FileSystem
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from monthtide.llm.common import prepare_checkpoints, slices, tidy
from monthtide.llm.simple8b import BLOCK, Packed, pack, unpack

# Fixed values of the format.
MAGIC = b"S8BTOK01"
_HEADER = "<8sQ"
_TRAILER = "<QQQQI8s"
_HEADER_SIZE, _TRAILER_SIZE = struct.calcsize(_HEADER), struct.calcsize(_TRAILER)

#: Blocks that a reader decodes at a time: about a million ids.
_BLOCKS_AT_ONCE = 256
#: Such runs of blocks that a task reads, about, where there are more than tasks that run at a time.
_RUNS_A_TASK = 32
#: Pieces whose ids a worker remembers; beyond this it starts again.
_KNOWN = 1_000_000
#: Pieces that the library gets at a time.
_TOGETHER = 20_000
#: Bytes of text that are encoded together.
_SLICE = 8 << 20

# What a byte is for the cuts below: a blank or line end, such without the blank, the start of a character that is no
# white space for certain, an ASCII letter, ASCII punctuation without the apostrophe.
_WHITE, _LINE, _BLACK, _LETTER, _MARK = 1, 2, 4, 8, 16
_KINDS = np.zeros(256, np.uint8)
_KINDS[list(b" \t\r\n")] |= _WHITE
_KINDS[list(b"\t\r\n")] |= _LINE
_KINDS[0x21:0x7F] |= _BLACK
_KINDS[0xC3:0xE0] |= _BLACK  # two bytes: U+00C0 to U+07FF
_KINDS[list(range(0x41, 0x5B)) + list(range(0x61, 0x7B))] |= _LETTER
_KINDS[[c for c in range(0x21, 0x7F) if not chr(c).isalnum() and chr(c) != "'"]] |= _MARK

_MANIFEST = "shard int, path string, n_docs long, n_ids long, n_blocks long, n_bytes long"
_READ = "doc_id long, start long, n_tokens long, ids binary"


def cuts(data: np.ndarray, starts: np.ndarray, whole: np.ndarray) -> np.ndarray:
    """Places in the bytes of several texts where no piece of a byte-level tokenizer goes on, text starts among them.

    Such are the last white space before a visible character, what follows it if it is no blank, and the mark after a
    Latin letter. Not all such places are found. whole tells the texts that are not to be cut.
    """
    kinds = _KINDS[data]
    following = kinds.copy()
    following[starts[starts < len(data)]] = 0  # a text's last byte has nothing after it
    here, after = kinds[:-1], following[1:]
    cut = np.zeros(len(data), bool)
    black = (after & _BLACK) > 0
    cut[:-1] = ((here & _WHITE) > 0) & black
    cut[1:] |= ((here & _LINE) > 0) & black
    letter = (here & _LETTER) > 0
    letter[1:] |= (data[:-2] == 0xC3) & (data[1:-1] != 0x97) & (data[1:-1] != 0xB7)  # U+00C0 to U+00FF but for two signs
    cut[1:] |= letter & ((after & _MARK) > 0)
    ends = np.append(starts[1:], len(data))
    for k in np.flatnonzero(whole):
        cut[starts[k] : ends[k]] = False
    cut[starts[starts < ends]] = True
    return np.flatnonzero(cut)


class Encoder:
    """Ids of texts by the tokenizers library, without special tokens added; each distinct piece is encoded once.

    Texts are cut into pieces that no token spans, if the tokenizer is byte-level without a normaliser; otherwise, and
    for texts that name a special token, the library gets the whole text.
    """

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # tasks run side by side
        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        with open(path, encoding="utf-8") as file:
            told = json.load(file)
        self.special = [t["content"] for t in told["added_tokens"]]
        splits = told["pre_tokenizer"] or {}
        self.by_piece = (splits.get("type"), splits.get("add_prefix_space"), splits.get("use_regex"), told["normalizer"]) == ("ByteLevel", False, True, None)
        self._forget()

    def _forget(self) -> None:
        self.number: dict[bytes, int] = {}
        self.flat, self.bounds = array("I"), array("q", [0])

    def _learn(self, pieces: list[bytes]) -> None:
        for piece in pieces:
            self.number[piece] = len(self.number)
        for start in range(0, len(pieces), _TOGETHER):
            some = [p.decode() for p in pieces[start : start + _TOGETHER]]
            for found in self.library.encode_batch_fast(some, add_special_tokens=False):
                self.flat.extend(found.ids)
                self.bounds.append(len(self.flat))

    def _pieces(self, texts: pa.Array) -> tuple[np.ndarray, pa.DictionaryArray]:
        """(number of pieces of each text, all pieces)."""
        texts = texts.cast(pa.large_binary())
        bounds = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
        data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[bounds[0] : bounds[-1]]
        starts = bounds[:-1] - bounds[0]
        whole = np.full(len(texts), not self.by_piece)
        for special in self.special:
            whole |= np.asarray(pc.match_substring(texts.cast(pa.large_string()), special))
        places = cuts(data, starts, whole) if len(data) else np.zeros(0, np.int64)
        offsets = pa.py_buffer(np.append(places, len(data)).astype(np.int64).tobytes())
        pieces = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(places), [None, offsets, pa.py_buffer(data)])
        return np.diff(np.searchsorted(places, np.append(starts, len(data)))), pieces.dictionary_encode()

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, numbers of ids of each); no text is null."""
        per_text, pieces = self._pieces(texts)
        distinct = pieces.dictionary.to_pylist()
        new = [p for p in distinct if p not in self.number]
        if len(self.number) + len(new) > _KNOWN:
            self._forget()
            new = distinct
        self._learn(new)
        which = np.fromiter(map(self.number.__getitem__, distinct), np.int64, len(distinct))
        bounds = np.frombuffer(self.bounds, np.int64).copy()
        at = np.asarray(pieces.indices)
        firsts, lengths = bounds[which][at], np.diff(bounds)[which][at]
        ends = np.cumsum(lengths)
        places = np.arange(ends[-1] if len(ends) else 0) + np.repeat(firsts - (ends - lengths), lengths)
        ids = np.frombuffer(self.flat, np.uint32).copy()[places] if len(places) else np.zeros(0, np.uint32)
        return ids, np.diff(np.append(0, ends)[np.cumsum([0, *per_text])])


def _encoder(path: str) -> Encoder:
    """The worker's encoder, which serves its later tasks, too. Code comes anew with each task; modules stay."""
    kept = vars(sys.modules.setdefault("_token_files_kept", ModuleType("_token_files_kept")))
    if kept.get("path") != path:
        kept.update(path=path, encoder=Encoder(path))
    return kept["encoder"]


class _Writer:
    """One file; ids are kept until they fill blocks."""

    def __init__(self, folder: str, name: str) -> None:
        self.files, base = FileSystem.from_uri(folder)
        self.path, self.uri = f"{base}/{name}", f"{folder}/{name}"
        self.out = self.files.open_output_stream(self.path)
        self.out.write(struct.pack(_HEADER, MAGIC, BLOCK))
        self.blocks: list[np.ndarray] = []
        self.docs: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.waiting = np.zeros(0, np.uint32)
        self.n_ids = 0

    def add(self, doc_ids: pa.Array, ids: np.ndarray, counts: np.ndarray) -> None:
        known = np.asarray(doc_ids.is_valid())
        self.docs.append((np.asarray(doc_ids.fill_null(0), dtype="<i8"), known, counts.astype("<u8")))
        self.n_ids += len(ids)
        ids = np.concatenate([self.waiting, ids])
        full = len(ids) // BLOCK * BLOCK
        self.waiting = ids[full:]
        self._pack(ids[:full])

    def _pack(self, ids: np.ndarray) -> None:
        packed = pack(ids)
        self.blocks.append(np.stack([packed.n_words, packed.n_escapes, packed.n_values], axis=1).astype("<u4"))
        if not len(packed.escapes):
            self.out.write(packed.words.astype("<u8").tobytes())
            return
        words, escapes = np.cumsum(packed.n_words)[:-1], np.cumsum(packed.n_escapes)[:-1]
        for pair in zip(np.split(packed.words, words), np.split(packed.escapes, escapes)):
            self.out.write(np.concatenate(pair).astype("<u8").tobytes())

    def close(self) -> tuple[str, int, int, int, int]:
        """Path and numbers of documents, ids, blocks and bytes."""
        self._pack(self.waiting)
        blocks = np.concatenate(self.blocks)
        n_docs = sum(len(some) for some, _, _ in self.docs)
        columns = [np.concatenate(column) for column in zip(*self.docs)]
        tables = blocks.tobytes() + columns[0].tobytes() + columns[1].astype("u1").tobytes() + columns[2].tobytes()
        place = self.out.tell()
        self.out.write(tables)
        self.out.write(struct.pack(_TRAILER, len(blocks), n_docs, self.n_ids, place, zlib.crc32(tables), MAGIC))
        size = self.out.tell()
        self.out.close()
        return self.uri, n_docs, self.n_ids, len(blocks), size


class Reader:
    """One file: its tables at once, ids where asked for."""

    def __init__(self, uri: str) -> None:
        files, path = FileSystem.from_uri(uri)
        self.file = files.open_input_file(path)
        size = self.file.size()
        if size < _HEADER_SIZE + _TRAILER_SIZE:
            raise ValueError(f"{uri}: too short for a file of token ids")
        n_blocks, n_docs, self.n_ids, place, checksum, magic = struct.unpack(_TRAILER, self._bytes(size - _TRAILER_SIZE, _TRAILER_SIZE))
        head, self.block = struct.unpack(_HEADER, self._bytes(0, _HEADER_SIZE))
        whole = head == magic == MAGIC and place + 12 * n_blocks + 17 * n_docs == size - _TRAILER_SIZE
        tables = self._bytes(place, size - _TRAILER_SIZE - place) if whole else b""
        if not whole or zlib.crc32(tables) != checksum:
            raise ValueError(f"{uri}: not a whole file of token ids")
        self.blocks = np.frombuffer(tables, "<u4", 3 * n_blocks).reshape(-1, 3).astype(np.int64)
        self.places = _HEADER_SIZE + 8 * np.append(0, np.cumsum(self.blocks[:, 0] + self.blocks[:, 1]))
        at = 12 * n_blocks
        self.doc_ids = np.frombuffer(tables, "<i8", n_docs, at)
        self.known = np.frombuffer(tables, "u1", n_docs, at + 8 * n_docs).astype(bool)
        self.counts = np.frombuffer(tables, "<u8", n_docs, at + 9 * n_docs).astype(np.int64)
        self.ends = np.cumsum(self.counts)

    def _bytes(self, place: int, size: int) -> bytes:
        self.file.seek(place)
        return self.file.read(size)

    def ids(self, start: int, end: int) -> np.ndarray:
        """The ids from start on, before end, of all ids of the file."""
        if start >= end:
            return np.zeros(0, np.uint64)
        first, last = start // self.block, -(-end // self.block)
        body = np.frombuffer(self._bytes(self.places[first], self.places[last] - self.places[first]), "<u8")
        n_words, n_escapes, n_values = self.blocks[first:last].T
        # Of each block its words come first, then its escaped values.
        spans = np.stack([n_words, n_escapes], axis=1).ravel()
        is_word = np.repeat(np.arange(len(spans)) % 2 == 0, spans)
        found = unpack(Packed(body[is_word], body[~is_word], n_words, n_escapes, n_values))
        return found[start - first * self.block : end - first * self.block]

    def close(self) -> None:
        self.file.close()


def _ordered(docs: DataFrame) -> DataFrame:
    """(doc_id, text) dealt out by ranges of doc_id and sorted; ties by text, equal rows by their place, so that they are dealt out, too."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.withColumns({"hash": F.xxhash64("text"), "place": F.monotonically_increasing_id()})
    order = [F.col("doc_id").asc_nulls_last(), F.col("hash").asc(), F.col("place").asc()]
    return rows.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text")


def write_token_files(docs: DataFrame, path: str, folder: str | None = None, end_id: int | None = 2) -> str:
    """Encode all texts of docs, write the ids in ascending order of doc_id, and return the folder of files and manifest.

    path is a tokenizer's JSON file, end_id is appended to each document (None: nothing). Each task writes one file of
    consecutive documents; files follow each other in the order of their numbers. folder must be one that all machines
    share (default: below spark.checkpoint.dir).
    A null text is empty, a null doc_id comes last, rows of one doc_id are ordered by their text, repeated rows are
    written as often as they are there. No rows give a manifest without files.
    """
    spark = docs.sparkSession
    folder = folder or f"{prepare_checkpoints(spark)}/token-ids-{uuid.uuid4().hex}"
    uri = folder if "://" in folder or folder.startswith("file:") else f"file://{folder}"
    uri = re.sub("^file:/+", "file:///", uri)
    files, base = FileSystem.from_uri(uri)
    files.create_dir(f"{base}/files", recursive=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, writer = _encoder(path), None
        shard = TaskContext.get().partitionId()
        for batch in batches:
            for some in slices(batch, _SLICE):
                if not some.num_rows:
                    continue
                if writer is None:
                    writer = _Writer(f"{uri}/files", f"{shard:06d}-{uuid.uuid4().hex}.s8b")
                ids, counts = encoder(some.column("text"))
                if end_id is not None:
                    ids = np.insert(ids, np.cumsum(counts), end_id)
                    counts = counts + 1
                writer.add(some.column("doc_id"), ids, counts)
        if writer:
            yield pa.RecordBatch.from_pylist([dict(zip(("shard", "path", "n_docs", "n_ids", "n_blocks", "n_bytes"), (shard, *writer.close())))], _manifest_schema())

    _ordered(docs).mapInArrow(tidy(run), _MANIFEST).write.parquet(f"{folder}/manifest")
    return folder


def _manifest_schema() -> pa.Schema:
    return pa.schema([("shard", pa.int32()), ("path", pa.string()), *((c, pa.int64()) for c in ("n_docs", "n_ids", "n_blocks", "n_bytes"))])


def read_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids) of each document in the files of a folder, from the files alone.

    start counts the ids of all documents before it, ids are unsigned 32-bit numbers, little-endian. Tasks get runs of
    blocks, not files, and give the documents that start in them; a file that isn't whole is an error.
    """
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # one row per file
    listed = spark.read.schema(_MANIFEST).parquet(f"{folder}/manifest")
    runs = F.sequence(F.lit(0), F.greatest(F.col("n_blocks") - 1, F.lit(0)), F.lit(_BLOCKS_AT_ONCE))
    placed = listed.withColumn("base", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))
    parts = placed.select("path", "base", F.explode(runs).alias("first"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, opened = None, None
        for batch in batches:
            for row in batch.to_pylist():
                if opened != row["path"]:
                    if reader:
                        reader.close()
                    reader, opened = Reader(row["path"]), row["path"]
                yield from _documents(reader, row["base"], row["first"])
        if reader:
            reader.close()

    # A number of partitions, since rows as short as these would be put into one.
    tasks = -(-parts.count() // _RUNS_A_TASK)
    return parts.repartition(max(tasks, spark.sparkContext.defaultParallelism), "path", "first").mapInArrow(tidy(run), _READ)


def _documents(reader: Reader, base: int, first: int) -> Iterator[pa.RecordBatch]:
    """The documents that start in a run of blocks, a run's ids at a time; an empty one at the very end counts for the last run."""
    starts = reader.ends - reader.counts
    last = first + _BLOCKS_AT_ONCE >= len(reader.blocks)
    low = np.searchsorted(starts, first * reader.block, side="left")
    high = len(starts) if last else np.searchsorted(starts, (first + _BLOCKS_AT_ONCE) * reader.block, side="left")
    if low == high:
        return
    ids = reader.ids(starts[low], reader.ends[high - 1]).astype("<u4")
    bounds = np.append(starts[low:high], reader.ends[high - 1]) - starts[low]
    body = pa.LargeBinaryArray.from_buffers(pa.large_binary(), int(high - low), [None, pa.py_buffer((4 * bounds).astype(np.int64).tobytes()), pa.py_buffer(ids.tobytes())])
    columns = [
        pa.array(reader.doc_ids[low:high], pa.int64(), mask=~reader.known[low:high]),
        pa.array(starts[low:high] + base, pa.int64()),
        pa.array(reader.counts[low:high], pa.int64()),
        body.cast(pa.binary()),
    ]
    yield pa.RecordBatch.from_arrays(columns, ["doc_id", "start", "n_tokens", "ids"])
