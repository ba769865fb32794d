"""Token ids as files of length-delimited binary records, with a separate offset index.

A record is framed as: length (8 bytes), masked CRC-32C of the length, payload, masked
CRC-32C of the payload; integers are little-endian. A payload holds the document's id, the
number of tokens, their width and the ids, 2 bytes each where the vocabulary allows it. Files
hold whole documents in ascending order of id; part numbers follow the order. Every block of
records ends with an empty record, which readers skip.

Spark's text writer writes the bytes, with the empty record as line end, so any file system
that Spark can write will do. Nothing is kept by document on the driver.

Defined results: null text counts as empty and has only the end id; a null id sorts last and
is read back as null; rows of one id follow each other by a digest of their text; an empty
table gives no files and an empty index. A damaged file raises an error that names it.
"""

from __future__ import annotations

import re
import struct
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
import regex
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from recordwash.llm.bpe import LATIN_DIGIT, Remembered, byte_letters, is_latin
from recordwash.llm.common import keep_for, text_of, total_bytes
from recordwash.llm.crc32c import crc32c, masked

#: Bytes of text a file is made from.
FILE_TEXT_BYTES = 32 << 20
#: Letters of text that are encoded at a time and written as one block.
BLOCK_BYTES = 2 << 20

CACHED_PIECES = 350_000

HEADER = struct.Struct("<qIBBH")  # id, number of tokens, bytes of a token, id is null, unused
EMPTY_RECORD = b"".join(
    int(x).to_bytes(n, "little")
    for x, n in (
        (0, 8),
        (masked(crc32c(np.zeros(8, np.uint8), np.array([0]), np.array([8])))[0], 4),
        (masked(crc32c(np.zeros(0, np.uint8), np.array([0]), np.array([0])))[0], 4),
    )
)

INDEX_SCHEMA = (
    "file string, part long, doc_id long, offset long, length long, n_tokens long, "
    "start_in_file long, ids_crc32 long"
)

# The file's own splitting pattern, for any text and for ASCII.
# Letters come first, being commonest; what may stand first in the others differs from them.
_CONTRACTION = "'(?:s|t|re|ve|m|ll|d)"
_PIECE = regex.compile(
    rf" ?\p{{L}}+|{_CONTRACTION}| ?\p{{N}}+| ?[^\s\p{{L}}\p{{N}}]+|\s+(?!\S)|\s+"
)


def _piece(space: str, letter: str, digit: str) -> re.Pattern:
    return re.compile(
        rf" ?[{letter}]+|{_CONTRACTION}| ?[{digit}]+| ?[^{space}{letter}{digit}]+"
        rf"|[{space}]+(?![^{space}])|[{space}]+"
    )


_ASCII_PIECE = _piece(r"\t-\r ", "A-Za-z", "0-9")
_LATIN_PIECE = _piece(
    r"\t-\r \x85\xa0", r"A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\xff", LATIN_DIGIT
)


class PieceEncoder:
    """Ids of whole texts from the library's ids of their pieces.

    The library merges within a piece only, so its model encodes each piece once, and the
    packed ids are kept: those of the last `CACHED_PIECES` pieces and of as many before.
    """

    def __init__(self, content: str):
        self.tokenizer = Tokenizer.from_str(content)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        added = self.tokenizer.get_added_tokens_decoder().items()
        self.special_ids = {token.content: i for i, token in added}
        longest_first = map(re.escape, sorted(self.special_ids, key=len, reverse=True))
        self.special = re.compile(f"({'|'.join(longest_first)})") if added else None
        self.letters = dict(enumerate(byte_letters()))
        self.width = 2 if self.tokenizer.get_vocab_size() <= 1 << 16 else 4
        self.known = Remembered(self.piece, CACHED_PIECES)

    def pack(self, ids: list[int]) -> bytes:
        return array("H" if self.width == 2 else "I", ids).tobytes()

    def pieces(self, text: str) -> list[str]:
        if self.special and self.special.search(text):
            parts = self.special.split(text)
            return [
                x for i, p in enumerate(parts) for x in ([p] if i % 2 else self.pieces(p))
            ]
        if text.isascii():
            return _ASCII_PIECE.findall(text)
        return (_LATIN_PIECE if is_latin(text) else _PIECE).findall(text)

    def encode(self, text: str) -> bytes:
        """Packed ids of the text."""
        return b"".join(map(self.known.__getitem__, self.pieces(text)))

    def piece(self, piece: str) -> bytes:
        if (special := self.special_ids.get(piece)) is not None:
            return self.pack([special])
        letters = piece.encode().decode("latin-1").translate(self.letters)
        return self.pack([token.id for token in self.tokenizer.model.tokenize(letters)])


@lru_cache(maxsize=2)
def piece_encoder(content: str) -> PieceEncoder:
    keep_for("token files", piece_encoder.cache_clear)
    return PieceEncoder(content)


def frames(payloads: list[bytes]) -> list[bytes]:
    """Each payload as a record."""
    lengths = np.array([len(p) for p in payloads], "<u8")
    data = np.frombuffer(b"".join(payloads), np.uint8)
    ends = np.cumsum(lengths.astype(np.int64))
    of_payload = masked(crc32c(data, ends - lengths.astype(np.int64), lengths.astype(np.int64)))
    heads = np.arange(len(payloads)) * 8
    of_length = masked(crc32c(lengths.view(np.uint8), heads, np.full(len(payloads), 8)))
    return [
        b"".join((n.tobytes(), a.tobytes(), p, b.tobytes()))
        for n, a, p, b in zip(lengths, of_length.astype("<u4"), payloads, of_payload.astype("<u4"))
    ]


def parse(data: bytes, file: str) -> tuple[list[int], list[int]]:
    """Offsets of the payloads of a file and their lengths; both checksums are verified."""
    starts, lengths, at = [], [], 0
    while at < len(data):
        if at + 16 > len(data):
            raise ValueError(f"{file}: it ends within a record")
        length = int.from_bytes(data[at : at + 8], "little")
        if at + 16 + length > len(data):
            raise ValueError(f"{file}: the record at {at} goes beyond the end")
        starts.append(at + 12)
        lengths.append(length)
        at += 16 + length
    raw = np.frombuffer(data, np.uint8)
    begin, size = np.array(starts, np.int64), np.array(lengths, np.int64)
    eights = np.full(len(begin), 8)
    for where, many, stored in ((begin - 12, eights, begin - 4), (begin, size, begin + size)):
        found = masked(crc32c(raw, where, many))
        kept = raw[stored[:, None] + np.arange(4)].reshape(-1, 4).copy().view("<u4")[:, 0]
        if len(bad := np.flatnonzero(found != kept)):
            raise ValueError(f"{file}: wrong checksum in the record at {starts[bad[0]] - 12}")
    return starts, lengths


def payload_ids(data: bytes, start: int) -> tuple[int | None, np.ndarray]:
    doc_id, n, width, no_id, _ = HEADER.unpack_from(data, start)
    ids = np.frombuffer(data, f"<u{width}", n, start + HEADER.size)
    return (None if no_id else doc_id), ids


def write_tokens(
    docs: DataFrame, path: str, out: str, end_id: int,
    id_col: str = "doc_id", text_col: str = "text", file_text_bytes: int = FILE_TEXT_BYTES,
) -> None:
    """Write the ids of every text, and the end id after each, in ascending order of id."""
    with open(path, encoding="utf-8") as file:
        shared = docs.sparkSession.sparkContext.broadcast(file.read())
    rows = docs.select(F.col(id_col).cast("long").alias("id"), text_of(text_col).alias("text"))
    n_files = max(1, -(-total_bytes(rows, ["text"]) // file_text_bytes))
    order = [F.col("id").asc_nulls_last(), F.xxhash64("text")]
    ordered = rows.repartitionByRange(n_files, *order).sortWithinPartitions(*order)

    records = ordered.mapInArrow(partial(_blocks, shared, end_id), "block binary").select(F.col("block").cast("string"))
    records.write.option("encoding", "ISO-8859-1").text(
        out, lineSep=EMPTY_RECORD.decode("latin-1")
    )


def _blocks(
    shared: Broadcast, end_id: int, batches: Iterator[pa.RecordBatch]
) -> Iterator[pa.RecordBatch]:
    encoder = piece_encoder(shared.value)
    for ids, texts in _slices(batches):
        held = []
        for doc_id, packed in zip(ids, map(encoder.encode, texts)):
            n = len(packed) // encoder.width + 1
            head = HEADER.pack(doc_id or 0, n, encoder.width, doc_id is None, 0)
            held.append(head + packed + encoder.pack([end_id]))
        yield pa.RecordBatch.from_pydict({"block": [b"".join(frames(held))]})


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list[str]]]:
    """Ids and texts, about `BLOCK_BYTES` of text at a time, a whole document at least."""
    ids, texts, size = [], [], 0
    for batch in batches:
        for doc_id, text in zip(batch.column(0), batch.column(1)):
            ids.append(doc_id.as_py())
            texts.append(text.as_py())
            size += len(texts[-1])
            if size >= BLOCK_BYTES:
                yield ids, texts
                ids, texts, size = [], [], 0
    if ids:
        yield ids, texts


def read_index(spark: SparkSession, out: str) -> DataFrame:
    """Every record's place, from the files; each file is read and verified whole."""
    files = _files(spark, out)
    return files.mapInArrow(_index_batches, INDEX_SCHEMA)


_INDEX_NUMBERS = (
    "part", "doc_id", "offset", "length", "n_tokens", "start_in_file", "ids_crc32",
)


def _index_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("file", pa.string()), *((c, pa.int64()) for c in _INDEX_NUMBERS)])
    for batch in batches:
        for path, content in zip(batch.column(0), batch.column(1)):
            rows = list(_entries(path.as_py(), content.as_buffer().to_pybytes()))
            yield pa.RecordBatch.from_pylist(rows, schema)


def _entries(path: str, data: bytes) -> Iterator[dict]:
    file, before = path.rsplit("/", 1)[-1], 0
    part = int(file.split("-")[1])
    for start, length in zip(*parse(data, file)):
        if not length:
            continue
        doc_id, ids = payload_ids(data, start)
        yield {
            "file": file, "part": part, "doc_id": doc_id, "offset": start - 12, "length": length,
            "n_tokens": len(ids), "start_in_file": before,
            "ids_crc32": zlib.crc32(ids.astype("<u4").tobytes()),
        }
        before += len(ids)


def _files(spark: SparkSession, out: str) -> DataFrame:
    """(path, content) of the data files; a file is bounded by its writer."""
    found = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(out)
    return found.select("path", "content")


def with_starts(index: DataFrame) -> DataFrame:
    """The index with `start`: the ids of all documents before. Only totals per file meet."""
    totals = index.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    firsts = totals.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    return index.join(firsts, "part").withColumn("start", F.col("first") + F.col("start_in_file"))


def read_tokens(spark: SparkSession, out: str, index: DataFrame) -> DataFrame:
    """doc_id and ids of the records that `index` names, fetched by offset."""
    wanted = index.groupBy("file").agg(F.collect_list("offset").alias("offsets"))
    files = _files(spark, out).withColumn("file", F.element_at(F.split("path", "/"), -1))
    rows = files.join(wanted, "file").select("content", "offsets")
    return rows.mapInArrow(_records, "doc_id long, token_ids array<int>")


def _records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for content, offsets in zip(batch.column(0), batch.column(1)):
            data = content.as_buffer().to_pybytes()
            found = [payload_ids(data, at + 12) for at in offsets.as_py()]
            ids = pa.array([x[1].astype(np.int32) for x in found], pa.list_(pa.int32()))
            doc_ids = pa.array([x[0] for x in found], pa.int64())
            yield pa.RecordBatch.from_arrays([doc_ids, ids], ["doc_id", "token_ids"])


def read_shuffled(spark: SparkSession, out: str, index: DataFrame, seed: int) -> DataFrame:
    """All records in an order that the seed decides, dealt out evenly over the tasks."""
    rows = read_tokens(spark, out, index)
    return rows.orderBy(F.xxhash64("doc_id", F.lit(seed)), "doc_id")
