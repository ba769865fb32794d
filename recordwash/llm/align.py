"""Alignment of two tokenizers: groups of tokens over the same bytes, and how often ids are linked.

Interval coalescing: the tokens of both sides, as byte intervals, are sorted by start; where a
start reaches the running maximum of the ends, a group breaks. Within a group every pair of
overlapping tokens is a link. All of that is done for a slice of texts at once, in numpy.

A text is cut before a lone space between other signs. No token of either side crosses such a
cut, so what lies between two cuts is encoded once per task and remembered.

How many documents of the corpus hold a pair of ids linked needs an exchange. Tasks gather
texts into blocks of `BLOCK_BYTES`; a block sends each of its pairs once, with the number of its
documents that hold it. Spark sums them, finds the largest sum of each A id, and sends sums back
to the blocks, which meet their documents' pairs there. Pairs of a block repeat, so what is sent
grows slower than the texts; no pair is sent more often than there are blocks.

Defined results: a text that is null or empty, or whose tokens' bytes are not the text's (with a
space before it), has no tokens: numbers are 0 and groups empty. Rows with equal ids count as
documents of their own; a null id is kept; an empty table gives an empty result; columns other
than id and text don't matter.
"""

from __future__ import annotations

import os
import re
from array import array
from collections.abc import Iterator, Mapping
from functools import lru_cache, partial
from itertools import chain
from pathlib import Path

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark import Broadcast, TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema
from tokenizers import Tokenizer

from recordwash.llm.bpe import byte_letters
from recordwash.llm.common import keep_for, quoted, scratch

#: Bytes of text whose pairs are sent together, and that are aligned at a time.
BLOCK_BYTES, SLICE_BYTES = 4 << 20, 1 << 20
#: Remembered pieces of text, and the longest that is remembered.
CACHED_PIECES, LONGEST_PIECE = 180_000, 48
#: Pairs of a block that are sent in one row.
SENT_PAIRS = 1 << 16

#: Up to a lone space between other signs, or the end.
PIECE = re.compile(r" \S++(?= \S)| (?s:.*?)(?:(?<=\S)(?= \S)|\Z)")

NUMBERS = ["n_a", "n_b", "n_groups", "n_links"]


class Sides:
    """Both tokenizers: ids of texts, and the bytes of ids."""

    def __init__(self, a_content: str, b_content: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.a = Tokenizer.from_str(a_content)
        self.a.no_truncation()
        self.a.no_padding()
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_proto=b_content)
        self.a_size, self.b_size = self.a.get_vocab_size(), self.b.get_piece_size()
        if self.a_size * self.b_size > 1 << 40:
            raise ValueError("the vocabularies are too large for one number a pair")
        byte_of = {letter: i for i, letter in enumerate(byte_letters())}
        added = {token.content for token in self.a.get_added_tokens_decoder().values()}
        self.a_bytes = [b""] * self.a_size
        for token, i in self.a.get_vocab().items():
            own = token in added or not all(c in byte_of for c in token)
            self.a_bytes[i] = token.encode() if own else bytes(byte_of[c] for c in token)
        self.b_bytes = [self._piece_bytes(i) for i in range(self.b_size)]
        self.a_len = np.array([len(x) for x in self.a_bytes], np.int64)
        self.b_len = np.array([len(x) for x in self.b_bytes], np.int64)
        #: An id's text with the sign after it: A's within a run and at its end, then B's.
        self.shown = [f"{i}{end}" for i in range(self.a_size) for end in ",|"]
        self.shown += [f"{i}{end}" for i in range(self.b_size) for end in ",;"]
        self.known: dict[str, tuple[bytes, bytes] | None] = {}
        self.earlier: dict[str, tuple[bytes, bytes] | None] = {}

    def _piece_bytes(self, i: int) -> bytes:
        piece = self.b.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode()

    def encode(self, texts: list[str]) -> list[tuple[bytes, bytes] | None]:
        """Packed ids of both sides; None where the bytes differ. Texts begin with a space."""
        of_a = [x.ids for x in self.a.encode_batch_fast(texts, add_special_tokens=False)]
        of_b = self.b.encode([t[1:] for t in texts], num_threads=1)
        raw = [t.encode() for t in texts]
        sides = ((of_a, self.a_bytes, self.a_len), (of_b, self.b_bytes, self.b_len))
        packed = [self._all_same(ids, raw, *known) for ids, *known in sides]
        if None not in packed:
            return list(zip(*packed))
        found = []
        for text, a, b in zip(raw, of_a, of_b):
            same = b"".join(map(self.a_bytes.__getitem__, a)) == text
            same = same and b"".join(map(self.b_bytes.__getitem__, b)) == text
            found.append((array("i", a).tobytes(), array("i", b).tobytes()) if same else None)
        return found

    @staticmethod
    def _all_same(
        ids: list[list[int]], texts: list[bytes], token_bytes: list[bytes], token_len: np.ndarray
    ) -> list[bytes] | None:
        """Each text's packed ids; None unless every text has its tokens' bytes."""
        flat = list(chain.from_iterable(ids))
        if b"".join(map(token_bytes.__getitem__, flat)) != b"".join(texts):
            return None
        numbers = np.array(flat, np.int32)
        edges = np.cumsum([0, *map(len, ids)])
        reach = np.concatenate([[0], np.cumsum(token_len[numbers])])[edges]
        if not np.array_equal(np.diff(reach), list(map(len, texts))):
            return None
        content, cuts = numbers.tobytes(), (4 * edges).tolist()
        return [content[i:j] for i, j in zip(cuts, cuts[1:])]

    def ids(self, texts: list[str]) -> list[tuple[bytes, bytes] | None]:
        """As `encode`, from remembered pieces: the latest, and as many from before them."""
        if len(self.known) > CACHED_PIECES:
            self.earlier, self.known = self.known, {}
        pieces = [PIECE.findall(t) for t in texts]
        missing = {p for of_text in pieces for p in of_text if p not in self.known}
        again = {p: self.earlier[p] for p in missing if p in self.earlier}
        new = [p for p in missing if p not in again]
        self.known |= again | dict(zip(new, self.encode(new) if new else []))
        found = []
        for text, of_text in zip(texts, pieces):
            ids = list(map(self.known.__getitem__, of_text))
            if None in ids:  # the whole may be encoded otherwise
                found += self.encode([text])
            else:
                found.append((b"".join([x[0] for x in ids]), b"".join([x[1] for x in ids])))
        for long in [p for p in new if len(p) > LONGEST_PIECE]:
            del self.known[long]
        return found


@lru_cache(maxsize=1)
def _sides(a_content: str, b_content: bytes) -> Sides:
    keep_for("alignment", _sides.cache_clear)
    return Sides(a_content, b_content)


def groups_of(
    start_a: np.ndarray, end_a: np.ndarray, start_b: np.ndarray, end_b: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """The group's number of each token of A and of B."""
    start, end = np.concatenate([start_a, start_b]), np.concatenate([end_a, end_b])
    order = np.lexsort((end, start))
    reach = np.maximum.accumulate(end[order])
    new = np.append(True, start[order][1:] >= reach[:-1])
    group = np.empty(len(start), np.int64)
    group[order] = np.cumsum(new) - 1
    return group[: len(start_a)], group[len(start_a) :]


class Slice:
    """The alignment of some texts that have tokens."""

    def __init__(self, sides: Sides, ids: list[tuple[bytes, bytes]]):
        self.sides = sides
        self.a = np.frombuffer(b"".join([x[0] for x in ids]), np.int32)
        self.b = np.frombuffer(b"".join([x[1] for x in ids]), np.int32)
        self.n_a = np.array([len(x[0]) // 4 for x in ids], np.int64)
        self.n_b = np.array([len(x[1]) // 4 for x in ids], np.int64)
        self.a_edges = np.concatenate([[0], np.cumsum(self.n_a)])
        self.b_edges = np.concatenate([[0], np.cumsum(self.n_b)])
        # Both sides have a text's bytes, so places go on from text to text.
        end_a, end_b = np.cumsum(sides.a_len[self.a]), np.cumsum(sides.b_len[self.b])
        start_a, start_b = end_a - sides.a_len[self.a], end_b - sides.b_len[self.b]
        self.group_a, self.group_b = groups_of(start_a, end_a, start_b, end_b)
        last_group = self.group_a[self.a_edges[1:] - 1]
        self.n_groups = np.diff(np.append(-1, last_group))
        first = np.searchsorted(end_b, start_a, "right")
        self.links = np.searchsorted(start_b, end_a, "left") - first
        linked = np.concatenate([[0], np.cumsum(self.links)])
        self.n_links = np.diff(linked[self.a_edges])
        self.link_b = np.arange(linked[-1]) - np.repeat(linked[:-1] - first, self.links)

    def shown(self) -> list[str]:
        """Each text's groups: ids of A, a bar, ids of B; a semicolon between groups."""
        n = self.group_a[-1] + 1
        numbers = np.arange(n)
        order = np.empty(len(self.a) + len(self.b), np.int64)
        b_before = np.searchsorted(self.group_b, numbers)
        a_through = np.searchsorted(self.group_a, numbers, "right")
        last_a = np.append(self.group_a[1:] != self.group_a[:-1], True)
        last_b = np.append(self.group_b[1:] != self.group_b[:-1], True)
        order[np.arange(len(self.a)) + b_before[self.group_a]] = self.a * 2 + last_a
        at_b = np.arange(len(self.b)) + a_through[self.group_b]
        order[at_b] = 2 * self.sides.a_size + self.b.astype(np.int64) * 2 + last_b
        words = list(map(self.sides.shown.__getitem__, order.tolist()))
        edges = (self.a_edges + self.b_edges).tolist()
        return ["".join(words[i:j])[:-1] for i, j in zip(edges, edges[1:])]

    def pairs(self) -> list[tuple[np.ndarray, np.ndarray]]:
        """Each text's distinct linked id pairs as numbers, ascending, and how often each occurs."""
        text = np.repeat(np.arange(len(self.n_a)), self.n_links)
        code = np.repeat(self.a.astype(np.int64), self.links) * self.sides.b_size
        code += self.b[self.link_b]
        code, times = np.unique(text << 40 | code, return_counts=True)
        edges = np.searchsorted(code, np.arange(len(self.n_a) + 1) << 40).tolist()
        code &= (1 << 40) - 1
        return [(code[i:j], times[i:j]) for i, j in zip(edges, edges[1:])]


def _slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    sizes = np.cumsum(batch.column("bytes").to_numpy(zero_copy_only=False))
    first = 0
    while first < batch.num_rows:
        before = sizes[first - 1] if first else 0
        last = max(first + 1, int(np.searchsorted(sizes, before + SLICE_BYTES, "right")))
        yield batch.slice(first, last - first)
        first = last


def _block_rows(block: int, held: list[np.ndarray], fields: pa.Schema) -> Iterator[pa.RecordBatch]:
    """The pairs of a block's texts with the number of its texts that hold each."""
    if not held:
        return
    codes, counts = np.unique(np.concatenate(held), return_counts=True)
    for i in range(0, len(codes), SENT_PAIRS):
        row = {
            "block": block,
            "block_codes": codes[i : i + SENT_PAIRS].astype("<i8").tobytes(),
            "block_counts": counts[i : i + SENT_PAIRS].astype("<i4").tobytes(),
        }
        yield pa.RecordBatch.from_pylist([row], fields)


def _aligned(
    contents: Broadcast, fields: pa.Schema, batches: Iterator[pa.RecordBatch]
) -> Iterator[pa.RecordBatch]:
    sides, number = _sides(*contents.value), TaskContext.get().partitionId() << 33
    held, size = [], 0
    for batch in batches:
        for rows in _slices(batch):
            texts = rows.column("text").to_pylist()
            some = [i for i, t in enumerate(texts) if t]
            ids = dict(zip(some, sides.ids([" " + texts[i] for i in some])))
            with_ids = [i for i in some if ids[i] is not None]
            n = rows.num_rows
            numbers = {name: np.zeros(n, np.int64) for name in NUMBERS}
            shown, codes, times = [""] * n, [b""] * n, [b""] * n
            if with_ids:
                found = Slice(sides, [ids[i] for i in with_ids])
                for name in NUMBERS:
                    numbers[name][with_ids] = getattr(found, name)
                for i, text, (code, count) in zip(with_ids, found.shown(), found.pairs()):
                    held.append(code)
                    shown[i], codes[i] = text, packed(code)
                    times[i] = count.astype("<u4").tobytes()
            yield pa.RecordBatch.from_arrays(
                [
                    rows.column("id"), *[pa.array(numbers[name]) for name in NUMBERS],
                    pa.array(shown, pa.string()), pa.array([number] * n, pa.int64()),
                    pa.array(codes, pa.binary()), pa.array(times, pa.binary()),
                    pa.nulls(n, pa.binary()), pa.nulls(n, pa.binary()),
                ],
                schema=fields,
            )
            size += int(rows.column("bytes").to_numpy(zero_copy_only=False).sum())
            if size >= BLOCK_BYTES:
                yield from _block_rows(number, held, fields)
                held, size, number = [], 0, number + 1
    yield from _block_rows(number, held, fields)


def packed(codes: np.ndarray) -> bytes:
    """Ascending numbers below 2^40 as five bytes each."""
    return codes.astype("<i8").view(np.uint8).reshape(-1, 8)[:, :5].tobytes()


def unpacked(content: bytes) -> np.ndarray:
    wide = np.zeros((len(content) // 5, 8), np.uint8)
    wide[:, :5] = np.frombuffer(content, np.uint8).reshape(-1, 5)
    return wide.view("<i8")[:, 0]


def _unpack_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            codes = np.frombuffer(row["block_codes"], "<i8")
            counts = np.frombuffer(row["block_counts"], "<i4").astype(np.int64)
            blocks = np.full(len(codes), row["block"])
            yield pa.RecordBatch.from_arrays(
                [pa.array(blocks), pa.array(codes), pa.array(counts)], ["block", "code", "n"]
            )


def _scored(fields: pa.Schema, docs: pa.Table, answers: pa.Table) -> pa.Table:
    """The documents of a block with the sums of their links' counts."""
    codes = answers.column("code").to_numpy()
    order = np.argsort(codes)
    codes = codes[order]
    count = answers.column("count").to_numpy()[order]
    best = answers.column("best").to_numpy()[order]
    n_best, count_sum = [], []
    for own, times in zip(docs.column("codes"), docs.column("times")):
        at = np.searchsorted(codes, unpacked(own.as_py()))
        times = np.frombuffer(times.as_py(), "<u4").astype(np.int64)
        n_best.append(int(times[best[at]].sum()))
        count_sum.append(int((times * count[at]).sum()))
    kept = docs.drop_columns(["block", "codes", "times"])
    kept = kept.append_column("n_best", pa.array(n_best, pa.int64()))
    kept = kept.append_column("count_sum", pa.array(count_sum, pa.int64()))
    return kept.select(fields.names).cast(fields)


def align(
    docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text",
    derive: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Per row its id, n_a, n_b, n_groups, n_links, n_best, count_sum and groups.

    `n_best` counts the links whose count is the highest of their A id, `count_sum` adds up the
    counts over the links. `groups` is `a1,a2|b1;a3|b2,b3`, decimal ids in order. It is longer
    than the text: `derive` names columns made from it and the numbers, to have in its stead.
    """
    spark, staging = docs.sparkSession, scratch(docs.sparkSession)
    contents = Path(a_path).read_text(), Path(b_path).read_bytes()
    vocabulary = Tokenizer.from_str(contents[0]).get_vocab_size()
    pieces = sentencepiece.SentencePieceProcessor(model_proto=contents[1]).get_piece_size()

    rows = docs.select(
        F.col(quoted(id_col)).alias("id"),
        F.col(quoted(text_col)).alias("text"),
        F.coalesce(F.octet_length(quoted(text_col)), F.lit(0)).cast("long").alias("bytes"),
    )
    kind = rows.schema["id"].dataType
    schema = T.StructType([T.StructField("id", kind)])
    for name in NUMBERS:
        schema.add(name, "long")
    schema.add("groups", "string").add("block", "long")
    for name in ("codes", "times", "block_codes", "block_counts"):
        schema.add(name, "binary")
    fields = to_arrow_schema(schema)
    found = rows.mapInArrow(
        partial(_aligned, spark.sparkContext.broadcast(contents), fields), schema
    )
    derived = derive or {"groups": F.col("groups")}
    coded = staging.store(
        found.select(
            "id", *NUMBERS, *[value.alias(name) for name, value in derived.items()],
            "block", "codes", "times", "block_codes", "block_counts",
        ),
        "coded",
    )

    sent = (
        coded.where(F.col("block_codes").isNotNull())
        .select("block", "block_codes", "block_counts")
        .mapInArrow(_unpack_blocks, "block long, code long, n long")
    )
    counts = sent.groupBy("code").agg(F.sum("n").alias("count"))
    counts = counts.withColumn("a", F.floor(F.col("code") / pieces))
    counts = staging.store(counts, "counts")
    most = counts.groupBy("a").agg(F.max("count").alias("most"))
    # One row an A id, so its size is bounded by the vocabulary.
    most = F.broadcast(most) if vocabulary <= 1 << 20 else most
    best = (F.col("count") == F.col("most")).alias("best")
    answers = sent.join(counts.join(most, "a").select("code", "count", best), "code")

    own = coded.where(F.col("codes").isNotNull()).drop("block_codes", "block_counts")
    result = T.StructType([f for f in own.schema if f.name not in ("block", "codes", "times")])
    result.add("n_best", "long").add("count_sum", "long")
    score = partial(_scored, to_arrow_schema(result))
    scored = own.groupBy("block").cogroup(
        answers.select("block", "code", "count", "best").groupBy("block")
    ).applyInArrow(lambda d, a: score(d, a), result)
    return scored.withColumnRenamed("id", id_col)
