"""BPE encoding and decoding, with a segment tree over the ranks of adjacent pairs.

A word's leaves are the ranks of its adjacent symbol pairs, each with its place, so the root
yields the lowest rank and its leftmost place. A merge changes at most three leaves, each in
logarithmic time, until no pair can be merged. So a word of a million letters is no trap.

Words repeat, so a task keeps the words it has met lately, up to twice `CACHED_WORDS`. The vocabulary file
is read once on the driver (1-2 MB) and broadcast.

Texts are split into words by this module's patterns. Python's tables of signs and the library's
are of different ages, so a text with a sign that Python's don't know is split by the library.

Defined results: null text counts as empty and has no tokens; repeated rows each give a row;
an empty table gives an empty result; a taken result name gets underscores before it.
"""

from __future__ import annotations

import json
import re
import sys
import unicodedata
from array import array
from collections.abc import Callable
from functools import cache, cached_property, lru_cache, partial

import numpy as np
import pyarrow as pa
import regex
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from tokenizers import Tokenizer

from recordwash.llm.common import add_column, add_columns, free_name, keep_for

CACHED_WORDS = 150_000
PLACE_BITS = 32
#: The rank of a pair that no merge has; as a tree's node it is above all ranks.
NO_RANK = 1 << 28
NEVER = NO_RANK << PLACE_BITS

# Contractions, letters, single digits, other signs; white space is dropped.
_CONTRACTION = "'(?:s|t|re|ve|m|ll|d)"
_SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_ASCII_WORD = re.compile(rf"[a-z]+|{_CONTRACTION}|[0-9]|[^{_SPACE}a-z0-9]+")
_LATIN = r"a-z\xaa\xb5\xba\xdf-\xf6\xf8-\xff"
LATIN_DIGIT = r"0-9\xb2\xb3\xb9\xbc-\xbe"
_LATIN_WORD = re.compile(
    rf"[{_LATIN}]+|{_CONTRACTION}|[{LATIN_DIGIT}]|[^{_SPACE}{_LATIN}{LATIN_DIGIT}]+"
)
_WORD = regex.compile(rf"\p{{L}}+|{_CONTRACTION}|\p{{N}}|[^{_SPACE}\p{{L}}\p{{N}}]+")


@cache
def unknown_signs() -> re.Pattern:
    """The code points that Python's tables have as unassigned."""
    ranges, start = [], None
    for point in range(sys.maxunicode + 2):
        unknown = point <= sys.maxunicode and unicodedata.category(chr(point)) == "Cn"
        if unknown and start is None:
            start = point
        elif not unknown and start is not None:
            ranges.append(rf"\U{start:08x}-\U{point - 1:08x}")
            start = None
    return re.compile(f"[{''.join(ranges)}]")


class PairTree:
    """Ranks by place, the least on top: a node holds rank and place, so the root has both."""

    def __init__(self, ranks: list[int]):
        n = len(ranks)
        self.size = size = 1 << (n - 1).bit_length()
        low = [NEVER] * size + [r << PLACE_BITS | i for i, r in enumerate(ranks)]
        low += [NEVER] * (size - n)
        for node in range(size - 1, 0, -1):
            left, right = low[2 * node], low[2 * node + 1]
            low[node] = left if left < right else right
        self.low = low

    def put(self, place: int, rank: int) -> None:
        low, node = self.low, place + self.size
        low[node] = rank << PLACE_BITS | place
        node >>= 1
        while node:
            least, right = low[2 * node], low[2 * node + 1]
            if right < least:
                least = right
            if low[node] == least:
                return
            low[node] = least
            node >>= 1


class Vocabulary:
    """A vocabulary file's ids, tokens and merges."""

    def __init__(self, text: str):
        self.content = text
        content = json.loads(text)
        model = content["model"]
        self.ids: dict[str, int] = model["vocab"]
        self.suffix: str = model.get("end_of_word_suffix") or ""
        self.tokens = {i: t for t, i in self.ids.items()}
        self.ranks: dict[tuple[int, int], int] = {}
        self.merged: list[int] = []
        for rank, pair in enumerate(model["merges"]):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            self.ranks.setdefault((self.ids[left], self.ids[right]), rank)
            self.merged.append(self.ids[left + right])
        self.special = {t["content"]: t["id"] for t in content["added_tokens"]}
        self.tokens |= {i: t for t, i in self.special.items()}
        longest_first = sorted(self.special, key=len, reverse=True)
        self.split_special = re.compile(f"({'|'.join(map(re.escape, longest_first))})")
        letters = byte_letters()
        self.inner = [self.ids[c] for c in letters]
        self.last = [self.ids[c + self.suffix] for c in letters]
        self.words = Remembered(lambda word: array("i", self.word(word)).tobytes(), CACHED_WORDS)

    def merge(self, symbols: list[int]) -> list[int]:
        """The symbols after all merges."""
        n = len(symbols)
        if n < 2:
            return symbols
        rank_of, merged = self.ranks.get, self.merged
        tree = PairTree([rank_of(pair, NO_RANK) for pair in zip(symbols, symbols[1:])])
        low, put = tree.low, tree.put
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        while (root := low[1]) < NEVER:
            left = root & (1 << PLACE_BITS) - 1
            right = after[left]
            symbol = symbols[left] = merged[root >> PLACE_BITS]
            symbols[right] = -1
            follower = after[left] = after[right]
            if follower < n:
                put(right, NO_RANK)
                before[follower] = left
                put(left, rank_of((symbol, symbols[follower]), NO_RANK))
            else:
                put(left, NO_RANK)
            if left:
                previous = before[left]
                put(previous, rank_of((symbols[previous], symbol), NO_RANK))
        return [s for s in symbols if s >= 0]

    def word(self, word: str) -> list[int]:
        *inner, last = word.encode()
        return self.merge([*map(self.inner.__getitem__, inner), self.last[last]])

    def encode(self, text: str) -> bytes:
        """Ids as little-endian 32-bit integers."""
        if "<|" not in text:
            return self._plain(text)
        parts = self.split_special.split(text)
        return b"".join(
            self.special[p].to_bytes(4, "little") if i % 2 else self._plain(p)
            for i, p in enumerate(parts)
        )

    def _plain(self, text: str) -> bytes:
        if text.isascii():
            found = _ASCII_WORD.findall(text.lower())
        else:
            if not is_latin(text) and unknown_signs().search(text):
                return self._split_by_library(text)
            text = unicodedata.normalize("NFC", text)
            # Letter by letter, so without the rule for a final sigma.
            text = text.replace("Σ", "σ").lower()
            found = (_LATIN_WORD if is_latin(text) else _WORD).findall(text)
        return b"".join(map(self.words.__getitem__, found))

    @cached_property
    def library(self) -> Tokenizer:
        return Tokenizer.from_str(self.content)

    def _split_by_library(self, text: str) -> bytes:
        byte_of = {letter: byte for byte, letter in enumerate(byte_letters())}
        text = self.library.normalizer.normalize_str(text)
        found = self.library.pre_tokenizer.pre_tokenize_str(text)
        words = (bytes(map(byte_of.__getitem__, word)).decode() for word, _ in found)
        return b"".join(map(self.words.__getitem__, words))

    def decode(self, ids: list[int]) -> str:
        """Tokens joined by a space: the file names no decoder, so word ends stay visible."""
        return " ".join(map(self.tokens.__getitem__, ids))


class Remembered(dict):
    """Results of a function for the latest texts; when it is full, those of the time before go."""

    def __init__(self, make: Callable[[str], bytes], most: int):
        self.make, self.most = make, most
        self.earlier: dict[str, bytes] = {}

    def __missing__(self, text: str) -> bytes:
        found = self.earlier.get(text)
        if found is None:
            found = self.make(text)
        if len(self) >= self.most:
            self.earlier = dict(self)
            self.clear()
        if len(text) <= 64:
            self[text] = found
        return found


def is_latin(text: str) -> bool:
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


def byte_letters() -> list[str]:
    """A printable letter for each byte: itself, or for the others the next from 256 on."""
    own = {*range(33, 127), *range(161, 173), *range(174, 256)}
    letters, spare = [], 256
    for byte in range(256):
        letters.append(chr(byte) if byte in own else chr(spare))
        spare += byte not in own
    return letters


@lru_cache(maxsize=2)
def vocabulary(text: str) -> Vocabulary:
    keep_for("bpe", vocabulary.cache_clear)
    return Vocabulary(text)


def _shared(df: DataFrame, path: str) -> Broadcast:
    with open(path, encoding="utf-8") as file:
        return df.sparkSession.sparkContext.broadcast(file.read())


def encode(docs: DataFrame, path: str, text_col: str = "text", out: str = "token_ids") -> DataFrame:
    """The rows with the ids of their whole text, an array of int."""
    of = partial(_ids, _shared(docs, path), docs.columns.index(text_col))
    return add_column(docs, free_name(docs, out), T.ArrayType(T.IntegerType()), of)


def _packed_ids(known: Vocabulary, texts: pa.Array) -> list[bytes]:
    return [known.encode(x.as_py() or "") for x in texts]


def _lists(packed: list[bytes]) -> pa.Array:
    ends = np.cumsum([0] + [len(x) // 4 for x in packed])
    values = np.frombuffer(b"".join(packed), "<i4")
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values, pa.int32()))


def _ids(shared: Broadcast, at: int, batch: pa.RecordBatch) -> pa.Array:
    return _lists(_packed_ids(vocabulary(shared.value), batch.column(at)))


def decode(
    rows: DataFrame, path: str, ids_col: str = "token_ids", out: str = "decoded"
) -> DataFrame:
    """The rows with the text of their ids, special tokens included; null gives no text."""
    of = partial(_texts, _shared(rows, path), rows.columns.index(ids_col))
    return add_column(rows, free_name(rows, out), T.StringType(), of)


def _texts(shared: Broadcast, at: int, batch: pa.RecordBatch) -> pa.Array:
    known = vocabulary(shared.value)
    return pa.array((known.decode(x.as_py() or []) for x in batch.column(at)), pa.string())


def round_trip(
    docs: DataFrame, path: str, text_col: str = "text", ids: str = "token_ids",
    decoded: str = "decoded",
) -> DataFrame:
    """The rows with the ids of their whole text and the text decoded from them, in one pass."""
    fields = [
        T.StructField(free_name(docs, ids), T.ArrayType(T.IntegerType())),
        T.StructField(free_name(docs, decoded), T.StringType()),
    ]
    return add_columns(docs, fields, partial(_both, _shared(docs, path), docs.columns.index(text_col)))


def _both(shared: Broadcast, at: int, batch: pa.RecordBatch) -> list[pa.Array]:
    known = vocabulary(shared.value)
    packed = _packed_ids(known, batch.column(at))
    texts = (known.decode(np.frombuffer(x, "<i4").tolist()) for x in packed)
    return [_lists(packed), pa.array(texts, pa.string())]
