"""Substring dedup by recompression: remove words in long windows seen in an earlier document.

Words get 64-bit names. A first round names runs of one word, the next rounds name pairs: each
round deals the symbols into left and right ones by a bit of their name, and a left symbol joins
a right one after it. A name is a digest of the names below, so all tasks agree on it without
a dictionary, and equal substrings get equal symbols inside: what lies outside can change only
a run, or a right symbol, at their front, and a run, or a left symbol, at their end.

For every window the symbols that cannot depend on its outside are found by that rule; the
first of them at the highest level is its anchor (of a window without any, its own digest).
Equal windows have equal anchors, so a window may repeat only if its anchor is shared by two
documents. Anchors are exchanged to find the shared ones, and then only windows with a shared
anchor, each with the smallest document that holds it. Names only choose these candidates: whether
two are the same is verified by BLAKE2b digests of their own words.

Texts are dealt into blocks of about `BLOCK_BYTES` once; the shuffle is used for all three
passes over them. A block sends each name once, however many of its documents hold it, so a
passage in a third of all documents costs a name per block. Answers go back as bits.

Defined results: null text has no words; a null id counts as larger than every id; rows with
the same id don't remove each other's words; texts shorter than a window are kept; an empty
table gives an empty result; other columns don't matter.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from hashlib import blake2b
from itertools import chain, compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest

from recordwash.llm.common import text_of, total_bytes

WINDOW = 13
PAIR_ROUNDS = 4
#: Bytes of text of a block, and of text whose names meet in a bucket.
BLOCK_BYTES, BUCKET_BYTES = 4 << 20, 32 << 20
#: Bytes whose words are named at a time, and words whose windows get their anchors at a time.
CHUNK_BYTES, CACHED_WORDS = 1 << 18, 1 << 15
#: Bytes of a word up to which its name is a sum.
LONGEST_SUMMED = 64
NO_ID = np.iinfo(np.int64).max

#: A window's digest as sent.
KEY = np.dtype([("high", "<u8"), ("low", "<u4")])
_U = np.uint64
_SPACE = np.isin(np.arange(256), [32, *range(9, 14)])

ANSWER = "block long, bucket int, stage int, shared binary, firsts binary"
RESULT = "doc_id long, n_words long, n_removed long, kept_text string"


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> _U(33))) * _U(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> _U(33))) * _U(0xC4CEB9FE1A85EC53)
    return x ^ (x >> _U(33))


def named(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    return mix(left * _U(0x9E3779B97F4A7C15) + mix(right + _U(0x632BE59BD9B4E019)))


@cache
def _numbers() -> np.ndarray:
    """A random number for each byte at each of the first places of a word."""
    return np.random.default_rng(5).integers(0, 1 << 64, (LONGEST_SUMMED, 256), dtype=_U).ravel()


def word_names(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Names of all words of the texts, in order, and each text's number of words.

    A name is the sum of random numbers, one for each byte and its place, taken from prefix sums
    for all words of a chunk at once. (Powers of one factor in their stead would give words of
    some patterns the same name, whatever the factor.) Long words are hashed one by one.
    """
    data = np.frombuffer(b" ".join([*texts, b""]), np.uint8)
    space = _SPACE[data]
    before = np.append(True, space[:-1])
    starts, ends = np.flatnonzero(~space & before), np.flatnonzero(space & ~before)
    if not len(starts):
        return np.zeros(0, _U), np.zeros(len(texts), np.int64)
    sizes = ends - starts
    inside = np.flatnonzero(~space)
    # Where each word's letters begin among all letters.
    letters = np.cumsum(sizes) - sizes
    place = np.minimum(np.arange(len(inside)) - np.repeat(letters, sizes), LONGEST_SUMMED - 1)
    sums = np.append(_U(0), np.cumsum(_numbers()[place << 8 | data[inside]]))
    values = sums[letters + sizes] - sums[letters]
    for i in np.flatnonzero(sizes > LONGEST_SUMMED).tolist():
        values[i] = xxh3_64_intdigest(data[starts[i] : ends[i]].tobytes())
    edges = np.cumsum([0] + [len(t) + 1 for t in texts])
    counts = np.diff(np.searchsorted(starts, edges))
    return mix(values + sizes.astype(_U) * _U(0x9E3779B97F4A7C15)), counts


def _chunks(texts: list[bytes]) -> Iterator[list[bytes]]:
    held, size = [], 0
    for text in texts:
        held.append(text)
        size += len(text)
        if size >= CHUNK_BYTES:
            yield held
            held, size = [], 0
    if held:
        yield held


class Block:
    """The documents of a block: their words' names, and their windows."""

    def __init__(self, ids: list[int | None], texts: list[str]):
        self.given_ids = ids
        self.ids = np.array([NO_ID if i is None else i for i in ids], np.int64)
        self.texts = [text.encode() for text in texts]
        named_chunks = [word_names(chunk) for chunk in _chunks(self.texts)]
        self.names = np.concatenate([names for names, _ in named_chunks])
        self.sizes = np.concatenate([counts for _, counts in named_chunks])
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.doc = np.repeat(np.arange(len(ids)), self.sizes)
        place = np.arange(len(self.names)) - self.starts[self.doc]
        #: First words of the windows.
        self.windows = np.flatnonzero(place + WINDOW <= self.sizes[self.doc])

    def digests(self, windows: np.ndarray, seed: int) -> np.ndarray:
        factors = np.random.default_rng(seed).integers(0, 1 << 63, WINDOW, dtype=_U) * _U(2) + _U(1)
        total = np.zeros(len(windows), _U)
        for i in range(WINDOW):
            total += self.names[windows + i] * factors[i]
        return mix(total)

    def exact_digests(self, windows: np.ndarray) -> np.ndarray:
        """A 96-bit BLAKE2b digest of each window's own words; windows ascend."""
        found, doc_of = [], self.doc[windows]
        edges = np.searchsorted(doc_of, np.arange(len(self.texts) + 1)).tolist()
        starts = self.starts.tolist()
        for doc in np.unique(doc_of).tolist():
            words = self.texts[doc].split()
            for at in (windows[edges[doc] : edges[doc + 1]] - starts[doc]).tolist():
                window = b" ".join(words[at : at + WINDOW])
                found.append(blake2b(window, digest_size=12).digest())
        return np.frombuffer(b"".join(found), KEY)

    def anchors(self) -> np.ndarray:
        """Each window's anchor, a few documents at a time, so that the arrays stay in cache."""
        ends = self.starts + self.sizes
        cuts, last = [0], 0
        for at in range(CACHED_WORDS, len(self.names) + CACHED_WORDS, CACHED_WORDS):
            last = max(last, int(ends[np.searchsorted(ends, min(at, len(self.names)))]))
            cuts.append(last)
        found = [np.zeros(0, _U)]
        for low, high in zip(cuts, cuts[1:]):
            a, b = np.searchsorted(self.windows, [low, high])
            if a < b:
                first = self.windows[a:b]
                part, own = _anchors(self.names[low:high], self.doc[low:high], first - low)
                part[~own] = self.digests(first[~own], 1)
                found.append(part)
        return np.concatenate(found)


def _anchors(
    names: np.ndarray, doc: np.ndarray, first: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Anchors of the windows that begin at `first`, and which of them have one."""
    anchor, covered = np.zeros(len(first), _U), np.zeros(len(first), bool)
    new = np.append(True, (names[1:] != names[:-1]) | (doc[1:] != doc[:-1]))
    number = np.cumsum(new, dtype=np.int32) - np.int32(1)
    lengths = np.diff(np.append(np.flatnonzero(new), len(names)))
    names, doc = named(names[new], lengths.astype(_U)), doc[new]
    # The first and last run of a window may go on outside it.
    low, high = number[first] + np.int32(1), number[first + WINDOW - 1]
    for level in range(PAIR_ROUNDS + 1):
        inside = low < high
        symbols = named(names, np.array([level], _U))
        anchor[inside] = symbols[low[inside]]
        covered |= inside
        if level == PAIR_ROUNDS:
            break
        right = mix(names + _U(level + 1)) >> _U(63) == 1
        joins = ~right[:-1] & right[1:] & (doc[:-1] == doc[1:])
        low = low + right[np.minimum(low, len(names) - 1)]
        high = high - ~right[high - 1]
        head = np.append(joins, False)
        names = np.where(head, named(names, np.append(names[1:], _U(0))), names)
        kept = np.append(True, ~joins)
        number = np.append(np.cumsum(kept, dtype=np.int32) - 1, int(kept.sum())).astype(np.int32)
        names, doc = names[kept], doc[kept]
        low, high = number[np.minimum(low, len(kept))], number[np.maximum(high, 0)]
    return anchor, covered


def _unique_by_doc(keys: np.ndarray, doc_rank: np.ndarray) -> tuple[np.ndarray, ...]:
    """Distinct keys, the lowest and highest document rank of each, and each key's number."""
    distinct, number = np.unique(keys, return_inverse=True)
    low = np.full(len(distinct), np.iinfo(np.int64).max)
    high = np.full(len(distinct), -1)
    np.minimum.at(low, number, doc_rank)
    np.maximum.at(high, number, doc_rank)
    return distinct, low, high, number


def _bucket_edges(keys: np.ndarray, n_buckets: int) -> np.ndarray:
    """Where each bucket's keys begin among sorted keys: buckets are ranges of names."""
    edges = [(b << 64) // n_buckets for b in range(1, n_buckets)]
    inner = np.searchsorted(keys, np.array(edges, _U)) if edges else np.zeros(0, np.int64)
    return np.concatenate([[0], inner, [len(keys)]])


class Anchors:
    """A block's anchors as sent: six bytes each, and whether two of its documents hold it."""

    def __init__(self, block: Block, n_buckets: int):
        anchors, doc = block.anchors() >> _U(16), block.doc[block.windows]
        # Neighbours mostly share their anchor, so only the first of each series is sorted.
        new = np.ones(len(anchors), bool)
        new[1:] = (anchors[1:] != anchors[:-1]) | (doc[1:] != doc[:-1])
        self.series = np.cumsum(new) - 1
        self.key, low, high, self.number = _unique_by_doc(anchors[new], doc[new])
        self.several = low != high
        self.edges = _bucket_edges(self.key << _U(16), n_buckets)

    def sent(self) -> Iterator[tuple[int, bytes, bytes]]:
        for bucket, (a, b) in enumerate(zip(self.edges, self.edges[1:])):
            if a < b:
                keys = self.key[a:b].astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6]
                yield bucket, keys.tobytes(), np.packbits(self.several[a:b]).tobytes()

    def shared(self, answers: dict[int, bytes]) -> np.ndarray:
        """For each window, whether its anchor is shared."""
        found = np.zeros(len(self.key), bool)
        for bucket, bits in answers.items():
            a, b = self.edges[bucket], self.edges[bucket + 1]
            found[a:b] = np.unpackbits(np.frombuffer(bits, np.uint8), count=b - a)
        return found[self.number][self.series]


class Candidates:
    """A block's windows with a shared anchor as sent: 96-bit digests and smallest documents."""

    def __init__(self, block: Block, shared: np.ndarray, n_buckets: int):
        self.windows = block.windows[shared]
        exact = block.exact_digests(self.windows)
        high, low = exact["high"], exact["low"]
        order = np.lexsort((low, high))
        high, low = high[order], low[order]
        new = np.ones(len(order), bool)
        new[1:] = (high[1:] != high[:-1]) | (low[1:] != low[:-1])
        self.number = np.empty(len(order), np.int64)
        self.number[order] = np.cumsum(new) - 1
        self.high, self.low = high[new].astype(_U), low[new]
        self.ids = block.ids[block.doc[self.windows]]
        self.first = np.full(len(self.high), NO_ID)
        np.minimum.at(self.first, self.number, self.ids)
        self.edges = _bucket_edges(self.high, n_buckets)

    def sent(self) -> Iterator[tuple[int, bytes, bytes]]:
        key = np.empty(len(self.high), KEY)
        key["high"], key["low"] = self.high, self.low
        for bucket, (a, b) in enumerate(zip(self.edges, self.edges[1:])):
            if a < b:
                yield bucket, key[a:b].tobytes(), self.first[a:b].astype("<i8").tobytes()

    def repeated(self, answers: dict[int, tuple[bytes, bytes]]) -> np.ndarray:
        """First words of the windows that start in a document with a smaller id too."""
        first = self.first.copy()
        for bucket, (bits, firsts) in answers.items():
            a, b = self.edges[bucket], self.edges[bucket + 1]
            lower = np.unpackbits(np.frombuffer(bits, np.uint8), count=b - a).astype(bool)
            first[a:b][lower] = np.frombuffer(firsts, "<i8")
        return self.windows[first[self.number] < self.ids]


def _sent(block_no: int, rows: Iterator[tuple[int, bytes, bytes]]) -> pa.Table:
    rows = list(rows)
    return pa.table({
        "block": pa.array([block_no] * len(rows), pa.int64()),
        "bucket": pa.array([r[0] for r in rows], pa.int32()),
        "keys": pa.array([r[1] for r in rows], pa.binary()),
        "about": pa.array([r[2] for r in rows], pa.binary()),
    })


SENT = "block long, bucket int, keys binary, about binary"


def _block(docs: pa.Table) -> Block:
    """The block, its documents in one order in every pass: a shuffle may deliver any."""
    rows = zip(docs.column("id").to_pylist(), docs.column("text").to_pylist())
    ordered = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    return Block([r[0] for r in ordered], [r[1] for r in ordered])


def _send_anchors(n_buckets: int, key: tuple, docs: pa.Table) -> pa.Table:
    return _sent(key[0].as_py(), Anchors(_block(docs), n_buckets).sent())


def _answers(stage: int, rows: pa.Table) -> dict[int, tuple[bytes, bytes]]:
    picked = (r for r in rows.to_pylist() if r["stage"] == stage)
    return {r["bucket"]: (r["shared"], r["firsts"]) for r in picked}


def _send_windows(n_buckets: int, key: tuple, docs: pa.Table, answers: pa.Table) -> pa.Table:
    """The candidates, and a note to the block itself: which of its windows they are."""
    block, number = _block(docs), key[0].as_py()
    bits = {k: v[0] for k, v in _answers(1, answers).items()}
    shared = Anchors(block, n_buckets).shared(bits)
    note = (n_buckets + number, np.packbits(shared).tobytes(), b"")
    return _sent(number, chain(Candidates(block, shared, n_buckets).sent(), [note]))


def _answer(
    stage: int, bucket: int, blocks: list[int], masks: list[np.ndarray], firsts: list[bytes]
) -> pa.Table:
    some = [i for i, mask in enumerate(masks) if mask.any()]
    bits = pa.array([np.packbits(masks[i]).tobytes() for i in some], pa.binary())
    kept = pa.array([firsts[i] for i in some], pa.binary())
    return _answer_rows(stage, bucket, pa.array([blocks[i] for i in some], pa.int64()), bits, kept)


def _answer_rows(stage: int, bucket: int, blocks, shared, firsts) -> pa.Table:
    return pa.table({
        "block": blocks,
        "bucket": pa.array([bucket] * len(blocks), pa.int32()),
        "stage": pa.array([stage] * len(blocks), pa.int32()),
        "shared": shared,
        "firsts": firsts,
    })


def _share_anchors(key: tuple, rows: pa.Table) -> pa.Table:
    """Which anchors of a bucket two documents hold, for each block that sent them."""
    sent = [np.frombuffer(x.as_buffer(), np.uint8).reshape(-1, 6) for x in rows.column("keys")]
    sizes = [len(x) for x in sent]
    wide = np.zeros((sum(sizes), 8), np.uint8)
    wide[:, :6] = np.concatenate(sent)
    keys = wide.view("<u8")[:, 0]
    several = np.concatenate([
        np.unpackbits(np.frombuffer(x.as_buffer(), np.uint8), count=n)
        for x, n in zip(rows.column("about"), sizes)
    ]).astype(bool)
    order = np.argsort(keys)
    ordered = keys[order]
    alike = np.append(ordered[1:] == ordered[:-1], False)
    shared = several
    shared[order[alike]] = True
    shared[order[1:][alike[:-1]]] = True
    blocks = rows.column("block").to_pylist()
    masks = np.split(shared, np.cumsum(sizes)[:-1])
    return _answer(1, key[0].as_py(), blocks, masks, [b""] * len(blocks))


def _first_windows(n_buckets: int, key: tuple, rows: pa.Table) -> pa.Table:
    """For each block, its windows of a bucket that begin in a smaller document elsewhere."""
    if key[0].as_py() >= n_buckets:
        return _answer_rows(3, 0, rows.column("block"), rows.column("keys"), rows.column("about"))
    sent = [np.frombuffer(x.as_buffer(), KEY) for x in rows.column("keys")]
    sizes = [len(x) for x in sent]
    keys = np.concatenate(sent)
    ids = np.concatenate([np.frombuffer(x.as_buffer(), "<i8") for x in rows.column("about")])
    order = np.lexsort((ids, keys["low"], keys["high"]))
    high, low = keys["high"][order], keys["low"][order]
    new = np.append(True, (high[1:] != high[:-1]) | (low[1:] != low[:-1]))
    first = np.empty(len(ids), np.int64)
    first[order] = ids[order][new][np.cumsum(new) - 1]
    lower = first < ids
    cuts = np.cumsum(sizes)[:-1]
    masks = np.split(lower, cuts)
    firsts = [f[m].astype("<i8").tobytes() for f, m in zip(np.split(first, cuts), masks)]
    return _answer(2, key[0].as_py(), rows.column("block").to_pylist(), masks, firsts)


def _remove(n_buckets: int, key: tuple, docs: pa.Table, answers: pa.Table) -> pa.Table:
    block = _block(docs)
    noted = np.frombuffer(_answers(3, answers)[0][0], np.uint8)
    shared = np.unpackbits(noted, count=len(block.windows)).astype(bool)
    at = Candidates(block, shared, n_buckets).repeated(_answers(2, answers))
    edge = np.zeros(len(block.names) + 1, np.int64)
    np.add.at(edge, at, 1)
    np.add.at(edge, at + WINDOW, -1)
    kept = np.cumsum(edge[:-1]) == 0
    removed = np.concatenate([[0], np.cumsum(~kept)])
    n_removed = removed[block.starts + block.sizes] - removed[block.starts]
    texts = []
    for text, a, size, n in zip(
        block.texts, block.starts.tolist(), block.sizes.tolist(), n_removed.tolist()
    ):
        words = text.split()  # of bytes: at space and tab to carriage return
        words = compress(words, kept[a : a + size].tolist()) if n else words
        texts.append(b" ".join(words).decode())
    return pa.table({
        "doc_id": pa.array(block.given_ids, pa.int64()),
        "n_words": pa.array(block.sizes, pa.int64()),
        "n_removed": pa.array(n_removed, pa.int64()),
        "kept_text": pa.array(texts, pa.string()),
    })


def remove_repeats(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    block_bytes: int = BLOCK_BYTES, bucket_bytes: int = BUCKET_BYTES,
) -> DataFrame:
    """doc_id, n_words, n_removed and kept_text (words joined by a space) of every row."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"), text_of(text_col).alias("text"))
    size = total_bytes(rows, ["text"])
    n_blocks, n_buckets = max(1, -(-size // block_bytes)), max(1, -(-size // bucket_bytes))
    least = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    block = F.pmod(F.xxhash64("id", "text"), F.lit(n_blocks)).alias("block")
    dealt = rows.select("id", "text", block).repartition(max(least, n_buckets), "block")

    by_block = dealt.groupBy("block")
    anchors = by_block.applyInArrow(lambda key, d: _send_anchors(n_buckets, key, d), SENT)
    shared = anchors.groupBy("bucket").applyInArrow(lambda key, r: _share_anchors(key, r), ANSWER)
    windows = by_block.cogroup(shared.groupBy("block")).applyInArrow(
        lambda key, d, a: _send_windows(n_buckets, key, d, a), SENT
    )
    firsts = windows.groupBy("bucket").applyInArrow(
        lambda key, r: _first_windows(n_buckets, key, r), ANSWER
    )
    return by_block.cogroup(firsts.groupBy("block")).applyInArrow(
        lambda key, d, a: _remove(n_buckets, key, d, a), RESULT
    )
