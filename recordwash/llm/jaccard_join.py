"""N-gram Jaccard join with Bayesian candidate pruning.

Texts of equal words form a class, and one of each class goes on. Texts that agree in a band of
MinHash values are candidates. Their values are compared `STEP` at a time, and a pair is dropped
as soon as the probability that its similarity reaches the threshold, given the matches so far
and a uniform prior, is below `TOLERANCE`. The rest are verified exactly on their shingles.

1. Tasks sketch every text: `BANDS` bands of `ROWS` values. Bands with the same members are
   looked at once.
2. Within a band's bucket only the connections that survive pruning are kept, as links to a
   root; their components are clusters, each a superset of groups of similar texts.
3. A cluster's texts meet once, in blocks of `BLOCK` texts if it is larger, two blocks at a
   time. There each pair is pruned again and verified; its links are counted, not written.
   What a task hands on is at most one row a text.

A pair of similarity 0.8 shares no band with probability 5e-8, and less when more similar.

Defined results: words are separated by white space; a text of one to four words is one shingle;
a text without words is similar to nothing and a class of its own; null counts as empty; a null
id belongs to a class but never names it unless all its ids are null; repeated rows count as
copies; an empty table gives an empty result; other columns pass through `drop_near_copies`.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recordwash.llm.common import (
    BLANK,
    join_groups,
    keep_for,
    quoted,
    row_digest,
    scratch,
    text_of,
)
from recordwash.llm.components import components
from recordwash.llm.exact_dedup import blocks_for, may_repeat, member_filter
from recordwash.plans.staging import Staging

SHINGLE = 5
THRESHOLD = 0.8
BANDS, ROWS = 32, 4
STEP, TOLERANCE = 16, 1e-7
#: Texts of a block; texts of a bucket that are compared in one task.
BLOCK, BUCKET = 512, 4096
KEPT_WORDS = 100_000
PERMUTATIONS = BANDS * ROWS

_WORD = re.compile(r"[^ \t-\r]+")
_U = np.uint64


def text_digest(text_col: str):
    """Equal for texts with the same words."""
    spaced = F.trim(F.regexp_replace(text_of(text_col), BLANK + "+", " "))
    return F.unhex(F.sha2(spaced, 256))


class _Hashes(dict):
    def __missing__(self, word: str) -> int:
        if len(self) >= KEPT_WORDS:
            self.clear()
        self[word] = value = xxhash.xxh3_64_intdigest(word)
        return value


@cache
def _hashes() -> _Hashes:
    keep_for("jaccard", _hashes.cache_clear)
    return _Hashes()


@cache
def _factors() -> tuple[np.ndarray, np.ndarray]:
    random = np.random.default_rng(8)
    odd = random.integers(0, 1 << 62, PERMUTATIONS + SHINGLE, dtype=_U) * _U(2) + _U(1)
    return odd[:PERMUTATIONS], odd[PERMUTATIONS:]


def shingles(text: str) -> np.ndarray:
    """Sorted distinct 64-bit digests of the text's shingles."""
    words = _WORD.findall(text)
    if not words:
        return np.zeros(0, _U)
    hashes = np.fromiter(map(_hashes().__getitem__, words), _U, len(words))
    factors, n = _factors()[1], min(SHINGLE, len(words))
    total = np.full(len(words) - n + 1, n, _U)
    for i in range(n):
        total += hashes[i : len(hashes) - n + 1 + i] * factors[i]
    total = (total ^ (total >> _U(31))) * _U(0x9FB21C651E98DF25)
    return np.unique(total ^ (total >> _U(28)))


def minhash(found: np.ndarray) -> np.ndarray:
    """The least value of each of the permutations."""
    factors = _factors()[0]
    least = np.full(PERMUTATIONS, np.iinfo(np.uint64).max, _U)
    for at in range(0, len(found), 4096):
        values = found[at : at + 4096, None] * factors
        np.minimum(least, values.min(0), out=least)
    return (least >> _U(32)).astype(np.uint32)


def _sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Bands and a byte of each MinHash value. A byte agrees too often, never too seldom."""
    weights = np.random.default_rng(9).integers(1, 1 << 62, ROWS, dtype=_U) * _U(2) + _U(1)
    for batch in batches:
        counts, bands, bytes_ = [], [], []
        for text in batch.column(batch.num_columns - 1):
            found = shingles(text.as_py())
            values = minhash(found)
            grouped = values.reshape(BANDS, ROWS).astype(_U) * weights
            mixed = (grouped.sum(1, dtype=_U) + np.arange(BANDS, dtype=_U)) * _U(0xD6E8FEB86659FD93)
            counts.append(len(found))
            bands.append((mixed ^ (mixed >> _U(32))).view(np.int64) if len(found) else [])
            bytes_.append((values & np.uint32(255)).astype(np.uint8).tobytes())
        yield pa.RecordBatch.from_arrays(
            [
                *batch.columns[:-1], pa.array(counts, pa.int64()),
                pa.array(bands, pa.list_(pa.int64())), pa.array(bytes_, pa.binary()),
            ],
            [*batch.schema.names[:-1], "n_shingles", "bands", "sketch"],
        )


@cache
def least_matches(threshold: float = THRESHOLD, tolerance: float = TOLERANCE) -> dict[int, int]:
    """Per number of values compared, the matches below which a pair is dropped.

    With a uniform prior the chance of reaching the threshold t after m matches in n is that of
    at most m successes in n + 1 trials of chance t.
    """
    out = {}
    for n in range(STEP, PERMUTATIONS + 1, STEP):
        chance, total, m = (1 - threshold) ** (n + 1), 0.0, 0
        while total + chance < tolerance:
            total += chance
            chance *= (n + 1 - m) / (m + 1) * threshold / (1 - threshold)
            m += 1
        out[n] = m
    return out


def surviving(sketches: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Places of the pairs (a, b) that pruning leaves."""
    alive = np.arange(len(a))
    matches = np.zeros(len(a), np.int16)
    for n, least in least_matches().items():
        part = slice(n - STEP, n)
        matches += (sketches[a[alive], part] == sketches[b[alive], part]).sum(1, dtype=np.int16)
        keep = matches >= least
        alive, matches = alive[keep], matches[keep]
        if not len(alive):
            break
    return alive


def least_linked(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For each of n nodes the least node that the pairs connect it to."""
    label = np.arange(n)
    while len(a):
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        new = new[new]
        if (new == label).all():
            break
        label = new
    return label


def connected(sketches: np.ndarray) -> np.ndarray:
    """Least connected node of each node, over the pairs that pruning leaves.

    The first node is compared with all, and then each node that it isn't connected to: two
    nodes that both are need no comparison to be connected.
    """
    n = len(sketches)
    others = np.arange(1, n)
    near = others[surviving(sketches, np.zeros(n - 1, np.int64), others)]
    found_a, found_b = [np.zeros(len(near), np.int64)], [near]
    rest = np.setdiff1d(others, near)
    for at in range(0, len(rest), max(1, (1 << 20) // n)):
        some = rest[at : at + max(1, (1 << 20) // n)]
        a, b = np.repeat(some, n), np.tile(np.arange(n), len(some))
        apart = a != b
        a, b = a[apart], b[apart]
        alive = surviving(sketches, a, b)
        found_a.append(a[alive])
        found_b.append(b[alive])
    return least_linked(n, np.concatenate(found_a), np.concatenate(found_b))


def _whole_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Rows sorted by their first column, as tables that hold whole groups."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch.column(0).to_numpy(zero_copy_only=False)
        last = int(np.searchsorted(keys, keys[-1]))
        if held and held[-1].column(0)[0].as_py() == keys[-1]:
            held.append(batch)
            continue
        yield pa.Table.from_batches([*held, batch.slice(0, last)])
        held = [batch.slice(last)]
    if held:
        yield pa.Table.from_batches(held)


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, PERMUTATIONS)


def _bucket_links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(a, b): each text of a bucket with the least one it is connected to."""
    for rows in _whole_groups(batches):
        if not rows.num_rows:
            continue
        keys, nodes = (rows.column(i).to_numpy() for i in (0, 1))
        sketches = _matrix(rows.column(2))
        edges = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
        sizes = np.diff(np.append(edges, len(keys)))
        a, b = [], []
        pairs = edges[sizes == 2]
        alive = surviving(sketches, pairs, pairs + 1)
        a.append(nodes[pairs[alive]])
        b.append(nodes[pairs[alive] + 1])
        for first, size in zip(edges[sizes > 2], sizes[sizes > 2]):
            own = slice(first, first + size)
            label = connected(sketches[own])
            linked = label != np.arange(size)
            a.append(nodes[own][linked])
            b.append(nodes[own][label[linked]])
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate(a), pa.int64()), pa.array(np.concatenate(b), pa.int64())],
            ["a", "b"],
        )


def common_shingles(found: list[np.ndarray]) -> np.ndarray:
    """How many shingles each two of the texts share, over slices of the shared shingles."""
    every = np.concatenate(found)
    values, number, count = np.unique(every, return_inverse=True, return_counts=True)
    text = np.repeat(np.arange(len(found)), [len(x) for x in found])
    shared = count[number] > 1
    place = (np.cumsum(count > 1) - 1)[number[shared]]
    text, order = text[shared], np.argsort(place, kind="stable")
    text, place = text[order], place[order]
    total = np.zeros((len(found), len(found)), np.float32)
    width = 4096
    for low in range(0, int(place[-1]) + 1 if len(place) else 0, width):
        a, b = np.searchsorted(place, [low, low + width])
        x = np.zeros((len(found), width), np.float32)
        x[text[a:b], place[a:b] - low] = 1
        total += x @ x.T
    return total


def verified(
    sketches: np.ndarray, found: list[np.ndarray], blocks: np.ndarray, alone: bool
) -> tuple[np.ndarray, np.ndarray]:
    """Pairs whose similarity reaches the threshold; of two blocks only pairs between them."""
    n = len(found)
    a, b = np.triu_indices(n, 1)
    if not alone:
        between = blocks[a] != blocks[b]
        a, b = a[between], b[between]
    alive = surviving(sketches, a, b)
    a, b = a[alive], b[alive]
    if not len(a):
        return a, b
    sizes = np.array([len(x) for x in found])
    used = np.unique(np.concatenate([a, b]))
    at = np.zeros(n, np.int64)
    at[used] = np.arange(len(used))
    common = common_shingles([found[i] for i in used])[at[a], at[b]].astype(np.int64)
    # In whole numbers, so that a similarity of just 0.8 counts.
    similar = common * 100 >= round(THRESHOLD * 100) * (sizes[a] + sizes[b] - common)
    return a[similar], b[similar]


def _cluster_links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node, root, n_links) for each text of a meeting of blocks: links count documents."""
    for rows in _whole_groups(batches):
        if not rows.num_rows:
            continue
        keys, nodes, copies, blocks, alone = (rows.column(i).to_numpy() for i in range(5))
        texts = rows.column(5)
        edges = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
        out: list[list[np.ndarray]] = [[], [], []]
        for first, last in zip(edges, np.append(edges[1:], len(keys))):
            own = np.arange(first, last)
            own = own[np.unique(nodes[own], return_index=True)[1]]  # repeated rows
            found = [shingles(texts[int(i)].as_py()) for i in own]
            sketches = np.stack([(minhash(x) & 255).astype(np.uint8) for x in found])
            a, b = verified(sketches, found, blocks[own], alone[first])
            links = np.bincount(a, copies[own[b]], len(own)) + np.bincount(b, copies[own[a]], len(own))
            label = least_linked(len(own), a, b)
            some = links > 0
            for column, values in zip(out, (nodes[own], nodes[own[label]], links.astype(np.int64))):
                column.append(values[some])
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate(x), pa.int64()) for x in out], ["node", "root", "n_links"]
        )


def _buckets(texts: DataFrame, staging: Staging) -> DataFrame:
    """(bucket, node): buckets of two texts or more; of those with equal members only one."""
    banded = texts.select("node", F.explode("bands").alias("band"))
    member = F.sum(F.xxhash64("node").cast("decimal(20,0)"))
    seen = banded.groupBy("band").agg(F.count("*").alias("n"), member.alias("members"))
    distinct = seen.where("n > 1").groupBy("n", "members").agg(F.min("band").alias("band"))
    kept = staging.store(distinct.select("band", "n"), "bands")
    total = texts.count() * BANDS
    blocks = F.ceil(F.col("n") / (BUCKET // 2))
    joined = join_groups(banded, kept, "band", "n", total).withColumn(
        "blocks", F.when(F.col("n") > BUCKET, blocks).otherwise(1)
    )
    return _meetings(joined, "band")


def _meetings(rows: DataFrame, group: str) -> DataFrame:
    """Each row once for every block of its group, its own too, that its block meets."""
    n = F.col("blocks")
    own = F.pmod(F.xxhash64("node", F.lit("block")), n)
    met = rows.withColumn("block", own).withColumn("other", F.explode(F.sequence(F.lit(0), n - 1)))
    pair = F.xxhash64(group, F.least("block", "other"), F.greatest("block", "other"))
    alone = F.col("block") == F.col("other")
    return met.withColumn("meeting", pair).withColumn("alone", alone).drop("other")


def _dealt(rows: DataFrame, key: str) -> DataFrame:
    return rows.repartition(key).sortWithinPartitions(key)


def _texts_of(docs: DataFrame, text_col: str, chosen: DataFrame, staging: Staging) -> DataFrame:
    """The chosen rows with their texts. A Bloom filter keeps most other texts unshuffled."""
    n_blocks = blocks_for(chosen.count())
    keys = chosen.select(F.col("key").alias("digest"))
    bloom = staging.store(member_filter(keys, n_blocks), "filter")
    sources = docs.select(row_digest(docs).alias("digest"), text_of(text_col).alias("text"))
    maybe = may_repeat(sources, bloom, n_blocks, "maybe").where("maybe")
    return maybe.withColumnRenamed("digest", "key").join(chosen.hint("merge"), "key")


def similar_texts(docs: DataFrame, id_col: str, text_col: str, staging: Staging) -> DataFrame:
    """id, key, digest, n_shingles, root of the class and links of every row."""
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"),
        row_digest(docs).alias("key"), text_digest(text_col).alias("digest"),
        text_of(text_col).alias("text"),
    )
    schema = rows.drop("text").schema.add("n_shingles", "long")
    schema = schema.add("bands", T.ArrayType(T.LongType())).add("sketch", "binary")
    sketched = rows.mapInArrow(_sketches, schema)
    every = staging.store(sketched, "sketches")
    copies = every.where("n_shingles > 0").groupBy("digest").agg(
        F.count("*").alias("copies"), F.min("row").alias("row")
    )
    texts = staging.store(
        copies.join(every.drop("digest"), "row").withColumnRenamed("row", "node"), "texts"
    )
    met = _buckets(texts, staging).select("meeting", "node")
    bucketed = met.join(texts.select("node", "sketch"), "node").select("meeting", "node", "sketch")
    near = _dealt(bucketed, "meeting").mapInArrow(_bucket_links, "a long, b long")
    clusters = staging.store(components(near, staging, "clusters"), "clusters")

    # Few clusters are larger than a meeting; where they are many, AQE splits their rows.
    sizes = clusters.groupBy("root").agg(F.count("*").alias("n")).where(F.col("n") > 2 * BLOCK)
    grouped = clusters.join(sizes, "root", "left").withColumn(
        "blocks", F.coalesce(F.ceil(F.col("n") / BLOCK), F.lit(1))
    )
    chosen = staging.store(
        grouped.join(texts.select("node", "copies", "id", "key"), "node"), "members"
    )
    whole = _texts_of(docs, text_col, chosen, staging).select(
        "root", "blocks", "node", "copies", "text"
    )
    if every.groupBy("key").count().where("count > 1").limit(1).count():  # rows equal throughout
        whole = whole.dropDuplicates(["node"])
    meeting = _meetings(whole, "root").select(
        "meeting", "node", "copies", "block", "alone", "text"
    )
    links = staging.store(
        _dealt(meeting, "meeting").mapInArrow(
            _cluster_links, "node long, root long, n_links long"
        ),
        "links",
    )
    roots = components(
        links.select(F.col("node").alias("a"), F.col("root").alias("b")), staging, "classes"
    )
    counted = links.groupBy("node").agg(F.sum("n_links").alias("n_links"))
    found = texts.select("node", "digest", "copies").join(roots, "node", "left")
    found = found.join(counted, "node", "left").select(
        "digest", "copies", F.coalesce("root", "node").alias("root"),
        (F.coalesce("n_links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
    )
    narrow = every.select("row", "id", "key", "digest", "n_shingles")
    known = join_groups(
        narrow.where("n_shingles > 0"), staging.store(found, "found"), "digest", "copies",
        every.count(),
    )
    alone = narrow.where("n_shingles = 0").select(
        "*", F.lit(1).cast("long").alias("copies"), F.col("row").alias("root"),
        F.lit(0).cast("long").alias("n_links"),
    )
    return staging.store(known.unionByName(alone), "rows")


def join_similar(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: its class (the least id of the texts linked to it), and its number of links.

    `n_links` counts the other documents whose similarity reaches the threshold, copies too.
    """
    staging = scratch(docs.sparkSession)
    rows = similar_texts(docs, id_col, text_col, staging)
    classes = rows.groupBy("root").agg(F.min("id").alias("class_id"), F.count("*").alias("size"))
    named = join_groups(rows, classes, "root", "size", rows.count())
    return named.select(
        F.col("id").alias(id_col), "class_id", F.col("size").alias("class_size"), "n_links"
    )


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows with one of each class: that with the smallest id, null last. Whole rows."""
    staging = scratch(docs.sparkSession)
    rows = similar_texts(docs, id_col, text_col, staging)
    order = F.struct(F.col("id").isNull().alias("no_id"), "id", "key")
    alike = rows.groupBy("root", "id", "key").agg(F.count("*").alias("same_rows"))
    firsts = alike.groupBy("root").agg(F.min(order)["key"].alias("first"), F.count("*").alias("n"))
    marked = join_groups(alike, firsts, "root", "n", rows.count())
    others = staging.store(
        marked.where("key <> first or same_rows > 1").select("key", (F.col("key") == F.col("first")).alias("stays")),
        "others",
    )
    keyed = docs.select(F.struct(*[docs[quoted(c)] for c in docs.columns]).alias("row"), row_digest(docs).alias("key"))
    kept = keyed.join(others, "key", "left_anti")
    same = keyed.join(others.where("stays"), "key", "left_semi").dropDuplicates(["key"])
    return kept.unionByName(same).select("row.*")
