"""Benchmark decontamination on a positional inverted index of the training texts.

The index is distributed by document: tasks turn their documents into segments of about
`SEGMENT_WORDS` words, each with the sorted positions of every term, so building it needs no
shuffle. A search expands the list of each phrase's rarest term, for all phrases at once, and
intersects with the others' lists from the next rarest on, each moved back by the term's place in the
phrase: a start is in a term's list if that term stands at its place. What is left are the exact
matches. With a slop, terms may stand that far from their place, and phrases are taken one by one.

The benchmark is taken in parts of about `PART_WORDS` words, dealt by their text: items of one
text are one part. Where there are several, a part's matches are written before the next is read.

A segment is one row of some 3 MB. `store_index` bounds the rows that a task holds while it writes and
reads them, and Arrow batches are bounded too, so neither grows with the size of a task's input.

Defined results: null texts have no words; an item without words matches nothing; items of one
id count once; an item without id is named "null"; rows of one doc_id each get their row; empty
tables give empty or clean results; a very long text is in one segment, whole; other columns don't
matter.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass
from functools import cached_property, partial, reduce
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordwash.llm.common import bound_batches, keep_for, quoted, row_digest, scratch
from recordwash.plans.staging import Staging

WINDOW = 13
SEGMENT_WORDS = 500_000
PART_WORDS = 2_000_000
#: Phrases that are looked for at a time, and postings that are expanded at a time.
PHRASES, EXPANDED = 1 << 15, 1 << 17
#: A document is contaminated from this share of hit words on: 1 in 20.
SHARE = 20
#: By default Parquet's writer looks at the size of a page and of a row group from 100 rows on, which are
#: some 300 MB of segments here; and a reader takes a row group's rows at once.
SMALL_GROUPS = {
    "parquet.block.size": str(16 << 20),
    "parquet.block.size.row.check.min": "1",
    "parquet.page.size.row.check.min": "1",
}

# What separates words, after lower-casing A-Z.
_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")

INDEX_SCHEMA = (
    "keys array<string>, doc_ids array<long>, starts array<int>, sizes array<int>, "
    "terms array<string>, counts array<int>, positions binary"
)
MATCH_SCHEMA = "key string, doc_id long, item string, start int, length int"
HIT_SCHEMA = "key string, doc_id long, n_words long, n_hit long, items array<string>"


def words_of(text: str | None) -> list[str]:
    return _WORD.findall(text.encode().lower().decode()) if text else []


class _Numbers(dict):
    def __missing__(self, term: str) -> int:
        self[term] = number = len(self)
        return number


def _segment(keys: list, ids: list, docs: list[list[str]]) -> pa.RecordBatch:
    """One segment. Between documents a place stays free, so that no phrase crosses."""
    numbers = _Numbers()
    sizes = np.array([len(d) for d in docs], np.int64)
    terms = np.fromiter(
        (n for d in docs for n in map(numbers.__getitem__, d)), np.int32, int(sizes.sum())
    )
    starts = np.cumsum(sizes + 1) - sizes - 1
    places = np.arange(len(terms)) + np.repeat(np.arange(len(docs)), sizes)
    positions = places[np.argsort(terms, kind="stable")]
    steps = np.diff(positions, prepend=0).astype("<i4")
    row = {
        "keys": [keys], "doc_ids": [ids], "starts": [starts.tolist()], "sizes": [sizes.tolist()],
        "terms": [list(numbers)], "counts": [np.bincount(terms, minlength=len(numbers)).tolist()],
        "positions": [steps.tobytes()],
    }
    return pa.RecordBatch.from_pydict(row, _ARROW_INDEX)


_LONGS, _INTS = pa.list_(pa.int64()), pa.list_(pa.int32())
_ARROW_INDEX = pa.schema([
    ("keys", pa.list_(pa.string())), ("doc_ids", _LONGS), ("starts", _INTS), ("sizes", _INTS),
    ("terms", pa.list_(pa.string())), ("counts", _INTS), ("positions", pa.binary()),
])


def _segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    keep_for("decontamination", lambda: None)
    keys, ids, docs, size = [], [], [], 0
    for batch in batches:
        for key, doc_id, text in zip(*batch.columns):
            keys.append(key.as_py())
            ids.append(doc_id.as_py())
            docs.append(words_of(text.as_py()))
            size += len(docs[-1])
            if size >= SEGMENT_WORDS:
                yield _segment(keys, ids, docs)
                keys, ids, docs, size = [], [], [], 0
    if docs:
        yield _segment(keys, ids, docs)


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The index of all documents; store it before searching. `key` is a digest of the row."""
    bound_batches(docs.sparkSession)
    rows = docs.select(
        row_digest(docs).alias("key"), F.col(id_col).cast("long").alias("doc_id"),
        F.col(text_col).alias("text"),
    )
    return rows.mapInArrow(_segments, INDEX_SCHEMA)


def store_index(
    docs: DataFrame, staging: Staging, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The index as stored, in small row groups."""
    return staging.store(build_index(docs, id_col, text_col), "index", **SMALL_GROUPS)


@dataclass
class Phrases:
    """Phrases as rows of term numbers, filled up with -1, and the items they come from."""

    terms: list[str]
    rows: np.ndarray
    lengths: np.ndarray
    items: list[str]
    item_of: np.ndarray

    @cached_property
    def arrow_terms(self) -> pa.Array:
        return pa.array(self.terms, pa.string())


def phrases(items: Sequence[tuple[str, list[str]]], window: int | None) -> Phrases:
    """All windows of the items; an item of fewer words, or without a window, is one phrase."""
    numbers = _Numbers()
    width = window or max((len(w) for _, w in items), default=0)
    rows, lengths, item_of = [], [], []
    for place, (_, words) in enumerate(items):
        coded = [numbers[w] for w in words]
        length = min(len(words), width)
        for at in range(len(words) - length + 1 if words else 0):
            rows.append(coded[at : at + length] + [-1] * (width - length))
            lengths.append(length)
            item_of.append(place)
    return Phrases(
        list(numbers), np.array(rows, np.int32).reshape(-1, max(1, width)),
        np.array(lengths, np.int32), [name for name, _ in items], np.array(item_of, np.int32),
    )


class Segment:
    """A segment of the index as read back."""

    def __init__(self, row: dict[str, pa.Scalar]):
        self.keys, self.doc_ids = row["keys"].as_py(), row["doc_ids"].as_py()
        self.starts = row["starts"].values.to_numpy()
        self.sizes = row["sizes"].values.to_numpy()
        self.terms = row["terms"].values
        self.counts = row["counts"].values.to_numpy()
        self.ends = np.cumsum(self.counts)
        steps = np.frombuffer(row["positions"].as_buffer(), "<i4")
        self.positions = np.cumsum(steps, dtype=np.int32)

    def postings(self, term: int) -> np.ndarray:
        return self.positions[self.ends[term] - self.counts[term] : self.ends[term]]

    def document(self, places: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.starts, places, "right") - 1

    def search(self, wanted: Phrases, slop: int = 0) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(start, phrase, document) of every match."""
        none = np.zeros(0, np.int64)
        if not len(wanted.rows) or not len(self.terms):
            return none, none, none
        own = pc.index_in(wanted.arrow_terms, value_set=self.terms).fill_null(-1).to_numpy()
        own = np.append(own, -2)  # for the filling
        own = own.astype(np.int32)
        if not slop:
            return self._exact(own, wanted.rows)
        coded = own[wanted.rows]
        starts, which, docs = [], [], []
        for phrase in np.flatnonzero((coded != -1).all(1)):
            found, doc = self._matches(coded[phrase, : wanted.lengths[phrase]], slop)
            if len(found):
                starts.append(found)
                docs.append(doc)
                which.append(np.full(len(found), phrase))
        if not starts:
            return none, none, none
        return np.concatenate(starts), np.concatenate(which), np.concatenate(docs)

    @cached_property
    def term_at(self) -> np.ndarray:
        """The term at each place; -1 between documents."""
        found = np.full(int(self.starts[-1] + self.sizes[-1]) + 1, -1, np.int32)
        found[self.positions] = np.repeat(np.arange(len(self.counts)), self.counts)
        return found

    def _exact(
        self, own: np.ndarray, rows: np.ndarray
    ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Matches of all phrases, a bounded number of phrases and of their starts at a time."""
        starts, which = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for low in range(0, len(rows), PHRASES):
            coded = own[rows[low : low + PHRASES]]
            present = np.flatnonzero((coded != -1).all(1))
            coded = coded[present]
            counts = np.append(self.counts, [np.iinfo(np.int32).max] * 2)[coded]
            order = np.argsort(counts, axis=1, kind="stable").astype(np.int32)
            least = np.take_along_axis(counts, order[:, :1], 1)[:, 0].astype(np.int64)
            group = (np.cumsum(least) - least) // EXPANDED
            edges = np.append(np.flatnonzero(np.diff(group, prepend=-1)), len(present))
            for i, j in zip(edges, edges[1:]):
                start, phrase = self._intersected(coded[i:j], order[i:j], least[i:j])
                starts.append(start)
                which.append(low + present[i + phrase])
        found = np.concatenate(starts)
        return found, np.concatenate(which), self.document(found)

    def _intersected(
        self, coded: np.ndarray, order: np.ndarray, least: np.ndarray
    ) -> tuple[np.ndarray, np.ndarray]:
        """Starts and numbers of the phrases; `order` has their places from the rarest term on."""
        phrase = np.repeat(np.arange(len(coded)), least)
        first = self.ends[coded[np.arange(len(coded)), order[:, 0]]] - least
        nth = np.arange(len(phrase)) - np.repeat(np.cumsum(least) - least, least)
        start = self.positions[first[phrase] + nth].astype(np.int64) - order[phrase, 0]
        fits = start >= 0
        for place in order.T[1:]:
            phrase, start = phrase[fits], start[fits]
            at = start + place[phrase]
            term = coded[phrase, place[phrase]]
            inside = at < len(self.term_at)
            fits = (term == -2) | (inside & (self.term_at[np.where(inside, at, 0)] == term))
        return start[fits], phrase[fits]

    def _matches(self, terms: np.ndarray, slop: int) -> tuple[np.ndarray, np.ndarray]:
        """Starts and documents of a phrase, from its rarest term's list on.

        With a slop a term may stand elsewhere, but in the document of the rarest one; a start
        may then lie before that document.
        """
        order = np.argsort(self.counts[terms], kind="stable")
        starts = self.postings(terms[order[0]]) - order[0]
        for place in order[1:]:
            if not len(starts):
                break
            others = self.postings(terms[place]) - place
            least = starts - slop
            if slop:
                doc = self.document(starts + order[0])
                first = self.starts[doc] - place
                least = np.maximum(least, first)
            near = np.searchsorted(others, least)
            near_place = others[np.minimum(near, len(others) - 1)]
            fits = (near < len(others)) & (near_place <= starts + slop)
            if slop:
                fits &= near_place < first + self.sizes[doc]
            starts = starts[fits]
        return starts, self.document(starts + order[0])

    def hits(self, wanted: Phrases) -> tuple[np.ndarray, list[list[str]]]:
        """Hit words and found items of each document."""
        starts, which, docs = self.search(wanted)
        edge = np.zeros(int(self.starts[-1] + self.sizes[-1]) + 2, np.int32)
        np.add.at(edge, starts, 1)
        np.add.at(edge, starts + wanted.lengths[which], -1)
        covered = np.concatenate([[0], np.cumsum(np.cumsum(edge) > 0)])
        n_hit = covered[self.starts + self.sizes] - covered[self.starts]
        items: list[set[str]] = [set() for _ in self.keys]
        pairs = np.stack([docs, wanted.item_of[which]], 1)
        for doc, item in np.unique(pairs, axis=0).tolist():
            items[doc].add(wanted.items[item])
        return n_hit, [sorted(x) for x in items]


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[Segment]:
    for batch in batches:
        for at in range(batch.num_rows):
            yield Segment({n: batch.column(i)[at] for i, n in enumerate(batch.schema.names)})


def _hits(shared: Broadcast, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for segment in _rows(batches):
        n_hit, items = segment.hits(shared.value)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(segment.keys, pa.string()), pa.array(segment.doc_ids, pa.int64()),
                pa.array(segment.sizes, pa.int64()), pa.array(n_hit, pa.int64()),
                pa.array(items, pa.list_(pa.string())),
            ],
            ["key", "doc_id", "n_words", "n_hit", "items"],
        )


def _found(
    shared: Broadcast, slop: int, batches: Iterator[pa.RecordBatch]
) -> Iterator[pa.RecordBatch]:
    wanted = shared.value
    for segment in _rows(batches):
        starts, which, doc = segment.search(wanted, slop)
        yield pa.RecordBatch.from_pydict({
            "key": pa.array([segment.keys[d] for d in doc], pa.string()),
            "doc_id": pa.array([segment.doc_ids[d] for d in doc], pa.int64()),
            "item": pa.array([wanted.items[i] for i in wanted.item_of[which]], pa.string()),
            "start": pa.array(starts - segment.starts[doc], pa.int32()),
            "length": pa.array(wanted.lengths[which], pa.int32()),
        })


def _parts(
    benchmark: DataFrame, window: int | None, id_col: str, text_col: str
) -> Iterator[Broadcast]:
    """The benchmark's phrases, a bounded part at a time."""
    named = benchmark.select(
        F.coalesce(F.col(id_col).cast("string"), F.lit("null")).alias("item"),
        F.col(text_col).alias("text"),
    )
    size = named.agg(F.coalesce(F.sum(F.char_length("text")), F.lit(0))).first()[0]
    n_parts = max(1, -(-size // (4 * PART_WORDS)))
    part = F.pmod(F.xxhash64("text"), F.lit(n_parts))
    for number in range(n_parts):
        rows = named.where(part == number).collect()
        items = [(r["item"], words_of(r["text"])) for r in rows]
        yield benchmark.sparkSession.sparkContext.broadcast(phrases(items, window))


def find(
    index: DataFrame, benchmark: DataFrame, window: int | None = WINDOW, slop: int = 0,
    id_col: str = "item_id", text_col: str = "text",
) -> DataFrame:
    """Every match of the items' windows, or of whole items: document, item, first word, length.

    With a slop, each term may stand up to so many words from its place beside the rarest.
    """
    return _found_in_parts(index, _parts(benchmark, window, id_col, text_col), slop)


def _found_in_parts(index: DataFrame, parts: Iterable[Broadcast], slop: int) -> DataFrame:
    """The matches of all parts; those of a part are written before the next is broadcast."""
    bound_batches(index.sparkSession)
    staging, found, last = scratch(index.sparkSession), [], None
    for part in parts:
        if last is not None:
            found[-1] = staging.store(found[-1], f"part_{len(found)}")
            last.destroy()
        found.append(index.mapInArrow(partial(_found, part, slop), MATCH_SCHEMA))
        last = part
    return reduce(DataFrame.unionByName, found)


def document_hits(
    index: DataFrame, benchmark: DataFrame, window: int = WINDOW,
    id_col: str = "item_id", text_col: str = "text",
) -> DataFrame:
    """For each document its words, the words within a match, and the items that match."""
    parts = _parts(benchmark, window, id_col, text_col)
    first = next(parts)
    second = next(parts, None)
    if second is None:
        bound_batches(index.sparkSession)
        found = index.mapInArrow(partial(_hits, first), HIT_SCHEMA)
        return found.withColumn("contaminated", is_contaminated())
    return _hits_of_parts(index, chain([first, second], parts))


def _hits_of_parts(index: DataFrame, parts: Iterable[Broadcast]) -> DataFrame:
    """Matches of several parts may overlap, so the words they cover are joined by document."""
    found = _found_in_parts(index, parts, 0)
    covered = F.explode(F.sequence("start", F.col("start") + F.col("length") - 1)).alias("word")
    words = (
        found.select("key", "doc_id", "item", covered)
        .groupBy("key", "doc_id", "word")
        .agg(F.collect_set("item").alias("items"))
    )
    names = F.array_sort(F.array_distinct(F.flatten(F.collect_set("items"))))
    hits = words.groupBy("key").agg(F.count("*").alias("n_hit"), names.alias("items"))
    docs = index.select(F.explode(F.arrays_zip("keys", "doc_ids", "sizes")).alias("d")).select(
        F.col("d.keys").alias("key"), F.col("d.doc_ids").alias("doc_id"),
        F.col("d.sizes").cast("long").alias("n_words"),
    )
    none = F.array().cast("array<string>")
    return docs.join(hits, "key", "left").select(
        "key", "doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).alias("n_hit"),
        F.coalesce("items", none).alias("items"),
    ).withColumn("contaminated", is_contaminated())


def is_contaminated() -> Column:
    return (F.col("n_hit") > 0) & (SHARE * F.col("n_hit") >= F.col("n_words"))


def decontaminate(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The rows whose document isn't contaminated, with all their columns."""
    staging = scratch(docs.sparkSession)
    index = store_index(docs, staging, id_col, text_col)
    hits = document_hits(index, benchmark).where("contaminated").select("key").distinct()
    found = staging.store(hits, "hits")
    rows = docs.select(
        F.struct(*[docs[quoted(c)] for c in docs.columns]).alias("row"),
        row_digest(docs).alias("key"),
    )
    return rows.join(found, "key", "left_anti").select("row.*")
