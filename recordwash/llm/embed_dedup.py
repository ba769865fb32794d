"""Near-duplicate vectors: links of a cosine from a threshold on, and their components.

PCA-ordered tiled comparison: unit vectors are turned to their principal axes, those of most
variance first. Tiles of vectors are compared by products over the leading axes; what the other
axes can add is at most the product of the two suffix norms, and where that cannot reach the
threshold a pair is given up. The rest gets the next axes, and at last the full cosine in double
precision, so a link is never wrong.

Which vectors meet: all tiles meet all, whatever the size of the table, so every link is found. The
work is quadratic, in memory bounded by two tiles a task. A caller who can do with a part of the links
gives a `recall`: vectors are then dealt into cells by cross-polytope hashes of
the turned vectors (the axis of a random rotation that is nearest), in several tables. All pairs
of a cell are compared. The size of cells is fixed, their number grows with the table, and the
number of tables follows from the rate at which pairs just at the threshold share a cell, which is
simulated: the expected recall of such pairs is the one given, of closer pairs more. Pairs that meet in
several tables are counted in the first one only, without any list of pairs.

Vectors with equal components are one class: each Arrow batch sends a class once with its number
of rows, so a vector that makes up a third of all rows is a few rows in its cell. Cells of more
than `CELL_ROWS` rows are compared as pairs of tiles by several tasks. Counting the links within
one dense group of different vectors remains quadratic in it, as each of its pairs is a link.

Defined results: vectors that are null, empty, zero, or hold null or non-finite components, or are
of another length than most of the sample, link with nothing and are kept. Rows with equal ids
are vectors of their own; a null id is greater than all others; an empty table gives an empty
result; columns other than id and vector don't matter.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial
from math import ceil, log

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordwash.llm.common import join_groups, quoted, scratch
from recordwash.llm.components import components

THRESHOLD = 0.9
#: Vectors that the axes are fitted on, those with the least digests of their ids: at most so
#: many, and at most so many components.
SAMPLE_ROWS, SAMPLE_NUMBERS = 20_000, 4_000_000
#: Vectors a cell holds on average, and at most in one task.
MEAN_ROWS, CELL_ROWS = 4_096, 16_384
TILE = 512
#: Axes after which pairs are given up.
LEADING = (16, 32)
#: Share of a tile's pairs from which on further products are computed for all of them.
DENSE = 0.05


@dataclass
class Plan:
    """Axes and tables, sent to all tasks."""

    axes: np.ndarray
    rotations: list[list[np.ndarray]]
    threshold: float

    @property
    def tables(self) -> int:
        return len(self.rotations)


def usable(column: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Numbers and components of the rows that can link."""
    lengths = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    values = column.flatten()
    edges = np.concatenate([[0], np.cumsum(lengths)])
    missing = np.zeros(len(values) + 1, np.int64)
    missing[1:] = np.cumsum(values.is_null().to_numpy(zero_copy_only=False))
    full = (lengths == width) & (missing[edges[1:]] == missing[edges[:-1]])
    rows = np.flatnonzero(full)
    numbers = values.fill_null(0).to_numpy(zero_copy_only=False)
    found = numbers[edges[rows][:, None] + np.arange(width)].astype(np.float64)
    good = np.isfinite(found).all(1) & (found != 0).any(1)
    return rows[good], found[good]


def unit(found: np.ndarray) -> np.ndarray:
    """Vectors of length one; scaled first, so that squares neither overflow nor vanish."""
    found = found / np.abs(found).max(1, keepdims=True)
    return found / np.sqrt((found * found).sum(1, keepdims=True))


def principal_axes(found: np.ndarray, width: int) -> np.ndarray:
    """Columns: the axes, by falling second moment."""
    if not len(found):
        return np.eye(width)
    _, axes = np.linalg.eigh(found.T @ found)
    return np.ascontiguousarray(axes[:, ::-1])


def nearest_axis(turned: np.ndarray, rotation: np.ndarray) -> np.ndarray:
    """Number of the rotation's axis, with its sign, that is nearest to each vector."""
    along = turned @ rotation
    best = np.abs(along).argmax(1)
    return best * 2 + (along[np.arange(len(along)), best] > 0)


def cells(turned: np.ndarray, table: list[np.ndarray]) -> np.ndarray:
    found = np.zeros(len(turned), np.int64)
    for rotation in table:
        found = found * (2 * rotation.shape[1]) + nearest_axis(turned, rotation)
    return found


def _table(random: np.random.Generator, width: int, n_cells: int) -> list[np.ndarray]:
    """Rotations whose axes make at least so many cells, if there are axes enough."""
    n_hashes = max(1, ceil(log(max(n_cells, 2)) / log(2 * width)))
    n_axes = min(width, max(1, ceil(n_cells ** (1 / n_hashes) / 2)))
    return [
        np.linalg.qr(random.standard_normal((width, width)))[0][:, :n_axes] for _ in range(n_hashes)
    ]


def rate_at(threshold: float, width: int, n_cells: int) -> float:
    """Simulated share of pairs with a cosine of the threshold that share a cell of a table."""
    random, same, pairs = np.random.default_rng(11), 0, 0
    for _ in range(8):
        a = unit(random.standard_normal((1000, width)))
        b = random.standard_normal((1000, width))
        b = unit(b - (a * b).sum(1, keepdims=True) * a) if width > 1 else np.zeros((1000, width))
        b = unit(threshold * a + (1 - threshold**2) ** 0.5 * b)
        table = _table(random, width, n_cells)
        same += int((cells(a, table) == cells(b, table)).sum())
        pairs += len(a)
    return same / pairs


def plan_for(
    sample: np.ndarray, width: int, n_rows: int, threshold: float, recall: float | None
) -> Plan:
    """Without a recall one cell for all rows, however many."""
    n_cells = 1 if recall is None else ceil(n_rows / MEAN_ROWS)
    if n_cells <= 1:
        rotations = [[np.zeros((width, 1))]]
    else:
        rate = min(rate_at(threshold, width, n_cells), 1 - 1e-6)
        random = np.random.default_rng(7)
        n_tables = max(1, ceil(log(1 - recall) / log(1 - rate)))
        rotations = [_table(random, width, n_cells) for _ in range(n_tables)]
    return Plan(principal_axes(unit(sample), width), rotations, threshold)


def _digests(found: np.ndarray) -> list[bytes]:
    # Adding zero makes minus zero the same as zero.
    return [hashlib.md5(row.tobytes()).digest() for row in found + 0.0]


def _classes(
    width: int, batches: Iterator[pa.RecordBatch]
) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray, list[bytes]]]:
    for batch in batches:
        rows, found = usable(batch.column("vector"), width)
        yield batch, rows, found, _digests(found)


def _with_digest(width: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch, rows, _, digests in _classes(width, batches):
        column: list[bytes | None] = [None] * batch.num_rows
        for i, digest in zip(rows, digests):
            column[i] = digest
        yield pa.RecordBatch.from_arrays(
            [batch.column("id"), pa.array(column, pa.binary())], ["id", "digest"]
        )


SENT = "cell long, digest binary, n long, vector binary"


def _sent(
    plan: Broadcast, width: int, kind: str, batches: Iterator[pa.RecordBatch]
) -> Iterator[pa.RecordBatch]:
    """Each class of a batch in its cell of every table, with its components as they are given."""
    plan = plan.value
    for batch, _, found, digests in _classes(width, batches):
        if not digests:
            continue
        counts, first = Counter(digests), {}
        for i, digest in enumerate(digests):
            first.setdefault(digest, i)
        at = np.fromiter(first.values(), np.int64)
        found = found[at]
        turned = unit(found) @ plan.axes
        content = [row.tobytes() for row in found.astype(kind)]
        n = [counts[d] for d in first]
        for table, rotations in enumerate(plan.rotations):
            cell = cells(turned, rotations) * plan.tables + table
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(cell), pa.array(list(first), pa.binary()),
                    pa.array(n, pa.int64()), pa.array(content, pa.binary()),
                ],
                ["cell", "digest", "n", "vector"],
            )


class Compared:
    """The classes of a cell, their links, and their components within the cell."""

    def __init__(self, plan: Plan, found: np.ndarray, weight: np.ndarray, table: int):
        self.threshold, self.weight = plan.threshold, weight
        self.units = unit(found)
        self.turned = self.units @ plan.axes
        self.suffix = {
            k: np.sqrt(np.maximum((self.turned[:, k:] ** 2).sum(1), 0)) for k in LEADING
        }
        #: Cells in the earlier tables: pairs that met there are counted there.
        self.earlier = [cells(self.turned, r) for r in plan.rotations[:table]]
        self.n_links = np.zeros(len(found), np.int64)
        self.label = np.arange(len(found))

    def compare(self, rows: slice, columns: slice) -> None:
        """Count the links between two tiles; of a tile with itself, each pair once."""
        i, j = self._linked(rows, columns)
        if rows == columns:
            i, j = i[i < j], j[i < j]
        if not len(i):
            return
        self._connect(i, j)
        new = np.ones(len(i), bool)
        for cell in self.earlier:
            new &= cell[i] != cell[j]
        np.add.at(self.n_links, i[new], self.weight[j[new]])
        np.add.at(self.n_links, j[new], self.weight[i[new]])

    def _linked(self, rows: slice, columns: slice) -> tuple[np.ndarray, np.ndarray]:
        least, slack = self.threshold, 1e-9
        known, low = None, 0
        pairs: tuple[np.ndarray, np.ndarray] | None = None
        a, b = self.turned[rows], self.turned[columns]
        for high in (*LEADING, a.shape[1]):
            if low >= a.shape[1]:
                break
            if pairs is None:
                part = a[:, low:high] @ b[:, low:high].T
            else:
                part = np.einsum("ij,ij->i", a[pairs[0], low:high], b[pairs[1], low:high])
            known = part if known is None else known + part
            low = high
            if high >= a.shape[1]:
                break
            rest_a, rest_b = self.suffix[high][rows], self.suffix[high][columns]
            if pairs is None:
                maybe = known + np.outer(rest_a, rest_b) >= least - slack
                if maybe.mean() < DENSE:
                    pairs = np.nonzero(maybe)
                    known = known[pairs]
            else:
                maybe = known + rest_a[pairs[0]] * rest_b[pairs[1]] >= least - slack
                pairs, known = (pairs[0][maybe], pairs[1][maybe]), known[maybe]
        if pairs is None:
            pairs = np.nonzero(known >= least - slack)
            known = known[pairs]
        i, j = pairs[0] + rows.start, pairs[1] + columns.start
        # At the threshold itself the cosine of the vectors as given decides.
        close = np.abs(known - least) <= slack
        known[close] = (self.units[i[close]] * self.units[j[close]]).sum(1)
        linked = known >= least
        return i[linked], j[linked]

    def _connect(self, i: np.ndarray, j: np.ndarray) -> None:
        """Merge the labels of linked rows: the larger hangs on the smaller until none differs."""
        while True:
            a, b = self.label[i], self.label[j]
            apart = a != b
            if not apart.any():
                return
            i, j, a, b = i[apart], j[apart], a[apart], b[apart]
            np.minimum.at(self.label, np.maximum(a, b), np.minimum(a, b))
            while not np.array_equal(shorter := self.label[self.label], self.label):
                self.label = shorter


def _parts(low: int, high: int) -> list[slice]:
    return [slice(i, min(i + TILE, high)) for i in range(low, high, TILE)]


FOUND = "digest binary, near binary, n long"


def _compare(plan: Broadcast, kind: str, key: tuple, rows: pa.Table) -> pa.Table:
    """Links of each class of a cell, or between two tiles of it, and one link to its component."""
    plan, cell = plan.value, key[0].as_py()
    digests = rows.column("digest").to_pylist()
    first: dict[bytes, int] = {}
    weight: dict[bytes, int] = {}
    for i, (digest, n) in enumerate(zip(digests, rows.column("n").to_pylist())):
        first.setdefault(digest, i)
        weight[digest] = weight.get(digest, 0) + n
    names = sorted(first)
    at = [first[d] for d in names]
    content = rows.column("vector").take(pa.array(at, pa.int64())).to_pylist()
    found = np.frombuffer(b"".join(content), kind).reshape(len(names), -1).astype(np.float64)
    tiles = np.array(rows.column("tile").to_pylist(), np.int64)[at]
    order = np.argsort(tiles, kind="stable")
    names = [names[i] for i in order]
    cell_of = Compared(plan, found[order], np.array([weight[d] for d in names]), cell % plan.tables)
    one, other = key[1].as_py(), key[2].as_py()
    # Of two tiles of a large cell the pairs across; else all pairs.
    cut = int(np.searchsorted(tiles[order], other)) if one != other else 0
    right = _parts(cut, len(names))
    left = _parts(0, cut) if cut else right
    for k, a in enumerate(left):
        for b in right if cut else right[k:]:
            cell_of.compare(a, b)
    some = np.flatnonzero((cell_of.n_links > 0) | (cell_of.label != np.arange(len(names))))
    return pa.table({
        "digest": pa.array([names[i] for i in some], pa.binary()),
        "near": pa.array([names[cell_of.label[i]] for i in some], pa.binary()),
        "n": pa.array(cell_of.n_links[some], pa.int64()),
    })


def _tiled(sent: DataFrame, sizes: DataFrame) -> DataFrame:
    """Rows with the pair of tiles (one, other) that they meet in, and their own tile.

    A row of a cell within `CELL_ROWS` has the pair (0, 0); of a larger one, as many as tiles.
    """
    none = F.lit(0).cast("long")
    alone = {"one": none, "other": none, "tile": none}
    n_tiles = F.ceil(F.col("rows") / (CELL_ROWS // 2)).alias("tiles")
    large = sizes.where(F.col("rows") > CELL_ROWS).select("cell", n_tiles)
    if large.isEmpty():
        return sent.withColumns(alone)
    split = sent.join(large, "cell").withColumn("tile", F.pmod(F.xxhash64("digest"), F.col("tiles")))
    partner = F.explode(F.sequence(F.lit(0).cast("long"), F.col("tiles") - 1)).alias("partner")
    met = split.select("*", partner).select(
        *sent.columns,
        F.least("tile", "partner").alias("one"),
        F.greatest("tile", "partner").alias("other"),
        "tile",
    )
    return sent.join(large, "cell", "left_anti").withColumns(alone).unionByName(met)


def _width_and_rows(rows: DataFrame) -> tuple[int, int]:
    """The commonest length of the vectors, the larger if equal, and the number of rows."""
    lengths = rows.groupBy(F.greatest(F.size("vector"), F.lit(0)).alias("width")).count()
    total = lengths.agg(F.sum("count")).first()[0] or 0
    first = lengths.where("width > 0").orderBy(F.desc("count"), F.desc("width")).first()
    return (first["width"] if first else 1), total


def _sample(rows: DataFrame, width: int) -> np.ndarray:
    most = min(SAMPLE_ROWS, max(1, SAMPLE_NUMBERS // width))
    same = rows.where(F.size("vector") == width)
    picked = same.orderBy(F.xxhash64("id", "vector"), "id").limit(most).select("vector").toArrow()
    if not picked.num_rows:
        return np.zeros((0, width))
    return usable(picked.column("vector").combine_chunks(), width)[1]


def link(
    df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
    threshold: float = THRESHOLD, recall: float | None = None,
) -> DataFrame:
    """Per row its id, n_links, component_id and kept.

    `n_links` counts the other rows with a cosine of the threshold or more; `component_id` is the
    least id reachable by links. Only with a `recall` (say 0.97) links may be missed: it is the
    expected share that is found of those just at the threshold.
    """
    spark, staging = df.sparkSession, scratch(df.sparkSession)
    single = df.schema[vector_col].dataType.simpleString() == "array<float>"
    kind, array = ("<f4", "array<float>") if single else ("<f8", "array<double>")
    rows = df.select(
        F.col(quoted(id_col)).alias("id"), F.col(quoted(vector_col)).cast(array).alias("vector")
    )
    width, n_rows = _width_and_rows(rows)
    planned = plan_for(_sample(rows, width), width, n_rows, threshold, recall)
    plan = spark.sparkContext.broadcast(planned)

    id_type = rows.schema["id"].dataType.simpleString()
    known = staging.store(
        rows.mapInArrow(partial(_with_digest, width), f"id {id_type}, digest binary"), "digests"
    )
    sent = rows.mapInArrow(partial(_sent, plan, width, kind), SENT)
    sizes = staging.store(sent.groupBy("cell").agg(F.count("*").alias("rows")), "sizes")
    compare = partial(_compare, plan, kind)
    met = _tiled(sent, sizes).groupBy("cell", "one", "other")
    found = staging.store(met.applyInArrow(lambda key, r: compare(key, r), FOUND), "found")

    links = found.groupBy("digest").agg(F.sum("n").alias("linked"))
    edges = found.where("digest <> near").select(F.col("digest").alias("a"), F.col("near").alias("b"))
    roots = components(edges, staging, "parts").withColumnRenamed("node", "digest")
    classes = known.where(F.col("digest").isNotNull()).groupBy("digest").agg(
        F.count("*").alias("rows"), F.min("id").alias("least")
    )
    # Classes that are alone, one row without links, need no more.
    some = classes.join(links, "digest", "left").join(roots, "digest", "left")
    some = some.where("rows > 1 OR linked IS NOT NULL OR root IS NOT NULL")
    some = staging.store(some.withColumn("root", F.coalesce("root", "digest")), "classes")
    least = some.groupBy("root").agg(F.count("*").alias("n"), F.min("least").alias("component"))
    named = join_groups(
        some, staging.store(least, "components"), "root", "n", max(n_rows, 1)
    ).select(
        "digest",
        "rows",
        (F.coalesce("linked", F.lit(0)) + F.col("rows") - 1).alias("n_links"),
        "component",
    )
    named = staging.store(named, "named")
    usable_rows, others = known.where("digest IS NOT NULL"), known.where("digest IS NULL")
    joined = join_groups(usable_rows, named, "digest", "rows", max(n_rows, 1), "left")
    every = joined.select("id", "n_links", "component").unionByName(
        others.select("id", F.lit(None).cast("long").alias("n_links"), F.lit(None).cast(id_type).alias("component"))
    )
    component = F.coalesce("component", "id")
    return every.select(
        F.col("id").alias(id_col),
        F.coalesce("n_links", F.lit(0)).alias("n_links"),
        component.alias("component_id"),
        component.eqNullSafe(F.col("id")).alias("kept"),
    )
