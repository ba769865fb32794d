"""Quality: attention-based multiple-instance learning over the passages of a document.

A document is a bag of passages of `PASSAGE_WORDS` words, all of them, whatever its length.
Each passage is encoded by features of its words (shapes, case, signs, repetition) and a learned
layer. Gated attention gives each passage a weight, learned from document labels alone; the
weighted mean of the encodings is scored.

The model, a few thousand numbers, is fitted on the driver to one row each of at most
`TRAINING_ROWS` labelled ids, whose features the tasks make, and broadcast for scoring. Features
take 232 bytes a passage. Ids are taken in the order of their digests while their passages add up to
`TRAINING_PASSAGES` at most: longer texts make fewer of them, never shorter ones.

Defined results: null text counts as empty; of the rows of a labelled id the one whose text has the
least digest is learned from; an empty text is one passage of zeros and gets a
score too. Without training rows of both labels the score is the share of label 1, or 0.5 if
there are none. Repeated ids each get their row; an empty table gives an empty result; other
columns pass through `add_score`, and a taken result name gets underscores before it.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cache, partial

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recordwash.llm.common import add_column, free_name, keep_for
from recordwash.llm.labelled import training_rows

PASSAGE_WORDS = 64
TRAINING_ROWS, TRAINING_PASSAGES = 12_000, 400_000
#: Bins for the shapes of words; words kept with their features; letters handled at a time.
SHAPES, KEPT_WORDS, SLICE_LETTERS = 48, 200_000, 1 << 20
HIDDEN, GATES, EPOCHS, BATCH, RATE, DECAY = 24, 12, 12, 64, 3e-3, 1e-4

_UPPER = re.compile(r"[A-ZÀ-ÖØ-Þ]+")
_LOWER = re.compile(r"[^\W\d_A-ZÀ-ÖØ-Þ]+")
_RUNS = re.compile(r"(.)\1+")
PER_WORD = 8


class Words(dict):
    """A number for each word met, with the features of the word by that number."""

    def __init__(self) -> None:
        self.rows = array("f")

    def __missing__(self, word: str) -> int:
        self[word] = number = len(self)
        shape = _RUNS.sub(r"\1", _LOWER.sub("a", _UPPER.sub("A", word)))
        n, letters = len(word), sum(map(str.isalpha, word))
        self.rows.extend((
            zlib.crc32(shape.encode()) % SHAPES, min(n, 40) / 10, float(word.isupper() and n > 1),
            float(letters == 0), (n - letters) / n, sum(map(str.isdigit, word)) / n,
            word.count("!") / n, float(n == 1),
        ))
        return number

    def features(self) -> np.ndarray:
        return np.array(self.rows, np.float32).reshape(-1, PER_WORD)


@cache
def words_met() -> Words:
    keep_for("quality", words_met.cache_clear)
    return Words()


N_FEATURES = (PER_WORD - 1) + 3 + SHAPES


def passages(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Features of all passages of the texts, and each text's first passage."""
    met = words_met()
    if len(met) > KEPT_WORDS:
        met.clear()
        met.__init__()
    numbers = []
    for text in texts:
        words = text.split()
        numbers.append(np.fromiter(map(met.__getitem__, words), np.int64, len(words)))
    sizes = np.array([len(x) for x in numbers], np.int64)
    bags = np.maximum(1, -(-sizes // PASSAGE_WORDS))
    first = np.cumsum(bags) - bags
    out = np.zeros((int(bags.sum()), N_FEATURES), np.float32)
    if not sizes.sum():
        return out, first
    ids = np.concatenate(numbers)
    place = np.arange(len(ids)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    passage = np.repeat(first, sizes) + place // PASSAGE_WORDS
    n = len(out)
    count = np.maximum(1, np.bincount(passage, minlength=n)).astype(np.float32)
    table = met.features()
    for column in range(1, PER_WORD):
        out[:, column - 1] = np.bincount(passage, table[ids, column], n) / count
    at = PER_WORD - 1
    same = (ids[1:] == ids[:-1]) & (passage[1:] == passage[:-1])
    out[:, at] = np.bincount(passage[1:][same], minlength=n) / count
    distinct = np.unique(passage * len(met) + ids) // len(met)
    out[:, at + 1] = np.bincount(distinct, minlength=n) / count
    out[:, at + 2] = count / PASSAGE_WORDS
    shapes = np.bincount(passage * SHAPES + table[ids, 0].astype(np.int64), minlength=n * SHAPES)
    out[:, at + 3 :] = shapes.reshape(n, SHAPES) / count[:, None]
    return out, first


@dataclass
class Model:
    """Weights of the encoder, the gated attention and the score."""

    mean: np.ndarray
    scale: np.ndarray
    weights: dict[str, np.ndarray] = field(default_factory=dict)
    constant: float | None = None

    def forward(self, x: np.ndarray, first: np.ndarray) -> tuple:
        w = self.weights
        h = np.tanh(x @ w["W"] + w["b"])
        t = np.tanh(h @ w["V"] + w["v"])
        g = 1 / (1 + np.exp(-(h @ w["U"] + w["u"])))
        e = (t * g) @ w["a"]
        bag = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(x))))
        e = np.exp(e - np.maximum.reduceat(e, first)[bag])
        attention = e / np.add.reduceat(e, first)[bag]
        z = np.add.reduceat(attention[:, None] * h, first)
        return h, t, g, attention, bag, z, z @ w["c"] + w["d"][0]

    def score(self, x: np.ndarray, first: np.ndarray) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(first), self.constant)
        logit = self.forward((x - self.mean) / self.scale, first)[-1]
        return 1 / (1 + np.exp(-np.clip(logit, -40, 40)))

    def gradients(self, x: np.ndarray, first: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        w = self.weights
        h, t, g, attention, bag, z, logit = self.forward(x, first)
        wrong = (1 / (1 + np.exp(-np.clip(logit, -40, 40))) - y) / len(y)
        dz = (wrong[:, None] * w["c"])[bag]
        da = (h * dz).sum(1)
        de = attention * (da - np.add.reduceat(attention * da, first)[bag])
        dt = de[:, None] * w["a"] * g * (1 - t * t)
        dg = de[:, None] * w["a"] * t * g * (1 - g)
        dh = (attention[:, None] * dz + dt @ w["V"].T + dg @ w["U"].T) * (1 - h * h)
        return {
            "W": x.T @ dh, "b": dh.sum(0), "V": h.T @ dt, "v": dt.sum(0), "U": h.T @ dg,
            "u": dg.sum(0), "a": (t * g).T @ de, "c": z.T @ wrong, "d": wrong.sum(keepdims=True),
        }


def train(bags: list[np.ndarray], y: np.ndarray, seed: int = 1) -> Model:
    """Adam over mini-batches of documents."""
    if len(set(y.tolist())) < 2:
        nothing = np.zeros(N_FEATURES, np.float32)
        return Model(nothing, nothing + 1, constant=float(y.mean()) if len(y) else 0.5)
    every = np.concatenate(bags)
    model = Model(every.mean(0), every.std(0) + 1e-3)
    bags = [(x - model.mean) / model.scale for x in bags]
    random = np.random.default_rng(seed)
    shapes = {"W": (N_FEATURES, HIDDEN), "b": HIDDEN, "V": (HIDDEN, GATES), "v": GATES,
              "U": (HIDDEN, GATES), "u": GATES, "a": GATES, "c": HIDDEN, "d": 1}
    for name, shape in shapes.items():
        size = np.zeros(shape)
        model.weights[name] = random.normal(0, len(size) ** -0.5, shape) * (name not in "bvud")
    moment = {k: [np.zeros_like(v), np.zeros_like(v)] for k, v in model.weights.items()}
    step = 0
    for _ in range(EPOCHS):
        order = random.permutation(len(bags))
        for at in range(0, len(order), BATCH):
            chosen = order[at : at + BATCH]
            x = np.concatenate([bags[i] for i in chosen])
            sizes = np.array([len(bags[i]) for i in chosen])
            step += 1
            for k, d in model.gradients(x, np.cumsum(sizes) - sizes, y[chosen]).items():
                m, v = moment[k]
                d = d + DECAY * model.weights[k]
                m += 0.1 * (d - m)
                v += 0.001 * (d * d - v)
                change = m / (1 - 0.9**step) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
                model.weights[k] -= RATE * change
    return model


def _bags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        labels = batch.column(1).to_pylist()
        for at, texts in slices(batch.column(0)):
            x, first = passages(texts)
            parts = np.split(x, first[1:])
            yield pa.RecordBatch.from_pydict(
                {"label": labels[at : at + len(texts)], "x": [p.tobytes() for p in parts]}
            )


def slices(texts: pa.Array) -> Iterator[tuple[int, list[str]]]:
    """Consecutive texts of about `SLICE_LETTERS` together, with the place of the first."""
    held, size, first = [], 0, 0
    for place, text in enumerate(texts):
        held.append(text.as_py() or "")
        size += len(held[-1])
        if size >= SLICE_LETTERS:
            yield first, held
            held, size, first = [], 0, place + 1
    if held:
        yield first, held


def fit(
    docs: DataFrame, labels: DataFrame, label: str, folds: int, fold: int,
    most: int = TRAINING_ROWS,
) -> Model:
    """A model of the label, learned outside the fold."""
    rows = bounded(training_rows(docs, labels, label, folds, fold, most))
    found = rows.orderBy("doc_id").select("text", "label").mapInArrow(_bags, "label double, x binary").collect()
    bags = [np.frombuffer(r["x"], np.float32).reshape(-1, N_FEATURES) for r in found]
    return train(bags, np.array([r["label"] for r in found], float))


def bounded(rows: DataFrame) -> DataFrame:
    """One whole row per id, for as many ids as keep to the bound of passages.

    What the driver adds up is one number an id, at most `TRAINING_ROWS` of them.
    """
    digest = F.struct(F.xxhash64("text"), F.md5("text")).alias("digest")
    n_words = F.regexp_count("text", F.lit(r"\S+"))
    sized = rows.select("*", digest, F.greatest(F.lit(1), F.ceil(n_words / PASSAGE_WORDS)).alias("n"))
    firsts = sized.groupBy("doc_id").agg(F.min(F.struct("digest", "n")).alias("first"))
    ordered = firsts.select("doc_id", "first.*").orderBy(F.xxhash64("doc_id"), "doc_id").toArrow()
    n_chosen = int(np.searchsorted(np.cumsum(ordered["n"].to_numpy()), TRAINING_PASSAGES, "right"))
    chosen = ordered.select(["doc_id", "digest"]).slice(0, n_chosen)
    kind = rows.schema["doc_id"].dataType.simpleString()
    # From Arrow it is a local table; rows of Python would start workers of another kind on each
    # executor, with a daemon that stays.
    kept = rows.sparkSession.createDataFrame(
        chosen, f"doc_id {kind}, digest struct<col1:bigint,col2:string>"
    )
    met = rows.select("*", digest).join(F.broadcast(kept), ["doc_id", "digest"], "left_semi")
    return met.dropDuplicates(["doc_id"]).drop("digest")


def add_score(docs: DataFrame, model: Model, text_col: str = "text", out: str = "score"):
    """The rows with the probability of label 1 for their whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    of = partial(_scores, shared, docs.columns.index(text_col))
    return add_column(docs, free_name(docs, out), T.DoubleType(), of)


def _scores(shared: Broadcast, at: int, batch: pa.RecordBatch) -> pa.Array:
    found = [shared.value.score(*passages(texts)) for _, texts in slices(batch.column(at))]
    return pa.array(np.concatenate(found) if found else np.zeros(0), pa.float64())


def add_attention(docs: DataFrame, model: Model, text_col: str = "text", out: str = "attention"):
    """The rows with the weight of each of their passages, in order."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    of = partial(_attention, shared, docs.columns.index(text_col))
    return add_column(docs, free_name(docs, out), T.ArrayType(T.DoubleType()), of)


def _attention(shared: Broadcast, at: int, batch: pa.RecordBatch) -> pa.Array:
    model, found = shared.value, []
    for _, texts in slices(batch.column(at)):
        x, first = passages(texts)
        if model.constant is not None:
            sizes = np.diff(np.append(first, len(x)))
            weights = np.repeat(1 / sizes, sizes)
        else:
            weights = model.forward((x - model.mean) / model.scale, first)[3]
        found += [w.tolist() for w in np.split(weights, first[1:])]
    return pa.array(found, pa.list_(pa.float64()))
