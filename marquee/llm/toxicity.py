"""Toxicity by a classifier chain (operator 6).

Categories are predicted one after the other by linear models on the words of a text and the
beginnings of its words, without case in any language. Each later model also
gets the log-odds of the earlier categories. It is trained on predictions of models that had not seen the
row (out-of-fold), so that it meets in training what it will meet later.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.llm.shared import labelled_texts, parts_of
from marquee.llm.words import SEPARATORS, Splitter

LABELLED_ROWS = 8_000  # the most labelled rows that a chain is fitted on
BITS = 20
PREFIXES = (4, 5, 6, 7, 8)  # bytes of the beginnings of words
FOLDS = 3
LEAST_TEXTS = 3  # what is in fewer training texts has no weight
LEAST_RATIO = 1.0  # nor has what is about as frequent in both classes
PUNCTUATION = list(b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~")


def word_features(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """id_col and the hashed different words of each whole text, packed as 32-bit integers."""
    kind = docs.schema[id_col].dataType.simpleString()

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, rows in hashed(batch.column(1)):
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0)[first : first + len(rows)], pa.array([r.tobytes() for r in rows], pa.binary())], names=[id_col, "words"]
                )

    return docs.select(id_col, text_col).mapInArrow(scan, f"`{id_col}` {kind}, words binary")


def hashed(column: pa.Array) -> Iterator[tuple[int, list[np.ndarray]]]:
    for words in Splitter(SEPARATORS + PUNCTUATION, PREFIXES, unicode=True).chunks(column):
        places = (np.stack([words.hashes, *words.prefixes]) >> np.uint64(64 - BITS)).astype("<u4")
        yield words.first, [np.unique(places[:, a:b]) for a, b in zip(words.offsets, words.offsets[1:])]


class Rows(NamedTuple):
    """Sparse 0/1 rows: places of the ones, one row after the other, and where each row begins."""

    places: np.ndarray
    offsets: np.ndarray

    @classmethod
    def of(cls, rows: list[np.ndarray]) -> Rows:
        return cls(np.concatenate([*rows, np.zeros(0, "<u4")]).astype(np.int32), np.cumsum([0, *map(len, rows)]))

    def only(self, wanted: np.ndarray) -> Rows:
        """With the wanted places alone, numbered anew."""
        keep, number = wanted[self.places], np.cumsum(wanted) - 1
        return Rows(number[self.places[keep]].astype(np.int32), np.concatenate([[0], np.cumsum(keep)])[self.offsets])

    def times(self, weights: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0.0], np.cumsum(weights[self.places])])
        return total[self.offsets[1:]] - total[self.offsets[:-1]]

    def some(self, which: np.ndarray) -> Rows:
        return Rows.of([self.places[self.offsets[i] : self.offsets[i + 1]] for i in np.flatnonzero(which)])

    def transposed(self, values: np.ndarray, width: int) -> np.ndarray:
        return np.bincount(self.places, np.repeat(values, np.diff(self.offsets)), minlength=width)


class Linear(NamedTuple):
    words: np.ndarray
    earlier: np.ndarray
    bias: float

    def chance(self, rows: Rows, earlier: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(rows.times(self.words) + earlier @ self.earlier + self.bias, -30, 30)))


def minimized(function, x: np.ndarray, *, steps: int = 30, memory: int = 6) -> np.ndarray:
    """L-BFGS with backtracking; function gives value and gradient."""
    value, gradient = function(x)
    past: list[tuple[np.ndarray, np.ndarray]] = []
    for _ in range(steps):
        way, used = -gradient, []
        for s, y in reversed(past):
            used.append(s @ way / (s @ y))
            way = way - used[-1] * y
        if past:
            way = way * (past[-1][0] @ past[-1][1]) / (past[-1][1] @ past[-1][1])
        for (s, y), a in zip(past, reversed(used)):
            way = way + (a - y @ way / (s @ y)) * s
        slope, size = gradient @ way, 1.0 if past else 1 / max(1.0, np.abs(gradient).sum())
        while True:
            new_value, new_gradient = function(x + size * way)
            if new_value <= value + 1e-4 * size * slope or size < 1e-10:
                break
            size /= 2
        s, y = size * way, new_gradient - gradient
        if value - new_value < 1e-7 * max(1.0, abs(value)):
            return x + s
        if s @ y > 1e-12:
            past = [*past[1 - memory :], (s, y)] if len(past) >= memory else [*past, (s, y)]
        x, value, gradient = x + s, new_value, new_gradient
    return x


def fit_linear(rows: Rows, earlier: np.ndarray, label: np.ndarray, *, ridge: float = 1e-4) -> Linear:
    """Logistic regression on words and beginnings, scaled by their log-ratio of texts in both classes.

    With one class only the model is its constant chance, held within 0.001 and 0.999.
    """
    n, ones = max(1, len(label)), float(label.sum())
    start = np.log((ones + 1e-3 * n + 1e-9) / (n - ones + 1e-3 * n + 1e-9))
    if ones in (0, len(label)):
        return Linear(np.zeros(1 << BITS), np.zeros(earlier.shape[1]), float(start))
    having, texts = rows.transposed(label.astype(float), 1 << BITS), rows.transposed(np.ones(len(label)), 1 << BITS)
    ratio = np.log((having + 0.5) / (ones + 1)) - np.log((texts - having + 0.5) / (n - ones + 1))
    wanted = (texts >= LEAST_TEXTS) & (np.abs(ratio) >= LEAST_RATIO)
    rows, scale = rows.only(wanted), ratio[wanted]
    width = len(scale)

    def loss(w: np.ndarray) -> tuple[float, np.ndarray]:
        margin = rows.times(scale * w[:width]) + earlier @ w[width:-1] + w[-1]
        off = (1 / (1 + np.exp(-np.clip(margin, -500, 500))) - label) / n
        value = (np.logaddexp(0, margin) - label * margin).sum() / n + ridge / 2 * (w[:-1] @ w[:-1])
        return value, np.concatenate([scale * rows.transposed(off, width) + ridge * w[:width], earlier.T @ off + ridge * w[width:-1], [off.sum()]])

    w = minimized(loss, np.concatenate([np.zeros(width + earlier.shape[1]), [start]]))
    words = np.zeros(1 << BITS, np.float32)
    words[wanted] = scale * w[:width]
    return Linear(words, w[width:-1], float(w[-1]))


def _log_odds(chance: np.ndarray) -> np.ndarray:
    chance = np.clip(chance, 1e-4, 1 - 1e-4)
    return np.log(chance / (1 - chance))


def fit_chain(rows: Rows, labels: np.ndarray, fold: np.ndarray) -> list[Linear]:
    """A model per column of labels, in order."""
    earlier, chain = np.zeros((len(labels), 0)), []
    for k, label in enumerate(labels.T):
        chain.append(fit_linear(rows, earlier, label))
        if k == labels.shape[1] - 1:
            break
        unseen = np.zeros(len(labels))
        for k in np.unique(fold):
            model = fit_linear(rows.some(fold != k), earlier[fold != k], label[fold != k])
            unseen[fold == k] = model.chance(rows.some(fold == k), earlier[fold == k])
        earlier = np.column_stack([earlier, _log_odds(unseen)])
    return chain


def predict_chain(chain: list[Linear], rows: Rows) -> list[np.ndarray]:
    earlier, chances = np.zeros((len(rows.offsets) - 1, 0)), []
    for model in chain:
        chances.append(model.chance(rows, earlier))
        earlier = np.column_stack([earlier, _log_odds(chances[-1])])
    return chances


def train_toxicity(docs: DataFrame, labels: DataFrame, categories: list[str], *, id_col: str = "doc_id", text_col: str = "text", rows: int = LABELLED_ROWS) -> list[Linear]:
    """Fit a chain for the 0/1 columns `categories` of labels, in that order.

    Uses `rows` labelled documents at most, chosen by a hash of their id; label rows with a null are left
    out. Folds go by another hash of the id.
    """
    names = [f"label{i}" for i in range(len(categories))]
    numbered = labels.select(id_col, *[F.col(c).cast("int").alias(n) for c, n in zip(categories, names)])
    texts = labelled_texts(docs, numbered, names, rows, id_col, text_col)
    found = texts.select(F.struct(F.pmod(F.hash("key"), F.lit(FOLDS)).alias("fold"), *names).alias("known"), "body")
    sample = word_features(found, "known", "body").toArrow()
    known = sample.column("known").combine_chunks()
    columns = [known.field(i).to_numpy() for i in range(len(categories) + 1)] if len(sample) else [np.zeros(0)] * (len(categories) + 1)
    ones = Rows.of([np.frombuffer(x.as_buffer(), "<u4") for x in sample.column("words")])
    return fit_chain(ones, np.stack(columns[1:], 1).astype(float), columns[0])


def toxicity_scores(docs: DataFrame, chain: list[Linear], categories: list[str], *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Chances of all categories for every whole text, one row per row of docs: id_col, p_<category> ...

    Null texts count as empty; null and repeated ids are kept; other columns are left out. The models, of a
    fixed size, are broadcast.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    # Plain tuples: a class of this package would be looked up where the executors have none.
    models = docs.sparkSession.sparkContext.broadcast([tuple(model) for model in chain])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = [Linear(*model) for model in models.value]
        for batch in parts_of(batches):
            for first, rows in hashed(batch.column(1)):
                chances = predict_chain(known, Rows.of(rows))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0)[first : first + len(rows)], *map(pa.array, chances)], names=[id_col, *[f"p_{c}" for c in categories]]
                )

    return docs.select(id_col, text_col).mapInArrow(scan, ", ".join([f"`{id_col}` {kind}", *[f"p_{c} double" for c in categories]]))
