"""Quality classifier (operator 7): Bradley-Terry ranking of documents.

A document's score is linear in features of its text. The weights make a good document of a labelled pair score
above a bad one: mean logistic loss on the difference of the two feature vectors, over all pairs of a good and a bad
training document. The threshold is the quantile of all training documents' scores at the share of bad documents among them.

Pairs are never listed. What a document adds to the loss depends on the other class only through the places of its
scores, so each Newton step takes two passes over the documents: one counts the scores of both classes on a grid, one
adds up gradient and curvature. A pass brings the driver sums of a fixed size.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.llm.shared import TEXTS_AT_ONCE, give_back, parts_of, staged
from marquee.llm.words import Splitter, Words

SPREAD, FARTHEST = 8.0, 1e4  # a grid's places lie evenly up to about SPREAD, then further and further apart
VALUES_AT_ONCE = 100_000  # scores that the driver may sort
MARKS = b"*#$%&!|.,;:?\"'()[]{}<>=_~^\\/@+-"


def _per_text(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0.0], np.cumsum(values, dtype=np.float64)])
    return total[offsets[1:]] - total[offsets[:-1]]


def _repeats(found: Words) -> tuple[np.ndarray, np.ndarray]:
    """Per text: units that equal the one before, and different units."""
    same = np.zeros(len(found.hashes), bool)
    same[1:] = found.hashes[1:] == found.hashes[:-1]
    firsts = found.offsets[:-1][found.offsets[:-1] < found.offsets[1:]]
    same[firsts] = False
    different = np.array([len(np.unique(found.hashes[a:b])) for a, b in zip(found.offsets, found.offsets[1:])], float)
    return _per_text(same, found.offsets), different


def features_of(words: Words, lines: Words) -> np.ndarray:
    """One row per text; shares come as such, as a root, and as whether they are more than slight."""
    data, at = words.data, words.texts
    size = np.maximum(1.0, np.diff(at))
    n, n_lines = np.diff(words.offsets).astype(float), np.diff(lines.offsets).astype(float)
    count = lambda chars: _per_text(np.isin(data, np.frombuffer(chars, np.uint8)), at)
    upper = _per_text((data >= 65) & (data <= 90), at)
    lower = _per_text((data >= 97) & (data <= 122), at)
    again, different = _repeats(words)
    lines_again, lines_different = _repeats(lines)
    shares = [
        upper / np.maximum(1.0, upper + lower),
        count(b"0123456789") / size,
        _per_text(data >= 128, at) / size,
        again / np.maximum(1.0, n),
        1 - different / np.maximum(1.0, n),
        lines_again / np.maximum(1.0, n_lines),
        1 - lines_different / np.maximum(1.0, n_lines),
        *[count(bytes([mark])) / np.maximum(1.0, n) for mark in MARKS],
    ]
    shares = np.clip(np.stack(shares, 1), 0, 1)
    length = _per_text(words.ends - words.starts, words.offsets) / np.maximum(1.0, n)
    amounts = np.stack([np.log1p(n), np.log1p(n_lines), np.log1p(length), n == 0], 1)
    return np.concatenate([amounts, shares, np.sqrt(shares), shares > 0.05, shares > 0.2], 1)


def features_in(column: pa.Array) -> np.ndarray:
    """The features of each whole text of a column, a row each."""
    words, lines = Splitter(), Splitter([10])
    rows = [features_of(w, x).astype("<f4") for w, x in zip(words.chunks(column), lines.chunks(column))]
    return np.concatenate(rows) if rows else np.zeros((0, len(features_in(pa.array(["a"]))[0])), "<f4")


class Ranking(NamedTuple):
    center: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    threshold: float

    def scores(self, rows: np.ndarray) -> np.ndarray:
        """0.5 at the threshold; the odds follow the model's odds of a win over a document there."""
        margin = ((rows - self.center) / self.scale) @ self.weights - self.threshold
        return 1 / (1 + np.exp(-np.clip(margin, -500, 500)))


def _places(step: float) -> np.ndarray:
    half = int(np.ceil(SPREAD * np.arcsinh(FARTHEST / SPREAD) / step))
    return SPREAD * np.sinh(np.arange(-half, half + 1) * step / SPREAD)


FINE, COARSE = _places(1 / 16), _places(1.0)  # for the gradient, which decides the result, and for the curvature

#: What one part of the documents adds to a sum: its rows, and which of them are good.
Part = Callable[[np.ndarray, np.ndarray], np.ndarray]


def _between(scores: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The place before each score, and how far it is on the way to the next: its weight there."""
    scores = np.clip(scores, places[0], places[-1])
    left = np.clip(np.searchsorted(places, scores, "right") - 1, 0, len(places) - 2)
    return left, (scores - places[left]) / (places[left + 1] - places[left])


def _counted(scores: np.ndarray, places: np.ndarray) -> np.ndarray:
    left, way = _between(scores, places)
    return np.bincount(left, 1 - way, len(places)) + np.bincount(left + 1, way, len(places))


def _dealt(scores: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """The sum of the rows at each coarse place."""
    left, way = _between(scores, COARSE)
    weights = np.zeros((len(scores), len(COARSE)))
    weights[np.arange(len(scores)), left], weights[np.arange(len(scores)), left + 1] = 1 - way, way
    return weights.T @ rows


def _lost(lead: np.ndarray) -> np.ndarray:
    """The model's chance that a pair is lost by whom has this lead."""
    return 1 / (1 + np.exp(np.clip(lead, -500, 500)))


def _moments(rows: np.ndarray, good: np.ndarray) -> np.ndarray:
    rows = rows.astype(float)
    return np.concatenate([[good.sum(), len(good)], rows.sum(0), (rows**2).sum(0)])


def fit(total: Callable[[Part], np.ndarray], width: int, *, ridge: float = 1e-3, steps: int = 25) -> Ranking:
    """Newton steps on the mean logistic loss of good minus bad over all pairs; ``total`` adds a part up over all documents.

    The threshold is still 0. Without a good or without a bad row there are no pairs, and the weights are 0.
    """
    sums = total(_moments)
    n_good, n = sums[:2]
    n_bad = n - n_good
    if not n_good or not n_bad:
        return Ranking(np.zeros(width), np.ones(width), np.zeros(width), 0.0)
    center = sums[2 : 2 + width] / n
    scale = np.sqrt(np.maximum(0, sums[2 + width :] / n - center**2))
    scale[scale < 1e-6] = 1.0
    chance = _lost(FINE[:, None] - FINE)
    kernel = _lost(COARSE[:, None] - COARSE)
    kernel = kernel * (1 - kernel)
    w = np.zeros(width)
    for _ in range(steps):

        def counted(rows: np.ndarray, good: np.ndarray, w: np.ndarray = w) -> np.ndarray:
            scores = ((rows - center) / scale) @ w
            return np.concatenate([_counted(scores[some], places) for places in (FINE, COARSE) for some in (good, ~good)])

        fine_good, fine_bad, coarse_good, coarse_bad = np.split(total(counted), np.cumsum([len(FINE), len(FINE), len(COARSE)]))
        # Of all pairs of a document at each place: the share that is lost, and the mean curvature.
        lost = {True: chance @ fine_bad / n_bad, False: chance.T @ fine_good / n_good}
        bend = {True: kernel @ coarse_bad / n_bad, False: kernel.T @ coarse_good / n_good}

        def added(rows: np.ndarray, good: np.ndarray, w: np.ndarray = w, lost: dict = lost, bend: dict = bend) -> np.ndarray:
            rows = (rows - center) / scale
            scores = rows @ w
            gradient, curvature, dealt = np.zeros(width), np.zeros((width, width)), []
            for kind, some, size, sign in ((True, good, n_good, -1), (False, ~good, n_bad, 1)):
                x, s = rows[some], scores[some]
                gradient += sign * (np.interp(s, FINE, lost[kind]) @ x) / size
                curvature += (x * np.interp(s, COARSE, bend[kind])[:, None]).T @ x / size
                dealt.append(_dealt(s, x) / size)
            return np.concatenate([gradient, curvature.ravel(), *[d.ravel() for d in dealt]])

        gradient, curvature, of_good, of_bad = np.split(total(added), np.cumsum([width, width**2, len(COARSE) * width]))
        both = of_good.reshape(-1, width).T @ kernel @ of_bad.reshape(-1, width)
        curvature = curvature.reshape(width, width) - both - both.T + ridge * np.eye(width)
        step = np.linalg.solve(curvature, gradient + ridge * w)
        w = w - step
        if np.abs(step).max() < 1e-6:
            break
    return Ranking(center, scale, w, 0.0)


def fit_pairs(good: np.ndarray, bad: np.ndarray, *, ridge: float = 1e-3, steps: int = 25) -> Ranking:
    """A ranking from the rows of good and of bad documents; without either every document scores 0.5."""
    rows, flags = np.concatenate([good, bad]), np.arange(len(good) + len(bad)) < len(good)
    ranking = fit(lambda part: part(rows, flags), rows.shape[1], ridge=ridge, steps=steps)
    if not len(good) or not len(bad):
        return ranking
    scores = ((rows - ranking.center) / ranking.scale) @ ranking.weights
    return ranking._replace(threshold=float(np.quantile(scores, len(bad) / len(rows))))


WIDTH = len(features_in(pa.array(["a"]))[0])


def _unpacked(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "<f4").reshape(-1, WIDTH)


def feature_rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """key, place (a hash of the text) and the packed features of every whole text; a row per row of docs."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts_of(batches):
            packed = [r.tobytes() for r in features_in(batch.column(2))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(packed, pa.binary())], names=["key", "place", "features"])

    body = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("key"), F.xxhash64(body).alias("place"), body.alias("body"))
    kind = docs.schema[id_col].dataType.simpleString()
    return staged(rows.mapInArrow(scan, f"key {kind}, place long, features binary"), "features")


def value_at(values: DataFrame, rank: int) -> float:
    """The value of a rank, from 0, in the one column of a stored frame: the range around it is narrowed until few are left."""
    value, below = F.col(values.columns[0]), 0
    inside = values
    while True:
        least, most, n = inside.agg(F.min(value), F.max(value), F.count(value)).first()
        if least == most:
            return least
        if n <= VALUES_AT_ONCE:
            return float(np.sort(inside.toArrow().column(0).to_numpy())[rank - below])
        bucket = F.width_bucket(value, F.lit(least), F.lit(most), F.lit(4096))
        for row in sorted(inside.groupBy(bucket.alias("bucket")).agg(F.count(value).alias("n"), F.min(value).alias("low"), F.max(value).alias("high")).collect()):
            if rank < below + row.n:
                inside = values.where(value.between(row.low, row.high))
                break
            below += row.n


def train_quality(features: DataFrame, labels: DataFrame, *, id_col: str = "doc_id") -> Ranking:
    """Fit on all labelled rows of ``feature_rows``.

    labels has id_col and quality (1 good, 0 bad; other rows are left out). Of several label rows of an id the greatest
    counts, of several documents the one of the least hash, so that repeated ids bring no more rows.
    """
    usable = labels.where("quality in (0, 1)").select(F.col(id_col).alias("key"), F.col("quality").cast("int").alias("quality")).dropna()
    usable = usable.groupBy("key").agg(F.max("quality").alias("quality"))
    one = features.join(usable, "key").groupBy("key", "quality").agg(F.min(F.struct("place", "features")).alias("text"))
    known = staged(one.select((F.col("quality") == 1).alias("good"), "text.features"), "training")

    def total(part: Part) -> np.ndarray:
        def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            found = 0.0
            for batch in batches:
                found = found + part(_unpacked(batch.column(1)), batch.column(0).to_numpy(zero_copy_only=False).astype(bool))
            if isinstance(found, np.ndarray):
                yield pa.RecordBatch.from_arrays([pa.array([found.astype(float).tobytes()], pa.binary())], names=["sums"])

        # A sum over no documents at all is that over a part without rows.
        sums = part(np.zeros((0, WIDTH)), np.zeros(0, bool)).astype(float)
        for found in known.mapInArrow(scan, "sums binary").toArrow().column("sums"):
            sums = sums + np.frombuffer(found.as_buffer())
        return sums

    ranking = fit(total, WIDTH)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = ((_unpacked(batch.column(0)) - ranking.center) / ranking.scale) @ ranking.weights
            yield pa.RecordBatch.from_arrays([pa.array(scores)], names=["score"])

    counts = known.agg(F.count("good").alias("n"), F.count_if(~F.col("good")).alias("bad")).first()
    if counts.bad in (0, counts.n):
        return ranking
    scores = staged(known.select("features").mapInArrow(scan, "score double"), "training-scores")
    place = counts.bad / counts.n * (counts.n - 1)
    before = int(place)
    low, high = (value_at(scores, min(rank, counts.n - 1)) for rank in (before, before + 1))
    return ranking._replace(threshold=low + (high - low) * (place - before))


def share_of(id_col: str, parts: int) -> Column:
    """The part of a row by the CRC of its id as text; a null id counts as empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")), F.lit(parts))


def good_documents(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", parts: int = 3, held_out: int = 1) -> DataFrame:
    """The rows of docs that `quality_scores` predicts to be good, with all their columns.

    Each row is judged by its own text, so null and repeated ids, null and empty texts are rows like others.
    """
    known = share_of(id_col, parts) != held_out
    ranking = train_quality(feature_rows(docs.where(known), id_col, text_col), labels.where(known), id_col=id_col)

    def judge(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        give_back()
        for column in columns:
            some = [ranking.scores(features_in(column[at : at + TEXTS_AT_ONCE])) >= 0.5 for at in range(0, len(column), TEXTS_AT_ONCE)]
            yield pa.array(np.concatenate([np.zeros(0, bool), *some]))
            give_back()

    judge.__annotations__ = {"columns": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return docs.where(F.arrow_udf(judge, "boolean")(F.coalesce(text_col, F.lit(""))))


def quality_scores(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", parts: int = 3, held_out: int = 1) -> DataFrame:
    """Scores of every whole text, one row per row of docs: id_col, held_out, score, predicted.

    Learns from all labelled rows whose part is not held out; inputs are features of the text alone. Null texts
    count as empty, which is a feature of its own; null and repeated ids are kept; other columns are left
    out. Of several label rows of a document the greatest counts.
    """
    features = feature_rows(docs, id_col, text_col)
    ranking = train_quality(features, labels.where(share_of(id_col, parts) != held_out), id_col=id_col)
    kind = docs.schema[id_col].dataType.simpleString()

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score = ranking.scores(_unpacked(batch.column(1)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(score), pa.array((score >= 0.5).astype(np.int32))], names=[id_col, "score", "predicted"]
            )

    scored = features.select("key", "features").mapInArrow(scan, f"`{id_col}` {kind}, score double, predicted int")
    return scored.select(id_col, (share_of(id_col, parts) == held_out).alias("held_out"), "score", "predicted")
