"""Document quality by Bradley-Terry ranking of pairs.

A pair is a document labelled good and one labelled bad; P(good beats bad) = sigmoid(w (x_good - x_bad)).  Where the
scores w x reach the quantile of all documents' scores that leaves the labels' share of bad ones below, a document counts
as good; its score in (0, 1) is 0.5 there.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import blocks, lists, mixed, text_bytes
from .samples import labelled
from .words import BLANKS, byte_class, words_of

#: Classes of bytes whose neighbours are counted: digits, upper and lower case, blanks, line ends, end marks, other
#: marks, beyond ASCII.
KINDS = np.full(256, 6, np.uint8)
for number, ranges in enumerate([[(48, 57)], [(65, 90)], [(97, 122)], [(32, 32), (9, 9)], [(10, 13)],
                                 [(44, 44), (46, 46), (58, 59), (63, 63)]]):
    KINDS[byte_class(*ranges)] = number
KINDS[128:] = 7
LINES = byte_class((10, 13))
PLAIN = 9
FEATURES = PLAIN + 8 + 64


@dataclass(frozen=True)
class Quality:
    training_rows: int = 20_000  #: bound of the labelled sample
    pairs_each: int = 8  #: opponents of each document of the rarer label's side
    penalty: float = 1e-3
    rounds: int = 25


@dataclass(frozen=True)
class Model:
    centre: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    threshold: float  #: the score at the quantile over all documents
    slope: float

    def raw(self, batch: pa.RecordBatch) -> np.ndarray:
        return (features(batch) - self.centre) / self.scale @ self.weights

    def scores(self, batch: pa.RecordBatch) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * (self.raw(batch) - self.threshold), -40, 40)))


def repeats(hashes: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of each text the share of items that are not its first ones of their kind, and the share of its commonest item."""
    again, most = np.zeros(len(bounds) - 1), np.zeros(len(bounds) - 1)
    for at, (begin, end) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)):
        if end > begin:
            one = np.sort(hashes[begin:end])
            first = np.flatnonzero(np.append(True, one[1:] != one[:-1]))
            again[at] = 1 - len(first) / len(one)
            most[at] = np.diff(np.append(first, len(one))).max() / len(one)
    return again, most


def features(batch: pa.RecordBatch) -> np.ndarray:
    """One row of numbers for each text; they come from the whole text and nothing else."""
    data, bounds = text_bytes(batch.column("text"))
    count = len(bounds) - 1
    sizes = np.diff(bounds)
    owner = np.repeat(np.arange(count), sizes)
    kinds = KINDS[data].astype(np.int64)
    alone = np.bincount(owner * 8 + kinds, minlength=count * 8).reshape(count, 8)
    same = owner[1:] == owner[:-1]
    pairs = np.bincount((owner[1:] * 64 + kinds[:-1] * 8 + kinds[1:])[same], minlength=count * 64).reshape(count, 64)
    words = words_of(data, bounds, BLANKS)
    lines = words_of(data, bounds, LINES)
    number, line_number = np.diff(words.bounds), np.diff(lines.bounds)
    many, of_lines = np.maximum(number, 1), np.maximum(line_number, 1)
    word_owner = np.repeat(np.arange(count), number)
    length = words.ends - words.begins
    twice = mixed(words.hashes[:-1] * np.uint64(3) + words.hashes[1:]) if len(words.hashes) else words.hashes
    pair_bounds = np.minimum(words.bounds, len(twice))
    again, most = repeats(words.hashes, words.bounds)
    pair_again, _ = repeats(twice, pair_bounds)
    line_again, _ = repeats(lines.hashes, lines.bounds)
    plain = np.stack([np.log1p(number), np.bincount(word_owner, length, count) / many,
                      np.bincount(word_owner, length > 14, count) / many, again, most, pair_again, line_again,
                      np.log1p(number / of_lines), np.log1p(line_number)], axis=1)
    return np.concatenate([plain, np.sqrt(alone / np.maximum(sizes, 1)[:, None]),
                           np.sqrt(pairs / np.maximum(sizes, 1)[:, None])], axis=1)


def fit(documents: DataFrame, labels: DataFrame, where: Column | None = None, by: Quality = Quality()) -> Model:
    """The model of labels (doc_id, quality 0 or 1), learnt from rows that satisfy `where` alone.

    If the sample has one label only, every document gets 0.5.
    """
    sample = labelled(documents, labels, "quality", F.lit(True) if where is None else where, by.training_rows)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(batches):
            rows = features(batch)
            bounds = np.arange(len(rows) + 1) * FEATURES
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("label"),
                                              lists(rows.astype(np.float32).ravel(), bounds)], ["doc_id", "label", "x"])

    rows = sample.select("doc_id", "text", "label").mapInArrow(
        measure, "doc_id long, label int, x array<float>").orderBy("doc_id").toArrow()
    label = rows.column("label").to_numpy()
    x = rows.column("x").combine_chunks().flatten().to_numpy().reshape(-1, FEATURES).astype(float)
    if len(set(label)) < 2:
        return Model(np.zeros(FEATURES), np.ones(FEATURES), np.zeros(FEATURES), 0.0, 1.0)
    centre, scale = x.mean(axis=0), x.std(axis=0) + 1e-6
    x = (x - centre) / scale
    good, bad = np.flatnonzero(label == 1), np.flatnonzero(label == 0)
    random = np.random.default_rng(5)
    number = by.pairs_each * max(len(good), len(bad))
    better, worse = (random.permutation(np.resize(side, number)) for side in (good, bad))
    apart = x[better] - x[worse]
    weights = np.zeros(FEATURES)
    for _ in range(by.rounds):  # Newton's steps on the mean logistic loss
        lost = 1 / (1 + np.exp(np.clip(apart @ weights, -40, 40)))
        slope = -(apart * lost[:, None]).mean(axis=0) + by.penalty * weights
        curve = apart.T @ (apart * (lost * (1 - lost))[:, None]) / number + by.penalty * np.eye(FEATURES)
        step = np.linalg.solve(curve, slope)
        weights -= step
        if np.abs(step).max() < 1e-6:
            break
    model = Model(centre, scale, weights, 0.0, 1.0)
    return replace(model, threshold=score_quantile(documents, model, len(bad) / len(label)))


def score_quantile(documents: DataFrame, model: Model, share: float) -> float:
    """The raw score below which this share of all documents is."""

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(batches):
            yield pa.RecordBatch.from_arrays([pa.array(model.raw(batch))], ["raw"])

    found = documents.select("text").mapInArrow(measure, "raw double").approxQuantile("raw", [share], 1e-3)
    return found[0] if found else 0.0


def scored(documents: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score, predicted) of every row of documents (doc_id, text).

    score is in [0, 1], higher if label 1 is likelier; predicted is 1 from 0.5 on.  Null and empty texts are measured as
    empty ones.  Null, tied and repeated doc_ids are passed on as they are; no rows give no rows; other columns are not
    looked at.
    """

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(batches):
            found = model.scores(batch)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found),
                                              pa.array((found >= 0.5).astype(np.int32))],
                                             ["doc_id", "score", "predicted"])

    return documents.select("doc_id", "text").mapInArrow(score, "doc_id long, score double, predicted int")
