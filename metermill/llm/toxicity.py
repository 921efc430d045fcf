"""Toxicity grades by cumulative-link ordinal regression on sparse counts of words and stems.

Grade 0 is a document labelled clean; the toxic ones have grades 1 to 3 by terciles of how often words that mark toxicity
occur in them.  One weight per word is shared by all thresholds: P(grade > k) = sigmoid(w x - theta_k), theta ascending.
A document's severity is its expected grade, the sum of these probabilities.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import blocks, lists, mixed, staged, text_bytes
from .samples import counted, labelled
from .words import LOWER, PUNCTUATION, segment_hashes, words_of

GRADES = 4
STEM, STEMS = 5, np.uint64(0x5851F42D4C957F2D)  # the latter tells stems from words


@dataclass(frozen=True)
class Toxicity:
    training_rows: int = 20_000  #: bound of the labelled sample; everything else covers all documents
    least_documents: int = 4  #: of the sample, in which a feature occurs
    least_sure: float = 2.5  #: a feature's log odds differ by so many standard errors at least
    penalty: float = 2e-5
    rounds: int = 500
    reject_from: float = 0.7  #: P(grade > 0) from which a document counts as toxic


@dataclass(frozen=True)
class Model:
    words: np.ndarray  #: hashes of the feature words, ascending
    weights: np.ndarray
    thresholds: np.ndarray

    def probabilities(self, batch: pa.RecordBatch) -> np.ndarray:
        """P(grade > k) for each text (rows) and k."""
        owner, feature, counts = features_of(batch, self.words)
        score = np.bincount(owner, np.log1p(counts) * self.weights[feature], batch.num_rows)
        return sigmoid(score[:, None] - self.thresholds)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def terms_of(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """(hash, text) of every word and, of longer ones, of their first STEM bytes, as endings vary; in order of texts."""
    data, bounds = text_bytes(batch.column("text"))
    words = words_of(data, bounds, PUNCTUATION)
    owner = np.searchsorted(words.bounds, np.arange(len(words.hashes)), "right") - 1
    long = np.flatnonzero(words.ends - words.begins > STEM)
    if not len(long):
        return words.hashes, owner
    stems = segment_hashes(LOWER[data][words.begins[long][:, None] + np.arange(STEM)].ravel(), np.full(len(long), STEM))
    hashes, owners = np.concatenate([words.hashes, mixed(stems ^ STEMS)]), np.concatenate([owner, owner[long]])
    order = np.argsort(owners, kind="stable")
    return hashes[order], owners[order]


def features_of(batch: pa.RecordBatch, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, feature, count) of the chosen words that occur."""
    if not len(chosen):
        return (np.zeros(0, np.int64),) * 3
    hashes, owner = terms_of(batch)
    at = np.minimum(np.searchsorted(chosen, hashes), len(chosen) - 1)
    hit = np.flatnonzero(chosen[at] == hashes)
    return counted(at[hit], owner[hit], len(chosen))


def word_counts(sample: DataFrame) -> DataFrame:
    """(doc_id, label, words, counts): distinct word hashes of each sampled document, and how often they occur."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(batches):
            hashes, owner = terms_of(batch)
            ends = np.searchsorted(owner, np.arange(batch.num_rows), "right")
            each = [np.unique(hashes[begin:end], return_counts=True)
                    for begin, end in zip([0, *ends[:-1].tolist()], ends.tolist(), strict=True)]
            bounds = np.concatenate([[0], np.cumsum([len(one) for one, _ in each])])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("label"),
                 lists(np.concatenate([one for one, _ in each]).view(np.int64), bounds),
                 lists(np.concatenate([number for _, number in each]).astype(np.int32), bounds)],
                ["doc_id", "label", "words", "counts"])

    return sample.select("doc_id", "text", "label").mapInArrow(
        count, "doc_id long, label int, words array<long>, counts array<int>")


def fit(documents: DataFrame, labels: DataFrame, where: Column | None = None, by: Toxicity = Toxicity()) -> Model:
    """The model of labels (doc_id, toxic 0 or 1), learnt from rows that satisfy `where` alone; without both labels among the sample nothing is toxic."""
    where = F.lit(True) if where is None else where
    sample = staged(word_counts(labelled(documents, labels, "toxic", where, by.training_rows)), "toxic-sample")
    total = {row["label"]: row["n"] for row in sample.groupBy("label").agg(F.count("*").alias("n")).collect()}
    if len(total) < 2:
        return Model(np.zeros(0, np.uint64), np.zeros(0), np.full(GRADES - 1, 40.0))
    toxic, clean = F.col("toxic"), F.col("found") - F.col("toxic")
    odds = (F.log((toxic + 0.5) / (total[1] - toxic + 0.5)) - F.log((clean + 0.5) / (total[0] - clean + 0.5)))
    chosen = (sample.select("label", F.explode("words").alias("word"))
              .groupBy("word").agg(F.count("*").alias("found"), F.sum("label").alias("toxic"))
              .filter(F.col("found") >= by.least_documents)
              .select("word", (odds / F.sqrt(1 / (toxic + 0.5) + 1 / (clean + 0.5))).alias("sure"))
              .filter(F.abs("sure") >= by.least_sure)
              .orderBy("word").collect())  # the sample's bound is theirs
    words = np.array([row["word"] for row in chosen], np.int64).view(np.uint64)
    order = np.argsort(words)
    words, marks = words[order], np.array([row["sure"] for row in chosen])[order] > 3
    known = [row["word"] for row in chosen]
    # Columns of numbers, not rows of objects: the chosen words of at most training_rows documents.
    rows = sample.select("doc_id", "label").orderBy("doc_id").toArrow()
    doc_ids, label = (rows.column(name).to_numpy() for name in ("doc_id", "label"))
    hits = (sample.select("doc_id", F.explode(F.arrays_zip("words", "counts")).alias("one"))
            .select("doc_id", F.col("one.words").alias("word"), F.col("one.counts").alias("count"))
            .filter(F.col("word").isin(known)).orderBy("doc_id", "word").toArrow())
    owner = np.searchsorted(doc_ids, hits.column("doc_id").to_numpy())
    feature = np.searchsorted(words, hits.column("word").to_numpy().view(np.uint64))
    counts = hits.column("count").to_numpy().astype(float)
    marked = np.bincount(owner, counts * marks[feature], len(label))
    cuts = np.quantile(marked[label == 1], [1 / 3, 2 / 3])
    grades = np.where(label == 1, 1 + np.searchsorted(cuts, marked), 0)
    return Model(words, *ordinal(owner, feature, np.log1p(counts), grades, len(words), by))


def ordinal(owner: np.ndarray, feature: np.ndarray, value: np.ndarray, grades: np.ndarray, width: int,
            by: Toxicity) -> tuple[np.ndarray, np.ndarray]:
    """Weights and ascending thresholds of greatest penalised likelihood, by Adam's steps over all rows."""
    number = len(grades)
    above = np.array([(grades > k).mean() for k in range(GRADES - 1)])
    thresholds = -np.log((above + 1e-3) / (1 - above + 1e-3))
    gaps = np.log(np.maximum(np.diff(thresholds), 1e-2))
    at = np.concatenate([np.zeros(width), thresholds[:1], gaps])
    mean, square = np.zeros_like(at), np.zeros_like(at)

    def cuts(point: np.ndarray) -> np.ndarray:
        return point[width] + np.concatenate([[0], np.cumsum(np.exp(point[width + 1:]))])

    low, high = grades - 1, grades
    for step in range(1, by.rounds + 1):
        weights, theta = at[:width], cuts(at)
        score = np.bincount(owner, value * weights[feature], number)
        wall = np.concatenate([[-np.inf], theta, [np.inf]])
        upper, lower = sigmoid(wall[high + 1] - score), sigmoid(wall[low + 1] - score)
        upper[high == GRADES - 1], lower[low < 0] = 1, 0
        share = np.maximum(upper - lower, 1e-12)
        slope_up, slope_low = upper * (1 - upper) / share, lower * (1 - lower) / share
        by_score = (slope_up - slope_low) / number
        by_theta = np.array([(-slope_up[high == k].sum() + slope_low[low == k].sum()) / number
                             for k in range(GRADES - 1)])
        tail = np.cumsum(by_theta[::-1])[::-1]
        slope = np.concatenate([np.bincount(feature, value * by_score[owner], width) + by.penalty * weights,
                                tail[:1], tail[1:] * np.exp(at[width + 1:])])
        mean = 0.9 * mean + 0.1 * slope
        square = 0.999 * square + 0.001 * slope**2
        at = at - 0.1 * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.999**step)) + 1e-9)
    return at[:width], cuts(at)


def graded(documents: DataFrame, model: Model, by: Toxicity = Toxicity()) -> DataFrame:
    """(doc_id, severity, grade, p_toxic, toxic) of every row of documents (doc_id, text).

    severity is the expected grade (0 to 3), grade the likeliest, toxic whether p_toxic = P(grade > 0) reaches
    `reject_from`.  Null and empty texts have no features and get what the thresholds alone say.  Null, tied and repeated
    doc_ids are passed on as they are; no rows give no rows; other columns are not looked at.
    """

    def grade(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(batches):
            above = model.probabilities(batch)
            each = -np.diff(np.concatenate([np.ones((len(above), 1)), above, np.zeros((len(above), 1))], axis=1))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(above.sum(axis=1)), pa.array(each.argmax(axis=1).astype(np.int32)),
                 pa.array(above[:, 0]), pa.array(above[:, 0] >= by.reject_from)],
                ["doc_id", "severity", "grade", "p_toxic", "toxic"])

    return documents.select("doc_id", "text").mapInArrow(
        grade, "doc_id long, severity double, grade int, p_toxic double, toxic boolean")


def without_toxic(documents: DataFrame, model: Model, by: Toxicity = Toxicity()) -> DataFrame:
    """The documents, with all their columns, that are not toxic; the same pass that reads them decides."""

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(batches):
            yield batch.filter(pa.array(model.probabilities(batch)[:, 0] < by.reject_from))

    return documents.mapInArrow(keep, documents.schema)
