"""What document filters remove in every order of applying them, by min-plus removal ranks.

Documents that fail the same filters are alike, so Spark counts them by part, mask of failed filters and labels.  For
each part the masks' matrix is then combined with the orders' inverse permutations: the step at which a mask is removed
is the minimum, over the filters it fails, of their positions in the order.  Scattering the counts by that step gives
what every step removes, keeps and finds gone already.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: One letter for each filter; bit n of a mask says that filter n is failed.
FILTERS = "ABCDE"
REPEATED = FILTERS.index("E")
ORDERS = list(permutations(range(len(FILTERS))))
CAPITALS = bytes(range(0x41, 0x5B))
BLANKS = b" \t\n\v\f\r"
#: Bytes of a text whose words are looked at together.
PIECE_BYTES = 1 << 20


@dataclass(frozen=True)
class Filters:
    least_words: int = 100  #: A: fewer words
    least_distinct_percent: int = 80  #: B: a smaller share of distinct words
    most_capitals_percent: int = 10  #: C: a larger share of A-Z among the code points
    symbols: str = "#$%&*|"  #: D: holds any of these ASCII signs


def word_counts(data: bytes) -> tuple[int, int]:
    """(words, distinct words) of a text; words are what blanks part."""
    count, distinct, begin = 0, set(), 0
    while begin < len(data):
        end = begin + PIECE_BYTES
        while end < len(data) and data[end] not in BLANKS:
            end += 1
        words = data[begin:end].split()
        count += len(words)
        distinct.update(words)
        begin = end
    return count, len(distinct)


def text_mask(data: bytes, points: int, by: Filters) -> int:
    """The filters, but for the last one, that a text fails."""
    words, distinct = word_counts(data)
    capitals = len(data) - len(data.translate(None, CAPITALS))
    return ((words < by.least_words)
            | (100 * distinct < by.least_distinct_percent * words) << 1
            | (100 * capitals > by.most_capitals_percent * points) << 2
            | (len(data.translate(None, by.symbols.encode())) < len(data)) << 3)


def measured(documents: DataFrame, by: Filters) -> DataFrame:
    """(doc_id, part, mask, digest) of each document: digest tells texts apart."""

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            masks, digests = [], []
            for value in batch.column("text"):
                text = value.as_py() or ""
                data = text.encode()
                masks.append(text_mask(data, len(text), by))
                digests.append(hashlib.sha256(data).digest())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("part"), pa.array(masks, pa.int32()),
                                              pa.array(digests, pa.binary())], ["doc_id", "part", "mask", "digest"])

    return documents.select("doc_id", F.coalesce("lang", F.lit("")).alias("part"), "text").mapInArrow(
        measure, "doc_id long, part string, mask int, digest binary")


def mask_counts(documents: DataFrame, labels: DataFrame, by: Filters) -> DataFrame:
    """(part, mask, good, toxic, n): how many documents of a part fail just these filters and have these labels."""
    kinds = ["part", "mask", "good", "toxic"]

    def marked(name: str) -> Column:
        return F.max(F.coalesce((F.col(name) == 1).cast("int"), F.lit(0)))

    # Repeated rows are counted before anything is dealt by id, so that a hot id costs a row of each task.
    rows = measured(documents, by).groupBy("doc_id", "part", "mask", "digest").agg(F.count("*").alias("n"))
    known = labels.filter("doc_id is not null").groupBy("doc_id").agg(
        marked("quality").alias("good"), marked("toxic").alias("toxic"))
    named = (rows.filter("doc_id is not null").join(known, "doc_id", "left")
             .select("doc_id", "part", "mask", "digest", "n", *(F.coalesce(one, F.lit(0)).alias(one) for one in kinds[2:])))
    # Of a text, the rows of the smallest id pass the last filter, all others fail it.  Copies are summed by task
    # first; what meets for one text is a row for each part and label.
    alike = named.groupBy("digest", *kinds).agg(
        F.sum("n").alias("n"), F.min(F.struct("doc_id", "n")).alias("first"))
    least = F.min("first.doc_id").over(Window.partitionBy("digest"))
    alike = alike.withColumn("passing", F.when(F.col("first.doc_id") == least, F.col("first.n")).otherwise(F.lit(0)))
    failing = F.col("mask").bitwiseOR(F.lit(1 << REPEATED))
    split = alike.select("part", "good", "toxic", F.inline(F.array(
        F.struct("mask", F.col("passing").alias("n")),
        F.struct(failing.alias("mask"), (F.col("n") - F.col("passing")).alias("n")))))
    unnamed = rows.filter("doc_id is null").select("part", F.lit(0).alias("good"), F.lit(0).alias("toxic"), "mask", "n")
    return split.unionByName(unnamed).filter("n > 0").groupBy(kinds).agg(F.sum("n").alias("n"))


def removal_steps(masks: np.ndarray, orders: np.ndarray) -> np.ndarray:
    """[mask, order]: the step, from 0, at which the order removes the mask, or the number of filters for never.

    A min-plus product: a failed filter adds nothing to its position, one that is passed adds more than any.
    """
    filters = orders.shape[1]
    positions = np.argsort(orders, axis=1)
    passed = np.where(masks[:, None] >> np.arange(filters) & 1, 0, filters)
    steps = np.full((len(masks), len(orders)), filters)
    for one in range(filters):
        np.minimum(steps, passed[:, one, None] + positions[None, :, one], out=steps)
    return steps


def scattered(steps: np.ndarray, weights: np.ndarray, filters: int) -> np.ndarray:
    """[order, step]: the weights of the masks that the order removes at the step; the last step is never."""
    found = np.zeros((steps.shape[1], filters + 1), np.int64)
    np.add.at(found, (np.broadcast_to(np.arange(steps.shape[1]), steps.shape), steps), weights[:, None])
    return found


REPORT = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def report(part: str, masks: np.ndarray, good: np.ndarray, toxic: np.ndarray, n: np.ndarray) -> pa.Table:
    """The rows of one part, from its counts by mask and labels."""
    count, orders = len(FILTERS), np.array(ORDERS)
    steps = removal_steps(masks, orders)
    removed = scattered(steps, n, count)
    fails = ((masks[:, None] >> np.arange(count) & 1) * n[:, None]).sum(axis=0)
    alone = np.array([n[masks == 1 << one].sum() for one in range(count)])
    here = removed[:, :count]
    # A document that fails a step's filter and isn't removed by it was removed before.
    values = {"kept": n.sum() - np.cumsum(here, axis=1), "removed": here, "redundant": fails[orders] - here,
              "unique_fails": alone[orders], "good_lost": scattered(steps, n * good, count)[:, :count],
              "toxic_lost": scattered(steps, n * toxic, count)[:, :count]}
    values["shapley"] = np.bincount(orders.ravel(), here.ravel(), count).astype(np.int64)[orders]
    names = ["".join(FILTERS[one] for one in order) for order in ORDERS]
    rows = orders.size
    return pa.table({"part": pa.array([part] * rows, pa.string()), "filter_order": np.repeat(names, count),
                     "step": pa.array(np.tile(np.arange(1, count + 1), len(orders)), pa.int32()),
                     **{name: pa.array(values[name].ravel(), pa.int64()) for name in REPORT}})


def filter_audit(documents: DataFrame, labels: DataFrame, by: Filters = Filters()) -> DataFrame:
    """For each part (lang) of documents (doc_id, text, lang), each order of the five filters and each step: documents
    kept after it, removed by it, failing its filter but removed before (redundant), failing only its filter
    (unique_fails), removed ones labelled good or toxic, and what its filter removes over all orders (shapley).

    Null and empty texts have no words and are equal; a null lang is the part "".  Filter E is failed by a row whose text
    a smaller doc_id has, in any part; rows with one doc_id never make each other fail, and a null doc_id neither fails it
    nor makes others fail, and has no labels.  Of repeated labels a 1 counts; null labels count as 0.  No documents give no
    rows.  Other columns are not looked at.
    """
    counts = mask_counts(documents, labels, by)

    def reported(rows: pa.Table) -> pa.Table:
        masks, good, toxic, n = (rows.column(one).to_numpy() for one in ("mask", "good", "toxic", "n"))
        return report(rows.column("part")[0].as_py(), masks.astype(np.int64), good, toxic, n)

    # A part has at most 128 rows here, however many documents it has.
    return counts.groupBy("part").applyInArrow(
        reported, "part string, filter_order string, step int, " + ", ".join(f"{name} long" for name in REPORT))
