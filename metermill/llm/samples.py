"""Bounded samples of labelled rows, and the word counts of texts."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def labelled(documents: DataFrame, labels: DataFrame, label: str, where: Column, rows: int) -> DataFrame:
    """(doc_id, text, label) of at most `rows` labelled documents: those whose ids hash lowest.

    The sample's ids are broadcast: rows is their bound.  An id that is labelled twice counts with the smaller label, and
    one that several rows of documents have with the text that sorts first, so the sample keeps its bound.
    """
    chosen = (labels.filter(F.col("doc_id").isNotNull() & F.col(label).isin(0, 1) & where)
              .groupBy("doc_id").agg(F.min(F.col(label).cast("int")).alias("label"))
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows))
    return (documents.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
            .groupBy("doc_id", "label").agg(F.min("text").alias("text")))


def counted(keys: np.ndarray, owner: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(owner, key, count) of the pairs, keys being below size."""
    pairs, counts = np.unique(owner * size + keys, return_counts=True)
    return pairs // size, pairs % size, counts
