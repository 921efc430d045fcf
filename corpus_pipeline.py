"""A corpus pipeline: five stages, each over all that the one before kept.

Part of subpackage llm.  run() writes each stage's result to the shared folder and reads it again, so a lost executor
costs a stage's tasks at most.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from metermill.llm import toxicity
from metermill.llm.byte_bpe import round_trip
from metermill.llm.common import small_batches, staged, table
from metermill.llm.decontamination import without_contaminated
from metermill.llm.near_duplicates import NearDuplicates, without_near_duplicates
from metermill.llm.personal_data import masked


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that the toxicity model, learnt from the labels, rejects.

    Each row goes by its own text: rows that share an id, or have none, are judged one by one.  Null and empty texts have
    no words and stay.  Labels of unknown ids, null labels and repeated ones (the smaller counts) do no harm; without any,
    nothing is rejected.  No rows give no rows; columns come back as they are.
    """
    small_batches(spark)
    return toxicity.without_toxic(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one row of each group of near duplicates: the smallest doc_id, rows with an id of their own first.

    Rows that share an id, or have none, are documents of their own: each goes or stays by its text, and of equal rows
    one stays.  Null and empty texts are near nothing and stay.  No rows give no rows; columns come back as they are.
    """
    return without_near_duplicates(docs, NearDuplicates())


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents in which a window of a benchmark item occurs.

    Rows go by id and text, so those that share an id are judged one by one.  Null and empty texts stay; null and empty
    items have no window.  No rows or no items: nothing is dropped.  Columns come back as they are.
    """
    return without_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces personal data in the texts by its kind; every row stays.

    Null texts stay null, empty ones empty; rows that share an id are masked one by one.  No rows give no rows; columns
    come back as they are.
    """
    return masked(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Encodes the texts, decodes the ids, and returns counts and digests of both: a row for each row, with its doc_id.

    Null and empty texts have no ids.  No rows give no rows; other columns are left out.
    """
    return round_trip(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))


STAGES = [("toxicity", reject_toxic), ("near_duplicates", drop_near_duplicates),
          ("decontamination", drop_contaminated), ("personal_data", mask_personal_data), ("byte_bpe", encode)]

#: SQL can express neither the fitted model nor the merges of the encoding.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
