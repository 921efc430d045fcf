"""Rows in the order of a key: consecutive ranges of it, each in order within one partition."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LEAST = -(2**63)  #: where rows without a key stand


@dataclass(frozen=True)
class Ranges:
    """As many ranges of a long column as there are shuffle partitions, of about as many rows each."""

    key: str
    splits: list[int]  #: the first key of each range but the first

    @classmethod
    def of(cls, rows: DataFrame, key: str) -> Ranges:
        number = max(1, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
        shares = [one / number for one in range(1, number)]
        found = rows.select(F.col(key).cast("double").alias(key)).approxQuantile(key, shares, 0.2 / number)
        return cls(key, sorted({int(one) for one in found}))

    def value(self) -> Column:
        return F.coalesce(F.col(self.key), F.lit(LEAST))

    def part(self) -> Column:
        if not self.splits:
            return F.lit(0)
        splits = F.array(*map(F.lit, self.splits))
        return F.size(F.filter(splits, lambda one: one <= self.value()))

    def dealt(self, rows: DataFrame, part: Column | str, *order: str | Column) -> DataFrame:
        """The rows, each part in a partition of its own, ordered as told."""
        rows = rows.withColumn("part", F.col(part) if isinstance(part, str) else part)
        return rows.repartitionById(len(self.splits) + 1, F.col("part").cast("int")).sortWithinPartitions("part", *order)
