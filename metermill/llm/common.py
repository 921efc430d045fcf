"""What the operators share: tables, the shared folder, batches in bounded blocks."""

from __future__ import annotations

import functools
import os
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of text that one numpy block covers; a longer document is a block of its own.
BLOCK_BYTES = 1 << 20
DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


ROOT = Path(__file__).resolve().parents[2]
SHIPPED: set[str] = set()


def ship(query: Callable) -> Callable:
    """The query, so that executors get this package with the first run where PYTHONPATH doesn't hold it."""

    @functools.wraps(query)
    def shipped(spark: SparkSession, *args: object) -> DataFrame:
        known = [Path(one or ".").resolve() for one in os.environ.get("PYTHONPATH", "").split(os.pathsep) if one]
        application = spark.sparkContext.applicationId
        if ROOT not in known and application not in SHIPPED:
            SHIPPED.add(application)
            with zipfile.ZipFile(name := f"{tempfile.mkdtemp()}/metermill.zip", "w") as file:
                for source in (ROOT / "metermill").rglob("*.py"):
                    file.write(source, source.relative_to(ROOT))
            spark.sparkContext.addPyFile(name)
        small_batches(spark)
        return query(spark, *args)

    return shipped


def small_batches(spark: SparkSession) -> None:
    """Fewer rows at once between Spark and Python, as texts are long."""
    if spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == "10000":  # Spark's own default
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder that all executors share: spark.checkpoint.dir of the session.

    Only where that is unset, as in tests on one machine, one is made for this session.
    """
    if not (folder := spark.conf.get("spark.checkpoint.dir", None)):
        spark.conf.set("spark.checkpoint.dir", folder := tempfile.mkdtemp(prefix="metermill-llm-"))
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder)
    return folder.rstrip("/")


def fresh_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def staged(rows: DataFrame, name: str, drop_shuffles: bool = False) -> DataFrame:
    """The rows, written once to the shared folder and read from there, so that lineage ends here.

    drop_shuffles: shuffle files made for them go as soon as they are written, not once the driver collects garbage.
    """
    return staged_parts([rows], name, drop_shuffles)


def staged_parts(parts: list[DataFrame], name: str, drop_shuffles: bool = False) -> DataFrame:
    """The rows of all parts, of one schema, written one after the other as `staged` does."""
    spark = parts[0].sparkSession
    folder, before = fresh_folder(spark, name), spark.conf.get(DROP_SHUFFLES, "false")
    spark.conf.set(DROP_SHUFFLES, "true" if drop_shuffles else before)
    try:
        for rows in parts:
            rows.write.mode("append").parquet(folder)
    finally:
        spark.conf.set(DROP_SHUFFLES, before)
    result = spark.read.schema(parts[0].schema).parquet(folder)
    result.staged_in = folder
    return result


def emptied(rows: DataFrame) -> None:
    """Staged rows that nothing reads any more give their disk back: their folder is overwritten with none."""
    rows.sparkSession.createDataFrame([], rows.schema).write.mode("overwrite").parquet(rows.staged_in)


def checkpointed(rows: DataFrame) -> DataFrame:
    shared_folder(rows.sparkSession)
    return rows.checkpoint()


def unused(name: str, rows: DataFrame) -> str:
    """The name, or one that starts with it, which no column has."""
    taken = {column.lower() for column in rows.columns}
    while name.lower() in taken:
        name += "_"
    return name


def text_or_empty(text: str | Column) -> Column:
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column, joined, and the n + 1 bounds of the texts in them; null reads as empty."""
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset:column.offset + len(column) + 1]
    bounds = bounds.astype(np.int64)
    if data is None or bounds[-1] == bounds[0]:
        return np.zeros(0, np.uint8), bounds - bounds[0]
    return np.frombuffer(data, np.uint8)[bounds[0]:bounds[-1]], bounds - bounds[0]


def blocks(batches: Iterator[pa.RecordBatch], text: str = "text",
           size: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches cut between rows, so that a block holds about `size` bytes of text."""
    for batch in batches:
        bounds = text_bytes(batch.column(text))[1] if batch.num_rows else [0]
        begin = 0
        while begin < batch.num_rows:
            end = int(np.searchsorted(bounds, bounds[begin] + size, "right")) - 1
            end = min(max(end, begin + 1), batch.num_rows)
            yield batch.slice(begin, end - begin)
            begin = end


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads them evenly (the finalizer of splitmix64)."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def numbers(seed: int, count: int) -> np.ndarray:
    """`count` fixed 64-bit numbers that belong to the seed."""
    return mixed((np.arange(count, dtype=np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
                 + np.uint64(seed * 0xD1B54A32D192ED03 % 2**64))


def lists(values: np.ndarray, bounds: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(values))
