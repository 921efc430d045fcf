"""CSV sinks and Parquet staging."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


#: Rows in a compressed CSV file, which one task reads.
COMPRESSED_ROWS = 1_000_000


def write_csv(readings: DataFrame, path: str, single_file: bool = False, compression: str | None = None) -> None:
    """A CSV directory with headers; NULL and "" both print as nothing.

    ``single_file`` sends all rows through one task: for small extracts only.  With ``compression`` ("gzip", say) files are
    a small part of their text, but cannot be split when they are read, so a task writes several.
    """
    rows = readings.coalesce(1) if single_file else readings
    writer = rows.write.mode("overwrite").option("header", True).option("emptyValue", "")
    if compression:
        writer = writer.option("compression", compression).option("maxRecordsPerFile", 0 if single_file else COMPRESSED_ROWS)
    writer.csv(path)


def shared_folder(spark: SparkSession, default: str) -> str:
    """A fresh folder under the cluster's shared checkpoint folder, or under ``default`` without one."""
    root = spark.conf.get("spark.checkpoint.dir", None) or default
    return f"{root.rstrip('/')}/metermill-{uuid.uuid4().hex}"


def working_folder(spark: SparkSession) -> str:
    """A fresh folder under the cluster's shared checkpoint folder; a temporary one stands in on a single machine."""
    if not spark.conf.get("spark.checkpoint.dir", None):
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        spark.conf.set("spark.checkpoint.dir", tempfile.mkdtemp(prefix="metermill-"))
    return shared_folder(spark, "")


def remove(spark: SparkSession, path: str) -> None:
    """Remove a folder, if it is there, through the file system that its address names."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(target, True)


def stage(documents: DataFrame, path: str) -> DataFrame:
    """Write documents as Parquet and read them back.

    The XML is parsed once; later readers prune to single nested fields, and a lost executor costs a
    re-read instead of a re-parse.
    """
    documents.write.mode("overwrite").parquet(path)
    return documents.sparkSession.read.schema(documents.schema).parquet(path)
