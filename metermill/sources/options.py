"""Options every XML read and write shares, and session settings."""

from pyspark.sql import SparkSession

from metermill.schemas import ROOT_TAG, ROW_TAG, VALUE_TAG

# A blank attribute is a missing one.
XML_OPTIONS = {"rootTag": ROOT_TAG, "rowTag": ROW_TAG, "nullValue": "", "valueTag": VALUE_TAG}

_METHOD_LIMIT = "spark.sql.codegen.hugeMethodLimit"


def short_methods(spark: SparkSession) -> None:
    """Stages whose generated method HotSpot would not compile (over 8000 bytes) run operator by operator.

    Thirty columns built from nested ones soon outgrow that, and interpreted they take two to three times as long.  A
    session that sets the limit itself keeps its own.
    """
    if spark.conf.get(_METHOD_LIMIT) == "65535":
        spark.conf.set(_METHOD_LIMIT, "8000")


_BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def small_batches(spark: SparkSession) -> None:
    """Fewer texts at once between Spark and Python; a session that sets the number itself keeps its own."""
    if spark.conf.get(_BATCH_ROWS) == "10000":
        spark.conf.set(_BATCH_ROWS, "2000")
