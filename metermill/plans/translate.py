"""Documents -> canonical readings of one kind.

    scan -> project (document columns, once per document) -> explode per level -> project

There is no shuffle: every document is translated where it was read, so a meter or source that holds
a large part of all rows costs no more than its share of the input.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from metermill.functions import scalars as S
from metermill.functions.quality import quality_codes
from metermill.operators.unnest import explode_levels
from metermill.plans.kinds import METERING_TYPE, STATUS, ReadingKind
from metermill.schemas import CANONICAL_COLUMNS
from metermill.sources.options import short_methods

Text = str | Column

DOCUMENT_COLUMNS = ("servicePointId", "deviceId", "primarySource", "documentTime")


def text_literal(text: str) -> str:
    """A text as a SQL literal."""
    escaped = text.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def document_rows(documents: DataFrame, arrays: Sequence[str], owner: Text | None = None,
                  guid_file: Text | None = None) -> DataFrame:
    """What readings take from their document, computed before they are unnested, and the arrays."""
    short_methods(documents.sparkSession)
    columns = [
        S.service_point(F.col("Meter._SdpIdent"), F.col("Meter._MeterIrn")).alias("servicePointId"),
        F.col("Meter._MeterIrn").alias("deviceId"),
        S.primary_source(F.col("_Source")).alias("primarySource"),
        F.col("_CollectionTime").alias("documentTime"),
    ]
    for name, value in (("owner", owner), ("guidFile", guid_file)):
        if value is not None:
            columns.append((F.lit(value) if isinstance(value, str) else value).alias(name))
    return documents.select(*columns, *dict.fromkeys(arrays))


def canonical(readings: DataFrame, values: dict[str, Column], constants: dict[str, str]) -> DataFrame:
    """The thirty columns in order: from the values, the document columns at hand, the constants, else "".

    ``time`` among the values fills both reading times; ``quality`` the DST status and the codes.
    """
    values = dict(values)
    if "quality" in values:
        # Settle the rule position first, so that the four lookups do not each repeat the search.
        readings = readings.withColumn("quality", values.pop("quality"))
        values |= quality_codes(F.col("quality"))
    filled = readings.select(*[name for name in (*DOCUMENT_COLUMNS, "owner", "guidFile") if name in readings.columns],
                             *[column.alias(name) for name, column in values.items()])
    constants = {"meteringType": METERING_TYPE, "estatus": STATUS, **constants}
    at_hand = set(filled.columns)

    def output(name: str) -> str:
        if name in ("readingDateSource", "readingLocalTime") and "time" in at_hand:
            return f"time AS {name}"
        return name if name in at_hand else f"{text_literal(constants.get(name, ''))} AS {name}"

    # As SQL texts, the many constant columns cost one call to the JVM together.
    return filled.selectExpr(*[output(name) for name in CANONICAL_COLUMNS])


def kind_readings(parents: DataFrame, kind: ReadingKind) -> DataFrame:
    """The canonical readings of one kind, from document rows."""
    others = [c for c in parents.columns if c in DOCUMENT_COLUMNS or c in ("owner", "guidFile")]
    readings, elements = explode_levels(parents.select(*others, kind.array), kind.array, kind.steps)
    if kind.keep is not None:
        readings = readings.filter(kind.keep(*elements))
    return canonical(readings, kind.reading(F.col("documentTime"), *elements), kind.constants)


def translate(documents: DataFrame, kind: ReadingKind, owner: Text | None = None,
              guid_file: Text | None = None) -> DataFrame:
    """The canonical readings of one kind.

    ``owner`` and ``guid_file`` replace the kind's own texts; give a column (such as the file name
    that ``read_documents`` can add) to take them from the document.
    """
    return kind_readings(document_rows(documents, [kind.array], owner, guid_file), kind)
