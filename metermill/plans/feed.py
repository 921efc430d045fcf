"""The unified feed: the readings of all kinds as one 27-column text table.

Two plans give the same rows:

* ``unified_feed`` unites the kinds.  Every branch scans the documents, so it wants a columnar source:
  over Parquet each branch reads only its own family's columns, and the branches together read each
  family once.
* ``fused_feed`` scans the documents once and builds the readings of all kinds inside the row.  Over
  XML, where parsing is the cost and nothing can be pruned below a row, it parses once instead of
  once per kind.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from metermill.functions.scalars import multiplier_text
from metermill.operators.sets import union_all, widening
from metermill.operators.unnest import nested_array, nested_count, nested_slice, slice_starts
from metermill.plans.kinds import KINDS, READING_FIELDS, ReadingKind
from metermill.plans.translate import Text, canonical, document_rows, kind_readings, text_literal
from metermill.schemas import CANONICAL_COLUMNS, FEED_COLUMNS, MULTIPLIER_PARTS

#: Readings of a family that the fused feed builds at once for a document.
SLICE_READINGS = 20_000
_SLICES = "array<struct<of:int,outer:int,begin:int>>"
# The common element type of the fused arrays.
_FUSED = "array<struct<kind:int," + ",".join(
    f"{name}:{'int' if name == 'quality' else 'string'}" for name in READING_FIELDS) + ">>"

# The feed's columns are all text, but for the device, also where no branch is text by itself.
_TEXT_CANONICAL = T.StructType([
    T.StructField(name, T.LongType() if name == "deviceId" else T.StringType()) for name in CANONICAL_COLUMNS])


def _paths(readings: Sequence[DataFrame]) -> dict[str, list[list[T.DataType]]]:
    """By column, what each branch's values are cast to, in order; the last is the feed's type."""
    schemas = [one.schema for one in readings]
    return {f.name: [path + [f.dataType] for path in widening([schema[f.name].dataType for schema in schemas])]
            for f in _TEXT_CANONICAL.fields}


def _along(value: Column, path: Sequence[T.DataType]) -> Column:
    return reduce(Column.cast, path, value)


def feed_branches(readings: Sequence[DataFrame]) -> list[DataFrame]:
    """Canonical readings of several kinds with the feed's types, widened as their union from left to right does."""
    paths = _paths(readings)
    return [one.select(*[_along(F.col(name), paths[name][at]).alias(name) for name in CANONICAL_COLUMNS])
            for at, one in enumerate(readings)]


def with_multiplier(readings: DataFrame) -> DataFrame:
    """Fold the four multiplier columns into one text, in the last column."""
    return readings.withColumn("multiplier", multiplier_text(F.col("ke"))).drop(*MULTIPLIER_PARTS)


def unified_feed(documents: DataFrame, kinds: Sequence[ReadingKind] = KINDS, owner: Text | None = None,
                 guid_file: Text | None = None) -> DataFrame:
    parents = document_rows(documents, [k.array for k in kinds], owner, guid_file)
    return with_multiplier(union_all(feed_branches([kind_readings(parents, kind) for kind in kinds])))


def _fused_reading(position: int, kind: ReadingKind, paths: dict[str, list[list[T.DataType]]]):
    """The reading of a kind as a struct of the common type, whose texts are those of the union."""

    def row(*elements: Column) -> Column:
        reading = kind.reading(F.col("documentTime"), *elements)
        fields = [F.lit(position).alias("kind")]
        for name in READING_FIELDS:
            if name == "quality":
                value = reading.get(name, F.lit(None)).cast("int")
            elif name in reading:
                value = _along(reading[name], paths["readingLocalTime" if name == "time" else name][position])
            else:
                value = F.lit(kind.constants.get(name, ""))
            fields.append(value.alias(name))
        return F.struct(*fields)

    return row


def _slice_of(position: int) -> Callable[[Column], Column]:
    return lambda one: F.struct(F.lit(position).alias("of"), one["outer"].alias("outer"), one["begin"].alias("begin"))


def fused_feed(documents: DataFrame, kinds: Sequence[ReadingKind] = KINDS, owner: Text | None = None,
               guid_file: Text | None = None, slice_readings: int = SLICE_READINGS) -> DataFrame:
    """The feed from one scan.  Of a family with more readings, a document gives ``slice_readings`` at a time."""
    parents = document_rows(documents, [k.array for k in kinds], owner, guid_file)
    arrays = list(dict.fromkeys(k.array for k in kinds))
    document = [c for c in parents.columns if c not in arrays]
    empty = F.expr(f"CAST(array() AS {_FUSED})")
    paths = _paths([kind_readings(parents, kind) for kind in kinds])
    rows = [_fused_reading(position, kind, paths) for position, kind in enumerate(kinds)]
    # A document is one row of work, and one more for each slice of a family with many readings, so that no array holds
    # more than a slice.
    large = [nested_count(F.col(kind.array), kind.steps) > slice_readings for kind in kinds]
    whole, slices = [], []
    for position, (kind, row, many) in enumerate(zip(kinds, rows, large, strict=True)):
        whole.append(F.when(many, empty).otherwise(nested_array(F.col(kind.array), kind.steps, row, empty, kind.keep)))
        starts = F.transform(slice_starts(F.col(kind.array), kind.steps, slice_readings), _slice_of(position))
        slices.append(F.when(many, starts).otherwise(F.expr(f"CAST(array() AS {_SLICES})")))
    work = F.concat(F.expr(f"CAST(array(named_struct('of', -1, 'outer', 0, 'begin', 0)) AS {_SLICES})"), *slices)
    pieces = parents.select(*document, *arrays, F.explode(work).alias("piece"))
    readings = F.when(F.col("piece.of") < 0, F.concat(*whole))
    for position, (kind, row) in enumerate(zip(kinds, rows, strict=True)):
        readings = readings.when(F.col("piece.of") == position, nested_slice(
            F.col(kind.array), kind.steps, row, empty, kind.keep, F.col("piece.outer"), F.col("piece.begin"), slice_readings))
    readings = pieces.select(*document, F.explode(readings).alias("reading"))
    values = {name: F.col(f"reading.{name}") for name in READING_FIELDS}
    for name in ("readingType", "logNumber", "version", "owner", "guidFile"):
        if name not in document:
            texts = ", ".join(text_literal(k.constants.get(name, "")) for k in kinds)
            values[name] = F.expr(f"get(array({texts}), reading.kind)")
    return with_multiplier(canonical(readings, values, {})).select(*FEED_COLUMNS)
