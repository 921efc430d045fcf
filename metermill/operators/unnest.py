"""Unnesting of array columns.  All of these are narrow: no shuffle, rows stream out of the generator."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Step = Callable[[Column], Column]


def zip_explode(frame: DataFrame, arrays: Sequence[str], into: str = "zipped") -> DataFrame:
    """One row per position of parallel arrays, as a struct column.

    A row is dropped when any of the arrays is NULL.  Where the arrays come from one array of structs,
    ``explode_levels`` on that array gives the same rows without building the zipped copy.
    """
    return frame.withColumn(into, F.explode(F.arrays_zip(*arrays)))


def explode_levels(frame: DataFrame, array: str, steps: Sequence[Step] = ()) -> tuple[DataFrame, list[Column]]:
    """Explode ``array``, then for every step the array the step finds in the element above it.

    Gives the frame and one element column per level.  Parents whose array is NULL or empty drop out
    at every level.  Only the columns of ``frame`` and the elements are carried on.
    """
    kept = [c for c in frame.columns if c != array]
    elements = ["element0"]
    # From a bare column Catalyst infers filters on the array and its size, each of which builds a derived array once more.
    found = F.col(array).isNotNull()
    frame = frame.filter(found).select(*kept, F.explode(F.when(found, F.col(array))).alias("element0"))
    for depth, step in enumerate(steps, start=1):
        inner = step(F.col(f"element{depth - 1}"))
        frame = frame.select(*kept, *elements, F.explode(inner).alias(f"element{depth}"))
        elements.append(f"element{depth}")
    return frame, [F.col(name) for name in elements]


def nested_array(array: Column, steps: Sequence[Step], row: Callable[..., Column], empty: Column,
                 keep: Callable[..., Column] | None = None) -> Column:
    """The rows of ``explode_levels`` as one array, built inside the row by higher-order functions."""

    def level(current: Column, remaining: Sequence[Step], above: tuple[Column, ...]) -> Column:
        if not remaining:
            kept = current if keep is None else F.filter(current, lambda e: keep(*above, e))
            return F.transform(kept, lambda e: row(*above, e))
        step, *rest = remaining
        return F.flatten(F.transform(
            current, lambda e: F.coalesce(level(step(e), rest, (*above, e)), empty)))

    return F.coalesce(level(array, list(steps), ()), empty)


def nested_count(array: Column, steps: Sequence[Step]) -> Column:
    """How many elements the array has, or those that the first step finds in them; 0 for NULL."""
    if not steps:
        return F.coalesce(F.size(array), F.lit(0))
    return F.coalesce(F.aggregate(array, F.lit(0), lambda n, e: n + F.coalesce(F.size(steps[0](e)), F.lit(0))), F.lit(0))


def slice_starts(array: Column, steps: Sequence[Step], length: int) -> Column:
    """Where ``nested_slice`` begins to cover the array in slices of ``length``: structs (outer, begin)."""

    def starts(outer: Column, count: Column) -> Column:
        found = F.sequence(F.lit(0), F.greatest(F.ceil(count / length) - 1, F.lit(0)).cast("int"))
        return F.transform(found, lambda n: F.struct(outer.alias("outer"), (n * length).alias("begin")))

    if not steps:
        return starts(F.lit(0), F.size(array))
    return F.flatten(F.transform(array, lambda e, at: starts(at, F.coalesce(F.size(steps[0](e)), F.lit(0)))))


def nested_slice(array: Column, steps: Sequence[Step], row: Callable[..., Column], empty: Column,
                 keep: Callable[..., Column] | None, outer: Column, begin: Column, length: int) -> Column:
    """``length`` of the rows of ``nested_array``, or rather those of ``length`` elements at its first two levels."""
    if not steps:
        return nested_array(F.slice(array, begin + 1, F.lit(length)), (), row, empty, keep)
    first, *rest = steps
    return nested_array(F.slice(array, outer + 1, F.lit(1)), (lambda e: F.slice(first(e), begin + 1, F.lit(length)), *rest),
                        row, empty, keep)
