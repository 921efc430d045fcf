"""Set operators."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce
from itertools import accumulate

from pyspark.sql import DataFrame
from pyspark.sql import types as T

_NUMBERS = (T.IntegerType, T.LongType, T.DoubleType)


def union_all(frames: Iterable[DataFrame]) -> DataFrame:
    """UNION ALL by name.  Catalyst flattens the chain into one n-way union."""
    return reduce(DataFrame.unionByName, frames)


def wider(left: T.DataType, right: T.DataType) -> T.DataType:
    """The type of a column that is united from both: equal ones stay, numbers become the wider, all else is text."""
    if left == right:
        return left
    if isinstance(left, _NUMBERS) and isinstance(right, _NUMBERS):
        return max(left, right, key=lambda one: [isinstance(one, kind) for kind in _NUMBERS].index(True))
    return T.StringType()


def widening(types: Sequence[T.DataType]) -> list[list[T.DataType]]:
    """What a column goes through in a union from left to right: for each branch, the types it is cast to, in order.

    A branch takes the type of the union so far, and then every wider one that later branches bring.  So a whole number
    that is united with a double before it is united with a text reads "14.0", and "14" otherwise.
    """
    united = list(accumulate(types, wider))
    paths = []
    for at, own in enumerate(types):
        path, last = [], own
        for one in united[at:]:
            if one != last:
                path.append(one)
                last = one
        paths.append(path)
    return paths
