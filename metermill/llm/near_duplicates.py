"""Near-duplicate documents by circulant MinHash.

Two permutations of a universe of cells make all signature coordinates: the first scatters a shingle's cell, the second,
circularly shifted by k, gives coordinate k.  As consecutive shifts lie side by side in the second table, a shingle's
values for all coordinates are one slice of it.  Bands of coordinates give candidates; every link is confirmed on the
documents' full shingle sets.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import blocks, checkpointed, lists, mixed, numbers, staged, text_bytes, unused
from .components import components
from .words import shingles, words_of

UNIVERSE_BITS = 20


@dataclass(frozen=True)
class NearDuplicates:
    """Parameters.  A pair at the threshold of 0.8 shares no band with probability (1 - 0.8 ** rows) ** bands: 1.2e-7."""

    shingle_words: int = 5
    percent: int = 80  #: least similarity
    bands: int = 40
    rows: int = 5

    @property
    def coordinates(self) -> int:
        return self.bands * self.rows


class Circulant:
    """Signatures with `coordinates` values each."""

    def __init__(self, coordinates: int):
        size = 1 << UNIVERSE_BITS
        self.first = np.argsort(numbers(21, size)).astype(np.uint32)
        second = np.argsort(numbers(22, size)).astype(np.uint32)
        around = np.concatenate([second, second[:coordinates]])
        self.shifts = np.lib.stride_tricks.sliding_window_view(around, coordinates)

    def signature(self, hashes: np.ndarray) -> np.ndarray:
        at = self.first[hashes >> np.uint64(64 - UNIVERSE_BITS)]
        least = self.shifts[at[:2048]].min(axis=0)
        for begin in range(2048, len(at), 2048):
            np.minimum(least, self.shifts[at[begin:begin + 2048]].min(axis=0), out=least)
        return least


@lru_cache(maxsize=2)
def circulant_of(coordinates: int) -> Circulant:
    return Circulant(coordinates)


def distinct_sets(batch: pa.RecordBatch, size: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    hashes, bounds = shingles(words_of(*text_bytes(batch.column("text"))), size)
    for begin, end in zip(bounds[:-1], bounds[1:], strict=True):
        one = np.sort(hashes[begin:end])
        yield one[np.concatenate([[True], one[1:] != one[:-1]])] if len(one) else one


def sketches(documents: DataFrame, by: NearDuplicates) -> DataFrame:
    """(doc_id, n_shingles, set_a, set_b, bands) of every document; set_a and set_b tell different sets apart."""

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        circulant = circulant_of(by.coordinates)
        salt = numbers(23, by.bands)
        factors = numbers(24, by.rows) | np.uint64(1)
        for batch in blocks(batches):
            sizes, set_a, set_b, bands = [], [], [], []
            for one in distinct_sets(batch, by.shingle_words):
                sizes.append(len(one))
                set_a.append(int(np.add.reduce(mixed(one))) if len(one) else 0)
                set_b.append(int(np.add.reduce(mixed(one ^ np.uint64(0x5851F42D4C957F2D)))) if len(one) else 0)
                if len(one):
                    rows = circulant.signature(one).reshape(by.bands, by.rows).astype(np.uint64)
                    bands.append(mixed((rows * factors).sum(axis=1, dtype=np.uint64) + salt))
            of = np.array(sizes) > 0
            joined = np.concatenate(bands).view(np.int64) if bands else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(np.array(set_a, np.uint64).view(np.int64)),
                pa.array(np.array(set_b, np.uint64).view(np.int64)),
                lists(joined, np.concatenate([[0], np.cumsum(of * by.bands)]))],
                ["doc_id", "n_shingles", "set_a", "set_b", "bands"])

    return documents.select("doc_id", "text").mapInArrow(
        sketch, "doc_id long, n_shingles long, set_a long, set_b long, bands array<long>")


def shingle_sets(documents: DataFrame, by: NearDuplicates) -> DataFrame:
    """(doc_id, shingles): the sorted distinct hashes as 8 bytes each."""

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(batches):
            found = [one.tobytes() for one in distinct_sets(batch, by.shingle_words)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found, pa.binary())],
                                             ["doc_id", "shingles"])

    return documents.select("doc_id", "text").mapInArrow(sets, "doc_id long, shingles binary")


def compared(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """(u, v, common, united) of each pair (u, v): sizes of the intersection and of the union of the full sets."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            common, united = [], []
            for left, right in zip(batch.column("left"), batch.column("right"), strict=True):
                a = np.frombuffer(left.as_buffer(), np.uint64)
                b = np.frombuffer(right.as_buffer(), np.uint64)
                at = np.searchsorted(b, a)
                same = int((b[np.minimum(at, len(b) - 1)] == a).sum())
                common.append(same)
                united.append(len(a) + len(b) - same)
            yield pa.RecordBatch.from_arrays([batch.column("u"), batch.column("v"), pa.array(common, pa.int64()),
                                              pa.array(united, pa.int64())], ["u", "v", "common", "united"])

    left = sets.select(F.col("doc_id").alias("u"), F.col("shingles").alias("left"))
    right = sets.select(F.col("doc_id").alias("v"), F.col("shingles").alias("right"))
    return (pairs.join(left, "u").join(right, "v").select("u", "v", "left", "right")
            .mapInArrow(compare, "u long, v long, common long, united long"))


def prefix_pairs(rest: DataFrame, sets: DataFrame, by: NearDuplicates) -> DataFrame:
    """(u, v), u the larger, of those rows of rest (doc_id, component) with different components whose sets may be
    similar enough.

    If shingles are ordered by rarity, similar sets of n and m have their first common one among the first n - a + 1 and
    m - a + 1, where a = ceil(percent (n + m) / (100 + percent)) is the least overlap, and differ in size by little.
    Copies with edits of their own have these edits first, and so meet few others.
    """

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for doc_id, component, one in zip(*(batch.column(name) for name in ("doc_id", "component", "shingles")),
                                              strict=True):
                hashes = np.frombuffer(one.as_buffer(), np.int64)
                whole = [pa.repeat(value, len(hashes)) for value in (doc_id, component, pa.scalar(len(hashes), pa.int64()))]
                yield pa.RecordBatch.from_arrays([*whole, pa.array(hashes)], ["doc_id", "component", "n", "shingle"])

    each = staged(rest.join(sets, "doc_id").select("doc_id", "component", "shingles").mapInArrow(
        spread, "doc_id long, component long, n long, shingle long"), "rest")
    rarity = (each.groupBy("shingle").agg(F.count("*").alias("found"))
              .select("shingle", "found"))
    order = Window.partitionBy("doc_id").orderBy("found", "shingle")
    first = (each.join(rarity, "shingle").withColumn("place", F.row_number().over(order))
             .filter(F.col("place") <= F.col("n") - F.ceil(F.col("n") * by.percent / 100) + 1).filter("found > 1"))
    first = staged(first.select("doc_id", "component", "n", "shingle", "place"), "prefixes")
    mixed_ones = first.groupBy("shingle").agg(F.min("component").alias("a"), F.max("component").alias("b")).filter(
        "a != b").select("shingle")
    first = first.join(mixed_ones, "shingle")
    one, other = first.alias("one"), first.alias("other")
    overlap = F.ceil((F.col("one.n") + F.col("other.n")) * by.percent / (100 + by.percent))
    return (one.join(other, F.col("one.shingle") == F.col("other.shingle"))
            .filter((F.col("one.component") != F.col("other.component")) & (F.col("one.doc_id") > F.col("other.doc_id"))
                    & (F.col("one.place") <= F.col("one.n") - overlap + 1)
                    & (F.col("other.place") <= F.col("other.n") - overlap + 1)
                    & (100 * F.least("one.n", "other.n") >= by.percent * F.greatest("one.n", "other.n")))
            .select(F.col("one.doc_id").alias("u"), F.col("other.doc_id").alias("v")).distinct())


def linked(verified: DataFrame, by: NearDuplicates) -> DataFrame:
    return verified.filter(100 * F.col("common") >= by.percent * F.col("united")).select("u", "v")


def near_duplicates(documents: DataFrame, by: NearDuplicates = NearDuplicates()) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every row of documents (doc_id, text).

    Documents link when |A & B| / |A | B| of their shingle sets reaches the threshold.  component_id is the smallest
    doc_id that links lead to, kept tells whether it is the document's own.

    Documents with the same set form a class of which the smallest id takes part.  In each bucket of a band every class
    is compared with the smallest one, so a bucket costs its size however large it is.  Only in buckets whose members
    then still belong to different components are further pairs compared: those of different components that an exact
    filter of prefixes and positions leaves possible.

    Null or empty text: an empty set, linked with nothing.  Null doc_id: linked with nothing, component_id null, kept.
    Rows that repeat a doc_id are documents of
    their own under one number; if their texts differ, links to the number are those of one of them, the same each run.  No rows give no rows.  Other columns are
    not looked at.
    """
    documents = documents.select("doc_id", "text")
    every = staged(sketches(documents, by), "sketches")
    full = every.filter("doc_id is not null and n_shingles > 0")
    key = ["n_shingles", "set_a", "set_b"]
    named = staged(full.groupBy(key).agg(F.min("doc_id").alias("class")), "classes")
    banded = (full.join(named.withColumnRenamed("class", "doc_id"), [*key, "doc_id"])
              .select(F.col("doc_id").alias("member"), F.explode("bands").alias("bucket")))
    shared = banded.groupBy("bucket").agg(F.min("member").alias("hub"), F.max("member").alias("most")).filter(
        "hub != most").select("bucket", "hub")
    buckets = staged(banded.join(shared, "bucket").distinct(), "buckets")

    stars = buckets.filter("member != hub").select(F.col("member").alias("u"), F.col("hub").alias("v")).distinct()
    wanted = buckets.select(F.col("member").alias("doc_id")).distinct()
    sets = staged(shingle_sets(documents.join(wanted, "doc_id"), by), "sets")
    sets = sets.groupBy("doc_id").agg(F.min("shingles").alias("shingles"))
    verified = staged(compared(stars, sets), "stars")
    links = linked(verified, by)
    found = components(links)

    placed = (buckets.join(found.withColumnRenamed("node", "member"), "member", "left")
              .select("bucket", "hub", "member", F.coalesce("component", "member").alias("component")))
    split = placed.groupBy("bucket").agg(F.min("component").alias("a"), F.max("component").alias("b")).filter(
        "a != b").select("bucket")
    rest = placed.join(split, "bucket").select(F.col("member").alias("doc_id"), "component").distinct()
    pairs = prefix_pairs(rest, sets, by).join(verified.select("u", "v"), ["u", "v"], "left_anti")
    pairs = checkpointed(pairs)
    if not pairs.isEmpty():
        found = components(links.union(linked(compared(pairs, sets), by)))

    placed = named.join(found.withColumnRenamed("node", "class"), "class", "left").select(
        *key, F.coalesce("component", "class").alias("component_id"))
    result = (every.filter("doc_id is not null").join(placed, key, "left")
              .select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id")))
    result = result.union(every.filter("doc_id is null").select("doc_id", "n_shingles", "doc_id"))
    return result.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def without_near_duplicates(documents: DataFrame, by: NearDuplicates = NearDuplicates()) -> DataFrame:
    """The documents (doc_id, text and any others) without all but one row of each group of near duplicates.

    Every row goes by itself, whatever ids repeat: the row with the smallest doc_id of its group stays.  Rows whose doc_id
    is null or that of other rows too come behind those with an id of their own (before them, where ids beyond 2 ** 62
    leave no room), in the order in which they are stored.  Null and empty texts are near nothing and stay, all of them.
    No rows give no rows.  Columns are returned as they are, whatever their names.
    """
    repeated = documents.groupBy("doc_id").agg(F.count("*").alias("n")).filter("n > 1 or doc_id is null").select("doc_id")
    if repeated.isEmpty():
        gone = near_duplicates(documents, by).filter("not kept").select("doc_id")
        return documents.join(gone, "doc_id", "left_anti").select(*documents.columns)
    key = unused("row", documents)
    rows = staged(documents.withColumn(key, F.monotonically_increasing_id()), "rows")
    several = repeated.filter("doc_id is not null").select(F.col("doc_id").alias("id"), F.lit(True).alias("several"))
    names = rows.select("doc_id", F.col(key).alias("row"), "text").join(several, F.col("doc_id") == F.col("id"), "left")
    last = names.filter("several is null").agg(F.max("doc_id")).first()[0]
    behind = -(2**63) if last is not None and last >= 2**62 else max(last if last is not None else -1, -1) + 1
    named = staged(names.select(
        F.when(F.col("several").isNull() & F.col("doc_id").isNotNull(), F.col("doc_id")).otherwise(F.col("row") + behind)
        .alias("doc_id"), "row", "text"), "named")
    gone = named.join(near_duplicates(named, by).filter("not kept").select("doc_id"), "doc_id").select(F.col("row").alias(key))
    return rows.join(gone, key, "left_anti").select(*documents.columns)
