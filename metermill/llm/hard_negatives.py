"""Hard negatives by segment summary filtering.

Of each vector, segments at several levels are summarised by their mean m and deviation s.  Over a segment of n places
the inner product of two vectors lies within n m m' - n s s' and n m m' + n s s'; summed over the segments this bounds the
score.  Pairs that the bounds of a level cannot settle go to the next one, whose segments are finer, and what is left
then is scored exactly.

Anchors are taken a bounded chunk at a time, so that each task holds a chunk and streams its share of the rows past it.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import fresh_folder, staged, text_bytes

#: Bytes of anchors that are broadcast at once, summaries and places among their positives included.
CHUNK_BYTES = 16 << 20
#: Rows and anchors that are compared at once.
BLOCK_ROWS, BLOCK_ANCHORS = 1024, 2048
#: Above it, sums of products are not exact as doubles.
EXACT = 2.0**53
LONGS = -(2**63), 2**63 - 1


@dataclass(frozen=True)
class HardNegatives:
    scale: int = 256  #: components count as floor(scale * x)
    positives: int = 5
    negatives: int = 5  #: for each positive
    low_percent: int = 80  #: of the positive's score, which a negative reaches
    high_percent: int = 100  #: and does not exceed
    segments: tuple[int, ...] = (1, 4, 16)  #: level by level; a vector has no more than components


def quantised(column: pa.Array, scale: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The components of the vectors as whole numbers, joined, the vectors' bounds in them, and which may take part."""
    known = column.is_valid().to_numpy(zero_copy_only=False)
    sizes = np.where(known, column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False), 0).astype(np.int64)
    flat = column.flatten()
    values = flat.cast(pa.float64()).fill_null(np.nan).to_numpy(zero_copy_only=False)
    with np.errstate(over="ignore", invalid="ignore"):
        values = np.floor(scale * values)
    bounds = np.concatenate([[0], np.cumsum(sizes)])
    odd = np.concatenate([[0], np.cumsum(~np.isfinite(values))])
    return values, bounds, known & (odd[bounds[1:]] == odd[bounds[:-1]])


def segment_bounds(size: int, segments: int) -> np.ndarray:
    count = min(segments, size)
    return np.arange(count + 1) * size // max(count, 1)


def summaries(matrix: np.ndarray, segments: tuple[int, ...]) -> tuple[np.ndarray, np.ndarray]:
    """The segments' means and deviations, level after level, each times the root of the segment's length."""
    means, deviations = [], []
    for count in segments:
        bounds = segment_bounds(matrix.shape[1], count)
        for begin, end in zip(bounds[:-1], bounds[1:], strict=True):
            part = matrix[:, begin:end]
            means.append(part.mean(axis=1) * np.sqrt(end - begin))
            deviations.append(part.std(axis=1) * np.sqrt(end - begin))
    shape = (len(matrix), len(means))
    return (np.array(means).T if means else np.zeros(shape)), (np.array(deviations).T if means else np.zeros(shape))


def joined(rows: list[np.ndarray]) -> pa.Array:
    return pa.array([one.tobytes() for one in rows], pa.binary())


def summarised(vectors: DataFrame, by: HardNegatives) -> DataFrame:
    """(row, vec_id, label, size, vector, means, deviations) of the vectors that take part; row is a key of its own."""

    def summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        next_row = TaskContext.get().partitionId() << 33
        for batch in batches:
            for begin in range(0, batch.num_rows, BLOCK_ROWS):
                part = batch.slice(begin, BLOCK_ROWS)
                values, bounds, usable = quantised(part.column("embedding"), by.scale)
                sizes = np.diff(bounds)
                for size in np.unique(sizes[usable]):
                    at = np.flatnonzero(usable & (sizes == size))
                    matrix = values[bounds[at][:, None] + np.arange(size)]
                    means, deviations = summaries(matrix, by.segments)
                    here = pa.array(at)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(next_row + np.arange(len(at))), part.column("vec_id").take(here),
                         part.column("label").take(here), pa.array(np.full(len(at), size, np.int32)), joined(matrix),
                         joined(means), joined(deviations)],
                        ["row", "vec_id", "label", "size", "vector", "means", "deviations"])
                    next_row += len(at)

    return vectors.select("vec_id", F.col("label").cast("long").alias("label"), "embedding").filter(
        "label is not null and embedding is not null").mapInArrow(
        summarise, "row long, vec_id long, label long, size int, vector binary, means binary, deviations binary")


class Vectors:
    """Vectors of one length with their summaries."""

    def __init__(self, rows: pa.RecordBatch | pa.Table, size: int):
        self.size, self.count = size, rows.num_rows
        self.row, self.label = (rows.column(one).to_numpy() for one in ("row", "label"))
        ids = rows.column("vec_id")
        self.known = ids.is_valid().to_numpy(zero_copy_only=False) if rows.num_rows else np.zeros(0, bool)
        self.ids = ids.fill_null(0).to_numpy()
        self.matrix, self.means, self.deviations = (self.numbers(rows.column(one)) for one in (
            "vector", "means", "deviations"))
        self.largest = float(np.abs(self.matrix).max(initial=0))

    def numbers(self, column: pa.Array | pa.ChunkedArray) -> np.ndarray:
        if isinstance(column, pa.ChunkedArray):
            column = column.combine_chunks()
        data, _ = text_bytes(column)
        return np.frombuffer(data.tobytes(), np.float64).reshape(self.count, -1) if self.count else np.zeros((0, 0))

    def part(self, begin: int, end: int) -> Vectors:
        one = object.__new__(Vectors)
        one.size, one.count, one.largest = self.size, min(end, self.count) - begin, self.largest
        for name in ("row", "label", "known", "ids", "matrix", "means", "deviations"):
            setattr(one, name, getattr(self, name)[begin:end])
        return one


def by_size(rows: pa.RecordBatch | pa.Table) -> Iterator[Vectors]:
    sizes = rows.column("size").to_numpy()
    for size in np.unique(sizes):
        yield Vectors(rows.filter(pa.array(sizes == size)), int(size))


def exact_scores(rows: Vectors, anchors: Vectors, at: np.ndarray, of: np.ndarray) -> np.ndarray:
    """The inner products of rows[at] and anchors[of], as long where they fit, else as the nearest long."""
    if rows.size * rows.largest * anchors.largest < EXACT:
        if 4 * len(at) > rows.count * anchors.count:
            return (rows.matrix @ anchors.matrix.T)[at, of].astype(np.int64)
        found = [np.einsum("ij,ij->i", rows.matrix[at[begin:begin + 65536]], anchors.matrix[of[begin:begin + 65536]])
                 for begin in range(0, len(at), 65536)]
        return np.concatenate(found).astype(np.int64) if found else np.zeros(0, np.int64)
    products = (sum(int(x) * int(y) for x, y in zip(rows.matrix[i], anchors.matrix[j], strict=True))
                for i, j in zip(at, of, strict=True))
    return np.array([min(max(one, LONGS[0]), LONGS[1]) for one in products], np.int64)


def scored(rows: Vectors, anchors: Vectors, allowed: np.ndarray, least: np.ndarray, most: np.ndarray,
           segments: tuple[int, ...]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, anchor, score) of the allowed pairs but for such as the summaries show to be outside the anchor's scores
    from least to most."""
    lines, columns = np.arange(rows.count), np.arange(anchors.count)
    # Rounding of the bounds is far below this.
    slack = 1e-9 * (1 + rows.size * rows.largest * anchors.largest)
    begin = 0
    for count in segments:
        end = begin + len(segment_bounds(rows.size, count)) - 1
        middle = rows.means[lines, begin:end] @ anchors.means[columns, begin:end].T
        reach = rows.deviations[lines, begin:end] @ anchors.deviations[columns, begin:end].T + slack
        allowed = allowed & (middle + reach >= least[columns]) & (middle - reach <= most[columns])
        begin = end
        keep, held = allowed.any(axis=1), allowed.any(axis=0)
        lines, columns, allowed = lines[keep], columns[held], allowed[np.ix_(keep, held)]
    at, of = np.nonzero(allowed)
    at, of = lines[at], columns[of]
    return at, of, exact_scores(rows, anchors, at, of)


class Best:
    """The first k of what each slot is offered: higher scores, then smaller ids, unknown ids last."""

    def __init__(self, slots: int, k: int):
        self.k, self.number = k, slots
        self.slot, self.score, self.ids = (np.zeros(0, np.int64) for _ in range(3))
        self.known = np.zeros(0, bool)
        self.least = np.full(slots, -np.inf)  #: below it, nothing is taken

    def offer(self, slot: np.ndarray, score: np.ndarray, ids: np.ndarray, known: np.ndarray) -> None:
        if not len(slot):
            return
        slot, score, ids, known = (np.concatenate(pair) for pair in (
            (self.slot, slot), (self.score, score), (self.ids, ids), (self.known, known)))
        order = np.lexsort((ids, ~known, ~score, slot))  # ~ turns a long's order about
        slot = slot[order]
        first = np.searchsorted(slot, slot)
        place = np.arange(len(slot)) - first
        order, last = order[place < self.k], slot[place == self.k - 1]
        self.slot, self.score, self.ids, self.known = slot[place < self.k], score[order], ids[order], known[order]
        kept = place[place < self.k]
        self.least[last] = self.score[kept == self.k - 1]

    def batch(self, names: dict[str, np.ndarray]) -> pa.RecordBatch:
        """What is kept, with columns by slot."""
        columns = {name: pa.array(values[self.slot]) for name, values in names.items()}
        return pa.RecordBatch.from_pydict({
            **columns, "id": pa.array(self.ids, mask=~self.known), "score": pa.array(self.score)})


def first_of(found: DataFrame, k: int, *slot: str) -> DataFrame:
    """The first k of each slot, numbered from 1: tasks have kept k at most each."""
    order = Window.partitionBy(*slot).orderBy(F.col("score").desc(), F.col("id").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def positives_of(rows: DataFrame, chunk, by: HardNegatives) -> DataFrame:
    """(anchor, rank, id, score): the first other rows of the same label as the chunk's anchors."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups = [(anchors, Best(anchors.count, by.positives)) for anchors in by_size(chunk.value)]
        for batch in batches:
            for begin in range(0, batch.num_rows, BLOCK_ROWS):
                for block in by_size(batch.slice(begin, BLOCK_ROWS)):
                    for anchors, best in groups:
                        for first in range(0, anchors.count if anchors.size == block.size else 0, BLOCK_ANCHORS):
                            some = anchors.part(first, first + BLOCK_ANCHORS)
                            allowed = (block.label[:, None] == some.label) & (block.row[:, None] != some.row)
                            at, of, score = scored(block, some, allowed, best.least[first:first + BLOCK_ANCHORS],
                                                   np.full(some.count, np.inf), by.segments)
                            best.offer(of + first, score, block.ids[at], block.known[at])
        for anchors, best in groups:
            yield best.batch({"anchor": anchors.row})

    found = rows.mapInArrow(find, "anchor long, id long, score long")
    return first_of(found, by.positives, "anchor")


def negatives_of(rows: DataFrame, chunk, wanted, by: HardNegatives) -> DataFrame:
    """(anchor, place, rank, id, score): the first rows of another label whose scores fit the anchor's positive at that
    place; wanted has (rows, scores) of the chunk's positives, sorted by row."""

    def ranges(anchors: Vectors) -> tuple[np.ndarray, np.ndarray]:
        """[anchor, place]: the scores from and up to which a row fits; none where there is no positive."""
        low, high = (np.full((anchors.count, by.positives), value) for value in LONGS[::-1])
        order = np.argsort(anchors.row)
        of, places, scores = wanted.value
        at = order[np.searchsorted(anchors.row[order], of).clip(max=anchors.count - 1)]
        mine = anchors.row[at] == of
        # 100 s >= low p and 100 s <= high p, in whole numbers
        for one, place, score in zip(at[mine], places[mine], scores[mine].tolist(), strict=True):
            low[one, place], high[one, place] = -(-by.low_percent * score // 100), by.high_percent * score // 100
        return low, high

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups = []
        for anchors in by_size(chunk.value):
            groups.append((anchors, *ranges(anchors), Best(anchors.count * by.positives, by.negatives)))
        for batch in batches:
            for begin in range(0, batch.num_rows, BLOCK_ROWS):
                for block in by_size(batch.slice(begin, BLOCK_ROWS)):
                    for group in groups:
                        if group[0].size == block.size:
                            offer(block, *group)
        for anchors, _, _, best in groups:
            slots = np.arange(best.number)
            yield best.batch({"anchor": anchors.row[slots // by.positives], "place": slots % by.positives})

    def offer(block: Vectors, anchors: Vectors, low: np.ndarray, high: np.ndarray, best: Best) -> None:
        for first in range(0, anchors.count, BLOCK_ANCHORS):
            some = anchors.part(first, first + BLOCK_ANCHORS)
            here = slice(first, first + BLOCK_ANCHORS)
            floor = np.maximum(low[here], best.least.reshape(-1, by.positives)[here])
            fits = floor <= high[here]
            least = np.where(fits, floor, np.inf).min(axis=1)
            most = np.where(fits, high[here], -np.inf).max(axis=1)
            at, of, score = scored(block, some, block.label[:, None] != some.label, least, most, by.segments)
            pair, place = np.nonzero((score[:, None] >= low[here][of]) & (score[:, None] <= high[here][of]))
            best.offer((of[pair] + first) * by.positives + place, score[pair], block.ids[at[pair]], block.known[at[pair]])

    found = rows.mapInArrow(find, "anchor long, place long, id long, score long")
    return first_of(found, by.negatives, "anchor", "place")


def chunks_of(rows: DataFrame, anchors: Column) -> Iterator[DataFrame]:
    """The anchors among the rows in chunks of about half of CHUNK_BYTES."""
    chosen = rows.filter(anchors)
    total = chosen.agg(F.sum(F.octet_length("vector") + F.octet_length("means") + F.octet_length("deviations") + 64)).first()[0]
    number = -(-(total or 0) // (CHUNK_BYTES // 2))
    for one in range(number):
        yield chosen.filter(F.pmod(F.xxhash64("row"), F.lit(number)) == one)


def hard_negatives(vectors: DataFrame, anchors: Column | None = None, by: HardNegatives = HardNegatives()) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) of vectors (vec_id, embedding, label).

    Of each anchor (by default every hundredth vec_id), the positives are the first other rows of its label, and their
    negatives the first rows of other labels whose scores are from low_percent to high_percent of the positive's.  Higher
    scores come first, ties by smaller vec_id, unknown ones last.  A positive without negatives gives no row, nor does one
    with a negative score.

    Rows without label or vector, and those with a component that is null or not finite once scaled, take no part.  A row
    with a null vec_id may be a positive or negative.  Rows that repeat an id count as rows of their own.  Vectors of another length than
    the anchor's are not compared with it; empty ones score 0 with each other.  Scores beyond a long count as the nearest
    long.  No rows give no rows.  Other columns are not looked at.

    The whole table is read twice for each chunk of anchors, and nothing of it is shuffled; tasks return the few that
    each has found best.
    """
    spark = vectors.sparkSession
    context = spark.sparkContext
    rows = staged(summarised(vectors, by), "summaries")
    parts = []
    for chunk in chunks_of(rows, F.col("vec_id") % 100 == 0 if anchors is None else anchors):
        held = context.broadcast(chunk.toArrow())  # CHUNK_BYTES at most, whatever the table's size
        positives = staged(positives_of(rows, held, by), "positives")
        found = positives.select("anchor", "rank", "score").orderBy("anchor").toArrow()
        wanted = context.broadcast((found.column("anchor").to_numpy(), found.column("rank").to_numpy() - 1,
                                    found.column("score").to_numpy()))
        named = positives.select("anchor", (F.col("rank") - 1).alias("place"), F.col("id").alias("positive_id"),
                                 F.col("score").alias("positive_score"))
        ids = chunk.select(F.col("row").alias("anchor"), F.col("vec_id").alias("anchor_id"))
        result = negatives_of(rows, held, wanted, by).join(named, ["anchor", "place"]).join(ids, "anchor").select(
            "anchor_id", "positive_id", F.col("rank").cast("long").alias("rank"), F.col("id").alias("negative_id"),
            "positive_score", F.col("score").alias("negative_score"))
        result.write.parquet(folder := fresh_folder(spark, "negatives"))
        parts.append(folder)
        held.destroy()
        wanted.destroy()
    schema = ("anchor_id long, positive_id long, rank long, negative_id long, positive_score long, negative_score long")
    return spark.read.schema(schema).parquet(*parts) if parts else spark.createDataFrame([], schema)
