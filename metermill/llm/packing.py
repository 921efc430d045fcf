"""Packing documents into sequences by bulk-synchronous best-fit decreasing.

Documents are cut into pieces of at most `capacity` tokens.  Rounds go through bands of lengths, longest first.  In each
round the band's pieces and the open sequences' gaps are range-sorted by size, which gives every one its rank among those
of its size.  A sweep over the sizes, of which there are no more than `capacity`, decides from their counts which sizes of
pieces go to which gaps: always the smallest that is large enough.  Where many pieces want gaps of one size, ranks decide
which gets which; tasks look up their own pieces and gaps by rank.  Then the gaps are updated for the next round.
"""

from __future__ import annotations

import bisect
import re
import zlib
from array import array
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from functools import lru_cache, reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .byte_bpe import shipped
from .common import blocks, staged, text_bytes

CAPACITY = 4096
#: A band's longest pieces are so many times as long as its shortest.
BAND = 16
#: Words, and pieces of words, that a worker remembers at least, and bytes of the longest of them.
REMEMBERED_WORDS, REMEMBERED_PIECES, LONGEST = 300_000, 300_000, 64
NEW = -1  #: stands for the size of the gap of a sequence that the round opens


#: ASCII signs and the letters from U+00C0 to U+00FF: words of these alone are cut here, others by the library.
_LATIN = rb"\xc3[\x80-\x96\x98-\xb6\xb8-\xbf]"
SIMPLE = re.compile(rb"(?:[!-~]|" + _LATIN + rb")+")
#: What the tokenizer's pattern cuts such a word into, in lower case.
PIECES = re.compile(rb"'s|'t|'re|'ve|'m|'ll|'d|(?:[a-z]|" + _LATIN + rb")+|[0-9]|[^a-z0-9\xc3]+")
#: Signs that are a piece of their own after letters.
SIGNS = frozenset(b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~")


def byte_alphabet() -> dict[int, int]:
    """The sign that stands for each byte in byte-level vocabularies: a visible one for itself, the others from 256 on."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    return {byte: 256 + at for at, byte in enumerate(byte for byte in range(256) if byte not in shown)}


class Memory(dict):
    """What was worked out for the keys looked up lately: at least `size` of them, at most twice as many."""

    def __init__(self, size: int, work: Callable[[bytes], bytes]):
        super().__init__()
        self.size, self.work, self.older = size, work, {}

    def __missing__(self, key: bytes) -> bytes:
        value = self.older.get(key) or self.work(key)
        if len(key) <= LONGEST:
            if len(self) >= self.size:
                self.older = dict(self)
                self.clear()
            self[key] = value
        return value


class WordIds:
    """Ids of texts, 4 bytes each.  White space parts words, which are cut into pieces on their own."""

    def __init__(self, raw: bytes):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the cores are Spark's
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(raw.decode())
        self.model, self.alphabet = self.tokenizer.model, byte_alphabet()
        self.added = [token.content.encode() for token in self.tokenizer.get_added_tokens_decoder().values()]
        self.pieces, self.words = Memory(REMEMBERED_PIECES, self.piece), Memory(REMEMBERED_WORDS, self.word)

    def library(self, text: bytes) -> bytes:
        return array("I", self.tokenizer.encode(text.decode(), add_special_tokens=False).ids).tobytes()

    def piece(self, piece: bytes) -> bytes:
        shown = piece.decode() if piece.isascii() else piece.decode("latin-1").translate(self.alphabet)
        return array("I", [token.id for token in self.model.tokenize(shown)]).tobytes()

    def word(self, word: bytes) -> bytes:
        lower = word.lower()  # of A-Z
        if lower.isalpha():
            return self.pieces[lower]
        if lower[-1] in SIGNS and lower[:-1].isalpha():
            return self.pieces[lower[:-1]] + self.pieces[lower[-1:]]
        if not SIMPLE.fullmatch(word):
            return self.library(word)
        word = word.lower() if word.isascii() else word.decode().lower().encode()
        return b"".join([self.pieces[piece] for piece in PIECES.findall(word)])

    def of(self, text: bytes) -> bytes:
        if any(one in text for one in self.added):  # the library finds these wherever they are
            return self.library(text)
        return b"".join(map(self.words.__getitem__, text.split()))


@lru_cache(maxsize=2)
def word_ids(raw: bytes) -> WordIds:
    return WordIds(raw)


def pieces(documents: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = 1, keep_ids: bool = False) -> DataFrame:
    """(row, doc_id, piece, start, length, ids_crc32) of the pieces of documents (doc_id, text); row is a key of its own.

    With keep_ids, the ids follow as `ids`, 4 bytes each."""
    raw = shipped(documents, path)
    names = ["row", "doc_id", "piece", "start", "length", "ids_crc32", *(["ids"] if keep_ids else [])]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, end = word_ids(raw.value), np.array([end_id], "<u4").tobytes()
        row = TaskContext.get().partitionId() << 33
        for batch in blocks(batches):
            data, bounds = text_bytes(batch.column("text"))
            raw_bytes = data.tobytes()
            owner, number, starts, lengths, crc, kept = [], [], [], [], [], []
            for at, (first, stop) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)):
                ids = words.of(raw_bytes[first:stop]) + end
                for begin in range(0, len(ids), 4 * capacity):
                    one = ids[begin:begin + 4 * capacity]
                    owner.append(at)
                    number.append(begin // (4 * capacity))
                    starts.append(begin // 4)
                    lengths.append(len(one) // 4)
                    crc.append(zlib.crc32(one))
                    kept += [one] if keep_ids else []
            columns = [pa.array(row + np.arange(len(owner))), batch.column("doc_id").take(pa.array(owner, pa.int64())),
                       pa.array(number, pa.int32()), pa.array(starts, pa.int64()), pa.array(lengths, pa.int64()),
                       pa.array(crc, pa.int64()), *([pa.array(kept, pa.binary())] if keep_ids else [])]
            row += len(owner)
            yield pa.RecordBatch.from_arrays(columns, names)

    return documents.select("doc_id", "text").mapInArrow(
        cut, "row long, doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids binary" * keep_ids)


def rank_offsets(rows: DataFrame) -> tuple[dict[tuple[int, int], int], dict[int, int]]:
    """Of range-sorted rows (part, size): how many rows of the size earlier parts have, by (part, size); and how many
    there are of each size.

    As parts hold consecutive ranges, there are fewer counts than parts and sizes together.
    """
    counts = sorted((row["size"], row["part"], row["n"]) for row in
                    rows.groupBy("part", "size").agg(F.count("*").alias("n")).collect())
    before, total = {}, {}
    for size, part, n in counts:
        before[part, size] = total.get(size, 0)
        total[size] = total.get(size, 0) + n
    return before, total


def range_sorted(rows: DataFrame, size: str, key: str) -> DataFrame:
    """(part, size, key, at): rows dealt in ranges of size and key, so that a size that many have is in many parts; at is
    the rank among those of one size in the part."""

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, last, seen = TaskContext.get().partitionId(), None, 0
        for batch in batches:
            sizes = batch.column("size").to_numpy()
            if not len(sizes):
                continue
            first = np.searchsorted(sizes, sizes)
            at = np.arange(len(sizes)) - first
            if sizes[0] == last:
                at[:np.searchsorted(sizes, last, "right")] += seen
            last, seen = sizes[-1], int(at[-1]) + 1
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(sizes), part, np.int32)), *batch.columns,
                                              pa.array(at, pa.int64())], ["part", "size", "key", "at"])

    sorted_rows = (rows.select(F.col(size).alias("size"), F.col(key).alias("key"))
                   .repartitionByRange("size", "key").sortWithinPartitions("size", "key"))
    return staged(sorted_rows.mapInArrow(number, "part int, size long, key long, at long"), "sorted")


@dataclass
class Sweep:
    """A round's decisions, as runs: consecutive pieces of a length go, `each` to a gap, to consecutive ranks of a size."""

    capacity: int
    #: (length, first rank, each, size of the gap, first rank of it, offset)
    pieces: list[tuple[int, int, int, int, int, int]] = field(default_factory=list)
    opened: int = 0
    #: gap as it is now -> [(size before the round, first rank, count)]
    gaps: dict[int, list[tuple[int, int, int]]] = field(default_factory=dict)

    def run(self, lengths: dict[int, int], gaps: dict[int, int]) -> None:
        self.gaps = {size: [(size, 0, count)] for size, count in gaps.items()}
        sizes = sorted(self.gaps)
        for length in sorted(lengths, reverse=True):
            rank, left = 0, lengths[length]
            while left:
                at = bisect.bisect_left(sizes, length)
                if at == len(sizes):
                    size, run = self.capacity, (NEW, self.opened, -(-left // (self.capacity // length)))
                    self.opened += run[2]
                else:
                    size = sizes[at]
                    run = self.gaps[size].pop()
                    if not self.gaps[size]:
                        del self.gaps[size], sizes[at]
                # A gap takes pieces of this length until it's too small for another: best-fit would, too.
                each = min(size // length, left)
                full = min(run[2], left // each)
                self.pieces.append((length, rank, each, run[0], run[1], self.capacity - size))
                rank, left = rank + full * each, left - full * each
                rests = [(size - each * length, (run[0], run[1], full))]
                if full < run[2] and run[0] == NEW and left:
                    # the last new sequence takes what is left
                    self.pieces.append((length, rank, left, NEW, run[1] + full, 0))
                    rests.append((self.capacity - left * length, (NEW, run[1] + full, 1)))
                    left = 0
                elif full < run[2]:
                    rests.append((size, (run[0], run[1] + full, run[2] - full)))
                for rest, one in rests:
                    if rest not in self.gaps:
                        bisect.insort(sizes, rest)
                    self.gaps.setdefault(rest, []).append(one)


class Runs:
    """Looks up runs of ranks by size: each has a first rank, and goes on to the next one's."""

    def __init__(self, runs: list[tuple[int, ...]]):
        """(size, first rank, ...)"""
        self.rows = np.array(sorted(runs), np.int64)

    def of(self, sizes: np.ndarray, ranks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The run of each rank and the place in it."""
        by_size, starts = self.rows[:, 0], self.rows[:, 1]
        # sizes and first ranks ascend together; a rank's run is the last that does not begin behind it
        found = np.empty(len(sizes), np.int64)
        for size in np.unique(sizes):
            here = sizes == size
            low, high = np.searchsorted(by_size, [size, size + 1])
            found[here] = low + np.searchsorted(starts[low:high], ranks[here], "right") - 1
        return self.rows[found], ranks - starts[found]


def full_ranks(batch: pa.RecordBatch, before: dict[tuple[int, int], int]) -> tuple[np.ndarray, np.ndarray]:
    sizes, at, parts = (batch.column(name).to_numpy() for name in ("size", "at", "part"))
    groups, inverse = np.unique(np.stack([parts.astype(np.int64), sizes]), axis=1, return_inverse=True)
    return sizes, at + np.array([before[one] for one in zip(*groups.tolist(), strict=True)], np.int64)[inverse.ravel()]


def matched(band: DataFrame, before: dict, sweep: Sweep, first_id: int) -> DataFrame:
    """(row, gap_size, gap_rank, sequence_id, offset) of the band's pieces; sequence_id where the round opened it."""
    context = band.sparkSession.sparkContext
    held = context.broadcast((Runs(sweep.pieces), before))

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs, offsets = held.value
        for batch in batches:
            if not batch.num_rows:
                continue
            lengths, ranks = full_ranks(batch, offsets)
            run, place = runs.of(lengths, ranks)
            gap, rank = run[:, 3], run[:, 4] + place // run[:, 2]
            new = gap == NEW
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), pa.array(gap), pa.array(rank), pa.array(rank + first_id, mask=~new),
                 pa.array(run[:, 5] + place % run[:, 2] * lengths)],
                ["row", "gap_size", "gap_rank", "sequence_id", "offset"])

    return band.mapInArrow(look_up, "row long, gap_size long, gap_rank long, sequence_id long, offset long")


def ranked_gaps(gaps: DataFrame, before: dict) -> DataFrame:
    """(gap_size, gap_rank, sequence_id)"""
    held = gaps.sparkSession.sparkContext.broadcast(before)

    def rank(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                sizes, ranks = full_ranks(batch, held.value)
                yield pa.RecordBatch.from_arrays([pa.array(sizes), pa.array(ranks), batch.column("key")],
                                                 ["gap_size", "gap_rank", "sequence_id"])

    return gaps.mapInArrow(rank, "gap_size long, gap_rank long, sequence_id long")


def updated(ranked: DataFrame, sweep: Sweep, first_id: int) -> DataFrame:
    """(sequence_id, gap) after the round, of the sequences that were open and of those that it opened."""
    spark = ranked.sparkSession
    runs = [(old, first, now) for now, own in sweep.gaps.items() for old, first, _ in own]
    held = spark.sparkContext.broadcast(Runs(runs))

    def update(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                sizes, ranks, ids = (batch.column(at).to_numpy() for at in range(3))
                run, _ = held.value.of(sizes, ranks)
                yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(run[:, 2])], ["sequence_id", "gap"])

    both = ranked if sweep.opened == 0 else ranked.union(
        spark.range(sweep.opened).select(F.lit(NEW).cast("long"), "id", F.col("id") + first_id))
    return both.mapInArrow(update, "sequence_id long, gap long").filter("gap > 0")


def packed(rows: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """(row, sequence_id, offset) of pieces (row, length) of 1 to capacity: sequences without gaps before their ends.

    Sequences are numbered from 0.  Equal lengths are told apart by row, so the result is the same each time.
    """
    gaps = staged(rows.sparkSession.createDataFrame([], "sequence_id long, gap long"), "gaps")
    placed, sequences, high = [], 0, capacity
    while high:
        low = high // BAND
        band = range_sorted(rows.filter((F.col("length") > low) & (F.col("length") <= high)), "length", "row")
        before, lengths = rank_offsets(band)
        high = low
        if not lengths:
            continue
        fitting = range_sorted(gaps.filter(F.col("gap") >= min(lengths)), "gap", "sequence_id")
        gaps_before, sizes = rank_offsets(fitting)
        sweep = Sweep(capacity)
        sweep.run(lengths, sizes)
        found = matched(band, before, sweep, sequences)
        ranked = ranked_gaps(fitting, gaps_before)
        if sizes:
            ids = ranked.withColumnRenamed("sequence_id", "older")
            found = found.join(ids, ["gap_size", "gap_rank"], "left").withColumn(
                "sequence_id", F.coalesce("sequence_id", "older"))
        placed.append(staged(found.select("row", "sequence_id", "offset"), "placed"))
        gaps = staged(updated(ranked, sweep, sequences).union(gaps.filter(F.col("gap") < min(lengths))), "gaps")
        sequences += sweep.opened
    if not placed:
        return rows.limit(0).select("row", F.lit(0).cast("long").alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    return reduce(DataFrame.union, placed)


def packed_documents(documents: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = 1,
                     keep_ids: bool = False) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset) of the pieces of documents (doc_id, text), packed into
    sequences of at most `capacity` tokens, and the pieces' `ids` (4 bytes each) with keep_ids.

    A document's ids are those of the tokenizer in the file at `path`, then end_id; only more than `capacity` are cut.
    Null and empty texts have the end id alone.  Rows that share a doc_id, or have none, are documents of their own.  No
    rows give no rows.  Other columns are not looked at.
    """
    rows = staged(pieces(documents, path, capacity, end_id, keep_ids), "pieces")
    return rows.join(packed(rows.select("row", "length"), capacity), "row").select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset", *(["ids"] if keep_ids else []))


def sequences(placed: DataFrame) -> DataFrame:
    """(sequence_id, ids) of pieces that packed_documents gave with keep_ids: the tokens of each sequence, as array<int>."""

    def join(table: pa.Table) -> pa.Table:
        table = table.sort_by("offset")
        ids = np.frombuffer(b"".join(table.column("ids").to_pylist()), "<i4")
        return pa.table({"sequence_id": table.column("sequence_id")[:1],
                         "ids": pa.array([ids], pa.list_(pa.int32()))})

    return placed.select("sequence_id", "offset", "ids").groupBy("sequence_id").applyInArrow(
        join, "sequence_id long, ids array<int>")
