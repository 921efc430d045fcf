"""Byte-level BPE encoding and decoding with length-bucketed padded matrices.

Texts are cut into pieces; of equal pieces in a block one is encoded, and what a worker has encoded it keeps while there
is room.  The pieces of one length class are rows of a padded matrix of ids.  In each round every row merges its leftmost
pair of least rank, found through a hash table of pairs, and moves up what stands behind; rows without a pair left
leave the matrix.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Iterator
from functools import lru_cache
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import blocks, lists, mixed, text_bytes
from .pretokens import piece_begins
from .words import segment_hashes

NONE = np.int32(2**31 - 1)
#: Pieces that a worker remembers before it starts afresh.
REMEMBERED = 150_000
#: Longest piece, in bytes, that goes into a matrix; a row of more is merged with a heap, as moving it up would be slow.
LONGEST_ROW = 512
MATRIX_CELLS = 1 << 20


class Pairs:
    """An open-addressing hash table: (left id, right id) -> rank of the merged token."""

    def __init__(self, left: np.ndarray, right: np.ndarray, rank: np.ndarray):
        keys = left.astype(np.uint64) << np.uint64(32) | right.astype(np.uint64)
        self.mask = np.uint64((1 << max(4, (4 * len(keys)).bit_length())) - 1)
        self.keys = np.full(int(self.mask) + 1, 2**64 - 1, np.uint64)
        self.ranks = np.full(int(self.mask) + 1, NONE, np.int32)
        todo, place, self.probes = np.arange(len(keys)), mixed(keys) & self.mask, 0
        while len(todo):
            at = place[todo]
            free = self.keys[at] == 2**64 - 1
            self.keys[at[free]] = keys[todo[free]]  # of several that want a place one gets it
            won = free & (self.keys[at] == keys[todo])
            self.ranks[at[won]] = rank[todo[won]]
            todo = todo[~won]
            place[todo] = (place[todo] + np.uint64(1)) & self.mask
            self.probes += 1

    def lookup(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = left.astype(np.uint64) << np.uint64(32) | right.astype(np.uint64)
        at = mixed(keys) & self.mask
        found = np.where(self.keys[at] == keys, self.ranks[at], NONE)
        open_ones = np.flatnonzero((found == NONE) & (self.keys[at] != 2**64 - 1))
        for _ in range(self.probes - 1):
            if not len(open_ones):
                break
            at[open_ones] = (at[open_ones] + np.uint64(1)) & self.mask
            here = self.keys[at[open_ones]]
            same = here == keys[open_ones]
            found[open_ones[same]] = self.ranks[at[open_ones[same]]]
            open_ones = open_ones[~same & (here != 2**64 - 1)]
        return found


class Vocabulary:
    def __init__(self, ranks: dict[bytes, int]):
        self.ids = ranks
        self.tokens = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            self.tokens[rank] = token
        self.of_byte = np.array([ranks.get(bytes([one]), -1) for one in range(256)], np.int32)
        if (self.of_byte < 0).any():
            raise ValueError("the vocabulary lacks single bytes")
        triples = [(left, right, rank) for token, rank in ranks.items() for cut in range(1, len(token))
                   if (left := ranks.get(token[:cut])) is not None and (right := ranks.get(token[cut:])) is not None]
        self.pairs = Pairs(*(np.array(column, np.int64) for column in zip(*triples, strict=True)))
        self.lengths = np.array([len(token) for token in self.tokens], np.int64)
        self.flat = np.frombuffer(b"".join(self.tokens), np.uint8)
        self.starts = np.cumsum(self.lengths) - self.lengths

    def encode_pieces(self, pieces: list[bytes]) -> list[np.ndarray]:
        """The ids of each piece."""
        found: list[np.ndarray | None] = [None] * len(pieces)
        rows: dict[int, list[int]] = {}
        for at, piece in enumerate(pieces):
            if (rank := self.ids.get(piece)) is not None:
                found[at] = np.array([rank], np.int32)
            elif len(piece) > LONGEST_ROW:
                found[at] = self.merge_long(piece)
            else:
                rows.setdefault((len(piece) - 1).bit_length(), []).append(at)
        for power, members in rows.items():
            width = 1 << power
            step = max(1, MATRIX_CELLS // width)
            for begin in range(0, len(members), step):
                part = members[begin:begin + step]
                for at, ids in zip(part, self.merge_rows([pieces[one] for one in part], width), strict=True):
                    found[at] = ids
        return found

    def merge_rows(self, pieces: list[bytes], width: int) -> list[np.ndarray]:
        lengths = np.array([len(piece) for piece in pieces])
        ids = np.full((len(pieces), width), -1, np.int32)
        filled = np.arange(width) < lengths[:, None]
        ids[filled] = self.of_byte[np.frombuffer(b"".join(pieces), np.uint8)]
        ranks = np.full((len(pieces), width), NONE, np.int32)
        both = filled[:, 1:]
        ranks[:, :-1][both] = self.pairs.lookup(ids[:, :-1][both], ids[:, 1:][both])
        done: list[np.ndarray | None] = [None] * len(pieces)
        rows = np.arange(len(pieces))
        columns = np.arange(width)
        while True:
            at = ranks.argmin(axis=1)
            least = ranks[np.arange(len(rows)), at]
            over = least == NONE
            for row, left in zip(rows[over], np.flatnonzero(over), strict=True):
                done[row] = ids[left][:lengths[row]].copy()
            if over.all():
                return done
            if over.any():
                rows, ids, ranks, at, least = rows[~over], ids[~over], ranks[~over], at[~over], least[~over]
            here = np.arange(len(rows))
            ids[here, at] = least
            behind = np.minimum(columns + (columns > at[:, None]), width - 1)
            ids = np.take_along_axis(ids, behind, 1)
            ranks = np.take_along_axis(ranks, behind, 1)
            ids[:, -1], ranks[:, -1] = -1, NONE
            lengths[rows] -= 1
            for left, ok in ((at, at + 1 < lengths[rows]), (at - 1, at > 0)):
                ranks[here[~ok & (left >= 0)], left[~ok & (left >= 0)]] = NONE
                row, left = here[ok], left[ok]
                ranks[row, left] = self.pairs.lookup(ids[row, left], ids[row, left + 1])

    def merge_long(self, piece: bytes) -> np.ndarray:
        """The same merges for one long row: pairs wait in a heap by rank, then place; neighbours are linked."""
        ids = self.of_byte[np.frombuffer(piece, np.uint8)].tolist()
        count = len(ids)
        after, before = list(range(1, count + 1)), list(range(-1, count - 1))
        tokens = self.tokens
        first = self.pairs.lookup(np.array(ids[:-1]), np.array(ids[1:]))
        heap = [(rank, at) for at, rank in enumerate(first.tolist()) if rank != NONE]
        waits = dict((at, rank) for rank, at in heap)
        heapq.heapify(heap)

        def offer(at: int) -> None:
            waits.pop(at, None)
            if at >= 0 and after[at] < count:
                rank = self.ids.get(tokens[ids[at]] + tokens[ids[after[at]]])
                if rank is not None:
                    waits[at] = rank
                    heapq.heappush(heap, (rank, at))

        while heap:
            rank, at = heapq.heappop(heap)
            if waits.get(at) != rank:
                continue
            gone = after[at]
            ids[at], ids[gone] = rank, -1
            after[at] = after[gone]
            if after[gone] < count:
                before[after[gone]] = at
            waits.pop(gone, None)
            offer(at)
            if before[at] >= 0:
                offer(before[at])
        return np.array([one for one in ids if one >= 0], np.int32)

    def decode(self, ids: np.ndarray) -> np.ndarray:
        """The bytes of the ids, joined."""
        lengths = self.lengths[ids]
        return self.flat[np.arange(lengths.sum()) + np.repeat(self.starts[ids] - (np.cumsum(lengths) - lengths), lengths)]


class Memory:
    """Pieces encoded so far, by their 64-bit hash."""

    def __init__(self, size: int, decimal: bool) -> None:
        self.slots: dict[int, int] = {}
        self.ids = np.zeros(1 << 16, np.int32)
        self.starts = np.zeros(size, np.int64)
        self.counts = np.zeros(size, np.int64)
        self.texts = np.empty(size if decimal else 0, object)  #: the ids in decimal, joined by commas
        self.decimal = decimal
        self.used = 0

    def add(self, hashes: list[int], encoded: list[np.ndarray]) -> None:
        if len(self.slots) + len(hashes) > len(self.starts):
            more = len(self.slots) + len(hashes) - len(self.starts)
            self.starts, self.counts = (np.concatenate([a, np.zeros(more, np.int64)]) for a in (self.starts, self.counts))
            self.texts = np.concatenate([self.texts, np.empty(more if self.decimal else 0, object)])
        joined = np.concatenate(encoded)
        if self.used + len(joined) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros(max(len(self.ids), len(joined)), np.int32)])
        self.ids[self.used:self.used + len(joined)] = joined
        first = len(self.slots)
        for slot, (key, ids) in enumerate(zip(hashes, encoded, strict=True), first):
            self.slots[key] = slot
            if self.decimal:
                self.texts[slot] = ",".join(map(str, ids.tolist())).encode()
        counts = np.array([len(ids) for ids in encoded])
        self.counts[first:first + len(counts)] = counts
        self.starts[first:first + len(counts)] = self.used + np.cumsum(counts) - counts
        self.used += len(joined)


class Encoder:
    def __init__(self, vocabulary: Vocabulary, remembered: int = REMEMBERED, decimal: bool = True):
        self.vocabulary, self.remembered, self.decimal = vocabulary, remembered, decimal
        self.memory = Memory(remembered, decimal)

    def encode(self, data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The slot in memory of each piece, the bounds of the texts in pieces, and those in ids."""
        begins = piece_begins(data, bounds)
        by_text = np.searchsorted(begins, bounds)
        if not len(begins):
            return np.zeros(0, np.int64), by_text, np.zeros(len(bounds), np.int64)
        ends = np.append(begins[1:], len(data))
        hashes, first, inverse = np.unique(segment_hashes(data, ends - begins), return_index=True, return_inverse=True)
        if len(self.memory.slots) + len(hashes) > self.remembered and self.memory.slots:
            self.memory = Memory(self.remembered, self.decimal)
        memory = self.memory
        keys = hashes.tolist()
        known = np.fromiter(map(memory.slots.get, keys, repeat(-1)), np.int64, len(keys))
        new = np.flatnonzero(known < 0)
        if len(new):
            raw, used = data.tobytes(), len(memory.slots)
            pieces = [raw[begin:end] for begin, end in zip(begins[first[new]].tolist(), ends[first[new]].tolist(), strict=True)]
            memory.add([keys[at] for at in new.tolist()], self.vocabulary.encode_pieces(pieces))
            known[new] = np.arange(used, used + len(new))
        slots = known[inverse]
        ids_before = np.concatenate([[0], np.cumsum(memory.counts[slots])])
        return slots, by_text, ids_before[by_text]

    def ids(self, slots: np.ndarray) -> np.ndarray:
        counts = self.memory.counts[slots]
        ends = np.cumsum(counts)
        return self.memory.ids[np.arange(counts.sum()) + np.repeat(self.memory.starts[slots] - (ends - counts), counts)]


def read_ranks(raw: bytes) -> dict[bytes, int]:
    return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, raw.splitlines()) if token}


@lru_cache(maxsize=2)
def encoder_of(raw: bytes) -> Encoder:
    """One per worker, used by task after task."""
    return Encoder(Vocabulary(read_ranks(raw)))


def shipped(documents: DataFrame, path: str):
    """The vocabulary file (under a megabyte) for the executors, which need not have it."""
    with open(path, "rb") as file:
        return documents.sparkSession.sparkContext.broadcast(file.read())


def encoded(documents: DataFrame, path: str) -> DataFrame:
    """(doc_id, ids) of documents (doc_id, text): ids as array<int>; a null or empty text has none."""
    raw = shipped(documents, path)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(raw.value)
        for batch in blocks(batches):
            slots, _, id_bounds = encoder.encode(*text_bytes(batch.column("text")))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), lists(encoder.ids(slots), id_bounds)],
                                             ["doc_id", "ids"])

    return documents.select("doc_id", "text").mapInArrow(encode, "doc_id long, ids array<int>")


def decoded(rows: DataFrame, path: str) -> DataFrame:
    """(doc_id, bytes) of rows (doc_id, ids); null ids give no bytes."""
    raw = shipped(rows, path)

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = encoder_of(raw.value).vocabulary
        for batch in batches:
            texts = [vocabulary.decode(np.array(ids.as_py() or [], np.int64)).tobytes() for ids in batch.column("ids")]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.binary())], ["doc_id", "bytes"])

    return rows.select("doc_id", "ids").mapInArrow(decode, "doc_id long, bytes binary")


def round_trip(documents: DataFrame, path: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of every row of documents (doc_id, text).

    Encodes each text and decodes its ids; the digests are of the decimal ids joined by commas and of the decoded
    bytes.  A null or empty text has no ids and no bytes.  Null, repeated or tied doc_ids are passed on as they are; no
    rows give no rows; other columns are not looked at.
    """
    raw = shipped(documents, path)

    def both_ways(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(raw.value)
        vocabulary = encoder.vocabulary
        for batch in blocks(batches):
            slots, pieces, id_bounds = encoder.encode(*text_bytes(batch.column("text")))
            ids = encoder.ids(slots)
            texts = encoder.memory.texts[slots]
            sizes = np.concatenate([[0], np.cumsum(vocabulary.lengths[ids])])[id_bounds]
            data = vocabulary.decode(ids).tobytes()
            of_ids = [hashlib.sha256(b",".join(texts[begin:end].tolist())).hexdigest()
                      for begin, end in zip(pieces[:-1].tolist(), pieces[1:].tolist(), strict=True)]
            of_bytes = [hashlib.sha256(data[begin:end]).hexdigest()
                        for begin, end in zip(sizes[:-1].tolist(), sizes[1:].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(np.diff(id_bounds), pa.int64()),
                                              pa.array(of_ids, pa.string()), pa.array(of_bytes, pa.string())],
                                             ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return documents.select("doc_id", "text").mapInArrow(
        both_ways, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
