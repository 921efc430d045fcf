"""Token ids in files of directly addressable codes.

An id is split into chunks of 8 bits.  Level 0 has the lowest chunk of every id, level k the chunk k of those ids that
reach so far; a bitmap per level tells which of its ids go on, and a rank directory counts the set bits before every
512th.  The place of an id's next chunk is the rank of its bit, so any id is read without decoding others.

A file: one line of JSON with the counts, then the arrays as little-endian numbers: document ids and whether they are
known, first ids of the documents, then per level chunks, bitmap and directory.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .byte_bpe import Encoder, shipped
from .common import blocks, fresh_folder, staged, text_bytes
from .files import new_file, read_file, write_file
from .ranges import Ranges

#: Ids after which a file is closed, at the next document.
FILE_IDS = 2_000_000
STEP = 512
#: Ids that are read at once; a longer document's are all read at once.
READ_IDS = 1 << 18
#: Pieces that a worker remembers.
REMEMBERED = 500_000


class Codes:
    def __init__(self, levels: list[tuple[np.ndarray, np.ndarray, np.ndarray]], size: int):
        self.levels = levels
        self.size = size

    @classmethod
    def of(cls, ids: np.ndarray) -> Codes:
        levels, size, rest = [], len(ids), ids.astype(np.uint64)
        while True:
            chunks = (rest & np.uint64(255)).astype(np.uint8)
            rest = rest >> np.uint64(8)
            on = rest > 0
            bits = np.packbits(on, bitorder="little")
            bits = np.concatenate([bits, np.zeros(-len(bits) % (STEP // 8), np.uint8)])
            ones = np.bitwise_count(bits).reshape(-1, STEP // 8).sum(axis=1, dtype=np.int64)
            levels.append((chunks, bits, np.concatenate([[0], np.cumsum(ones)])))
            rest = rest[on]
            if not len(rest):
                return cls(levels, size)

    def ranks(self, level: int, at: np.ndarray) -> np.ndarray:
        """Set bits before each place: the directory's count and those since its mark."""
        _, bits, directory = self.levels[level]
        mark = at // STEP
        since = bits.reshape(-1, STEP // 8)[mark]
        left = (at % STEP)[:, None] - 8 * np.arange(STEP // 8)
        masks = ((1 << np.clip(left, 0, 8)) - 1).astype(np.uint8)
        return directory[mark] + np.bitwise_count(since & masks).sum(axis=1, dtype=np.int64)

    def take(self, at: np.ndarray) -> np.ndarray:
        """The ids at any places."""
        at = np.asarray(at, np.int64)
        found = np.zeros(len(at), np.uint64)
        who = np.arange(len(at))
        for level, (chunks, bits, _) in enumerate(self.levels):
            found[who] |= chunks[at].astype(np.uint64) << np.uint64(8 * level)
            on = (bits[at // 8] >> (at % 8).astype(np.uint8)) & 1 == 1
            who, at = who[on], self.ranks(level, at[on]) if on.any() else at[on]
            if not len(who):
                break
        return found

    def slice(self, begin: int, end: int) -> np.ndarray:
        """The ids from begin to end: one rank per level, as neighbours' chunks are neighbours."""
        found = np.zeros(end - begin, np.uint64)
        who = np.arange(end - begin)
        for level, (chunks, bits, _) in enumerate(self.levels):
            if not len(who):
                break
            found[who] |= chunks[begin:end].astype(np.uint64) << np.uint64(8 * level)
            on = np.unpackbits(bits[begin // 8:(end + 7) // 8], bitorder="little")[begin % 8:][:end - begin] == 1
            who = who[on]
            if len(who):
                begin = int(self.ranks(level, np.array([begin]))[0])
                end = begin + len(who)
        return found


def packed(doc_ids: list[int | None], firsts: np.ndarray, codes: Codes) -> bytes:
    head = {"documents": len(doc_ids), "ids": codes.size, "levels": [len(chunks) for chunks, _, _ in codes.levels]}
    arrays = [np.array([one or 0 for one in doc_ids], "<i8"), np.array([one is not None for one in doc_ids], np.uint8),
              firsts.astype("<i8")]
    for chunks, bits, directory in codes.levels:
        arrays += [chunks, bits, directory.astype("<i8")]
    return json.dumps(head).encode() + b"\n" + b"".join(one.tobytes() for one in arrays)


def unpacked(data: bytes) -> tuple[list[int | None], np.ndarray, Codes]:
    at = data.index(b"\n") + 1
    head = json.loads(data[:at])

    def array(kind: str, count: int) -> np.ndarray:
        nonlocal at
        found = np.frombuffer(data, kind, count, at)
        at += found.nbytes
        return found

    number = head["documents"]
    doc_ids, known, firsts = array("<i8", number), array("u1", number), array("<i8", number + 1)
    levels = []
    for count in head["levels"]:
        marks = -(-count // STEP)
        levels.append((array("u1", count), array("u1", marks * STEP // 8), array("<i8", marks + 1)))
    return [one if sure else None for one, sure in zip(doc_ids.tolist(), known, strict=True)], firsts, Codes(
        levels, head["ids"])


class Library:
    """The pieces' ids by the tokenizers library, which is called once for all pieces that it tells apart by their blanks."""

    def __init__(self, raw: bytes):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(raw.decode())
        self.added = [token.content.encode() for token in self.tokenizer.get_added_tokens_decoder().values()]
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=False)
        self.lengths = np.zeros(self.tokenizer.get_vocab_size() + 1, np.int64)  #: of each id, in bytes: a sign stands for one
        self.lengths[list(vocabulary.values())] = [len(token) for token in vocabulary]

    def encode_pieces(self, pieces: list[bytes]) -> list[np.ndarray]:
        texts = [piece.decode() for piece in pieces]
        blank = [text[0] == " " and bool(text[1:2].strip()) for text in texts]
        joined = [at for at, one in enumerate(blank) if one]
        found: list[np.ndarray | None] = [None] * len(pieces)
        if joined:
            ids = self.encoded(["".join([texts[at] for at in joined])])[0]
            ends, wanted = np.cumsum(self.lengths[ids]), np.cumsum([len(pieces[at]) for at in joined])
            cuts = np.searchsorted(ends, wanted)
            if cuts[-1] == len(ids) - 1 and (ends[cuts] == wanted).all():  # no token reaches over the end of a piece
                bounds = [0, *(cuts + 1).tolist()]
                for at, begin, end in zip(joined, bounds[:-1], bounds[1:], strict=True):
                    found[at] = ids[begin:end]
        rest = [at for at, ids in enumerate(found) if ids is None]
        for at, ids in zip(rest, self.encoded([texts[at] for at in rest]), strict=True):
            found[at] = ids
        return found

    def encoded(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(one.ids, np.int32) for one in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]


@lru_cache(maxsize=2)
def library_of(raw: bytes) -> Encoder:
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the cores are Spark's
    return Encoder(Library(raw), REMEMBERED, decimal=False)


def ids_of(encoder: Encoder, column: pa.Array) -> Iterator[np.ndarray]:
    """The ids of each text; equal pieces are encoded once.  Texts with the string of an added token go to the library
    whole, as it doesn't cut these into pieces."""
    data, bounds = text_bytes(column)
    raw = data.tobytes()
    special = any(one in raw for one in encoder.vocabulary.added)
    if not special:
        slots, _, id_bounds = encoder.encode(data, bounds)
        yield from np.split(encoder.ids(slots), id_bounds[1:-1])
        return
    for begin, end in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        if any(one in raw[begin:end] for one in encoder.vocabulary.added):
            text = raw[begin:end].decode()
            yield np.array(encoder.vocabulary.tokenizer.encode(text, add_special_tokens=False).ids, np.int32)
        else:
            slots, _, _ = encoder.encode(data[begin:end], np.array([0, end - begin]))
            yield encoder.ids(slots)


def written(documents: DataFrame, path: str, folder: str, end_id: int = 0) -> DataFrame:
    """The list of the files that hold the ids of documents (doc_id, text), each document's followed by end_id, in
    ascending order of doc_id: (part, number, file, n_ids), ordered by part and number."""
    raw = shipped(documents, path)
    ranges = Ranges.of(documents, "doc_id")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = library_of(raw.value)
        part, number, ids, doc_ids, size = None, 0, [], [], 0

        def close() -> Iterator[pa.RecordBatch]:
            nonlocal number, ids, doc_ids, size
            if doc_ids:
                firsts = np.concatenate([[0], np.cumsum([len(one) for one in ids])])
                write_file(name := new_file(folder, ".dac"), packed(doc_ids, firsts, Codes.of(np.concatenate(ids))))
                yield pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int32()), "number": pa.array(
                    [number], pa.int32()), "file": [name], "n_ids": pa.array([int(firsts[-1])], pa.int64())})
                number, ids, doc_ids, size = number + 1, [], [], 0

        end = np.array([end_id], np.int32)
        for batch in blocks(batches):
            rows = zip(batch.column("part").to_pylist(), batch.column("doc_id").to_pylist(),
                       ids_of(encoder, batch.column("text")), strict=True)
            for own, doc_id, found in rows:
                if own != part or size >= FILE_IDS:
                    yield from close()
                    part, number = own, number if own == part else 0
                ids.append(np.append(found, end))
                doc_ids.append(doc_id)
                size += len(found) + 1
        yield from close()

    rows = ranges.dealt(documents.select("doc_id", "text"), ranges.part(), ranges.value(), "text")
    return rows.select("part", "doc_id", "text").mapInArrow(write, "part int, number int, file string, n_ids long")


def document_crcs(firsts: np.ndarray, codes: Codes) -> list[int]:
    """The crc32 of each document's ids; neighbours are read at once."""
    found, at = [], 0
    while at < len(firsts) - 1:
        end = max(at + 1, int(np.searchsorted(firsts, firsts[at] + READ_IDS, "right")) - 1)
        data = memoryview(codes.slice(int(firsts[at]), int(firsts[end])).astype("<u4")).cast("B")
        bounds = (4 * (firsts[at:end + 1] - firsts[at])).tolist()
        found += [zlib.crc32(data[begin:after]) for begin, after in zip(bounds[:-1], bounds[1:], strict=True)]
        at = end
    return found


def read_back(files: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) from the files, of which base says how many ids all before it hold."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, base in zip(batch.column("file").to_pylist(), batch.column("base").to_pylist(), strict=True):
                doc_ids, firsts, codes = unpacked(read_file(name))
                crc = document_crcs(firsts, codes)
                yield pa.RecordBatch.from_pydict({
                    "doc_id": pa.array(doc_ids, pa.int64()), "start": pa.array(base + firsts[:-1], pa.int64()),
                    "n_tokens": pa.array(np.diff(firsts), pa.int64()), "ids_crc32": pa.array(crc, pa.int64())})

    parts = int(files.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return files.select("file", "base").repartition(parts, "file").mapInArrow(
        read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_files(documents: DataFrame, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every row of documents (doc_id, text), from the files written for them.

    start counts the ids of all documents before, in ascending order of doc_id; n_tokens counts the end id too.  Null
    and empty texts have the end id alone.  Rows without doc_id come first; rows that share one are ordered by text.  No
    rows write no file.  Other columns are not looked at.
    """
    spark = documents.sparkSession
    files = staged(written(documents, path, fresh_folder(spark, "token-ids")), "token-files")
    # One row for each part, of which there are as many as shuffle partitions.
    totals = {row["part"]: row["n"] for row in files.groupBy("part").agg(F.sum("n_ids").alias("n")).collect()}
    before, bases = 0, []
    for part in sorted(totals):
        bases.append((part, before))
        before += totals[part]
    bases = F.broadcast(spark.createDataFrame(bases or [(0, 0)], "part int, part_first long"))
    own = Window.partitionBy("part").orderBy("number").rowsBetween(Window.unboundedPreceding, -1)
    # Known before anything is read, so that what is read needs no join.
    based = files.withColumn("file_first", F.coalesce(F.sum("n_ids").over(own), F.lit(0))).join(bases, "part").select(
        "file", (F.col("file_first") + F.col("part_first")).alias("base"))
    return read_back(based)
