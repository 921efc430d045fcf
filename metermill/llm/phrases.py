"""Document fingerprints by locally consistent parsing.

A text is parsed in levels.  On each, runs of equal names are taken as one; deterministic coin tossing gives each name a
label below 6 that differs from its neighbours' and depends on a few names to the left alone; a phrase begins where the
label is a local minimum, and is named by a hash of its names.  Equal substrings so get equal phrases but near their ends,
wherever they stand.  A fingerprint keeps the least hashes of the phrase names from the second level up.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import BLOCK_BYTES, mixed, numbers, text_bytes
from .ranges import Ranges

KEPT = 64  #: hashes in a fingerprint
LEVELS = 24
BYTE_NAMES = numbers(31, 256)
PLACES = numbers(32, 64) | np.uint64(1)


def tossed(left: np.ndarray, own: np.ndarray) -> np.ndarray:
    """2 i + b: the lowest bit i in which a name differs from its left neighbour, and its own bit there."""
    apart = left ^ own
    lowest = apart & (~apart + apart.dtype.type(1))
    bit = (np.frexp(lowest.astype(np.float64))[1] - 1).astype(np.uint8)
    return (2 * bit + ((own & lowest) > 0)).astype(np.uint8)


LEFT, OWN = np.meshgrid(np.arange(256, dtype=np.uint8), np.arange(256, dtype=np.uint8), indexing="ij")
TOSSED = tossed(LEFT.ravel() ^ (LEFT == OWN).ravel().astype(np.uint8), OWN.ravel())


def toss(labels: np.ndarray, opens: np.ndarray) -> np.ndarray:
    """One toss of labels below 256; a text's first label has its own value with the lowest bit turned to its left."""
    left = np.empty_like(labels)
    left[1:] = labels[:-1]
    left[opens] = labels[opens] ^ 1
    return TOSSED[left.astype(np.uint16) << 8 | labels]


def phrases(names: np.ndarray, plain: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The phrase names of the next level and their bounds by text.  plain: what the labels are tossed from, bytes or the
    names themselves; texts may be empty."""
    some = np.diff(bounds) > 0
    opens = bounds[:-1][some]
    fresh = np.empty(len(plain), bool)
    fresh[1:] = plain[1:] != plain[:-1]
    fresh[opens] = True
    at = np.flatnonzero(fresh)
    runs = np.diff(np.append(at, len(plain)))
    plain, names = plain[at], names[at]
    long = runs > 1
    names = names.copy()
    names[long] = mixed(names[long] + runs[long].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    bounds = np.searchsorted(at, bounds)
    opens = bounds[:-1][some]
    if plain.dtype == np.uint8:
        labels = plain
    else:
        left = np.empty_like(plain)
        left[1:] = plain[:-1]
        left[opens] = plain[opens] ^ np.uint64(1)
        labels = tossed(left, plain)
    for _ in range(3):
        labels = toss(labels, opens)
    begins = np.zeros(len(labels), bool)
    begins[1:-1] = (labels[1:-1] < labels[:-2]) & (labels[1:-1] < labels[2:])
    begins[opens[1:] - 1] = False  # what comes after a text's last name is another text
    begins[opens] = True
    first = np.flatnonzero(begins)
    place = np.arange(len(labels)) - np.repeat(first, np.diff(np.append(first, len(labels))))
    values = names * PLACES[np.minimum(place, len(PLACES) - 1)]
    found = mixed(np.add.reduceat(values, first) + np.diff(np.append(first, len(labels))).astype(np.uint64))
    return found, np.searchsorted(first, bounds)


def fingerprints(texts: list[str]) -> list[np.ndarray]:
    """Of each text the least hashes, ascending, at most KEPT; none for an empty text."""
    data, bounds = text_bytes(pa.array(texts, pa.large_string()))
    kept: list[list[np.ndarray]] = [[] for _ in texts]
    names, plain = BYTE_NAMES[data], data
    open_ones = np.diff(bounds) > 0
    if len(data):
        for level in range(1, LEVELS):
            names, bounds = phrases(names, plain, bounds)
            plain = names
            high = (mixed(names + np.uint64(level)) >> np.uint64(32)).astype(np.uint32)
            # Each text goes by its own levels, so that it doesn't matter which others are in the batch.
            for at in np.flatnonzero(open_ones).tolist():
                begin, end = int(bounds[at]), int(bounds[at + 1])
                several = end > begin + 1
                if several and level > 1 or not several and (level < 3 or not kept[at]):
                    kept[at].append(high[begin:end])
            open_ones &= np.diff(bounds) > 1
            if not open_ones.any():
                break
    return [least(np.concatenate(one)) if one else np.zeros(0, np.uint32) for one in kept]


def least(hashes: np.ndarray) -> np.ndarray:
    hashes = np.sort(hashes)
    return hashes[np.append(True, hashes[1:] != hashes[:-1])][:KEPT]


def likeness(one: np.ndarray, other: np.ndarray) -> float:
    """The estimated share of common phrases among all: of the least hashes of both, those that both have."""
    if not len(one) or not len(other):
        return float(len(one) == len(other))
    both = np.sort(np.concatenate([one, other]))
    again = both[1:] == both[:-1]
    first = np.append(True, ~again)
    number = min(max(len(one), len(other)), int(first.sum()))
    last = np.flatnonzero(first)[number - 1]
    return float(again[:last + 1].sum() / number)


def hexadecimal(hashes: np.ndarray) -> str:
    return hashes.astype(">u4").tobytes().hex()


def edited_fingerprints(documents: DataFrame) -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next) of every row of documents
    (doc_id, text).

    The next document is that of the next smaller doc_id; after the smallest comes the largest.  The edited text has the
    next one's first code points, as many as a third of its own or all, in place of its last third.

    Null texts read as empty; empty texts have an empty fingerprint, like another's by 1 if that is empty too, else by 0.
    Rows without doc_id stand below all others; rows that share one are ordered by text.  No rows give no rows; other
    columns are not looked at.

    Each text is shuffled once, into ranges of doc_id; the last of each range goes to the next range too.
    """
    ranges = Ranges.of(documents, "doc_id")
    documents = documents.select("doc_id", "text", ranges.value().alias("key"), ranges.part().alias("part"))
    # At most as many rows as there are ranges.
    tops = sorted((row["part"], row["top"]) for row in
                  documents.groupBy("part").agg(F.max("key").alias("top")).collect())
    goes = [(top, tops[(at + 1) % len(tops)][0]) for at, (_, top) in enumerate(tops)]
    if goes:
        target = F.element_at(F.create_map(*(F.lit(one) for pair in goes for one in pair)), F.col("key"))
        places = F.array_compact(F.array(F.struct("part", F.lit(1).alias("own")), F.when(
            target.isNotNull(), F.struct(target.alias("part"), F.lit(0).alias("own")))))
        documents = documents.select("doc_id", "text", "key", F.explode(places).alias("place")).select(
            "doc_id", "text", "key", "place.part", "place.own")
    else:
        documents = documents.withColumn("own", F.lit(1))
    rows = ranges.dealt(documents, "part", "own", "key", "text").select("part", "own", "doc_id", "text")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, before, print_before = None, "", np.zeros(0, np.uint32)
        for batch in batches:
            columns = [batch.column(name).to_pylist() for name in ("part", "own", "doc_id", "text")]
            everything = list(zip(*columns, strict=True))
            begin = 0
            while begin < len(everything):
                end, size = begin, 0
                while end < len(everything) and (end == begin or size < BLOCK_BYTES):
                    size += len(everything[end][3] or "")
                    end += 1
                block = everything[begin:end]
                begin = end
                texts = [text or "" for *_, text in block]
                edited = []
                for (own_part, own, _, _), text in zip(block, texts, strict=True):
                    before = before if own_part == part else ""
                    part = own_part
                    third = len(text) // 3
                    edited.append(text[:len(text) - third] + before[:third] if own else "")
                    before = text
                prints, edited_prints = fingerprints(texts), fingerprints(edited)
                found = []
                for (_, own, doc_id, _), text, new, one, two in zip(block, texts, edited, prints, edited_prints,
                                                                    strict=True):
                    if own:
                        found.append((doc_id, len(text), hashlib.sha256(new.encode()).hexdigest(), hexadecimal(one),
                                      hexadecimal(two), likeness(one, two), likeness(one, print_before)))
                    print_before = one
                yield pa.RecordBatch.from_pylist([dict(zip(OUT.names, row, strict=True)) for row in found], OUT)

    return rows.mapInArrow(compare, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
                           "edited_fingerprint string, near_edited double, near_next double")


OUT = pa.schema([("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()),
                 ("fingerprint", pa.string()), ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()),
                 ("near_next", pa.float64())])
