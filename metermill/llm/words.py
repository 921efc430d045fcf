"""Words of many texts at once: where they are in the bytes and a 64-bit hash of each."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

from .common import mixed, numbers


def byte_class(*ranges: tuple[int, int]) -> np.ndarray:
    inside = np.zeros(256, bool)
    for low, high in ranges:
        inside[low:high + 1] = True
    return inside


#: Bytes between words: blanks only, or everything in ASCII but digits and letters.
BLANKS = byte_class((0x09, 0x0D), (0x20, 0x20))
PUNCTUATION = byte_class((0x00, 0x2F), (0x3A, 0x40), (0x5B, 0x60), (0x7B, 0x7F))
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20
BYTE_VALUES = numbers(11, 256)
#: An odd factor for each place in a word; longer words get theirs on the way.
PLACES = numbers(12, 256) | np.uint64(1)
STEPS = numbers(13, 64) | np.uint64(1)


@dataclass
class Words:
    hashes: np.ndarray  #: one uint64 per word
    bounds: np.ndarray  #: words of text i: bounds[i] to bounds[i + 1]
    begins: np.ndarray  #: of each word, in the joined bytes
    ends: np.ndarray


def segment_hashes(data: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """A hash of each of the segments, none of them empty, that make up the data."""
    if not len(lengths):
        return np.zeros(0, np.uint64)
    first = np.cumsum(lengths) - lengths
    place = np.arange(len(data), dtype=np.int64) - np.repeat(first, lengths)
    longest = int(lengths.max())
    factors = PLACES if longest <= len(PLACES) else numbers(12, longest) | np.uint64(1)
    values = BYTE_VALUES[data]
    values *= factors[place]
    return mixed(np.add.reduceat(values, first) + lengths.astype(np.uint64))


def words_of(data: np.ndarray, bounds: np.ndarray, between: np.ndarray = BLANKS) -> Words:
    """The words of the joined texts in lower case (A-Z only): longest runs of bytes that aren't `between`."""
    data = LOWER[data]
    inside = ~between[data]
    # A word also ends where its text does.
    starts = inside.copy()
    starts[1:] &= ~inside[:-1]
    cut = bounds[1:-1]
    cut = cut[cut < len(data)]
    starts[cut] = inside[cut]
    stops = inside.copy()
    stops[:-1] &= ~inside[1:]
    last = cut[cut > 0] - 1
    stops[last] = inside[last]
    begins, ends = np.flatnonzero(starts), np.flatnonzero(stops) + 1
    hashes = segment_hashes(data[inside], ends - begins)
    return Words(hashes, np.searchsorted(begins, bounds), begins, ends)


def shingles(words: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the runs of `size` words, and their bounds by text.

    A text of fewer words, but not none, has one shingle: all its words.
    """
    counts = np.diff(words.bounds)
    made = np.where(counts >= size, counts - size + 1, np.minimum(counts, 1))
    bounds = np.concatenate([[0], np.cumsum(made)])
    if not bounds[-1]:
        return np.zeros(0, np.uint64), bounds
    owner = np.repeat(np.arange(len(counts)), made)
    at = np.arange(bounds[-1]) - bounds[owner] + words.bounds[owner]
    long = counts[owner]
    total = np.minimum(long, size).astype(np.uint64)
    padded = np.concatenate([words.hashes, np.zeros(size, np.uint64)])
    for step in range(size):
        part = padded[at + step] * STEPS[step]
        if step:
            part[long <= step] = 0
        total += part
    return mixed(total), bounds
