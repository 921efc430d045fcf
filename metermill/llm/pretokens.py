"""Where the pieces of byte-level BPE begin, for many texts at once.

The pattern is the one that public_tokenizers.PATTERN states: contractions, letters, digits or other signs with at most
one blank before them, and runs of white space, of which the last sign goes with what follows.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np

SPACE, LETTER, NUMBER, OTHER = range(4)
#: White space as Unicode's property has it, and the contractions after an apostrophe.
WHITE_SPACE = (0x09, 0x0A, 0x0B, 0x0C, 0x0D, 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F,
               0x205F, 0x3000)
SHORT, LONG = "stmd", ("re", "ve", "ll")


def members(pattern: str) -> np.ndarray:
    """The code points that a class of signs has in the tokenizer library, whose Unicode tables may be newer than Python's."""
    import tiktoken

    each_byte = {bytes([byte]): byte for byte in range(256)}
    library = tiktoken.Encoding("class", pat_str=pattern, mergeable_ranks=each_byte, special_tokens={})
    found = []
    for begin in range(0, 0x110000, 4096):
        points = [point for point in range(begin, begin + 4096) if not 0xD800 <= point < 0xE000]
        found.append(bytes(library.encode_ordinary("".join(map(chr, points)))))
    return np.frombuffer(b"".join(found).decode().encode("utf-32-le"), np.uint32)


@lru_cache(maxsize=1)
def kinds() -> np.ndarray:
    """The class of every code point."""
    table = np.full(0x110000, OTHER, np.uint8)
    table[members(r"\p{L}")], table[members(r"\p{N}")] = LETTER, NUMBER
    table[list(WHITE_SPACE)] = SPACE
    return table


def code_points(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The code points of UTF-8 bytes, and the byte at which each begins."""
    begins = np.flatnonzero((data & 0xC0) != 0x80)
    return np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32), begins


def piece_begins(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """The bytes at which pieces begin, in order; texts are bounds[i] to bounds[i + 1]."""
    if not len(data):
        return np.zeros(0, np.int64)
    points, at = code_points(data)
    count = len(points)
    kind = kinds()[points]
    opens = np.zeros(count + 1, bool)  # a text begins
    opens[np.searchsorted(at, bounds[:-1])] = True
    opens = opens[:count]
    run = opens.copy()
    run[1:] |= kind[1:] != kind[:-1]
    begins = run.copy()
    white = kind == SPACE
    # The last sign of white space before something else: a blank joins it, any other is a piece of its own.
    last = np.zeros(count, bool)
    last[:-1] = white[:-1] & ~white[1:] & ~opens[1:]
    where = np.flatnonzero(last)
    begins[where] = True
    begins[where[points[where] == 0x20] + 1] = False
    # An apostrophe of its own that no blank precedes, with a contraction after it.
    lone = np.flatnonzero((points == 0x27) & run & begins)
    lone = lone[lone + 1 < count]
    lone = lone[(kind[lone + 1] == LETTER) & ~opens[lone + 1]]
    if len(lone):
        next_one = points[lone + 1]
        after = np.where(lone + 2 < count, points[np.minimum(lone + 2, count - 1)], 0)
        after[(lone + 2 < count) & opens[np.minimum(lone + 2, count - 1)]] = 0
        taken = np.isin(next_one, [ord(one) for one in SHORT]).astype(np.int64)
        for pair in LONG:
            taken[(next_one == ord(pair[0])) & (after == ord(pair[1]))] = 2
        hit = taken > 0
        lone, taken = lone[hit], taken[hit]
        begins[lone + 1] = False
        rest = lone + 1 + taken
        rest = rest[rest < count]
        begins[rest] = True
    return at[begins]
