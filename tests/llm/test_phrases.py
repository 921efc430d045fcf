"""Locally consistent parsing: equal substrings have the same interior phrases wherever they stand."""

import random

import numpy as np
import pyarrow as pa
import pytest

from metermill.llm.common import text_bytes
from metermill.llm.phrases import BYTE_NAMES, KEPT, fingerprints, least, likeness, phrases


def levels(text, count):
    """The phrase names of each level, in the text's order."""
    data, bounds = text_bytes(pa.array([text], pa.large_string()))
    names, plain, found = BYTE_NAMES[data], data, []
    for _ in range(count):
        names, bounds = phrases(names, plain, bounds)
        plain = names
        found.append(names.tolist())
    return found


def common_run(one, other):
    """The longest run of names that both have."""
    best, ends = 0, {}
    for i, name in enumerate(one):
        now = {}
        for j, that in enumerate(other):
            if that == name:
                now[j] = ends.get(j - 1, 0) + 1
                best = max(best, now[j])
        ends = now
    return best


@pytest.mark.parametrize("seed", range(6))
def test_interior_phrases_do_not_depend_on_the_offset(seed):
    choose = random.Random(seed)
    shared = " ".join("".join(choose.choices("abcdefghij", k=choose.randrange(2, 9))) for _ in range(700))
    one = levels(shared, 4)
    for _ in range(4):
        before, behind = ("".join(choose.choices("abcdefghij \n", k=choose.randrange(1, 200))) for _ in range(2))
        other = levels(before + shared + behind, 4)
        for level, (mine, theirs) in enumerate(zip(one, other, strict=True), 1):
            # Only phrases within a few names of either end may differ, whatever the level.
            assert common_run(mine, theirs) >= len(mine) - 16, level


def test_texts_are_parsed_alone_whatever_batch_they_are_in():
    choose = random.Random(1)
    texts = ["", "a", "aaaaaaa", "ab" * 50, "é" * 9, *("".join(choose.choices("ab \n", k=choose.randrange(300))) for _ in range(60))]
    alone = [fingerprints([text])[0].tolist() for text in texts]
    assert [one.tolist() for one in fingerprints(texts)] == alone
    assert [one.tolist() for one in fingerprints(texts[::-1])] == alone[::-1]


def test_likeness_against_sets():
    choose = random.Random(2)
    for _ in range(300):
        one, other = (set(choose.sample(range(120), choose.randrange(0, 100))) for _ in range(2))
        a, b = (least(np.array(sorted(x), np.uint32)) if x else np.zeros(0, np.uint32) for x in (one, other))
        kept = [sorted(x)[:KEPT] for x in (one, other)]
        if not one or not other:
            wanted = float(not one and not other)
        else:
            union = sorted(set(kept[0]) | set(kept[1]))[:max(map(len, kept))]
            wanted = sum(x in kept[0] and x in kept[1] for x in union) / len(union)
        assert likeness(a, b) == pytest.approx(wanted)
