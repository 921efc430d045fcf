"""Hard negatives against scoring every pair, and the bounds of the summaries."""

import math
import random

import duckdb
import numpy as np
import pytest

from metermill.llm import hard_negatives as module
from metermill.llm.hard_negatives import HardNegatives, hard_negatives, segment_bounds, summaries
from metermill.llm.queries import ORACLE, op12_hard_negatives

VECTORS = "vec_id long, embedding array<double>, label int, size string, row string, score double"
OUT = ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def brute_force(rows, by=HardNegatives()):
    vectors = []
    for one, values, label in rows:
        if label is not None and values is not None and all(x is not None and math.isfinite(x) for x in values):
            vectors.append((one, [math.floor(by.scale * x) for x in values], label))
    found = []
    for at, (anchor, q, label) in enumerate(vectors):
        if anchor is None or anchor % 100:
            continue
        scored = []
        for other, (one, values, own) in enumerate(vectors):
            if other != at and len(values) == len(q):
                scored.append((-sum(x * y for x, y in zip(q, values)), one is None, one or 0, own == label))
        scored.sort()
        for score, unknown, one, same in [row for row in scored if row[3]][:by.positives]:
            fits = [row for row in scored if not row[3] and by.low_percent * -score <= 100 * -row[0] <= by.high_percent * -score]
            for rank, row in enumerate(fits[:by.negatives], 1):
                found.append((anchor, None if unknown else one, rank, None if row[1] else row[2], -score, -row[0]))
    return sorted(map(repr, found))


def result(frame):
    return sorted(repr(tuple(row[name] for name in OUT)) for row in frame.collect())


def table(spark, rows):
    return spark.createDataFrame([(*row, "clash", "clash", 0.5) for row in rows], VECTORS)


def awkward(choose):
    rows = []
    for n in range(600):
        centre = n % 5
        rows.append((n, [choose.choice([0.0, 0.1, 0.25]) + (at % 5 == centre) for at in range(8)], choose.choice([centre, 0, 1])))
    rows += [(600, [0.1] * 7, 1), (700, None, 1), (800, [0.5] * 8, None), (900, [0.5] * 7 + [math.nan], 1),
             (1000, [math.inf] + [0.5] * 7, 0), (1100, [None] + [0.5] * 7, 0), (1200, [], 1), (1201, [], 2), (1202, [], 1),
             (None, [1.0] * 8, 0), (None, [1.0] * 8, 1), (100, [1.0] * 8, 0), (100, [1.0] * 8, 0), (7, [1.0] * 8, 2),
             (1300, [0.3], 1), (1301, [0.3], 1), (1302, [0.3], 2), (1400, [-0.1] * 8, 3)]
    return rows


def test_against_every_pair(spark):
    rows = awkward(random.Random(3))
    vectors = table(spark, rows)
    wanted = brute_force(rows)
    assert result(hard_negatives(vectors)) == wanted and len(wanted) > 150
    assert result(hard_negatives(vectors.repartition(7))) == wanted
    by = HardNegatives(positives=3, negatives=2, low_percent=90, segments=(2,))
    assert result(hard_negatives(vectors, by=by)) == brute_force(rows, by)
    assert hard_negatives(vectors.limit(0)).isEmpty()
    assert hard_negatives(vectors.filter("vec_id % 100 = 1")).isEmpty()


def test_chunks_and_blocks_change_nothing(spark, monkeypatch):
    rows = awkward(random.Random(4))
    for name, value in (("CHUNK_BYTES", 2000), ("BLOCK_ROWS", 50), ("BLOCK_ANCHORS", 3)):
        monkeypatch.setattr(module, name, value)
    assert result(hard_negatives(table(spark, rows))) == brute_force(rows)


def test_large_components(spark):
    choose = random.Random(9)
    rows = [(n, [choose.choice([1e6, -1e6, 9e5, 0.0]) + choose.random() for _ in range(3)], n // 4 % 2)
            for n in range(0, 400, 4)]
    wanted = brute_force(rows)
    assert result(hard_negatives(table(spark, rows))) == wanted
    assert any(eval(one)[4] > 2**53 for one in wanted)


@pytest.mark.parametrize("size", [1, 3, 16, 64, 65])
def test_summaries_bound_the_inner_product(size):
    numbers = np.random.default_rng(size)
    one, other = (np.floor(numbers.normal(numbers.normal(), 1, (50, size)) * 256) for _ in range(2))
    exact, begin = one @ other.T, 0
    (m, s), (n, t) = summaries(one, (1, 4, 16)), summaries(other, (1, 4, 16))
    for count in (1, 4, 16):
        end = begin + len(segment_bounds(size, count)) - 1
        middle, reach = m[:, begin:end] @ n[:, begin:end].T, s[:, begin:end] @ t[:, begin:end].T + 1e-6
        assert (middle - reach <= exact).all() and (exact <= middle + reach).all()
        begin = end


def test_query_against_sql(spark):
    folder = "/root/testdata/sf0.001"
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{folder}/embeddings.parquet'")
    rows = connection.execute(f"SELECT {', '.join(OUT)} FROM ({ORACLE['op12_hard_negatives']})").fetchall()
    assert result(op12_hard_negatives(spark, folder)) == sorted(map(repr, rows)) and rows
