"""The filter audit against applying the filters one by one, and its counts by mask."""

import random
import re
from collections import Counter
from itertools import permutations

import duckdb
import numpy as np
import pytest

from metermill.llm.filter_audit import ORDERS, REPORT, Filters, filter_audit, removal_steps, word_counts
from metermill.llm.queries import ORACLE, op13_filter_audit

DOCUMENTS = "doc_id long, text string, lang string, part string, mask int, n long"
LABELS = "doc_id long, quality int, toxic int, good int"


def brute_force(rows, labels, by):
    """Every order applied to every document."""
    good, toxic = ({one for one, *both in labels if both[at] == 1 and one is not None} for at in (0, 1))
    documents = []
    for one, text, lang in rows:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        fails = set()
        if len(words) < by.least_words:
            fails.add("A")
        if 100 * len(set(words)) < by.least_distinct_percent * len(words):
            fails.add("B")
        if 100 * len(re.findall("[A-Z]", text)) > by.most_capitals_percent * len(text):
            fails.add("C")
        if re.search("[#$%&*|]", text):
            fails.add("D")
        if one is not None and any(other is not None and other < one and (that or "") == text for other, that, _ in rows):
            fails.add("E")
        documents.append((lang or "", fails, one in good and one is not None, one in toxic and one is not None))
    found, shapley = {}, Counter()
    for order in map("".join, permutations("ABCDE")):
        for part in {one[0] for one in documents}:
            left = [one for one in documents if one[0] == part]
            gone = []
            for step, letter in enumerate(order, 1):
                removed = [one for one in left if letter in one[1]]
                redundant = sum(letter in one[1] for one in gone)
                left = [one for one in left if letter not in one[1]]
                gone += removed
                alone = sum(one[0] == part and one[1] == {letter} for one in documents)
                shapley[part, letter] += len(removed)
                found[part, order, step] = [len(left), len(removed), redundant, alone, sum(one[2] for one in removed),
                                            sum(one[3] for one in removed)]
    return {key: (*values, shapley[key[0], key[1][key[2] - 1]]) for key, values in found.items()}


def result(frame):
    return {(row.part, row.filter_order, row.step): tuple(row[name] for name in REPORT) for row in frame.collect()}


def test_against_applying_filters_one_by_one(spark):
    choose = random.Random(5)
    texts = ["", None, " \t\n", "é" * 5, "A B C", "A a", "a|b c", "x y z", "word " * 9, "Word\x0bword\x1cword " * 3,
             "a b c d e f", "a b c d e f $", "AA BB cc"]
    rows = [(choose.choice([None, *range(30)]), choose.choice(texts), choose.choice([None, "", "en", "de"])) for _ in range(150)]
    rows += [(40, "tie", "en"), (40, "tie", "en"), (41, "tie", "de"), (None, "tie", "en")]
    labels = [(n, n % 2, n % 3 == 0) for n in range(45)] + [(4, None, None), (3, 0, 1), (3, 1, None), (None, 1, 1)]
    by = Filters(least_words=4)
    docs = spark.createDataFrame([(*row, "clash", 1, 2) for row in rows], DOCUMENTS)
    marks = spark.createDataFrame([(one, q, None if t is None else int(t), 7) for one, q, t in labels], LABELS)
    found = result(filter_audit(docs, marks, by))
    wanted = brute_force(rows, [(one, q, t) for one, q, t in labels], by)
    assert found == wanted and len(found) == 3 * 600
    unlabelled = result(filter_audit(docs, marks.limit(0), by))
    assert all(row[4] == row[5] == 0 and row[:4] == found[key][:4] for key, row in unlabelled.items())
    assert filter_audit(docs.limit(0), marks, by).isEmpty()


def test_steps_are_the_first_failed_filter():
    steps = removal_steps(np.arange(32), np.array(ORDERS))
    for mask in range(32):
        for at, order in enumerate(ORDERS):
            assert steps[mask, at] == next((n for n, one in enumerate(order) if mask >> one & 1), 5)


def test_words_of_long_texts():
    choose = random.Random(1)
    text = "".join(choose.choice(["a ", "bb\t", "c\x0b", "dd", "é  "]) for _ in range(900_000)).encode()
    assert word_counts(text) == (len(text.split()), len(set(text.split()))) and len(text) > 1 << 20
    assert word_counts(b"x" * 3_000_000) == (1, 1)


def test_query_against_sql(spark):
    folder = "/root/testdata/sf0.001"
    connection = duckdb.connect()
    for name in ("documents", "labels"):
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    wanted = connection.execute(ORACLE["op13_filter_audit"]).fetch_df()
    found = op13_filter_audit(spark, folder).toPandas()
    key = ["part", "filter_order", "step"]
    found, wanted = (one.sort_values(key).reset_index(drop=True)[sorted(one.columns)].astype(str) for one in (found, wanted))
    assert found.equals(wanted) and len(found)


@pytest.mark.parametrize("text", ["a#b", "a%b", "|"])
def test_symbols(text):
    from metermill.llm.filter_audit import text_mask

    assert text_mask(text.encode(), len(text), Filters(least_words=0)) == 8
