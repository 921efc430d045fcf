"""Packing against best-fit decreasing, one piece after the other, and ids against the tokenizers library."""

import bisect
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from metermill.llm.packing import WordIds, packed, packed_documents, sequences

PATH = public_tokenizers.path("word_bpe_49k.json")
DOCUMENTS = "doc_id long, text string, row string, length int, sequence_id string"


def best_fit_decreasing(lengths, capacity):
    """How many sequences best-fit takes."""
    gaps, count = [], 0
    for length in sorted(lengths, reverse=True):
        at = bisect.bisect_left(gaps, length)
        if at == len(gaps):
            count += 1
            rest = capacity - length
        else:
            rest = gaps.pop(at) - length
        bisect.insort(gaps, rest)
    return count


def check(rows, capacity):
    """(sequence_id, offset, length): gapless and not too long."""
    filled = {}
    for sequence, offset, length in sorted(rows):
        assert filled.get(sequence, 0) == offset
        filled[sequence] = offset + length
    assert all(0 < end <= capacity for end in filled.values())
    return len(filled)


@pytest.mark.parametrize("kind", ["mixed", "equal", "small", "halves", "one", "full"])
def test_as_few_sequences_as_best_fit_decreasing(spark, kind):
    choose = random.Random(kind)
    capacity = 100
    lengths = {"mixed": [min(100, int(choose.expovariate(1 / 25)) + 1) for _ in range(3000)],
               "equal": [choose.choice([33, 33, 33, 33, 1]) for _ in range(1000)], "small": [choose.randint(1, 3) for _ in range(2000)],
               "halves": [choose.choice([50, 51, 49, 25, 26]) for _ in range(999)], "one": [7], "full": [100] * 20 + [99] * 3 + [1] * 2}[kind]
    rows = spark.createDataFrame(list(enumerate(lengths)), "row long, length long")
    found = packed(rows, capacity).collect()
    assert sorted(row.row for row in found) == list(range(len(lengths)))
    count = check([(row.sequence_id, row.offset, lengths[row.row]) for row in found], capacity)
    assert count == best_fit_decreasing(lengths, capacity) >= -(-sum(lengths) // capacity)
    assert {row.sequence_id for row in found} == set(range(count))


def test_words_have_the_ids_of_whole_texts():
    library = Tokenizer.from_file(PATH)
    with open(PATH, "rb") as file:
        words = WordIds(file.read())
    choose = random.Random(8)
    signs = [*" \t\n\x0b\x0c\r  aAbBéÉß'sST09.,!?-", "́", " ", " ", "İ", "Σ", "日", "😀", "\x1c", "\x85",
             "don't ", "I'LL", "'S", "'Ve", "\x01", "\x7f", "~", "{|}", "À", "ÿ", "ß", "×", "÷", "Þ'S", "Ã", "ª", "µ", "ſ", "K", "<|endoftext|>", "<|startoftext|> ", "क़", "\U0001e5d0", "å", "ﬁ", "x" * 90]
    texts = ["".join(choose.choices(signs, k=choose.randrange(60))) for _ in range(4000)] + [" ́ a", "", "a ́"]
    wanted = [np.array(library.encode(text, add_special_tokens=False).ids, "<u4").tobytes() for text in texts]
    assert [words.of(text.encode()) for text in texts] == wanted


def test_documents(spark):
    choose = random.Random(2)
    texts = [(1, "one two three"), (2, None), (2, ""), (None, "four"), (None, "four"), (7, " \t "), (-5, "Ünï 'll don't x" * 3),
             (8, " ".join(choose.choice("abcdefgh") for _ in range(1000))), (9, " ".join("ab" for _ in range(63))), (9, "x")]
    docs = spark.createDataFrame([(*row, "c", 1, "c") for row in texts], DOCUMENTS)
    library = Tokenizer.from_file(PATH)
    found = packed_documents(docs, PATH, 64, keep_ids=True)
    wanted = []
    for one, text in texts:
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 1]
        for begin in range(0, len(ids), 64):
            part = np.array(ids[begin:begin + 64], "<u4").tobytes()
            wanted.append((one, begin // 64, begin, len(part) // 4, zlib.crc32(part)))
    rows = found.collect()
    assert sorted(map(repr, wanted)) == sorted(
        repr((row.doc_id, row.piece, row.start, row["length"], row.ids_crc32)) for row in rows)
    count = check([(row.sequence_id, row.offset, row["length"]) for row in rows], 64)
    assert count == best_fit_decreasing([one[3] for one in wanted], 64)
    joined = {row.sequence_id: row.ids for row in sequences(found).collect()}
    assert len(joined) == count
    for row in rows:
        part = joined[row.sequence_id][row.offset:row.offset + row["length"]]
        assert zlib.crc32(np.array(part, "<u4").tobytes()) == row.ids_crc32
    assert packed_documents(docs.limit(0), PATH).isEmpty()


def test_sizes_that_many_pieces_have_are_in_many_parts(spark):
    from metermill.llm.packing import range_sorted, rank_offsets

    rows = spark.range(4000).selectExpr("id AS row", "IF(id % 3 > 0, 10, id % 50 + 1) AS length")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # which joins parts as small as these
    try:
        dealt = range_sorted(rows, "length", "row")
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    before, total = rank_offsets(dealt)
    assert max(row["count"] for row in dealt.groupBy("part").count().collect()) < 1000
    ranks = sorted((row["size"], before[row.part, row["size"]] + row["at"]) for row in dealt.collect())
    assert ranks == [(size, at) for size in sorted(total) for at in range(total[size])]


def test_words_are_worked_out_once():
    with open(PATH, "rb") as file:
        words = WordIds(file.read())
    worked, work = [], words.words.work
    words.words.work = lambda word: worked.append(word) or work(word)
    text = " ".join(f"{chr(97 + n % 26)}{chr(97 + n // 26 % 26)}{n}" for n in range(250_000)).encode()
    assert words.of(text) == words.of(text) and len(worked) == 250_000


def test_letters_with_a_sign_need_no_pattern(monkeypatch):
    with open(PATH, "rb") as file:
        words = WordIds(file.read())
    library = Tokenizer.from_file(PATH)
    signs = [chr(n) for n in range(0x21, 0x7F) if not chr(n).isalnum()]
    texts = [f"{word}{sign}" for word in ("Abc", "x", "don") for sign in ["", *signs]]
    wanted = [np.array(library.encode(text, add_special_tokens=False).ids, "<u4").tobytes() for text in texts]
    monkeypatch.setattr("metermill.llm.packing.PIECES", None)
    assert [words.of(text.encode()) for text in texts] == wanted
