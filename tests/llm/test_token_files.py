"""The library is called once for the pieces that blanks tell apart, and files are read by many documents at once."""

from __future__ import annotations

import zlib

import numpy as np
import pytest

from metermill.llm.addressable_codes import READ_IDS, Codes, Library, document_crcs

public_tokenizers = pytest.importorskip("public_tokenizers")


class Counting:
    def __init__(self, tokenizer):
        self.tokenizer, self.texts = tokenizer, 0

    def encode_batch_fast(self, texts, **options):
        self.texts += len(texts)
        return self.tokenizer.encode_batch_fast(texts, **options)


@pytest.fixture(scope="module")
def library():
    with open(public_tokenizers.path("byte_bpe_50k.json"), "rb") as file:
        return Library(file.read())


PIECES = [" erorea", "The", " \U0001f600\U0001f600", " 1234", " \n", "  ", " ", "\n", " 'tis", "'s", " s", " Grüße", " ß", "...", " ...",
          "  ", " x", " ああ", " ", " \x1c", " ​", " ́e", " ٣٤", "s"]


def test_pieces_have_the_ids_that_each_has_alone(library):
    for pieces in (PIECES, PIECES[::-1], PIECES * 2, [" one"], ["one"], []):
        found = library.encode_pieces([one.encode() for one in pieces])
        assert [one.tolist() for one in found] == [
            library.tokenizer.encode(one, add_special_tokens=False).ids for one in pieces]


def test_pieces_with_a_blank_are_one_text(library, monkeypatch):
    monkeypatch.setattr(library, "tokenizer", counting := Counting(library.tokenizer))
    found = library.encode_pieces([f" w{'abcdefghij'[at % 10] * (at // 10 + 1)}".encode() for at in range(500)])
    assert len(found) == 500 and counting.texts == 1


def test_a_token_over_the_end_of_a_piece_is_not_cut(library, monkeypatch):
    class Merging(Counting):
        def encode_batch_fast(self, texts, **options):  # a library that doesn't cut at the blanks
            return super().encode_batch_fast([one.replace(" ", "") for one in texts], **options)

    monkeypatch.setattr(library, "tokenizer", Merging(library.tokenizer))
    found = library.encode_pieces([b" th", b" e"])
    assert [one.tolist() for one in found] == [
        library.tokenizer.encode_batch_fast([one], add_special_tokens=False)[0].ids for one in (" th", " e")]


def test_documents_of_a_file_are_read_together(monkeypatch):
    rng = np.random.default_rng(5)
    sizes = [1, 3, 700, 1, READ_IDS - 2, 5, READ_IDS + 9, 1, 2, 513]
    firsts = np.concatenate([[0], np.cumsum(sizes)])
    ids = rng.integers(0, 50_000, firsts[-1]).astype(np.int32)
    codes, slices = Codes.of(ids), []
    whole = codes.slice
    monkeypatch.setattr(codes, "slice", lambda begin, end: slices.append(0) or whole(begin, end))
    assert document_crcs(firsts, codes) == [zlib.crc32(ids[begin:end].astype("<u4").tobytes())
                                            for begin, end in zip(firsts[:-1], firsts[1:], strict=True)]
    assert len(slices) < len(sizes)
