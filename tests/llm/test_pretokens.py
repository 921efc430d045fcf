"""Random texts of all of Unicode, letters that Python's tables lack included, against the libraries."""

import random
import unicodedata
import zlib

import numpy as np
import public_tokenizers
import tiktoken
from tokenizers import Tokenizer

from metermill.llm.addressable_codes import token_files
from metermill.llm.byte_bpe import encoded, read_ranks
from metermill.llm.pretokens import LETTER, NUMBER, kinds


def random_texts(count, seed):
    choose = random.Random(seed)
    table = kinds()
    newer = [point for point in range(0x110000) if table[point] in (LETTER, NUMBER) and unicodedata.category(chr(point)) == "Cn"]
    plain = "abcXYZ 's't're 've'll  019.,;!\t\n\u00a0\u2003éñßΣ日本😀\u0301"

    def sign():
        kind = choose.randrange(10)
        if kind < 6:
            return choose.choice(plain)
        if kind < 8 and newer:
            return chr(choose.choice(newer))
        point = choose.randrange(0x110000)
        return chr(point) if not 0xD800 <= point < 0xE000 else "x"

    return ["".join(sign() for _ in range(choose.randrange(40))) for _ in range(count)] + ["\u1c89 a\U00010d4a1 \U0001e5d0"]


def test_byte_bpe(spark):
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    with open(path, "rb") as file:
        library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=read_ranks(file.read()),
                                    special_tokens={})
    texts = random_texts(3000, 1)
    rows = encoded(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), path).collect()
    found = {row.doc_id: list(row.ids) for row in rows}
    assert [found[n] for n in range(len(texts))] == [library.encode_ordinary(text) for text in texts]


def test_token_files(spark):
    path = public_tokenizers.path("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    texts = random_texts(2000, 2)
    rows = token_files(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), path).collect()
    wanted = [zlib.crc32(np.array([*library.encode(text, add_special_tokens=False).ids, 0], "<u4").tobytes()) for text in texts]
    assert [row.ids_crc32 for row in sorted(rows, key=lambda row: row.doc_id)] == wanted
