"""Each stage of the corpus pipeline against plain Python, on rows with nulls, repeats, ties and clashing columns."""

import hashlib
import re

import public_tokenizers
import pytest
import tiktoken
from test_base_spans import literal

import corpus_pipeline
from metermill.llm.byte_bpe import read_ranks
from test_operators import PASSAGE, near, prose

COLUMNS = "doc_id long, text string, lang string, row long, component_id long, spans string, n_words int"
STAGES = dict(corpus_pipeline.STAGES)


def texts():
    found = [(n, prose(n, 40) + (" awful vile" if n % 4 == 0 else "")) for n in range(300)]
    a, b = prose(900), prose(901)
    found += [(1000, a), (1001, near(a)), (1002, a), (1002, b), (None, b), (None, a), (None, None), (1003, ""), (1003, ""), (None, " \t"),
              (1004, "One two"), (1004, "one TWO"), (1005, prose(905) + " " + PASSAGE), (1005, prose(906)), (None, PASSAGE + " x"),
              (-7, "mail a.b@c.example.org, 10.0.0.1 or 4111 1111 1111 1111"), (-7, "call +1 (202) 555-0123 é"), (1006, "x" * 3000)]
    return found


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("corpus"))
    rows = [(*row, "en", at, 1, "clash", 0) for at, row in enumerate(texts())]
    spark.createDataFrame(rows, COLUMNS).write.parquet(f"{folder}/documents.parquet")
    labels = [(n, 1, int(n % 4 == 0)) for n in range(300)] + [(None, 1, 1), (5, None, None), (4000, 0, 1)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    items = [(1, PASSAGE), (2, None), (3, ""), (None, prose(905)[:30])]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder


@pytest.fixture(scope="module")
def documents(spark, folder):
    return spark.read.parquet(f"{folder}/documents.parquet")


def kept(frame):
    return sorted(row.row for row in frame.select("row").collect())


def words(text, pattern):
    return re.findall(pattern, re.sub("[A-Z]", lambda one: one.group().lower(), text or ""))


@pytest.mark.parametrize("name", [name for name in STAGES if name != "byte_bpe"])
def test_columns_and_no_rows(spark, folder, documents, name):
    found = STAGES[name](spark, documents, folder)
    assert found.dtypes == documents.dtypes
    assert STAGES[name](spark, documents.limit(0), folder).isEmpty()


def test_toxicity(spark, folder, documents):
    found = kept(STAGES["toxicity"](spark, documents, folder))
    rows = texts()
    assert found == [at for at, (one, text) in enumerate(rows) if not (text or "").endswith("awful vile")]


def test_near_duplicates(spark, folder, documents):
    rows = texts()
    sets = []
    for _, text in rows:
        own = words(text, r"[^\x20\x09-\x0D]+")
        sets.append({tuple(own[at:at + 5]) for at in range(max(len(own) - 4, min(len(own), 1)))})
    group = list(range(len(rows)))
    for one in range(len(rows)):
        for other in range(one):
            if sets[one] and 100 * len(sets[one] & sets[other]) >= 80 * len(sets[one] | sets[other]):
                low, high = sorted((group[one], group[other]))
                group = [low if of == high else of for of in group]
    ids = [one for one, _ in rows]
    wanted = []
    for of in sorted(set(group)):
        members = [at for at in range(len(rows)) if group[at] == of]
        own = [at for at in members if ids[at] is not None and ids.count(ids[at]) == 1]
        wanted.append([min(own, key=lambda at: ids[at])] if own else members)
    found = kept(STAGES["near_duplicates"](spark, documents, folder))
    assert len(found) == len(wanted) < len(rows) - 4
    assert all(len(set(one) & set(found)) == 1 for one in wanted)


def test_decontamination(spark, folder, documents):
    pattern = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    windows = set()
    for text in (PASSAGE, prose(905)[:30]):
        own = words(text, pattern)
        windows |= {tuple(own[at:at + 10]) for at in range(max(1, len(own) - 9))}
    wanted = []
    for at, (_, text) in enumerate(texts()):
        own = words(text, pattern)
        if not any(tuple(own[begin:begin + len(one)]) == one for begin in range(len(own)) for one in windows):
            wanted.append(at)
    assert kept(STAGES["decontamination"](spark, documents, folder)) == wanted and len(wanted) == len(texts()) - 2


def test_personal_data(spark, folder, documents):
    found = {row.row: row.text for row in STAGES["personal_data"](spark, documents, folder).collect()}
    for at, (_, text) in enumerate(texts()):
        masked = text
        for kind, begin, end in sorted(literal(text or ""), key=lambda one: -one[1]):
            masked = masked[:begin] + "[" + ("EMAIL", "IP", "CARD", "PHONE")[kind] + "]" + masked[end:]
        assert found[at] == masked


def test_byte_bpe(spark, folder, documents):
    with open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb") as file:
        library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=read_ranks(file.read()),
                                    special_tokens={})
    wanted = []
    for one, text in texts():
        ids = library.encode_ordinary(text or "")
        wanted.append(repr((one, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                            hashlib.sha256((text or "").encode()).hexdigest())))
    found = STAGES["byte_bpe"](spark, documents, folder)
    assert sorted(wanted) == sorted(repr((row.doc_id, row.n_tokens, row.ids_sha256, row.decoded_sha256)) for row in found.collect())
    assert STAGES["byte_bpe"](spark, documents.limit(0), folder).isEmpty()


def test_run(spark, folder):
    rows = corpus_pipeline.run(spark, folder).collect()
    texts_left = {row.decoded_sha256 for row in rows}
    digest = {text: hashlib.sha256((text or "").encode()).hexdigest() for _, text in texts()}
    assert len([row for row in rows if row.decoded_sha256 == digest[None]]) == 3  # nulls and empty ones, all of them
    assert digest[prose(901)] in texts_left and digest[prose(900)] in texts_left
    assert not any(digest[text] in texts_left for text in digest if text and ("awful vile" in text or PASSAGE in text))
