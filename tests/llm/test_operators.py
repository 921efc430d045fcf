"""The operators against brute force, on awkward small tables: nulls, empty and long texts, ties, repeats, no rows,
clashing columns."""

import base64
import hashlib
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from metermill.llm import quality, toxicity
from metermill.llm.addressable_codes import Codes, token_files
from metermill.llm.byte_bpe import decoded, encoded, read_ranks, round_trip
from metermill.llm.components import components
from metermill.llm.decontamination import contamination, without_contaminated
from metermill.llm.near_duplicates import NearDuplicates, near_duplicates, without_near_duplicates
from metermill.llm.passages import shared_passages
from metermill.llm.personal_data import base_spans, masked, personal_data
from metermill.llm.phrases import edited_fingerprints
from metermill.llm.warc import history, loser_tree

DOCUMENTS = "doc_id long, text string, score double, kept int, n_words string, part string"
WORDS = [f"w{n}" for n in range(400)]
RANDOM = random.Random(4)
LONG = " ".join(RANDOM.choice(WORDS) for _ in range(3000))
PASSAGE = " ".join(RANDOM.choice(WORDS) for _ in range(70))


def prose(number, count=60):
    return " ".join(random.Random(number).choices(WORDS, k=count))


def near(text):
    words = text.split()
    return " ".join([*words[:30], "other", *words[31:]])


TEXTS = [(1, LONG), (2, near(LONG)), (3, prose(3)), (4, prose(3)), (5, None), (6, ""), (7, "  \n"), (8, "One two"),
         (9, "one TWO"), (10, "é" * 40 + " 's 've don't   x"), (11, prose(11) + " " + PASSAGE), (12, PASSAGE + " " + prose(12)),
         (12, PASSAGE + " " + prose(12)), (None, prose(14)), (15, "mail a.b@c.example.org or +1 (202) 555-0123"),
         (16, "<|endoftext|> 10.0.0.255 and 4111 1111 1111 1111 300.1.1"), (-3, "x" * 2000)]


@pytest.fixture(scope="module")
def documents(spark):
    return spark.createDataFrame([(one, text, 1.0, 2, "n", "p") for one, text in TEXTS], DOCUMENTS)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], DOCUMENTS)


def lower(text):
    return re.sub("[A-Z]", lambda match: match.group().lower(), text or "")


def test_near_duplicates(documents, nothing):
    rows = {row.doc_id: row for row in near_duplicates(documents, NearDuplicates(shingle_words=4)).collect()}
    assert {one: row.component_id for one, row in rows.items() if row.component_id != one} == {2: 1, 4: 3, 9: 8}
    assert rows[None].kept and rows[5].n_shingles == rows[6].n_shingles == rows[7].n_shingles == 0
    assert rows[8].n_shingles == 1 and not rows[9].kept
    assert near_duplicates(documents).count() == len(TEXTS) and near_duplicates(nothing).isEmpty()


def test_near_duplicates_go_row_by_row(spark):
    """Repeated ids with other texts, copies without ids, and columns of clashing names."""
    a, b, c = prose(50), prose(51), prose(52)
    rows = [(1, a), (2, a), (2, b), (None, a), (None, c), (None, c), (3, near(b)), (4, None), (4, None), (5, ""), (None, None),
            (9, prose(59)), (9, prose(59)), (9, prose(60)), (8, near(prose(60)))]
    docs = spark.createDataFrame([(*row, 0.5, n, "x", "y") for n, row in enumerate(rows)],
                                 "doc_id long, text string, score double, row long, row_ string, id string")
    found = without_near_duplicates(docs, NearDuplicates())
    kept = sorted(row.row for row in found.collect())
    groups = [[0, 1, 3], [2, 6], [4, 5], [11, 12], [13, 14]]
    assert found.columns == docs.columns
    assert all(len([n for n in group if n in kept]) == 1 for group in groups)
    assert {0, 6, 14} <= set(kept)  # ids of their own come first
    assert {7, 8, 9, 10} <= set(kept) and len(kept) == 9
    large = docs.withColumn("doc_id", F.when(F.col("row") == 0, F.lit(2**62)).otherwise(F.col("doc_id")))
    assert without_near_duplicates(large).count() == 9
    assert without_near_duplicates(docs.limit(0)).isEmpty()
    alone = docs.filter("row in (0, 9, 14)")
    assert without_near_duplicates(alone).count() == 3 and without_near_duplicates(alone).columns == docs.columns


def test_a_chain_of_near_copies_is_one_group(spark):
    words = prose(1, 400).split()
    rows = [(n, " ".join(f"new{k}" if k < 12 * n else word for k, word in enumerate(words)), 0.0, 0, "", "")
            for n in range(12)]
    found = near_duplicates(spark.createDataFrame(rows, DOCUMENTS), NearDuplicates(shingle_words=4)).collect()
    assert {row.component_id for row in found} == {0}


def test_components(spark):
    links = spark.createDataFrame([(n + 1, n) for n in range(40)] + [(50, 60), (60, 50), (70, 70)], "u long, v long")
    found = {row.node: row.component for row in components(links).collect()}
    assert found == {**dict.fromkeys(range(41), 0), 50: 50, 60: 50}


def test_archives(spark):
    rows = [(1, "http://a.example/x", "same"), (2, "HTTP://b.a.example:80/y?q#f", "same"), (3, None, None), (4, "", ""),
            (5, "x", "é\r\n\r\n" * 3), (None, "http://a.example/", "same"), (7, "a\r\nb", LONG)]
    pages = spark.createDataFrame([(*row, "clash") for row in rows], "page_id long, url string, html string, file string")
    found = {row.page_id: row for row in history(pages).collect()}
    for page_id, _, html in rows:
        data = (html or "").encode()
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        assert (found[page_id].payload_bytes, found[page_id].payload_digest) == (len(data), digest)
    assert {one: row.refers_to for one, row in found.items() if row.refers_to is not None} == {2: 1, 4: 3}
    order = sorted(found.values(), key=lambda row: (row.range, row.place))
    assert [row.url_key for row in order] == sorted(row.url_key for row in order)
    assert history(pages.limit(0)).isEmpty()


@pytest.mark.parametrize("count", range(7))
def test_loser_tree(count):
    runs = [sorted(RANDOM.choices(range(9), k=RANDOM.randrange(6))) for _ in range(count)]
    merged = [runs[run][place] for run, place in loser_tree(runs, lambda item: item)]
    assert merged == sorted(item for run in runs for item in run)


def test_fingerprints(documents, nothing):
    rows = edited_fingerprints(documents).collect()
    ordered = sorted(TEXTS, key=lambda row: (row[0] is None, -(row[0] or 0)))
    wanted = []
    for at, (one, text) in enumerate(ordered):
        text, after = text or "", ordered[(at + 1) % len(ordered)][1] or ""
        new = text[:len(text) - len(text) // 3] + after[:len(text) // 3]
        wanted.append((one, len(text), hashlib.sha256(new.encode()).hexdigest()))
    assert sorted(map(repr, wanted)) == sorted(repr((row.doc_id, row.n_chars, row.edited_sha256)) for row in rows)
    prints = {row.doc_id: row.fingerprint for row in rows}
    assert prints[3] == prints[4] and prints[5] == prints[6] == "" and prints[1] != prints[2]
    assert all(0 <= row.near_edited <= 1 and 0 <= row.near_next <= 1 for row in rows)
    assert edited_fingerprints(nothing).isEmpty()


def test_contamination(spark, documents, nothing):
    items = spark.createDataFrame([(1, PASSAGE), (2, "ONE two"), (3, None), (None, "w1"), (5, prose(3)[:20])],
                                  "item_id long, text string")
    found = contamination(documents, items).collect()
    texts = {}
    for one, text in TEXTS:
        texts[one] = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text))
    windows = {}
    for item, text in ((1, PASSAGE), (2, "ONE two"), ("", "w1"), (5, prose(3)[:20])):
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text))
        for at in range(max(1, len(words) - 9)):
            windows.setdefault(tuple(words[at:at + 10]), set()).add(str(item))
    for row in found:
        words, hit, named = texts[row.doc_id], set(), set()
        for at in range(len(words)):
            for window, own in windows.items():
                if tuple(words[at:at + len(window)]) == window:
                    named |= own
                    hit.update(range(at, at + len(window)))
        digest = hashlib.sha256(",".join(sorted(named)).encode()).hexdigest()
        assert (row.n_words, row.n_hit, row.n_items, row.items_sha256, row.contaminated) == (
            len(words), len(hit), len(named), digest, bool(hit)), row.doc_id
    assert len(found) == len(TEXTS) and contamination(nothing, items).isEmpty()
    assert contamination(documents, items.limit(0)).filter("contaminated").isEmpty()


def test_contaminated_rows_go_by_id_and_text(spark):
    rows = [(1, PASSAGE), (1, prose(8)), (None, PASSAGE), (None, prose(9)), (2, None)]
    docs = spark.createDataFrame([(*row, "x", "y", 5) for row in rows],
                                 "doc_id long, text string, spans string, of string, of_text int")
    items = spark.createDataFrame([(1, PASSAGE)], "item_id long, text string")
    kept = without_contaminated(docs, items)
    assert kept.columns == docs.columns
    assert sorted(map(repr, ((row.doc_id, row.text) for row in kept.collect()))) == sorted(
        map(repr, (row for row in rows if row[1] != PASSAGE)))
    assert without_contaminated(docs, items.limit(0)).count() == len(rows)
    assert masked(docs).columns == docs.columns and masked(docs).count() == len(rows)


def test_token_files(documents, nothing):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    library, start, wanted = Tokenizer.from_file(path), 0, []
    for one, text in sorted(TEXTS, key=lambda row: (row[0] is not None, row[0] or 0)):
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 0]
        wanted.append((one, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    found = [tuple(row) for row in token_files(documents, path).collect()]
    assert sorted(map(repr, found)) == sorted(map(repr, wanted))
    assert token_files(nothing, path).isEmpty()


@pytest.mark.parametrize("high", [1, 200, 70_000, 2**32])
def test_codes(high):
    ids = np.random.default_rng(high).integers(0, high, 3000, dtype=np.uint64)
    codes, places = Codes.of(ids), np.random.default_rng(1).integers(0, 3000, 500)
    assert (codes.take(places) == ids[places]).all() and (codes.slice(700, 2345) == ids[700:2345]).all()


def test_byte_bpe(documents, nothing):
    import tiktoken

    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    with open(path, "rb") as file:
        library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=read_ranks(file.read()),
                                    special_tokens={})
    wanted = []
    for one, text in TEXTS:
        ids = library.encode_ordinary(text or "")
        wanted.append((one, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                       hashlib.sha256((text or "").encode()).hexdigest()))
    assert sorted(map(repr, wanted)) == sorted(repr(tuple(row)) for row in round_trip(documents, path).collect())
    both = decoded(encoded(documents, path), path).collect()
    assert sorted((bytes(row.bytes).decode() for row in both)) == sorted(text or "" for _, text in TEXTS)
    assert round_trip(nothing, path).isEmpty()


def test_base_spans():
    text = "a.b@c.example.org, 10.0.0.255 300.1.1.1 and 4111 1111 1111 1111 +1 (202) 555-0123 x@y 1.2.3.4.5.6.7.8"
    found = [(kind, text[begin:end]) for kind, begin, end in base_spans(text)]
    assert found == [(0, "a.b@c.example.org"), (1, "10.0.0.255"), (1, "1.2.3.4"), (1, "5.6.7.8"),
                     (2, "4111 1111 1111 1111"), (3, "+1 (202) 555-0123")]
    assert base_spans("9" * 200_000 + "@" + "a" * 200_000) == []
    assert base_spans("0" * 5000 + "1.2.3.4") == [(1, 0, 5007)] and base_spans("1." * 3 + "9" * 5000) == []


def test_personal_data(documents, nothing):
    rows = {row.doc_id: row for row in personal_data(documents).collect()}
    assert (rows[15].n_email, rows[15].n_phone, rows[16].n_ip, rows[16].n_card) == (1, 1, 1, 1)
    assert rows[5].spans == "" and rows[15].spans.startswith("email:5:22,")
    texts = {row.doc_id: row.text for row in masked(documents).collect()}
    assert texts[15] == "mail [EMAIL] or [PHONE]" and texts[5] is None and texts[3] == prose(3)
    assert masked(documents).columns == documents.columns and personal_data(nothing).isEmpty()


def test_contexts_discover_identifiers(spark):
    rows = [(n, f"{prose(n, 8)} caller +1 (202) 555-{n:04d} {prose(n + 500, 5)}") for n in range(60)]
    rows += [(100, "the caller 555-12-34567 asked")]
    found = {row.doc_id: row.spans for row in personal_data(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert found[100] == "phone:11:23"


def test_contexts_discover_identifiers_without_digits(spark):
    kinds = {"email": ("writes", "user{}@mail.example.org"), "ip": ("host", "10.0.7.{}"), "phone": ("caller", "+1 202 555 1{:03d}")}
    rows = [(1000 * at + n, f"{prose(n, 8)} {word} {form.format(n)} {prose(n + 500, 5)}")
            for at, (word, form) in enumerate(kinds.values()) for n in range(60)]
    rows += [(9000, "he writes jdoe@intranet today"), (9001, "she writes @handle today"), (9002, "he writes a@b today"),
             (9003, "the host jdoe@intranet today"), (9004, "the caller @handle today"), (9005, "he writes 1234567 today")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {row.doc_id: row.spans for row in personal_data(docs).collect()}
    assert [found[9000 + n] for n in range(6)] == ["email:10:23", "email:11:18", "", "", "", "email:10:17"]
    assert {row.text for row in masked(docs).filter("doc_id in (9000, 9001)").collect()} == {
        "he writes [EMAIL] today", "she writes [EMAIL] today"}


def test_shared_passages(documents, nothing):
    rows = shared_passages(documents).collect()
    pairs = {(row.doc_id, row.other_id) for row in rows}
    assert pairs == {(2, 1), (4, 3), (12, 11)}
    (row,) = [row for row in rows if row.doc_id == 12]
    words = {one: (text or "").split() for one, text in TEXTS}
    assert words[12][row.begin:row.end][:70] == PASSAGE.split()[:70] or row.end - row.begin >= 70
    assert shared_passages(nothing).isEmpty()


def test_passages_whose_parts_smaller_documents_hold(spark):
    passage = prose(900, 52).split()
    texts = [passage[:38], passage[14:], passage, passage, prose(901, 80).split(), passage]
    rows = [(n, f"{prose(910 + n, 30)} {' '.join(text)} {prose(930 + n, 30)}") for n, text in enumerate(texts)]
    found = shared_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {(row.doc_id, row.other_id) for row in found} == {(3, 2), (5, 2)}
    assert all(row.begin <= 30 and row.end >= 82 for row in found)


@pytest.fixture(scope="module")
def given(spark):
    """Documents of the test tables with partly copied ones, and their words by id."""
    rows = [(int(row.doc_id), row.text) for row in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    texts = [text for _, text in rows if text and len(text.split()) > 120][:20]
    for n, text in enumerate(texts):
        words = text.split()
        rows += [(10_000 + n, " ".join([*words[:100], f"end{n}"])), (9_000 + n, " ".join(words[20:70])), (8_000 + n, near(text))]
    words = {one: [word for word in re.split("[\t-\r ]+", lower(text)) if word] for one, text in rows}
    return spark.createDataFrame(rows, "doc_id long, text string"), words


def test_near_duplicates_against_all_pairs(given):
    docs, words = given
    sets = {one: {tuple(all_words[at:at + 4]) for at in range(max(len(all_words) - 3, min(len(all_words), 1)))}
            for one, all_words in words.items()}
    component = {one: one for one in sets}
    for one in sorted(sets):
        for other in sorted(sets):
            if other < one and sets[one] and 100 * len(sets[one] & sets[other]) >= 80 * len(sets[one] | sets[other]):
                low, high = sorted((component[one], component[other]))
                component = {node: low if of == high else of for node, of in component.items()}
    found = near_duplicates(docs, NearDuplicates(shingle_words=4)).collect()
    assert {row.doc_id: row.component_id for row in found} == component and len(set(component.values())) < len(sets) - 15


def test_shared_passages_against_direct_search(given):
    docs, words = given
    runs = {}
    for one in sorted(words):
        for at in range(len(words[one]) - 49):
            runs.setdefault(tuple(words[one][at:at + 50]), []).append((one, at))
    covered = {}
    for row in shared_passages(docs).collect():
        covered.setdefault(row.doc_id, set()).update(range(row.begin, row.end))
        one, other = words[row.doc_id][row.begin:row.end], words[row.other_id][row.other_begin:row.other_end]
        common = [0] * (len(other) + 1)  # of a longest common subsequence
        for word in one:
            before = 0
            for at, that in enumerate(other, 1):
                before, common[at] = common[at], before + 1 if word == that else max(common[at], common[at - 1])
        assert row.other_id < row.doc_id and min(len(one), len(other)) >= 50
        assert common[-1] >= row.agreeing >= 0.8 * max(len(one), len(other))
    missed = [(one, at) for found in runs.values() for one, at in found
              if one != found[0][0] and not covered.get(one, set()).issuperset(range(at, at + 50))]
    assert missed == [] and len(covered) >= 40


def test_edited_passages(spark):
    """One word replaced in every 5 to 15: 80 to 93 % agree."""
    rows, wanted = [], set()
    for n, every in enumerate((5, 6, 7, 8, 10, 12, 15) * 6):
        words = prose(1000 + n, 62).split()
        edited = [f"new{n}x{at}" if at % every == every - 1 else word for at, word in enumerate(words)]
        rows += [(2 * n, " ".join(words)), (2 * n + 1, f"{prose(2000 + n, 40)} {' '.join(edited)} {prose(3000 + n, 40)}")]
        wanted.add((2 * n + 1, 2 * n))
    rows += [(500, "a " + "de " * 5 + "b " + "de " * 70 + "c"), (501, "d e f g " + "de " * 5 + "h " + "de " * 60 + "i")]
    found = shared_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {(row.doc_id, row.other_id) for row in found} == wanted | {(501, 500)}


def test_models(spark, documents, nothing):
    rows = [(n, prose(n, 40) + (" awful vile" if n % 4 == 0 else "") + (" ###!!!$$$" * 9 if n % 5 == 0 else ""))
            for n in range(300)] + [(None, None), (1000, ""), (1000, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(n, int(n % 5 > 0), int(n % 4 == 0)) for n in range(0, 300, 1) if n % 3]
                                   + [(None, 1, 1), (7, None, None)], "doc_id long, quality int, toxic int")
    model = toxicity.fit(docs, labels)
    graded = toxicity.graded(docs, model).collect()
    found = {row.doc_id: row for row in graded}
    assert sum(found[n].toxic == (n % 4 == 0) for n in range(300)) >= 285 and not found[1000].toxic
    assert toxicity.without_toxic(docs, model).count() == sum(not row.toxic for row in graded)
    scores = {row.doc_id: row for row in quality.scored(docs, quality.fit(docs, labels)).collect()}
    assert sum(scores[n].predicted == int(n % 5 > 0) for n in range(300)) >= 295
    assert len(scores) == 302 and 0 <= scores[1000].score <= 1
    for empty in (labels.limit(0),):
        assert not any(row.toxic for row in toxicity.graded(docs, toxicity.fit(docs, empty)).collect())
        assert {row.score for row in quality.scored(docs, quality.fit(docs, empty)).collect()} == {0.5}
    assert toxicity.graded(nothing, toxicity.fit(docs, labels)).isEmpty()


def test_pipeline(spark):
    import corpus_pipeline

    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "toxicity", "near_duplicates", "decontamination", "personal_data", "byte_bpe"]
    found = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    assert 0 < found.count() < 200 and found.columns[0] == "doc_id"
