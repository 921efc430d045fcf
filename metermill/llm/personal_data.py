"""Personal data by bootstrapped contextual extraction.

Four base patterns find the seed entities.  An entity's left neighbours (the word before, and the two words before) are
its lexical patterns; every token with a digit or an at-sign is an instance of the patterns before it.  On the graph of
patterns and instances, Spark scores in turns: a pattern by how surely its instances are entities, an instance by the
patterns it occurs with.  Instances of sure patterns become spans of the pattern's kind.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import blocks, staged

KINDS = ("email", "ip", "card", "phone")
# The base patterns.  Lookbehinds and possessive counts only spare retries within a run of digits.
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
ADDRESS = re.compile(r"[0-9](?<![0-9]{2})[0-9]*+(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?<![0-9]{2})(?:[ -]?[0-9])++")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
DIGIT = re.compile(r"[0-9]")
NO_DIGIT = re.compile(r"[^0-9]+")
#: Tokens between white space that hold a digit or an at-sign; within one, what quotes, brackets and marks enclose.
TOKEN = re.compile(r"(?<!\S)[^\s0-9@]*+[0-9@]\S*+")
INNER = re.compile(r"[^\"'<>()\[\]{},;:=|!*#$&]+")

SPANS = "array<struct<kind int, begin int, end int>>"
TOKENS = "array<struct<begin int, end int, kind int, digits int, named boolean, instance string, patterns array<string>>>"


@dataclass(frozen=True)
class PersonalData:
    rounds: int = 3
    surely: float = 0.8  #: least score of a pattern, a lower confidence bound, and of an instance
    confidence: float = 1.96  #: standard deviations of that bound
    least_length: int = 6  #: of a discovered identifier
    least_digits: int = 4  #: of one, unless it follows an e-mail's pattern and has a letter or an at-sign


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches, found from the at-signs so that time stays linear."""
    free = 0
    at = text.find("@")
    while at >= 0:
        begin = at
        while begin > free and text[begin - 1] in LOCAL:
            begin -= 1
        if begin < at and (domain := DOMAIN.match(text, at + 1)):
            yield begin, domain.end()
            free = domain.end()
        at = text.find("@", max(at + 1, free))


def luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + place % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, begin, end) in code points of the base patterns' matches, ordered by kind and begin."""
    found = [(0, *span) for span in emails(text)] if "@" in text else []
    if not DIGIT.search(text):
        return found
    found += [(1, *match.span()) for match in ADDRESS.finditer(text)
              if all(len(part) <= 3 and int(part or 0) <= 255
                     for part in (one.lstrip("0") for one in match.group().split(".")))]
    for match in CARD.finditer(text):
        digits = NO_DIGIT.sub("", match.group())
        if 13 <= len(digits) <= 19 and luhn(digits):
            found.append((2, *match.span()))
    found += [(3, *match.span()) for match in PHONE.finditer(text)
              if 9 <= len(NO_DIGIT.sub("", match.group())) <= 15]
    return found


def lexical(word: str) -> str:
    """A context word: lower case, digits as 0; a hash stands for a very long one."""
    word = re.sub("[0-9]+", "0", word.lower())
    return word if len(word) <= 64 else hashlib.sha256(word.encode()).hexdigest()


def tokens_of(text: str, base: list[tuple[int, int, int]]) -> list[tuple]:
    """(begin, end, kind or -1, digits, named, instance, patterns) of the tokens and of the base entities."""
    taken = sorted((begin, end, kind) for kind, begin, end in base)
    things, at = [], 0
    for match in TOKEN.finditer(text):
        for inner in INNER.finditer(match.group()):
            begin = match.start() + inner.start()
            end = begin + len(inner.group().rstrip(".?"))
            if begin < end and re.search("[0-9@]", inner.group()):
                while at < len(taken) and taken[at][1] <= begin:
                    at += 1
                if at == len(taken) or taken[at][0] >= end:
                    things.append((begin, end, -1))
    found = []
    for begin, end, kind in sorted(things + taken):
        # What the same token has before the instance (as password= has) is part of the context.
        words = before(text, begin)
        near = [lexical(word) for word in words]
        patterns = ([f"1 {near[-1]}"] if near else []) + ([f"2 {near[0]} {near[1]}"] if len(near) > 1 else [])
        thing = text[begin:end]
        digits = len(NO_DIGIT.sub("", thing))
        named = "@" in thing or any(map(str.isalpha, thing))
        found.append((begin, end, kind, digits, named, hashlib.sha256(thing.lower().encode()).hexdigest()[:32], patterns))
    return found


def before(text: str, end: int) -> list[str]:
    """The last two words that end before or at `end`, in order."""
    words: list[str] = []
    while end > 0 and len(words) < 2:
        while end > 0 and text[end - 1].isspace():
            end -= 1
        begin = end
        while begin > 0 and not text[begin - 1].isspace():
            begin -= 1
        if begin < end:
            words.insert(0, text[begin:end])
        end = begin
    return words


def extracted(documents: DataFrame) -> DataFrame:
    """(doc_id, text_key, base, tokens) of every document."""

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        span = pa.list_(pa.struct([("kind", pa.int32()), ("begin", pa.int32()), ("end", pa.int32())]))
        token = pa.list_(pa.struct([("begin", pa.int32()), ("end", pa.int32()), ("kind", pa.int32()),
                                    ("digits", pa.int32()), ("named", pa.bool_()), ("instance", pa.string()), ("patterns", pa.list_(pa.string()))]))
        for batch in blocks(batches):
            base, tokens = [], []
            for text in batch.column("text").to_pylist():
                spans = base_spans(text or "")
                base.append([dict(zip(("kind", "begin", "end"), one, strict=True)) for one in spans])
                names = ("begin", "end", "kind", "digits", "named", "instance", "patterns")
                tokens.append([dict(zip(names, one, strict=True)) for one in tokens_of(text or "", spans)])
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("text_key"), pa.array(base, span),
                                              pa.array(tokens, token)], ["doc_id", "text_key", "base", "tokens"])

    return documents.select("doc_id", F.xxhash64("text").alias("text_key"), "text").mapInArrow(
        extract, f"doc_id long, text_key long, base {SPANS}, tokens {TOKENS}")


def sure_patterns(edges: DataFrame, by: PersonalData) -> tuple[DataFrame, DataFrame]:
    """((pattern, kind, score), (instance, score)) after the last round.

    edges: (pattern, instance, kind), distinct.  Nodes however hot are combined before each shuffle.
    """
    seeds = edges.filter("kind >= 0").groupBy("instance").agg(F.lit(1.0).alias("score"))
    known = seeds
    patterns = None
    kinds = staged(edges.filter("kind >= 0").groupBy("pattern", "kind").agg(F.count("*").alias("n"))
                   .groupBy("pattern").agg(F.max(F.struct("n", (-F.col("kind")).alias("kind"))).alias("most"))
                   .select("pattern", (-F.col("most.kind")).alias("kind")), "pattern-kinds")
    z = by.confidence
    for _ in range(by.rounds):
        share, n = F.col("good") / F.col("n"), F.col("n")
        bound = ((share + z * z / (2 * n) - z * F.sqrt(share * (1 - share) / n + z * z / (4 * n * n)))
                 / (1 + z * z / n))
        patterns = staged(
            edges.select("pattern", "instance").distinct().join(known, "instance", "left")
            .groupBy("pattern").agg(F.sum(F.coalesce("score", F.lit(0.0))).alias("good"), F.count("*").alias("n"))
            .select("pattern", bound.alias("score")).filter(F.col("score") >= by.surely)
            .join(kinds, "pattern"), "patterns")
        found = (edges.select("pattern", "instance").distinct().join(patterns.select("pattern", "score"), "pattern")
                 .groupBy("instance").agg((1 - F.exp(F.sum(F.log1p(-F.least("score", F.lit(0.999)))))).alias("score"))
                 .filter(F.col("score") >= by.surely))
        known = staged(found.union(seeds).groupBy("instance").agg(F.max("score").alias("score")), "instances")
    return patterns, known


def all_spans(documents: DataFrame, by: PersonalData = PersonalData()) -> DataFrame:
    """(doc_id, text_key, base, spans) of every row of documents (doc_id, text): arrays of (kind, begin, end), ordered,
    in code points; spans holds base and what the sure patterns add outside of it."""
    found = staged(extracted(documents), "tokens")
    each = found.select("doc_id", "text_key", F.explode("tokens").alias("token")).select(
        "doc_id", "text_key", "token.begin", "token.end", "token.kind", "token.digits", "token.named", "token.instance",
        F.explode("token.patterns").alias("pattern"))
    edges = staged(each.select("pattern", "instance", "kind").distinct(), "edges")
    patterns, known = sure_patterns(edges, by)
    new = (each.filter("kind < 0").filter(F.col("end") - F.col("begin") >= by.least_length)
           .drop("kind").join(patterns, "pattern")
           .filter((F.col("digits") >= by.least_digits) | (F.col("kind") == KINDS.index("email")) & F.col("named"))
           .join(known.select("instance"), "instance")
           .groupBy("doc_id", "text_key", "begin", "end")
           .agg(F.max(F.struct("score", (-F.col("kind")).alias("kind"))).alias("best"))
           .select("doc_id", "text_key", (-F.col("best.kind")).alias("kind"), "begin", "end"))
    added = (new.groupBy(F.col("doc_id").alias("of"), F.col("text_key").alias("of_text"))
             .agg(F.collect_set(F.struct("kind", "begin", "end")).alias("added")))
    same = F.col("doc_id").eqNullSafe(F.col("of")) & (F.col("text_key") == F.col("of_text"))
    return found.select("doc_id", "text_key", "base").join(added, same, "left").select(
        "doc_id", "text_key", "base",
        F.array_sort(F.array_union("base", F.coalesce("added", F.array().cast(SPANS)))).alias("spans"))


def span_list(spans: str) -> Column:
    """kind:begin:end, joined by commas."""
    names = F.array(*map(F.lit, KINDS))
    return F.concat_ws(",", F.transform(F.col(spans), lambda one: F.concat_ws(
        ":", F.get(names, one["kind"]), one["begin"].cast("string"), one["end"].cast("string"))))


def number_of(kind: int) -> Column:
    return F.size(F.filter("base", lambda one: one["kind"] == kind)).cast("long")


def personal_data(documents: DataFrame, by: PersonalData = PersonalData()) -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans) of every row of documents (doc_id, text).

    The counts and the digest are of the base spans, spans lists all.  Null and empty texts have none.  Null, tied and
    repeated doc_ids are passed on as they are, one row for each; no rows give no rows; other columns are not looked at.
    """
    counts = [number_of(kind).alias(f"n_{name}") for kind, name in enumerate(KINDS)]
    return all_spans(documents, by).select(
        "doc_id", *counts, F.sha2(span_list("base"), 256).alias("base_sha256"), span_list("spans").alias("spans"))


def masked(documents: DataFrame, by: PersonalData = PersonalData()) -> DataFrame:
    """The documents, with all their columns, each span of personal data in the text replaced by its kind in brackets.

    n_chars, where there is such a column, follows the text.  Spans that overlap are replaced as one.
    """
    found = (all_spans(documents, by).filter("size(spans) > 0")
             .select(F.col("doc_id").alias("of"), F.col("text_key").alias("of_text"), "spans")
             .dropDuplicates(["of", "of_text"]))

    @F.pandas_udf("string")
    def without(texts, spans):
        import pandas as pd

        return pd.Series([replaced(text, these) for text, these in zip(texts, spans, strict=True)], dtype=object)

    rows = documents.join(found, documents["doc_id"].eqNullSafe(found["of"])
                          & (F.xxhash64(documents["text"]) == found["of_text"]), "left")
    new = F.when(found["spans"].isNull(), documents["text"]).otherwise(without(documents["text"], found["spans"]))
    rows = rows.withColumn("~new", new)
    sizes = {"n_chars": F.char_length("~new").cast(documents.schema["n_chars"].dataType).alias("n_chars")
             } if "n_chars" in documents.columns else {}
    return rows.select(*(F.col("~new").alias("text") if name == "text" else sizes.get(name, documents[name])
                         for name in documents.columns))


def replaced(text: str | None, spans) -> str | None:
    if text is None or spans is None:
        return text
    parts, at = [], 0
    for begin, end, kind in sorted((one["begin"], one["end"], one["kind"]) for one in spans):
        if begin >= at:
            parts += [text[at:begin], f"[{KINDS[kind].upper()}]"]
        else:
            parts.append("")
        at = max(at, end)
    return "".join([*parts, text[at:]])
