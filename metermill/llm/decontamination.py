"""Benchmark decontamination by a prefix-filtered join, in DataFrame operations only.

A window of an item is contained in a document only if all its shingles are, so one of them is a sufficient prefix: the
one that is rarest in the corpus.  Documents are joined on these alone.  A match fixes where in the document the window
would begin; windows that would not fit there fall to the bounds on length and position, the others are compared word by
word.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import staged, text_or_empty

#: What separates words once A-Z are lower-cased.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Decontamination:
    window_words: int = 10
    shingle_words: int = 3  #: of the joined tokens; of a shorter item, all its words
    broadcast_rows: int = 200_000  #: prefixes are broadcast up to so many, else joined by shuffling


def words(text: str = "text") -> Column:
    """The words of a text; only texts beyond ASCII need the slower way of lower-casing A-Z alone."""
    plain = text_or_empty(text)
    lower = F.when(F.octet_length(plain) == F.char_length(plain), F.lower(plain)).otherwise(
        F.translate(plain, UPPER, LOWER))
    return F.array_remove(F.split(lower, SEPARATORS), "")


def shingle(words: str, at: Column, size: int) -> Column:
    """A hash of `size` words from the one at `at` (0 the first); null where the array ends before."""
    return F.when(at + size <= F.size(words),
                  F.xxhash64(*(F.get(words, at + step) for step in range(size))))


def windows_of(items: DataFrame, by: Decontamination) -> DataFrame:
    """(window_id, item_id, words, length) of every window; one row for windows that items share, item_ids collected."""
    split = items.select(F.col("item_id").cast("string").alias("item"), words().alias("all")).filter("size(all) > 0")
    n = by.window_words
    each = split.select("item", F.explode(F.transform(
        F.sequence(F.lit(0), F.greatest(F.size("all") - n, F.lit(0))),
        lambda at: F.slice("all", at + 1, n))).alias("window"))
    return (each.groupBy("window").agg(F.collect_set("item").alias("items"))
            .select("window", "items", F.size("window").alias("length"), F.xxhash64("window").alias("window_id")))


def positions(documents: DataFrame, size: int) -> DataFrame:
    """(doc_id, text_key, words, at, token) for every place in a document where a shingle begins."""
    return (documents.select("doc_id", F.xxhash64("text").alias("text_key"), words().alias("words"))
            .select("doc_id", "text_key", "words", F.posexplode("words").alias("at", "word"))
            .withColumn("token", shingle("words", F.col("at"), size)))


def rarest(windows: DataFrame, documents: DataFrame, by: Decontamination, size: int) -> DataFrame:
    """Of each window the shingle that is rarest among all documents, with its offset: (token, offset, window, length,
    items)."""
    offered = windows.select("window_id", F.explode(F.sequence(F.lit(0), F.col("length") - size)).alias("offset"),
                             "window").withColumn("token", shingle("window", F.col("offset"), size)).drop("window")
    tokens = bounded(offered.select("token").distinct(), by)
    counts = positions(documents, size).select("token").join(tokens, "token").groupBy("token").agg(
        F.count("*").alias("n"))
    order = Window.partitionBy("window_id").orderBy("n", "token", "offset")
    ranked = (offered.join(counts, "token", "left").fillna(0, ["n"])
              .withColumn("rank", F.row_number().over(order)).filter("rank = 1"))
    return ranked.select("token", "offset", "window_id", "n").join(windows, "window_id")


def bounded(side: DataFrame, by: Decontamination) -> DataFrame:
    """The side for a broadcast, if counting shows it to be within the bound."""
    return F.broadcast(side) if side.limit(by.broadcast_rows + 1).count() <= by.broadcast_rows else side


def occurrences(documents: DataFrame, windows: DataFrame, by: Decontamination) -> DataFrame:
    """(doc_id, text_key, begin, length, items) of every place where a window occurs."""
    found = None
    sizes = windows.select(F.least("length", F.lit(by.shingle_words)).alias("size")).distinct()
    for size in sorted(row["size"] for row in sizes.collect()):  # at most shingle_words values
        own = windows.filter(F.least("length", F.lit(by.shingle_words)) == size)
        prefixes = staged(rarest(own, documents, by, size).filter("n > 0").drop("n"), "prefixes")
        begin = F.col("at") - F.col("offset")
        here = (positions(documents, size).join(bounded(prefixes, by), "token")
                .filter((begin >= 0) & (begin + F.col("length") <= F.size("words")))
                .filter(F.slice("words", F.greatest(begin, F.lit(0)) + 1, F.col("length")) == F.col("window"))
                .select("doc_id", "text_key", begin.alias("begin"), "length", "items"))
        found = here if found is None else found.union(here)
    return found


def without_contaminated(documents: DataFrame, items: DataFrame,
                         by: Decontamination = Decontamination()) -> DataFrame:
    """The documents, with all their columns, in which no window of the items occurs.

    Rows are told apart by doc_id and text, so a null or repeated doc_id is no shelter for, or blame on, another text.
    """
    found = occurrences(documents.select("doc_id", "text"), staged(windows_of(items, by), "windows"), by)
    if found is None:
        return documents
    hit = staged(found.select(F.col("doc_id").alias("of"), F.col("text_key").alias("of_text")).distinct(), "contaminated")
    return documents.join(hit, documents["doc_id"].eqNullSafe(hit["of"])
                          & (F.xxhash64(documents["text"]) == hit["of_text"]), "left_anti")


def contamination(documents: DataFrame, items: DataFrame, by: Decontamination = Decontamination()) -> DataFrame:
    """(doc_id, n_words, n_hit, n_items, items_sha256, contaminated) of every row of documents (doc_id, text), held
    against items (item_id, text).

    A window is `window_words` consecutive words of an item, or all words of a shorter one.  A document's word is hit if
    it lies in an occurrence of a window; n_items counts the items with occurring windows.

    Null or empty texts have no words; an item without words has no window.  Null ids are ids like others among
    documents; items with a null id count as one named "".  A row that repeats another gets the same result.  No items:
    nothing is hit.  Other columns are not looked at.
    """
    documents = documents.select("doc_id", "text")
    items = items.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id"), "text")
    windows = staged(windows_of(items, by), "windows")
    found = occurrences(documents, windows, by)
    every = documents.select("doc_id", F.xxhash64("text").alias("text_key"), F.size(words()).cast("long").alias("n_words"))
    nothing = F.sha2(F.lit(""), 256)
    if found is None:
        return every.select("doc_id", "n_words", F.lit(0).cast("long").alias("n_hit"),
                            F.lit(0).cast("long").alias("n_items"), nothing.alias("items_sha256"),
                            F.lit(False).alias("contaminated"))
    found = staged(found, "occurrences")
    key = ["doc_id", "text_key"]
    # The hit words of a document: lengths of its occurrences, less what earlier ones have covered.
    before = Window.partitionBy(*key).orderBy("begin").rowsBetween(Window.unboundedPreceding, -1)
    end = F.col("begin") + F.col("length")
    places = found.groupBy(*key, "begin").agg(F.max("length").alias("length"))
    hits = (places.withColumn("seen", F.coalesce(F.max(end).over(before), F.lit(0)))
            .groupBy(*key).agg(F.sum(F.greatest(end - F.greatest("begin", "seen"), F.lit(0))).alias("n_hit")))
    named = (found.select(*key, F.explode("items").alias("item")).distinct()
             .groupBy(*key).agg(F.array_sort(F.collect_list("item")).alias("items")))
    facts = hits.join(named, key).select(
        F.col("doc_id").alias("of"), F.col("text_key").alias("of_text"), "n_hit",
        F.size("items").cast("long").alias("n_items"), F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"))
    joined = every.join(facts, F.col("doc_id").eqNullSafe(F.col("of")) & (F.col("text_key") == F.col("of_text")), "left")
    return joined.select("doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
                         F.coalesce("n_items", F.lit(0)).cast("long").alias("n_items"),
                         F.coalesce("items_sha256", nothing).alias("items_sha256"),
                         F.coalesce(F.col("n_hit") > 0, F.lit(False)).alias("contaminated"))
