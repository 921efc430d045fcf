"""The registered queries of the operators, over whole tables, and their SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import quality, toxicity
from .addressable_codes import token_files
from .byte_bpe import round_trip
from .common import table
from .decontamination import contamination
from .filter_audit import filter_audit
from .hard_negatives import hard_negatives
from .near_duplicates import NearDuplicates, near_duplicates
from .packing import packed_documents
from .passages import shared_passages
from .personal_data import personal_data
from .phrases import edited_fingerprints
from .warc import history


def op1_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), NearDuplicates(shingle_words=4))


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return history(table(spark, sf_dir, "pages"))


def op3_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edited_fingerprints(table(spark, sf_dir, "documents"))


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False))
    model = quality.fit(documents, table(spark, sf_dir, "labels"), ~held_out)
    return quality.scored(documents, model).select("doc_id", held_out.alias("held_out"), "score", "predicted")


def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return toxicity.graded(documents, toxicity.fit(documents, table(spark, sf_dir, "labels")))


def op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))


def op9_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data(table(spark, sf_dir, "documents"))


def op10_shared_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shared_passages(table(spark, sf_dir, "documents"))


def op11_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(table(spark, sf_dir, "embeddings").withColumn("label", moved))


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    query.__name__: query for query in (
        op1_near_duplicates, op2_warc, op3_fingerprints, op4_decontamination, op5_quality, op6_token_files, op7_toxicity,
        op8_byte_bpe, op9_personal_data, op10_shared_passages, op11_packing,
        op12_hard_negatives, op13_filter_audit)}

_WORDS = (r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', "
          r"'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')")

ORACLE: dict[str, str] = {"op4_decontamination": f"""
WITH dw AS (SELECT doc_id, {_WORDS} AS w FROM documents),
iw AS (SELECT CAST(item_id AS VARCHAR) AS item, {_WORDS} AS w FROM benchmark),
win AS (SELECT DISTINCT item, least(len(w), 10) AS n, array_to_string(w[i + 1 : i + 10], ' ') AS s
        FROM (SELECT item, w, unnest(range(0, greatest(len(w) - 10, 0) + 1)) AS i FROM iw WHERE len(w) > 0)),
place AS (SELECT doc_id, p, n, array_to_string(w[p + 1 : p + n], ' ') AS s
          FROM (SELECT doc_id, w, unnest(range(0, len(w))) AS p FROM dw), (SELECT DISTINCT n FROM win)
          WHERE p + n <= len(w)),
occ AS (SELECT doc_id, p, n, item FROM place JOIN win USING (s, n)),
hit AS (SELECT doc_id, count(DISTINCT q) AS h FROM (SELECT doc_id, unnest(range(p, p + n)) AS q FROM occ) GROUP BY doc_id),
named AS (SELECT doc_id, count(*) AS k, sha256(string_agg(item, ',' ORDER BY item)) AS z
          FROM (SELECT DISTINCT doc_id, item FROM occ) GROUP BY doc_id)
SELECT dw.doc_id, len(w) AS n_words, coalesce(h, 0) AS n_hit, coalesce(k, 0) AS n_items,
       coalesce(z, sha256('')) AS items_sha256, coalesce(h, 0) > 0 AS contaminated
FROM dw LEFT JOIN hit USING (doc_id) LEFT JOIN named USING (doc_id)"""}

ORACLE["op12_hard_negatives"] = """
WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, row_number() OVER () AS r,
             list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q FROM embeddings
           WHERE label IS NOT NULL AND embedding IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.r AS anchor, a.vec_id AS anchor_id, v.r, v.vec_id, a.label = v.label AS same,
             CAST(list_inner_product(a.q, v.q) AS BIGINT) AS score FROM v a, v WHERE a.vec_id % 100 = 0),
p AS (SELECT *, row_number() OVER (PARTITION BY anchor ORDER BY score DESC, vec_id) AS place FROM s
      WHERE same AND anchor != r QUALIFY place <= 5)
SELECT p.anchor_id, p.vec_id AS positive_id, s.vec_id AS negative_id, p.score AS positive_score, s.score AS negative_score,
       row_number() OVER (PARTITION BY p.anchor, p.place ORDER BY s.score DESC, s.vec_id) AS rank
FROM p JOIN s ON p.anchor = s.anchor AND NOT s.same AND 80 * p.score <= 100 * s.score AND 100 * s.score <= 100 * p.score
QUALIFY rank <= 5"""
ORACLE["op13_filter_audit"] = r"""
WITH d AS (SELECT coalesce(lang, '') AS part, coalesce(text, '') AS t, doc_id,
             regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
f AS (SELECT part, len(w) < 100 AS a, 100 * len(list_distinct(w)) < 80 * len(w) AS b,
             100 * len(regexp_replace(t, '[^A-Z]', '', 'g')) > 10 * len(t) AS c, regexp_matches(t, '[#$%&*|]') AS d,
             coalesce(doc_id > min(doc_id) OVER (PARTITION BY t), false) AS e,
             doc_id IN (SELECT doc_id FROM labels WHERE quality = 1) AS good,
             doc_id IN (SELECT doc_id FROM labels WHERE toxic = 1) AS toxic FROM d),
g AS (SELECT part, a, b, c, d, e, a::INT + b::INT + c::INT + d::INT + e::INT AS failed, count(*) AS n,
             count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic FROM f GROUP BY ALL),
l AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
o AS (SELECT v.x || w.x || y.x || z.x || u.x AS filter_order FROM l v, l w, l y, l z, l u
      WHERE len(list_distinct([v.x, w.x, y.x, z.x, u.x])) = 5),
r AS (SELECT g.*, filter_order, least(if(a, instr(filter_order, 'A'), 6), if(b, instr(filter_order, 'B'), 6),
             if(c, instr(filter_order, 'C'), 6), if(d, instr(filter_order, 'D'), 6), if(e, instr(filter_order, 'E'), 6)) AS gone
      FROM g, o),
s AS (SELECT r.*, step, filter_order[step] AS x,
             CASE filter_order[step] WHEN 'A' THEN a WHEN 'B' THEN b WHEN 'C' THEN c WHEN 'D' THEN d ELSE e END AS fails
      FROM r, (SELECT unnest(range(1, 6)) AS step))
SELECT part, filter_order, CAST(step AS INT) AS step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, x) AS BIGINT) AS shapley
FROM (SELECT part, filter_order, step, x, CAST(coalesce(sum(n) FILTER (gone > step), 0) AS BIGINT) AS kept,
             CAST(coalesce(sum(n) FILTER (gone = step), 0) AS BIGINT) AS removed,
             CAST(coalesce(sum(n) FILTER (fails AND gone < step), 0) AS BIGINT) AS redundant,
             CAST(coalesce(sum(n) FILTER (fails AND failed = 1), 0) AS BIGINT) AS unique_fails,
             CAST(coalesce(sum(good) FILTER (gone = step), 0) AS BIGINT) AS good_lost,
             CAST(coalesce(sum(toxic) FILTER (gone = step), 0) AS BIGINT) AS toxic_lost
      FROM s GROUP BY ALL)"""
