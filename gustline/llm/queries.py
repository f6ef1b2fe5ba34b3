"""The queries of this package and their SQL, with production parameters over whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gustline.llm.conversations import conversation_reports, damaged, repair_conversations
from gustline.llm.conversations_sql import CONVERSATION_REPAIR
from gustline.llm.decontamination import decontaminate
from gustline.llm.fingerprints import fingerprints_of_edits
from gustline.llm.fingerprints_sql import FINGERPRINTS
from gustline.llm.hard_negatives import hard_negatives
from gustline.llm.jaccard_join import near_duplicates
from gustline.llm.language import identify_language
from gustline.llm.line_templates import drop_recurring_lines
from gustline.llm.neighbours import nearest_neighbours
from gustline.llm.packing import pack_documents
from gustline.llm.passages import repeated_passages
from gustline.llm.pseudonyms import pseudonymise
from gustline.llm.secrets import secret_spans
from gustline.llm.shared import table
from gustline.llm.token_counts import token_counts

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


@query
def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"), limit=4096)


@query
def op7_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pseudonymise(table(spark, sf_dir, "documents"), key=b"a key of the deployment")


@query
def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = F.crc32(F.encode(F.col("doc_id").cast("string"), "UTF-8")) % 4 == 2
    held_out = F.coalesce(held_out, F.lit(False)).alias("held_out")
    return identify_language(docs, labelled=docs.where(~held_out), keep=[held_out]).select(
        "doc_id", "held_out", "lang_pred", "score"
    )


@query
def op10_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_spans(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_inferred")


@query
def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(
        table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), capacity=4096, end_id=1
    )


@query
def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.drop("text_a", "text_b")


ORACLES["op4_decontamination"] = r"""
WITH low AS (
    SELECT 'd' AS kind, row_number() OVER () AS r, doc_id AS id, coalesce(text, '') AS text FROM documents
    UNION ALL SELECT 'b', row_number() OVER (), item_id, coalesce(text, '') FROM benchmark WHERE item_id IS NOT NULL
), words AS (
    SELECT kind, r, id, [x FOR x IN string_split_regex(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[\x00-\x2F\x3A-\x60\x7B-\x7F]+') IF x <> ''] AS w
    FROM low
), windows AS (
    SELECT DISTINCT id AS item_id, least(len(w), 10) AS size, list_slice(w, s + 1, s + 10) AS win
    FROM (SELECT id, w, unnest(range(0, greatest(len(w) - 10, 0) + 1)) AS s FROM words WHERE kind = 'b' AND len(w) > 0)
), runs AS (
    SELECT r, size, s, list_slice(w, s + 1, s + size) AS win
    FROM (SELECT r, w, size, unnest(range(0, len(w) - size + 1)) AS s
          FROM words, (SELECT DISTINCT size FROM windows) WHERE kind = 'd' AND len(w) >= size)
), found AS (
    SELECT DISTINCT r, s, runs.size AS size, item_id FROM runs JOIN windows USING (size, win)
), hit AS (
    SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(s, s + size)) AS p FROM found) GROUP BY r
), items AS (
    SELECT r, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS ids
    FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS i FROM found) GROUP BY r
)
SELECT id AS doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM words LEFT JOIN hit USING (r) LEFT JOIN items USING (r)
WHERE kind = 'd'
"""


@query
def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = drop_recurring_lines(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "text", "n_lines", "n_dropped")


@query
def op1_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents")).drop("node", "component", "key")


@query
def op2_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest_neighbours(table(spark, sf_dir, "embeddings"), queries="vec_id % 20 = 0", k=20)


@query
def op5_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_passages(table(spark, sf_dir, "documents"))


@query
def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, times = damaged(table(spark, sf_dir, "conversations"))
    return conversation_reports(repair_conversations(rows, times))


ORACLES["op11_conversation_repair"] = CONVERSATION_REPAIR


@query
def op13_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = fingerprints_of_edits(table(spark, sf_dir, "documents"))
    return found.withColumn("edited", F.sha2("edited", 256)).withColumnRenamed("edited", "edited_sha256")


ORACLES["op13_fingerprints"] = FINGERPRINTS


@query
def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vector, label = F.col("embedding").cast("array<double>"), F.col("label").cast("long")
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = table(spark, sf_dir, "embeddings").select(
        "vec_id",
        F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label).alias("label"),
        F.when(fine, F.transform(vector, lambda x: F.floor(x * 256))).alias("vector"),
    )
    return hard_negatives(rows, anchors="vec_id % 50 = 0", positives=5, negatives=3, low=50, high=95)


ORACLES["op12_hard_negatives"] = """
WITH usable AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           [CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS v
    FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
      AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), scored AS (
    SELECT a.vec_id AS anchor_id, r.vec_id, a.label = r.label AS same,
           CAST(list_inner_product(CAST(a.v AS DOUBLE[]), CAST(r.v AS DOUBLE[])) AS BIGINT) AS score
    FROM usable a JOIN usable r ON a.vec_id % 50 = 0 AND a.vec_id <> r.vec_id
), positives AS (
    SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT anchor_id, positive_id,
       CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
       vec_id AS negative_id, positive_score, score AS negative_score
FROM positives JOIN scored USING (anchor_id)
WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
QUALIFY rank <= 3
"""
