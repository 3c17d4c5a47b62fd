"""The operators bound to the tables: queries ``opN_<name>`` and their SQL.

Each query reads its table whole and applies its operator with production
parameters; the vocabulary files are parameters of the operators.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lendgrade.llm import bpe, extraction, hardneg, learning, linefield, packing, pivots, quality, simhash, topk, toxicity, urlfilter, warc, whitening


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


#: A document's label serves for learning unless its fold is the one held out.
QUALITY_FOLDS, QUALITY_HELD, QUALITY_KEPT = 3, 1, 0.5
TOXIC_FOLDS, TOXIC_HELD, TOXIC_FROM = 4, 2, 0.3


def quality_model(docs: DataFrame, labels: DataFrame) -> quality.ByteNet | float:
    return quality.fit_labelled(docs, labels, learning.fold(F.col("doc_id"), QUALITY_FOLDS) != QUALITY_HELD)


def toxicity_model(docs: DataFrame, labels: DataFrame) -> toxicity.Crf | None:
    return toxicity.fit_labelled(docs, labels, learning.fold(F.col("doc_id"), TOXIC_FOLDS) != TOXIC_HELD)


def _held(folds: int, held: int):
    return F.coalesce(learning.fold(F.col("doc_id"), folds) == held, F.lit(False)).alias("held_out")


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = quality.score(docs, quality_model(docs, table(spark, sf_dir, "labels")), keep=["doc_id"])
    return scored.select("doc_id", _held(QUALITY_FOLDS, QUALITY_HELD), "score", (F.col("score") >= QUALITY_KEPT).cast("int").alias("predicted"))


def op10_toxicity_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = toxicity.score(docs, toxicity_model(docs, table(spark, sf_dir, "labels")), keep=["doc_id"])
    return scored.select("doc_id", _held(TOXIC_FOLDS, TOXIC_HELD), "score", (F.col("score") >= TOXIC_FROM).cast("int").alias("predicted"), "spans")


def op2_warc_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = warc.archive(table(spark, sf_dir, "pages"))
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op3_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return out.select("doc_id", simhash.hex_fingerprint(F.col("fp")).alias("fingerprint"), "component_id")


def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return bpe.encode_digests(table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN, keep=["doc_id"])


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op6_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extraction.extract(table(spark, sf_dir, "pages"), keep=["page_id", "url"])


def op7_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pivots.near_duplicates(table(spark, sf_dir, "embeddings"))


def op8_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 nearest binary codes of every vector whose id divides by 100."""
    found = topk.nearest(table(spark, sf_dir, "embeddings"), F.col("id") % 100 == 0, k=10)
    return found.withColumnRenamed("id", "vec_id")


#: (verdict, host/path); the longest that fits decides.
URL_RULES = [("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/")]


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urlfilter.judge(table(spark, sf_dir, "pages"), URL_RULES, keep=["page_id"]).drop("score")


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels of every 7th row are off by one; anchors are every 100th."""
    rows = table(spark, sf_dir, "embeddings")
    off = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hardneg.mine(rows.select("vec_id", "embedding", off.alias("label")), F.col("id") % 100 == 0)


def op12_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    wanted = learning.fold(F.col("doc_id"), QUALITY_FOLDS) != QUALITY_HELD  # the rest measures the verdicts
    model = linefield.fit_labelled(docs, table(spark, sf_dir, "labels"), wanted)
    return linefield.judge(docs, model, keep=["doc_id"]).drop("content")


def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = whitening.whiten(table(spark, sf_dir, "embeddings"))
    # exact; beyond a long it is null here
    return out.withColumn("deviation", F.col("deviation").try_cast("bigint"))


QUERIES = {f.__name__: f for f in (op1_quality_classifier, op2_warc_shards, op3_simhash_near_dedup, op4_byte_bpe, op5_best_fit_packing, op6_html_extraction, op7_embedding_near_dedup, op8_exact_topk, op9_url_filter, op10_toxicity_crf, op11_hard_negatives, op12_quality_rules, op13_embedding_whitening)}

ORACLE_SQL: dict[str, str] = {
    "op2_warc_shards": """
        WITH p AS (
            SELECT page_id, coalesce(html, '') AS h FROM pages
        ), d AS (
            SELECT page_id, strlen(h) AS n, sha1(h) AS x, max(page_id) OVER (PARTITION BY h) AS top FROM p
        ), bits AS (
            SELECT *, list_aggregate(list_transform(range(1, 41), lambda i:
                substr('0000000100100011010001010110011110001001101010111100110111101111',
                       4 * instr('0123456789abcdef', substr(x, CAST(i AS INTEGER), 1)) - 3, 4)), 'string_agg', '') AS b FROM d
        )
        SELECT page_id, CAST(n AS BIGINT) AS payload_bytes,
               list_aggregate(list_transform(range(0, 32), lambda i:
                   substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1
                       + 16 * CAST(substr(b, CAST(5 * i + 1 AS INTEGER), 1) AS INTEGER) + 8 * CAST(substr(b, CAST(5 * i + 2 AS INTEGER), 1) AS INTEGER)
                       + 4 * CAST(substr(b, CAST(5 * i + 3 AS INTEGER), 1) AS INTEGER) + 2 * CAST(substr(b, CAST(5 * i + 4 AS INTEGER), 1) AS INTEGER)
                       + CAST(substr(b, CAST(5 * i + 5 AS INTEGER), 1) AS INTEGER), 1)), 'string_agg', '') AS payload_digest,
               CASE WHEN page_id = top THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN page_id <> top THEN top END AS refers_to
        FROM bits
    """,
    "op7_embedding_near_dedup": """
        WITH RECURSIVE v AS (
            SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
        ), links AS (
            SELECT a.vec_id AS x, b.vec_id AS y
            FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id
            WHERE list_cosine_similarity(a.e, b.e) >= 0.98
        ), reach(x, y) AS (
            SELECT vec_id, vec_id FROM v
            UNION
            SELECT r.x, l.y FROM reach r JOIN links l ON l.x = r.y
        ), least AS (SELECT x, min(y) AS c FROM reach GROUP BY x),
        degree AS (SELECT x, count(*) AS n FROM links GROUP BY x)
        SELECT v.vec_id, CAST(coalesce(d.n, 0) AS BIGINT) AS n_links,
               l.c AS component_id, v.vec_id = l.c AS kept
        FROM v JOIN least l ON l.x = v.vec_id LEFT JOIN degree d ON d.x = v.vec_id
    """,
    "op8_exact_topk": """
        WITH b AS (
            SELECT vec_id, list_transform(embedding, lambda x: CASE WHEN x > 0 THEN 1 ELSE 0 END) AS c FROM embeddings
        ), pairs AS (
            SELECT q.vec_id AS query_id, t.vec_id,
                   CAST(list_sum(list_transform(list_zip(q.c, t.c), lambda z: CASE WHEN z[1] <> z[2] THEN 1 ELSE 0 END)) AS BIGINT) AS distance
            FROM b q JOIN b t ON t.vec_id <> q.vec_id WHERE q.vec_id % 100 = 0
        ), ranked AS (
            SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY distance, vec_id) AS INTEGER) AS rank FROM pairs
        )
        SELECT query_id, rank, vec_id, distance FROM ranked WHERE rank <= 10
    """,
    "op11_hard_negatives": """
        WITH v AS (
            SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                   list_transform(embedding, lambda c: CAST(floor(256 * CAST(c AS DOUBLE)) AS BIGINT)) AS x
            FROM embeddings
            WHERE label IS NOT NULL AND embedding IS NOT NULL
              AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0
        ), pairs AS (
            SELECT a.vec_id AS anchor_id, r.vec_id, a.label = r.label AS same,
                   CAST(list_sum(list_transform(list_zip(a.x, r.x), lambda z: z[1] * z[2])) AS BIGINT) AS score
            FROM v a JOIN v r ON a.vec_id <> r.vec_id WHERE a.vec_id % 100 = 0
        ), p AS (
            SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM pairs WHERE same
            QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
        )
        SELECT anchor_id, positive_id,
               CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY n.score DESC, n.vec_id) AS INTEGER) AS rank,
               n.vec_id AS negative_id, positive_score, n.score AS negative_score
        FROM p JOIN pairs n USING (anchor_id)
        WHERE NOT n.same AND 30 * positive_score <= 100 * n.score AND 100 * n.score <= 90 * positive_score
        QUALIFY row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY n.score DESC, n.vec_id) <= 10
    """,
}
