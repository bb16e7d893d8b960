"""The operators of this subpackage over their whole tables, and the SQL they must agree with."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

import public_tokenizers

from changevault.llm import (
    alignment, bpe, embedding_dedup, exact_dedup, graph_search, hard_negatives, html, language, minhash, packing, pii, quality, toxicity,
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return exact_dedup.mark_copies(docs, keep="largest").select(
        "doc.doc_id", "keep_id", "group_size", "kept", "text_sha256",
    )


def op2_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_copies(table(spark, sf_dir, "embeddings"))


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    spans = pii.find(docs, pii.fit(docs))
    counts = [pii.count(F.col("base"), kind).alias(f"n_{kind}") for kind in pii.KINDS]
    return spans.select(
        "doc.doc_id", *counts, F.sha2(pii.digest(F.col("base")), 256).alias("base_sha256"),
        pii.digest(F.col("spans")).alias("spans"),
    )


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    weights = quality.fit(docs, table(spark, sf_dir, "labels"))
    return quality.predict(docs, weights).select(
        "doc.doc_id", language.is_held_out("doc.doc_id").alias("held_out"), "score", "predicted",
    )


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = language.fit(docs.where(~language.is_held_out("doc_id")))
    return language.predict(docs.drop("lang"), model).select(
        "doc.doc_id", language.is_held_out("doc.doc_id").alias("held_out"), "lang_pred", "score",
    )


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.predict(docs, model).select("doc.doc_id", "severity", "grade", "toxic")


def op7_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_copies(table(spark, sf_dir, "documents"))


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe.digests(docs, public_tokenizers.path("word_bpe_49k.json")).select(
        "doc.doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op10_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract(table(spark, sf_dir, "pages")).select("doc.page_id", "doc.url", "text")


def op11_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph_search.nearest(table(spark, sf_dir, "embeddings"))


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return alignment.align(docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")).select(
        "doc.doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(table(spark, sf_dir, "embeddings"), label)


QUERIES = {
    "op1_exact_dedup": op1_exact_dedup,
    "op2_embedding_dedup": op2_embedding_dedup,
    "op3_pii": op3_pii,
    "op4_quality": op4_quality,
    "op5_language_id": op5_language_id,
    "op6_toxicity": op6_toxicity,
    "op7_minhash_dedup": op7_minhash_dedup,
    "op8_bpe": op8_bpe,
    "op9_packing": op9_packing,
    "op10_html_extract": op10_html_extract,
    "op11_nearest_neighbours": op11_nearest_neighbours,
    "op12_token_alignment": op12_token_alignment,
    "op13_hard_negatives": op13_hard_negatives,
}

ORACLES = {
    "op1_exact_dedup": """
        SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
               row_number() OVER (PARTITION BY coalesce(text, '') ORDER BY doc_id DESC NULLS LAST) = 1 AS kept,
               sha256(coalesce(text, '')) AS text_sha256
        FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))""",
}
