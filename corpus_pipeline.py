"""From raw documents to packed training sequences: language, exact copies, near copies, personal data, packing."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from changevault.llm import exact_dedup, language, minhash, packing, pii
from changevault.session import fresh_dir

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language cannot be told go: those without text or without a letter. The others bear the language
    predicted for them, whatever they were said to be in. Where no row of the table names a language there is none to
    learn: documents with a letter stay as they are."""
    model = language.fit(docs.where(~language.is_held_out("doc_id")))
    if not model.languages:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    told = language.predict(docs, model).withColumn("row", F.monotonically_increasing_id())
    # a filter that needs the row's number stays above the model, which else would run once more for the filter
    kept = told.where((F.col("lang_pred") != language.UNDETERMINED) & (F.col("row") >= 0))
    return kept.select(*(F.col("lang_pred" if c == "lang" else f"doc.`{c}`").alias(c) for c in docs.columns))


def unique_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts stays, the one with the smallest doc_id."""
    return exact_dedup.drop_copies(docs)


def far_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays, the one with the smallest doc_id."""
    return minhash.drop_near_copies(docs)


def masked(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data and secrets give way to their kind between angle brackets; n_chars follows the text."""
    found = pii.find(docs, pii.fit(docs)).select("doc", pii.masked(F.col("doc.text"), F.col("spans")).alias("safe"))
    values = {"text": F.col("safe"), "n_chars": F.length("safe").cast("long")}
    return found.select(*(values.get(c, F.col(f"doc.`{c}`")).alias(c) for c in docs.columns))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of what is left, in sequences of 1024 ids."""
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES: list[tuple[str, Stage]] = [
    ("language", known_language),
    ("exact_dedup", unique_texts),
    ("near_dedup", far_texts),
    ("pii", masked),
    ("packing", packed),
]

#: Trained models and tokenizers are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``. Each stage's result is written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = fresh_dir(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
