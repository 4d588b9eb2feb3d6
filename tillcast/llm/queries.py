"""The registered queries of the training-data operators: production parameters, whole tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillcast.llm import (
    bpe, chosen_path, kneser_ney, lattice, line_dedup, packing, periodic, pii, piece_counts, quality, secrets, toxicity,
    whitening)
from tillcast.llm.common import documents
from tillcast.llm.sql import SQL  # noqa: F401


def op1_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return line_dedup.dedup_lines(documents(spark, folder))


def op2_bpe_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    return bpe.round_trip(documents(spark, folder), public_tokenizers.path("byte_bpe_50k.json"))


def op3_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return piece_counts.token_counts(documents(spark, folder), public_tokenizers.path("piece_bpe_32k.model"))


def op4_curve_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(documents(spark, folder), public_tokenizers.path("byte_bpe_50k.json"))


def op5_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder)
    return secrets.scan(docs, secrets.train(docs))


def op6_lm_scores(spark: SparkSession, folder: str) -> DataFrame:
    held_out = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 7 == 2
    docs = documents(spark, folder)
    scores = kneser_ney.scored(docs, kneser_ney.train(docs.filter(~held_out)))
    return scores.withColumn("held_out", held_out)


def op7_embedding_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return lattice.near_vectors(spark.read.parquet(f"{folder}/embeddings.parquet"))


def op8_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return quality.judged(documents(spark, folder))


def op9_pii_surrogates(spark: SparkSession, folder: str) -> DataFrame:
    return pii.replace_pii(documents(spark, folder).select("doc_id", "text"), count_col="n_replaced").select("doc_id", "n_replaced", "text")


def op10_ngram_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return chosen_path.jaccard_join(documents(spark, folder))


def op11_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """Nothing is learnt from rows with remainder 0, neither from their labels nor from their texts."""
    held_out = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 5 == 0
    docs, labels = documents(spark, folder), spark.read.parquet(f"{folder}/labels.parquet")
    classifier = toxicity.train(docs.filter(~held_out), labels.filter(~held_out))
    return toxicity.scores(docs, classifier).select("doc_id", held_out.alias("held_out"), "score", "predicted")


def op12_embedding_whitening(spark: SparkSession, folder: str) -> DataFrame:
    return whitening.whitened(spark.read.parquet(f"{folder}/embeddings.parquet"))


def op13_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    return periodic.run_digests(periodic.periodic_runs(periodic.repeat_tails(documents(spark, folder))))


QUERIES = {f.__name__: f for f in (
    op1_line_dedup, op2_bpe_round_trip, op3_token_counts, op4_curve_packing, op5_secret_scan, op6_lm_scores,
    op7_embedding_near_dedup, op8_quality_rules, op9_pii_surrogates, op10_ngram_jaccard_join, op11_toxicity, op12_embedding_whitening,
    op13_periodic_runs)}
