"""From raw documents to packed training sequences, in five stages.

Every stage works on all that its predecessor kept; all but the last return the columns of ``documents``, with
``n_chars`` following the text. Texts are told apart by themselves, so repeated ids and null ids are fine; a
null text has no words and goes in the first stage."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillcast.functions.lineage import materialise
from tillcast.llm import chosen_path, line_dedup, packing, pii, quality
from tillcast.llm.common import documents


def _counted(docs: DataFrame) -> DataFrame:
    """``n_chars`` of the text as it is now."""
    if "n_chars" not in docs.columns:
        return docs
    return docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return quality.keep_good(docs)


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that repeat an earlier one go, and documents of which nothing is left."""
    return _counted(line_dedup.remove_repeated_lines(docs))


def jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays."""
    return chosen_path.keep_one(docs)


def pii_surrogates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data are replaced."""
    return _counted(pii.replace_pii(docs))


def curve_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the packed sequences."""
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [("quality_rules", quality_rules), ("line_dedup", line_dedup_stage), ("ngram_jaccard_join", jaccard_join),
          ("pii_surrogates", pii_surrogates), ("curve_packing", curve_packing)]

#: SimHash, chosen paths, keyed surrogates and the curve are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for _, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
