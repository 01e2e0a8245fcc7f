"""The stages of the corpus pipeline; each calls one operator of this package.

Every stage but the last returns the columns of its input, whatever further
columns there are. Each row is judged by its own text: rows with a null or a repeated
doc_id are matched to their verdict by the key of their text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import table, text_key
from strata.llm.decontamination import contaminated
from strata.llm.language_id import language_filter
from strata.llm.line_dedup import without_repeated_lines
from strata.llm.sentencepiece import encode_documents
from strata.llm.simhash import simhash_survivors


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a recognised language: rejected are those without a letter and
    those whose text agrees with no codeword."""
    return language_filter(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, its text without the lines that an earlier document has."""
    return without_repeated_lines(docs)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of linked fingerprints the document with the smallest id."""
    return simhash_survivors(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    own = docs.withColumn("_key", text_key("text"))
    leaks = contaminated(own, table(spark, sf_dir, "benchmark"), doc_id="_key").select("doc_id").distinct()
    leaks = leaks.select(F.col("doc_id").alias("_leak"))
    return own.join(leaks, F.col("_key") == F.col("_leak"), "left_anti").drop("_key")


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, and whether decoding them gives the text back."""
    return encode_documents(docs)
