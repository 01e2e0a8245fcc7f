"""The corpus pipeline: documents through stages of the training-data operators.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir) and
returns a DataFrame. ``run`` writes every stage's result to the shared scratch
folder and reads it back as the next one's input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from strata.llm import stages
from strata.llm.common import stored, table

STAGES = [
    ("language_id", stages.language_id),
    ("line_dedup", stages.line_dedup),
    ("simhash_near_dedup", stages.simhash_near_dedup),
    ("benchmark_decontamination", stages.benchmark_decontamination),
    ("sentencepiece", stages.sentencepiece),
]

#: SQL can neither learn the language model nor walk the token lattice.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
