"""Corpus cleaning as five stages, each written as Parquet and read again as the next one's documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tessera.llm import decontaminate, language_id, minmax_dedup, mixture, span_dedup
from tessera.llm.textkit import tuned
from tessera.session import materialize

STAGES = [
    ("language_id", tuned(language_id.stage)),
    ("near_dedup", tuned(minmax_dedup.stage)),
    ("span_dedup", tuned(span_dedup.stage)),
    ("decontaminate", tuned(decontaminate.stage)),
    ("mixture", tuned(mixture.stage)),
]

#: Language models and hash signatures have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return docs
