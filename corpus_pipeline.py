"""The corpus pipeline: filters, deduplicates, decontaminates, mixes and tokenizes ``documents``.

Each stage takes ``(spark, docs, sf_dir)``; its result is written as Parquet and read again as the next one's
``docs``. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from martlet.llm import contamination, mixing, neardup, tokens, toxicity
from martlet.llm import queries as llm
from martlet.session import scratch_path


def toxicity_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity classifier does not reject (operator 9)."""
    return toxicity.drop_toxic(docs, llm.table(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, the one with the smallest id (operator 8)."""
    return neardup.drop_duplicates(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no benchmark item (operator 3)."""
    return contamination.drop_contained(docs, llm.table(spark, sf_dir, "benchmark"))


def mix_to_targets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated so that sources weigh the square root of their size, in random order (operator 7)."""
    return mixing.mix_sources(docs).select(*docs.columns)


def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row as token ids in files; returns what the files hold of each (operator 1)."""
    path = scratch_path(spark, "pipeline-tokens")
    tokens.write_tokens(docs, path, public_tokenizers.path(llm.TOKENIZER), llm.END_ID, keep=("lang", "source"))
    return tokens.id_digest(tokens.read_tokens(spark, path))


STAGES = [
    ("toxicity", toxicity_filter),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("mixing", mix_to_targets),
    ("token_output", token_output),
]

#: Trained models and a tokenizer have no SQL form; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
