"""Corpus pipeline: from raw documents to packed training sequences.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written as
Parquet and read again as the documents of the next. All but the last keep the
columns of ``documents``. Every stage works on all rows that the one before kept,
and its decisions take effect.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from meridian.llm.common import documents, materialise
from meridian.llm.decontamination import drop_leaks
from meridian.llm.exact_dedup import drop_copies
from meridian.llm.near_join import keep_one
from meridian.llm.packing import pack
from meridian.llm.toxicity import drop_toxic


def remove_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def remove_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_copies(docs)


def remove_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_one(docs)


def remove_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack(docs)


STAGES = [
    ("toxicity", remove_toxic),
    ("exact_dedup", remove_copies),
    ("ngram_jaccard_join", remove_near_copies),
    ("decontamination", remove_benchmark),
    ("best_fit_packing", pack_sequences),
]

#: A fitted classifier and a tokenizer are beyond SQL; the tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each read back from what the one before wrote."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
