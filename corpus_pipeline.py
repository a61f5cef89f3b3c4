"""The corpus pipeline: languages, exact copies, near copies, benchmark passages, packing; each stage is one operator over all that its predecessor kept.

A filtering stage returns the rows it keeps with all columns of ``documents``; the last returns the pieces of the packed sequences. Edge cases (null or empty texts, repeated rows,
empty tables, further columns) are those of the operators: a text without letters has no language and is dropped by the first stage; of repeated rows one stays.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from paceway.llm import decontaminate, exact, langid, near, packing
from paceway.llm.queries import vocabulary
from paceway.runtime import workspace, written


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the evidence supports."""
    return langid.keep(docs, langid.train(docs))


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts, that with the largest id."""
    return exact.keep(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies, that with the least id."""
    return near.keep(docs)


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that benchmark items do not contaminate."""
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the training sequences, with the language and source of their documents' rows left behind."""
    return packing.pack(docs, vocabulary("word_bpe_49k.json"), end_id=1).withColumnRenamed("id", "doc_id")


STAGES = [
    ("language", language),
    ("exact_copies", exact_copies),
    ("near_copies", near_copies),
    ("benchmark_passages", benchmark_passages),
    ("sequences", sequences),
]

#: SQL cannot express a trained model, signatures or a tokenizer; tests/llm compares the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage returns is written to the shared folder and read again. All but the last stage's result goes when the run ends."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    with workspace(spark, "pipeline") as keep:
        for name, stage in STAGES[:-1]:
            docs = keep(stage(spark, docs, sf_dir), name)
        name, stage = STAGES[-1]
        return written(stage(spark, docs, sf_dir), name)
