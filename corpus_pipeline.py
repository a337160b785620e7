"""Documents to training sequences: without toxic ones, repeated lines, near copies and benchmark passages, then packed."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stopline.llm import decontamination, lines, packing, simhash, toxicity
from stopline.llm.queries import table
from stopline.scratch import run_folder


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    return toxicity.without_toxic(docs, table(spark, sf_dir, "labels"))


def repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated lines go, and documents that had words and lose their last; n_chars is counted again."""
    rows = lines.without_repeated_lines(docs, signs=lines.MIN_SIGNS)
    words = F.trim(F.translate(F.coalesce("text", F.lit("")), "\t\n\v\f\r", "     ")) != ""
    rows = rows.filter(words | (F.col("_lines_before") == F.col("_lines_after")))
    count = F.when(F.col("_lines_before") == F.col("_lines_after"), F.col("n_chars")).otherwise(F.char_length("text"))
    return rows.withColumn("n_chars", count.cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays, the one with the smallest id."""
    return simhash.without_near_copies(docs)


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents contaminated with benchmark items go."""
    return decontamination.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents left, in sequences of 2048 tokens."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), with_ids=False)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", toxic),
    ("line_dedup", repeated_lines),
    ("simhash", near_copies),
    ("decontamination", benchmark_passages),
    ("packing", packed),
]

#: Scores of a learned model decide the first stage, so no SQL can express the result; tests compare each stage instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, one after the other; what a stage returns is written as Parquet, and the next one reads that."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        folder = run_folder(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(folder)
        docs = spark.read.parquet(folder)
    return STAGES[-1][1](spark, docs, sf_dir)
