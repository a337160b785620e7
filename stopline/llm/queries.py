"""The operators on the given tables: one query each."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stopline.llm import (
    decontamination,
    extraction,
    hard_negatives,
    lines,
    packing,
    preference,
    prefix_trie,
    quality,
    sharding,
    simhash,
    substrings,
    token_counts,
    toxicity,
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = toxicity.scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    score = F.col("_score")
    return rows.select("doc_id", F.col("_held_out").alias("held_out"), score.alias("score"), (score >= 0.5).cast("int").alias("predicted"))


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = simhash.near_copies(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), "component_id")


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = lines.without_repeated_lines(table(spark, sf_dir, "documents"), signs=lines.MIN_SIGNS)
    digest = F.sha2(F.coalesce("text", F.lit("")), 256)
    return rows.select("doc_id", F.col("_lines_before").alias("n_lines"), F.col("_lines_after").alias("n_kept"), digest.alias("kept_sha256"))


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = sharding.shards(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op5_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extraction.extracted(table(spark, sf_dir, "pages"))


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = decontamination.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    names = F.array_sort(F.transform("items", lambda i: i.cast("string")))
    return rows.select("doc_id", "n_words", "n_hit", "n_items", F.sha2(F.array_join(names, ","), 256).alias("items_sha256"), "contaminated")


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.rated(table(spark, sf_dir, "documents"))


def op8_preference(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations")
    return preference.preference_segments(turns.withColumnRenamed("conv_id", "pair_id"), preference.borrowed_answers(turns))


def op9_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.without_repeated_substrings(table(spark, sf_dir, "documents"), with_text=False)


def op10_packing(spark: SparkSession, sf_dir: str, tokenizer: str | None = None) -> DataFrame:
    path = tokenizer or public_tokenizers.path("word_bpe_49k.json")
    return packing.pack(table(spark, sf_dir, "documents"), path, with_ids=False)


def op11_token_counts(spark: SparkSession, sf_dir: str, tokenizer: str | None = None) -> DataFrame:
    path = tokenizer or public_tokenizers.path("byte_bpe_50k.json")
    return token_counts.token_counts(table(spark, sf_dir, "documents"), path, limit=1024)


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = hard_negatives.vectors(table(spark, sf_dir, "embeddings"), label)
    return hard_negatives.hard_negatives(rows, F.col("vec_id") % 100 == 0, lower=30, upper=90, positives=5, negatives=10)


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = prefix_trie.ordered_turns(table(spark, sf_dir, "conversations"))
    head = F.crc32(F.col("conv_id").cast("string").cast("binary")) % 9
    return prefix_trie.trie(*prefix_trie.spliced(turns, every=5, head=head))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_toxicity,
        op2_simhash,
        op3_line_dedup,
        op4_sharding,
        op5_extraction,
        op6_decontamination,
        op7_quality,
        op8_preference,
        op9_substrings,
        op10_packing,
        op11_token_counts,
        op12_hard_negatives,
        op13_prefix_trie,
        pipeline,
    )
}
