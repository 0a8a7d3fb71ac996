"""Registered queries of the training-data operators: thin forms with production parameters over whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspark.llm import (alignment, binary_output, byte_bpe, collocations, decontamination, language_model, oracles,
                            quality_classifier, quality_rules, secret_scan, sharding, simhash, surrogates, toxicity)
from tallyspark.llm.calibration import id_remainder


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    m = F.col("match")
    return decontamination.find_matches(docs, table(spark, sf_dir, "benchmark"), window=13).select(
        "doc_id", m["n_words"].alias("n_words"), m["n_hit"].alias("n_hit"),
        F.size(m["items"]).cast("bigint").alias("n_items"),
        F.sha2(F.array_join(m["items"], ","), 256).alias("items_sha256"),
        decontamination.contaminated(m).alias("contaminated"), m["longest"].alias("longest_match"))


def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    part = id_remainder(F.col("doc_id"), 3)
    model = quality_classifier.fit(docs, table(spark, sf_dir, "labels"), where=part != 1)
    scored = quality_classifier.score_documents(docs.select("doc_id", "text", (part == 1).alias("held_out")), model)
    return scored.select("doc_id", "held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    rules = quality_rules.fit_rules(docs, table(spark, sf_dir, "labels"))
    s = F.col("stats")
    return quality_rules.apply_rules(docs, rules).select(
        "doc_id", *[s[c].alias(c) for c in quality_rules.STATS[:5]], quality_rules.base_failed(s).alias("base_failed"),
        F.col("rule").isNull().alias("kept"), "rule")


def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = byte_bpe.encode_digests(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    return coded.drop("text")


#: The key of the registered query's surrogates; users pass their own secret.
SURROGATE_KEY = "tallyspark"


def op5_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    kinds = F.map_values("kinds")
    return surrogates.replace_pii(docs, SURROGATE_KEY).select(
        "doc_id", F.aggregate(kinds, F.lit(0), lambda a, n: a + n).alias("n_entities"),
        F.array_join(F.array_sort(F.map_keys("kinds")), ",").alias("kinds"), "text")


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.shard_by_bytes(table(spark, sf_dir, "documents").select("doc_id", "text"), shards=16)
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
                         "slot", F.lit(None).cast("int").alias("grown_shard"))


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = secret_scan.scan(docs)
    spans = F.col("spans")
    count = {k: F.size(secret_scan.of_kinds(spans, k)).cast("bigint") for k in secret_scan.BASE_KINDS}
    return found.select(
        "doc_id", *[count[k].alias(f"n_{k}") for k in secret_scan.BASE_KINDS],
        F.sha2(secret_scan.written(secret_scan.of_kinds(spans, *secret_scan.BASE_KINDS)), 256).alias("base_sha256"),
        secret_scan.written(spans).alias("spans"))


def op8_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    held = id_remainder(F.col("doc_id"), 5) == 1
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", held.alias("held_out"))
    model = language_model.fit(docs.withColumn("train", ~F.col("held_out")))
    return language_model.score_documents(docs, model).select(
        "doc_id", "held_out", "n_tokens", "n_known", F.lit(model["total"]).cast("bigint").alias("train_tokens"),
        "base_score", "score")


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), size=4, distance=4)


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    part = id_remainder(F.col("doc_id"), 4)
    fitted = toxicity.fit(docs, table(spark, sf_dir, "labels"), where=part != 2)
    scored = toxicity.score_documents(docs.select("doc_id", "text", (part == 2).alias("held_out")), fitted)
    return scored.select("doc_id", "held_out", "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"), max_words=3, least=10, share=50, top=2000)


def op12_binary_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    manifest = binary_output.write_documents(docs, public_tokenizers.path("byte_bpe_50k.json"), end_id=2)
    return binary_output.digests(manifest)


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return alignment.align_documents(docs, public_tokenizers.path("byte_bpe_50k.json"),
                                     public_tokenizers.path("piece_bpe_32k.model"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_decontamination": op1_decontamination,
    "op2_quality_classifier": op2_quality_classifier,
    "op3_quality_rules": op3_quality_rules,
    "op4_byte_bpe": op4_byte_bpe,
    "op5_surrogates": op5_surrogates,
    "op6_sharding": op6_sharding,
    "op7_secret_scan": op7_secret_scan,
    "op8_language_model": op8_language_model,
    "op9_simhash": op9_simhash,
    "op10_toxicity": op10_toxicity,
    "op11_collocations": op11_collocations,
    "op12_binary_output": op12_binary_output,
    "op13_alignment": op13_alignment,
    "pipeline": pipeline,
}

ORACLE_SQL: dict[str, str] = oracles.ORACLE_SQL
