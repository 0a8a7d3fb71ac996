"""The corpus pipeline: documents go through five stages, each one operator of ``tallyspark.llm``.

A stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes it below the shared folder and
reads it back as the next stage's documents.

1. quality rules: documents that the base rules or the learned list reject go;
2. SimHash near-dedup: one document of each group stays, that with the smallest id;
3. benchmark decontamination: contaminated documents go; matched spans of 100 words or more go from the others;
4. secret scans: secrets in the texts that stay are replaced by a mark;
5. byte-level BPE: the texts are encoded; the rows get ``ids``, ``n_tokens`` and the check that the ids decode
   to the text (``round_trip``).
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tallyspark.llm import byte_bpe, decontamination, quality_rules, secret_scan, simhash
from tallyspark.llm.storage import cut

#: Rows that go to Python together: the stages carry whole documents, and a batch is held several times.
BATCH_ROWS = 2000


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    # the session of the pipeline keeps this setting: a plan reads it when it runs
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    return quality_rules.keep_good(docs, _table(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_one(docs, size=4, distance=4)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontamination.decontaminate(docs, _table(spark, sf_dir, "benchmark"), window=13, share=20, max_span=100)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secret_scan.redact(docs)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return byte_bpe.encode_checked(docs, path, public_tokenizers.PATTERN, kept=100_000, chunk=1 << 20,
                                   stay=False)


STAGES = [
    ("quality_rules", quality),
    ("simhash_near_dedup", near_dedup),
    ("benchmark_decontamination", decontaminate),
    ("secret_scans", secrets),
    ("byte_level_bpe", tokenize),
]

#: The learned rules and the tokenizer have no SQL form; tests hold the rows against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = cut(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
