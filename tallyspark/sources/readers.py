"""Typed scans of the source relations.

Every read gives the schema explicitly (no inference pass over the files) and
stays lazy, so Catalyst prunes columns and pushes the models' filters into the
parquet scan (``PushedFilters``; ``PartitionFilters`` on partitioned layouts).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

REWARDS_SCHEMA = T.StructType([
    T.StructField("block_time", T.TimestampNTZType()),
    T.StructField("reward_type", T.StringType()),
    T.StructField("recipient", T.StringType()),
    T.StructField("lamports", T.LongType()),
])

ACTIVITY_SCHEMA = T.StructType([
    T.StructField("block_time", T.TimestampNTZType()),
    T.StructField("address", T.StringType()),
    T.StructField("tx_success", T.BooleanType()),
    T.StructField("balance_change", T.LongType()),
    T.StructField("token_balance_change", T.DoubleType()),
])

PRICES_SCHEMA = T.StructType([
    T.StructField("timestamp", T.TimestampNTZType()),
    T.StructField("symbol", T.StringType()),
    T.StructField("blockchain", T.StringType()),
    T.StructField("price", T.DoubleType()),
])

TRANSACTIONS_SCHEMA = T.StructType([
    T.StructField("block_number", T.LongType()),
    T.StructField("block_date", T.DateType()),
])


def read_source(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """schema'd parquet scan (a directory may be hive-partitioned)."""
    return spark.read.schema(schema).parquet(path)


def read_json_bodies(spark: SparkSession, path: str, one_per_line: bool = False) -> DataFrame:
    """Landed API responses as a ``body`` column.

    By default each file holds one (possibly pretty-printed) JSON document;
    with ``one_per_line`` every line of every file is one document.
    """
    return spark.read.text(path, wholetext=not one_per_line).withColumnRenamed("value", "body")


@dataclass
class Sources:
    """The source relations of the revenue DAG, all lazy."""

    activity: DataFrame
    prices: DataFrame
    mapping: DataFrame
    mapping_rows: int | None
    rewards: DataFrame
    responses: DataFrame
    transactions: DataFrame


def load_source_tables(spark: SparkSession, root: str, bodies_one_per_line: bool = False) -> Sources:
    """Production layout: one parquet directory per source under ``root``
    (``rewards``, ``account_activity``, ``prices_day``, ``transactions``; any of
    them may be hive-partitioned) and landed API bodies under ``mev_responses``.
    """
    from tallyspark.sources.mapping import mapping_df, mapping_size

    r = root.rstrip("/")
    return Sources(
        activity=read_source(spark, f"{r}/account_activity", ACTIVITY_SCHEMA),
        prices=read_source(spark, f"{r}/prices_day", PRICES_SCHEMA),
        mapping=mapping_df(spark).drop("idx"),
        mapping_rows=mapping_size(),
        rewards=read_source(spark, f"{r}/rewards", REWARDS_SCHEMA),
        responses=read_json_bodies(spark, f"{r}/mev_responses", bodies_one_per_line),
        transactions=read_source(spark, f"{r}/transactions", TRANSACTIONS_SCHEMA),
    )
