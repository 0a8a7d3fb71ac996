"""Adapters: driver test tables -> the source shapes the models read.

The driver ships TPC-H-like tables plus ``events``; these functions reshape
them into reward facts, account activity, daily prices, landed API response
bodies and block transactions. They are ordinary lazy DataFrame expressions,
so the model plans read straight through them down to the parquet scans.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspark.functions.time import day_start, period_start
from tallyspark.sources.mapping import MAPPING_ROWS, mapping_df, mapping_size
from tallyspark.sources.readers import Sources

# Adapter rules: the slot of a user in the mapping list; one more slot than
# mapped addresses leaves some users unmapped.
MAPPING_SLOTS = 25
EVENT_COLS = ["event_id", "ts", "user_id", "event_type", "value", "props"]
# Elements per landed response body: bounded, so building a body never
# gathers an unbounded group into one row.
BODY_SPAN = 64


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _cents(value: Column) -> Column:
    return F.round(value * F.lit(100)).cast("bigint")


def slot_address(user_id: Column) -> Column:
    """Mapped address of a user's slot (``user_id % 25``); NULL for the unmapped slot.

    A literal-array lookup: a projection, no join and no broadcast job.
    """
    addresses = F.array(*[F.lit(r[0]) for r in MAPPING_ROWS])
    return F.try_element_at(addresses, (user_id % F.lit(MAPPING_SLOTS)).cast("int") + F.lit(1))


def account_activity(events: DataFrame, mapping: DataFrame | None = None) -> DataFrame:
    """events -> balance-change facts; the address is the user's mapping slot."""
    cents = _cents(F.col("value"))
    return events.select(
        F.col("ts").alias("block_time"),
        F.coalesce(slot_address(F.col("user_id")), F.lit("unmapped")).alias("address"),
        (F.col("event_type") != F.lit("error")).alias("tx_success"),
        ((cents - F.lit(3000)) * F.lit(1000000)).cast("bigint").alias("balance_change"),
        ((cents - F.lit(3000)).cast("double") / F.lit(100)).alias("token_balance_change"),
    )


def prices_day(events: DataFrame) -> DataFrame:
    """Daily prices, one row per event; on days of month divisible by 7 the
    price is NULL (the no-price-that-day cases)."""
    uid = F.col("user_id") % F.lit(3)
    priced = F.dayofmonth("ts") % F.lit(7) != F.lit(0)
    return events.select(
        day_start("ts").alias("timestamp"),
        F.when(uid == 0, "SOL").when(uid == 1, "WETH").otherwise("BONK").alias("symbol"),
        F.when(F.col("event_id") % F.lit(10) < F.lit(9), "solana").otherwise("ethereum").alias("blockchain"),
        F.when(priced, F.col("value")).alias("price"),
    )


def rewards(events: DataFrame) -> DataFrame:
    """Reward facts at hourly block times (so times repeat)."""
    uid = F.col("user_id") % F.lit(4)
    et = F.col("event_type")
    return events.select(
        period_start("hour", "ts").alias("block_time"),
        F.when(et == "view", "Voting").when(et == "click", "Fee").when(et == "signup", "Rent")
         .otherwise("Staking").alias("reward_type"),
        F.when(uid == 0, "id_key").when(uid == 1, "vote_key").otherwise("other").alias("recipient"),
        (_cents(F.col("value")) * F.lit(10000000)).cast("bigint").alias("lamports"),
    )


def mev_responses(events: DataFrame) -> DataFrame:
    """Landed validator API bodies: JSON arrays of per-epoch MEV records.

    One body per user and run of ``BODY_SPAN`` event ids, elements sorted.
    """
    el = F.to_json(F.struct(
        (F.lit(132) + F.get_json_object("props", "$.k").cast("int")).alias("epoch"),
        F.lit(800).alias("mev_commission_bps"),
        (_cents(F.col("value")) * F.lit(1000000)).alias("mev_rewards"),
    ))
    p = events.where(F.col("event_type") == F.lit("purchase")).select(
        "user_id", F.floor(F.col("event_id") / F.lit(BODY_SPAN)).alias("span"), el.alias("el"))
    return p.groupBy("user_id", "span").agg(
        F.concat(F.lit("["), F.concat_ws(",", F.sort_array(F.collect_list("el"))), F.lit("]")).alias("body"))


def transactions(lineitem: DataFrame) -> DataFrame:
    """Block transactions: block_number = line number, block_date = ship date."""
    return lineitem.select(F.col("l_linenumber").cast("bigint").alias("block_number"),
                           F.col("l_shipdate").cast("date").alias("block_date"))


def load_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "events").select(*EVENT_COLS)


def load_sources(spark: SparkSession, sf_dir: str) -> Sources:
    return sources_from(spark, load_events(spark, sf_dir), read_table(spark, sf_dir, "lineitem"))


def sources_from(spark: SparkSession, events: DataFrame, lineitem: DataFrame) -> Sources:
    """Build every source relation from (possibly time-cut) events and lineitem."""
    mapping = mapping_df(spark)
    return Sources(
        activity=account_activity(events),
        prices=prices_day(events),
        mapping=mapping.select("address", "fee_type", "fee_source", "token"),
        mapping_rows=mapping_size(),
        rewards=rewards(events),
        responses=mev_responses(events),
        transactions=transactions(lineitem),
    )
