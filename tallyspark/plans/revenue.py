"""Revenue models: product fees (M1), staking (M3-M5), unified (M6), rollups.

``since`` is the incremental lower bound (a timestamp or Column); ``None``
means a full build. Plans are shaped for large fact tables:

* the activity scan gets its time and success filters pushed into parquet;
* the 24-row mapping is broadcast, so the fact table is never shuffled;
* fees are summed per (day, product, token) *before* the price join: the
  price is a function of (day, token), so the groups are the same, and the
  join then runs on two small aggregates instead of raw facts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyspark.functions.json import parse_json_rows
from tallyspark.functions.numeric import to_tokens
from tallyspark.functions.time import day_start, time_bound, ts_lit
from tallyspark.operators.joins import broadcast_dim_join, price_token
from tallyspark.operators.rollup import rollup_by_period
from tallyspark.params import Params

# Chain and symbols priced for product fees; rfq fee share.
CHAIN = "solana"
PRODUCT_SYMBOLS = ("SOL", "WETH")
STAKING_SYMBOL = "SOL"
RFQ_FEE_NUM, RFQ_FEE_DEN = 2.0, 98.0
NATIVE_REWARD_TYPES = ("Fee", "Rent", "Voting")
SOL_TOKENS = ("sol", "wsol")
BPS = 10000
# Fields of one validator API record and their SQL types.
JITO_FIELDS = {
    "epoch": "int",
    "mev_commission_bps": "double",
    "mev_rewards": "double",
    "priority_fee_commission_bps": "double",
    "priority_fee_rewards": "double",
}

PRODUCT_KEYS = ["date", "fee_type", "fee_source", "token"]
REVENUE_COLS = ["date", "fee_type", "fee_source", "token", "usd_price", "amount", "usd_amount"]


def _since(c: str, since) -> Column | None:
    if since is None:
        return None
    return F.col(c) >= (since if isinstance(since, Column) else ts_lit(since))


def _bounded(df: DataFrame, c: str, *lowers) -> DataFrame:
    """Apply every non-None lower time bound (with partition pruning, see ``time_bound``)."""
    for lo in lowers:
        if lo is not None:
            df = time_bound(df, c, lo)
    return df


def _where(df: DataFrame, *conds: Column | None) -> DataFrame:
    for c in conds:
        if c is not None:
            df = df.where(c)
    return df


# ---------------------------------------------------------------- M1

def product_prices(prices: DataFrame, p: Params, since=None) -> DataFrame:
    """A1: average price per (day, lower(symbol)) for SOL and WETH on the chain."""
    f = _bounded(prices, "timestamp", p.start_date, since).where(
        (F.col("blockchain") == F.lit(CHAIN)) & F.col("symbol").isin(*PRODUCT_SYMBOLS))
    return (f.groupBy(F.col("timestamp").alias("date"), F.lower("symbol").alias("token"))
            .agg(F.avg("price").alias("price")))


def fee_amount() -> Column:
    """Fee amount in tokens; arm order matters."""
    rfq = (F.col("fee_type") == F.lit("instant_unstake")) & (F.col("fee_source") == F.lit("rfq"))
    return (F.when(rfq & (F.col("balance_change") < 0),
                   to_tokens(F.abs(F.col("balance_change"))) * F.lit(RFQ_FEE_NUM) / F.lit(RFQ_FEE_DEN))
            .when(rfq, F.lit(0.0))
            .when(F.col("token") == F.lit("sol"), to_tokens(F.col("balance_change")))
            .otherwise(F.col("token_balance_change")))


def fee_sign_filter() -> Column:
    """Incoming token, incoming SOL, or outgoing rfq unstake."""
    rfq = (F.col("fee_type") == F.lit("instant_unstake")) & (F.col("fee_source") == F.lit("rfq"))
    return (((F.col("token") != F.lit("sol")) & (F.col("token_balance_change") > 0))
            | ((F.col("token") == F.lit("sol")) & (F.col("balance_change") > 0))
            | (rfq & (F.col("balance_change") < 0)))


def mapped_activity(activity: DataFrame, mapping: DataFrame, p: Params, since=None,
                    mapping_rows: int | None = None) -> DataFrame:
    """S2+J1+P6+P9: successful activity at mapped addresses since the start date.

    ``mapping_rows`` is the caller's bound on the mapping size; with it the
    mapping is broadcast and the fact side streams through without a shuffle.
    Without it Spark decides from the mapping's estimated size.
    """
    a = _bounded(activity, "block_time", p.start_date, since).where(F.col("tx_success"))
    return broadcast_dim_join(a, mapping.select("address", "fee_type", "fee_source", "token"),
                              "address", known_rows=mapping_rows)


def fees_raw(activity: DataFrame, mapping: DataFrame, p: Params, since=None,
             mapping_rows: int | None = None) -> DataFrame:
    """fees_raw: per-activity fee amounts after the weth cut-off and sign rules."""
    j = mapped_activity(activity, mapping, p, since, mapping_rows)
    j = j.where(~((F.col("token") == F.lit("weth")) & (F.col("block_time") >= ts_lit(p.weth_cutoff))))
    j = j.where(fee_sign_filter())
    return j.select(day_start("block_time").alias("date"), "fee_type", "fee_source", "token",
                    fee_amount().alias("raw_amount"))


def product_revenue(activity: DataFrame, prices: DataFrame, mapping: DataFrame, p: Params,
                    since=None, mapping_rows: int | None = None) -> DataFrame:
    """M1: daily fee revenue per (fee_type, fee_source, token) in tokens and USD."""
    fees = (fees_raw(activity, mapping, p, since, mapping_rows)
            .groupBy(*PRODUCT_KEYS).agg(F.sum("raw_amount").alias("amount")))
    px = product_prices(prices, p, since).select("date", F.col("token").alias("_ptoken"), "price")
    j = fees.join(px, (fees["date"] == px["date"]) & (price_token(fees["token"]) == px["_ptoken"]), "left")
    return j.select(
        fees["date"], "fee_type", "fee_source", "token",
        F.col("price").alias("usd_price"),
        F.col("amount"),
        F.when(F.col("token") == F.lit("usdc"), F.col("amount"))
         .otherwise(F.col("amount") * F.col("price")).alias("usd_amount"),
    )


# ---------------------------------------------------------------- M3-M5

def staking_native(rewards: DataFrame, p: Params, since=None) -> DataFrame:
    """M3: daily native rewards (Fee, Rent, Voting) of the validator keys, in SOL."""
    f = _bounded(rewards, "block_time", p.start_date, since).where(
        F.col("recipient").isin(*p.recipients) & F.col("reward_type").isin(*NATIVE_REWARD_TYPES))
    return (f.groupBy(day_start("block_time").alias("date"))
            .agg(to_tokens(F.sum("lamports")).alias("amount_sol")))


def jito_api_rows(responses: DataFrame, body_col: str = "body") -> DataFrame:
    """One typed row per element of the landed API arrays."""
    return parse_json_rows(responses, body_col, JITO_FIELDS)


def staking_jito(responses: DataFrame, epochs: DataFrame) -> DataFrame:
    """M4 (view): MEV commission per day, epochs placed on days by epoch_info."""
    api = jito_api_rows(responses)
    j = api.join(epochs.select("epoch", "date"), "epoch")
    return j.groupBy("date").agg(
        F.sum(to_tokens(F.col("mev_rewards") * F.col("mev_commission_bps") / F.lit(BPS))).alias("amount_sol"))


def sol_prices(prices: DataFrame, since=None) -> DataFrame:
    """A1: average SOL price per day on the chain (no start-date bound)."""
    f = _bounded(prices, "timestamp", since).where(
        (F.col("blockchain") == F.lit(CHAIN)) & (F.col("symbol") == F.lit(STAKING_SYMBOL)))
    return f.groupBy(F.col("timestamp").alias("date")).agg(F.avg("price").alias("price"))


def staking_revenue(native: DataFrame, jito: DataFrame, prices: DataFrame, since=None,
                    since_jito="same") -> DataFrame:
    """M5: native and MEV staking revenue tagged by source, priced per day.

    By default one cutoff bounds both branches (as the SQL project does, so a
    branch lagging by more than the lookback is skipped for good). Passing
    ``since_jito`` gives the MEV branch its own bound; prices then start at
    the earlier of the two.
    """
    sj = since if isinstance(since_jito, str) and since_jito == "same" else since_jito
    raw = (_where(native, _since("date", since)).select("date", F.lit("native").alias("fee_source"), "amount_sol")
           .unionByName(_where(jito, _since("date", sj))
                        .select("date", F.lit("jito").alias("fee_source"), "amount_sol")))
    if since is None or sj is None:
        price_since = None
    elif isinstance(since, Column) or isinstance(sj, Column):
        as_col = [x if isinstance(x, Column) else ts_lit(x) for x in (since, sj)]
        price_since = F.least(*as_col)
    else:
        price_since = min(since, sj)
    j = raw.join(sol_prices(prices, price_since), "date", "left")
    return j.select("date", F.lit("staking").alias("fee_type"), "fee_source", F.lit("sol").alias("token"),
                    F.col("price").alias("usd_price"), F.col("amount_sol").alias("amount"),
                    (F.col("amount_sol") * F.col("price")).alias("usd_amount"))


# ---------------------------------------------------------------- M6-M10

def revenue_union(product: DataFrame, staking: DataFrame, since=None) -> DataFrame:
    """Product and staking revenue rows in one relation."""
    cols = ["date", "fee_type", "token", "usd_price", "amount", "usd_amount"]
    return (_where(product, _since("date", since)).select(*cols)
            .unionByName(_where(staking, _since("date", since)).select(*cols)))


def unified_revenue(product: DataFrame, staking: DataFrame, since=None) -> DataFrame:
    """M6: per (day, type): SOL and USDC amounts, SOL price and USD totals."""
    base = revenue_union(product, staking, since)
    sol = F.col("token").isin(*SOL_TOKENS)
    agg = base.groupBy("date", "fee_type").agg(
        F.sum(F.when(sol, F.col("amount")).otherwise(F.lit(0.0))).alias("sol_amount"),
        F.max(F.when(sol, F.col("usd_price"))).alias("sol_price_usd"),
        F.sum(F.when(sol, F.col("usd_amount")).otherwise(F.lit(0.0))).alias("sol_amount_usd"),
        F.sum(F.when(F.col("token") == F.lit("usdc"), F.col("amount")).otherwise(F.lit(0.0))).alias("usdc_amount"),
        F.sum("usd_amount").alias("total_usd_amount"),
    )
    return agg.select("date", F.col("fee_type").alias("type"), "sol_amount", "sol_price_usd",
                      "sol_amount_usd", "usdc_amount", "total_usd_amount")


ROLLUP_SUMS = {"sol_amount": "sol_amount", "sol_usd_amount": "sol_amount_usd",
               "usdc_amount": "usdc_amount", "total_usd_amount": "total_usd_amount"}


def revenue_by_period(unified: DataFrame, period: str, since=None) -> DataFrame:
    """Unified revenue summed per day / week / month / quarter."""
    s = None if since is None else (since if isinstance(since, Column) else ts_lit(since))
    return rollup_by_period(unified, "date", period, ROLLUP_SUMS, since=s)
