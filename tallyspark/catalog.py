"""Registered queries: one callable per operator id of the blueprint.

Each callable takes ``(spark, sf_dir)``, reads the driver tables under
``sf_dir`` through the adapters in :mod:`tallyspark.sources.fixtures` and
returns a DataFrame over the whole tables. Doubles are rounded half-up at 4
decimals for result comparison (``round_doubles``); the SQL oracle does the
same. Queries that exercise stored-table writes write into fresh directories
under the shared checkpoint folder and return the table read back.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspark.functions.json import json_elements, json_scalar
from tallyspark.functions.keys import surrogate_key
from tallyspark.functions.numeric import round_doubles, to_tokens
from tallyspark.functions.time import day_start, minus_days, period_start, ts_lit
from tallyspark.operators import checks, upsert
from tallyspark.operators.joins import dim_left_join, price_token, time_bounded_join
from tallyspark.operators.rollup import rollup_by_period
from tallyspark.params import TEST_PARAMS as P
from tallyspark.plans import blocks, epochs, pipeline, revenue
from tallyspark.session import apply_conf, scratch_dir
from tallyspark.sinks import tables
from tallyspark.sources.fixtures import (Sources, load_events, load_sources, read_table, slot_address,
                                         sources_from)
from tallyspark.streaming.microbatch import stream_upsert, land_event_files

# Scenario constants (shared with the SQL oracle).
SPLIT = "2024-01-20 15:00:00"          # first run sees events before this instant
LOOKBACK_FROM = "2024-01-17 00:00:00"  # cutoff of the second run: max(day) - 3 days
NARROW_PRED = "2024-01-19 00:00:00"    # target predicate narrower than the batch
EPOCH_SPLIT = "2024-01-15 10:00:00"
LATE_DAY = "2024-01-05"
AS_OF = "2001-10-01 12:00:00"
RUN1_AS_OF = "2001-09-30 00:00:00"
RUN2_AS_OF = "2001-10-01 00:00:00"
JOIN_SINCE = "1998-01-01 00:00:00"

Query = Callable[[SparkSession, str], DataFrame]
_REGISTRY: dict[str, Query] = {}


def register(name: str):
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            apply_conf(spark)
            return round_doubles(fn(spark, sf_dir))
        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        _REGISTRY[name] = run
        return fn
    return deco


def queries() -> dict[str, Query]:
    return dict(_REGISTRY)


# ---------------------------------------------------------------- shared builders

def _src(spark, sf_dir) -> Sources:
    return load_sources(spark, sf_dir)


def _product(s: Sources, since=None) -> DataFrame:
    return revenue.product_revenue(s.activity, s.prices, s.mapping, P, since, s.mapping_rows)


def _chain(s: Sources) -> dict[str, DataFrame]:
    prod = _product(s)
    ep = epochs.epoch_info(s.rewards, P)
    nat = revenue.staking_native(s.rewards, P)
    jito = revenue.staking_jito(s.responses, ep)
    st = revenue.staking_revenue(nat, jito, s.prices)
    un = revenue.unified_revenue(prod, st)
    return {"product": prod, "epochs": ep, "native": nat, "jito": jito, "staking": st, "unified": un}


def _first_run_sources(spark, sf_dir, cond) -> Sources:
    return sources_from(spark, load_events(spark, sf_dir).where(cond), read_table(spark, sf_dir, "lineitem"))


def _raw_activity(spark, sf_dir) -> DataFrame:
    """Activity whose address stays NULL for unmapped users (for NULL-key cases)."""
    return load_events(spark, sf_dir).select(F.col("ts").alias("block_time"),
                                             slot_address(F.col("user_id")).alias("address"),
                                             "event_type", "value")


def _daily_events(ev: DataFrame) -> DataFrame:
    return ev.groupBy(day_start("ts").alias("day"), "event_type").agg(
        F.count(F.lit(1)).alias("n_events"), F.sum("value").alias("value_sum"))


def _events_target_batch(spark, sf_dir):
    ev = load_events(spark, sf_dir)
    target = _daily_events(ev.where(F.col("ts") < ts_lit(SPLIT)))
    batch = _daily_events(ev.where(F.col("ts") >= ts_lit(LOOKBACK_FROM)))
    return target, batch


def _stored_daily_target(spark, sf_dir, name):
    target, batch = _events_target_batch(spark, sf_dir)
    path = scratch_dir(spark, name)
    tables.write_table(target, path, partition_by=["day"])
    return path, batch


EVENT_KEYS = ["day", "event_type"]


# ---------------------------------------------------------------- 2.1 sources

@register("S1")
def s1(spark, d):
    """Reward facts."""
    return _src(spark, d).rewards


@register("S2")
def s2(spark, d):
    """Account activity, time and success filters pushed to the scan."""
    a = _src(spark, d).activity
    return a.where((F.col("block_time") >= ts_lit(P.start_date)) & F.col("tx_success"))


@register("S3")
def s3(spark, d):
    return _src(spark, d).transactions


@register("S4")
def s4(spark, d):
    return _src(spark, d).prices


@register("S5")
def s5(spark, d):
    """The inline mapping with the number of activity rows per address."""
    s = _src(spark, d)
    n = s.activity.groupBy("address").agg(F.count(F.lit(1)).alias("n_rows"))
    return (F.broadcast(s.mapping).join(n, "address", "left")
            .select("address", "fee_type", "fee_source", "token",
                    F.coalesce(F.col("n_rows"), F.lit(0)).cast("bigint").alias("n_rows")))


@register("S6")
def s6(spark, d):
    """JSON array bodies -> one typed row per element."""
    return revenue.jito_api_rows(_src(spark, d).responses)


@register("S7")
def s7(spark, d):
    """Watermark of a stored target: max(date) and the lookback cutoff."""
    path = scratch_dir(spark, "s7")
    tables.write_table(_product(_src(spark, d)), path)
    t = tables.read_stored(spark, path)
    return t.agg(F.max("date").alias("max_date"),
                 minus_days(F.max("date"), P.lookback_days).alias("cutoff"))


@register("S8")
def s8(spark, d):
    """An upstream model read back from its stored table."""
    path = scratch_dir(spark, "s8")
    tables.write_table(epochs.epoch_info(_src(spark, d).rewards, P), path)
    return tables.read_stored(spark, path).select("epoch", "date")


# ---------------------------------------------------------------- 2.2 sinks

def _tx_counts(s: Sources) -> DataFrame:
    return s.transactions.groupBy(*blocks.BLOCK_KEYS).agg(F.count(F.lit(1)).alias("total_tx_per_block"))


@register("K1")
def k1(spark, d):
    path = scratch_dir(spark, "k1")
    tables.write_table(_tx_counts(_src(spark, d)), path)
    tables.write_table(_tx_counts(_src(spark, d)), path)  # rebuild over an existing table
    return tables.read_stored(spark, path)


@register("K2")
def k2(spark, d):
    view = f"tx_per_block_view_{abs(hash(d)) % 10**8}"
    blocks.tx_per_block(_src(spark, d).transactions, AS_OF, 1).createOrReplaceTempView(view)
    return spark.sql(f"SELECT block_number, block_date, total_tx_per_block FROM {view}")


@register("K3")
def k3(spark, d):
    path, batch = _stored_daily_target(spark, d, "k3")
    tables.write_merge(spark, path, batch, EVENT_KEYS, partition_by=["day"])
    return tables.read_stored(spark, path, batch.schema)


@register("K4")
def k4(spark, d):
    path, batch = _stored_daily_target(spark, d, "k4")
    tables.write_delete_insert(spark, path, batch, EVENT_KEYS, partition_by=["day"])
    return tables.read_stored(spark, path, batch.schema)


def _by_slot(events: DataFrame) -> DataFrame:
    return events.groupBy(F.date_trunc("day", "ts").alias("day"), "event_type", (F.col("user_id") % 50).alias("slot")) \
        .agg(F.max("event_id").alias("last_event")) \
        .withColumn("kind", F.when(F.col("event_type") != "view", F.col("event_type")))


@register("K3_null")
def k3_null(spark, d):
    """Two partition columns, one of them NULL and not part of the key."""
    ev, path = load_events(spark, d), scratch_dir(spark, "k3-null")
    tables.write_table(_by_slot(ev.where(F.col("ts") < ts_lit(SPLIT))), path, partition_by=["day", "kind"])
    batch = _by_slot(ev.where(F.col("ts") >= ts_lit(LOOKBACK_FROM)))
    tables.write_merge(spark, path, batch, ["day", "event_type", "slot"], partition_by=["day", "kind"])
    return tables.read_stored(spark, path, batch.schema)


@register("K3_carry")
def k3_carry(spark, d):
    """The batch lacks a column of the table: kept rows keep it, new rows have NULL."""
    target, batch = _events_target_batch(spark, d)
    path, target = scratch_dir(spark, "k3-carry"), target.withColumn("note", F.lit("first run"))
    tables.write_table(target, path, partition_by=["day"])
    tables.write_merge(spark, path, batch, EVENT_KEYS, partition_by=["day"])
    return tables.read_stored(spark, path, target.schema)


@register("K4_dup")
def k4_dup(spark, d):
    """Repeated batch keys: delete+insert keeps them all."""
    path, batch = _stored_daily_target(spark, d, "k4-dup")
    tables.write_delete_insert(spark, path, batch.unionByName(batch), EVENT_KEYS, partition_by=["day"])
    return tables.read_stored(spark, path, batch.schema)


def _monthly_run(spark, d, name, write):
    """A first run and an incremental one on a month-partitioned table whose key has no month."""
    tx, path = _src(spark, d).transactions, scratch_dir(spark, name)
    month = F.date_trunc("month", "block_date").cast("date")
    one, two = (blocks.tx_per_block(tx, at, n).withColumn("block_month", month)
                for at, n in ((RUN1_AS_OF, blocks.FIRST_RUN_DAYS), (RUN2_AS_OF, blocks.INCREMENTAL_DAYS)))
    tables.write_table(one.where(F.col("block_date") <= ts_lit(RUN1_AS_OF)), path, partition_by=["block_month"])
    pred = F.col("block_date") >= blocks.since_days_before(RUN2_AS_OF, blocks.INCREMENTAL_DAYS)
    write(spark, path, two, blocks.BLOCK_KEYS, ["block_month"], pred)
    return tables.read_stored(spark, path, two.schema)


@register("K3_month")
def k3_month(spark, d):
    return _monthly_run(spark, d, "k3-month", tables.write_merge)


@register("K5_month")
def k5_month(spark, d):
    return _monthly_run(spark, d, "k5-month", tables.write_append_new)


@register("K5")
def k5(spark, d):
    path, batch = _stored_daily_target(spark, d, "k5")
    tables.write_append_new(spark, path, batch, EVENT_KEYS, partition_by=["day"])
    return tables.read_stored(spark, path, batch.schema)


@register("K6")
def k6(spark, d):
    path, batch = _stored_daily_target(spark, d, "k6")
    tables.write_merge(spark, path, batch, EVENT_KEYS, partition_by=["day"],
                       target_pred=F.col("day") >= ts_lit(NARROW_PRED))
    return tables.read_stored(spark, path, batch.schema)


def _tx_monthly(s: Sources) -> DataFrame:
    return _tx_counts(s).withColumn("block_month", F.date_trunc("month", "block_date").cast("date"))


@register("K7")
def k7(spark, d):
    df = _tx_monthly(_src(spark, d))
    path = scratch_dir(spark, "k7")
    tables.write_table(df, path, partition_by=["block_month"])
    return tables.read_stored(spark, path, df.schema)


@register("K8")
def k8(spark, d):
    """Full refresh over an existing, stale target rebuilds from scratch."""
    wh = pipeline.Warehouse(scratch_dir(spark, "k8"))
    first = _first_run_sources(spark, d, F.col("ts") < ts_lit(SPLIT))
    pipeline.run_product_revenue(spark, first, wh, P)
    return pipeline.run_product_revenue(spark, _src(spark, d), wh, P, full_refresh=True)


@register("K9")
def k9(spark, d):
    path = scratch_dir(spark, "k9")
    tables.write_table(epochs.epoch_info(_src(spark, d).rewards, P), path, sort_within=["epoch_end_time"])
    return tables.read_stored(spark, path)


@register("K10")
def k10(spark, d):
    df = _tx_monthly(_src(spark, d))
    path = scratch_dir(spark, "k10")
    df.repartition(4).write.partitionBy("block_month").parquet(path)   # fragmented by a plain writer
    tables.compact(spark, path, partition_by=["block_month"], schema=df.schema)
    return tables.read_stored(spark, path, df.schema)


# ---------------------------------------------------------------- 2.3 projections / filters

@register("P1")
def p1(spark, d):
    return _src(spark, d).prices.select(F.col("timestamp").alias("date"), F.lower("symbol").alias("token"), "price")


@register("P2")
def p2(spark, d):
    nat = revenue.staking_native(_src(spark, d).rewards, P)
    return nat.select("date", F.lit("staking").alias("fee_type"), F.lit("native").alias("fee_source"),
                      F.lit("sol").alias("token"), "amount_sol")


@register("P3")
def p3(spark, d):
    s = _src(spark, d)
    return revenue.fees_raw(s.activity, s.mapping, P, mapping_rows=s.mapping_rows)


@register("P4")
def p4(spark, d):
    return _product(_src(spark, d)).select("date", "fee_type", "fee_source", "token", "usd_amount")


@register("P5")
def p5(spark, d):
    r = _src(spark, d).rewards
    return r.where(F.col("recipient").isin(*P.recipients) & F.col("reward_type").isin(*revenue.NATIVE_REWARD_TYPES))


@register("P6")
def p6(spark, d):
    return _src(spark, d).activity.where(F.col("block_time") >= ts_lit(P.start_date))


def _mapped(s: Sources) -> DataFrame:
    return revenue.mapped_activity(s.activity, s.mapping, P, mapping_rows=s.mapping_rows)


@register("P7")
def p7(spark, d):
    j = _mapped(_src(spark, d))
    return (j.where(~((F.col("token") == "weth") & (F.col("block_time") >= ts_lit(P.weth_cutoff))))
            .select("block_time", "address", "token", "balance_change"))


@register("P8")
def p8(spark, d):
    return _mapped(_src(spark, d)).where(revenue.fee_sign_filter()) \
        .select("block_time", "address", "fee_type", "fee_source", "token", "balance_change",
                "token_balance_change")


@register("P9")
def p9(spark, d):
    return _src(spark, d).activity.where(F.col("tx_success"))


@register("P10")
def p10(spark, d):
    return blocks.rolling_window(_src(spark, d).transactions, AS_OF, 1)


@register("P11")
def p11(spark, d):
    return _raw_activity(spark, d).dropna(subset=["address"])


@register("P12")
def p12(spark, d):
    return _src(spark, d).prices.where((F.col("blockchain") == "solana")
                                       & (F.col("timestamp") >= ts_lit(P.start_date)))


# ---------------------------------------------------------------- 2.4 joins

@register("J1")
def j1(spark, d):
    return _mapped(_src(spark, d)).select("block_time", "address", "fee_type", "fee_source", "token",
                                          "balance_change", "token_balance_change")


@register("J2")
def j2(spark, d):
    s = _src(spark, d)
    f = revenue.fees_raw(s.activity, s.mapping, P, mapping_rows=s.mapping_rows)
    px = revenue.product_prices(s.prices, P).select(F.col("date").alias("_pdate"), F.col("token").alias("_ptoken"),
                                                    "price")
    j = f.join(px, (f["date"] == px["_pdate"]) & (price_token(f["token"]) == px["_ptoken"]), "left")
    return j.select("date", "fee_type", "fee_source", "token", "raw_amount", F.col("price").alias("usd_price"))


@register("J3")
def j3(spark, d):
    s = _src(spark, d)
    return revenue.staking_native(s.rewards, P).join(revenue.sol_prices(s.prices), "date", "left")


@register("J4")
def j4(spark, d):
    s = _src(spark, d)
    api = revenue.jito_api_rows(s.responses)
    return api.join(epochs.epoch_info(s.rewards, P).select("epoch", "date"), "epoch") \
        .select("epoch", "date", "mev_rewards", "mev_commission_bps")


@register("J5")
def j5(spark, d):
    target, batch = _events_target_batch(spark, d)
    return upsert.new_rows(target, batch, EVENT_KEYS, F.col("day") >= ts_lit(LOOKBACK_FROM))


@register("J6")
def j6(spark, d):
    """Uncorrelated scalar subquery as the lower bound."""
    prod = _product(_src(spark, d))
    bound = prod.agg(minus_days(F.max("date"), P.lookback_days)).scalar()
    return prod.where(F.col("date") >= bound)


def _event_users(spark, d):
    """Staged dimension: the users of the events (most customers are none)."""
    return load_events(spark, d).groupBy("user_id").agg(F.min("event_type").alias("first_type"),
                                                        F.max("event_type").alias("last_type"))


@register("J7")
def j7(spark, d):
    c = read_table(spark, d, "customer").select("c_custkey", "c_name", "c_mktsegment")
    return dim_left_join(c, _event_users(spark, d).withColumnRenamed("user_id", "c_custkey"), "c_custkey")


@register("J8")
def j8(spark, d):
    li = read_table(spark, d, "lineitem")
    o = read_table(spark, d, "orders")
    j = time_bounded_join(li, o, "l_orderkey", "o_orderkey", "l_shipdate", "o_orderdate", ts_lit(JOIN_SINCE))
    return j.groupBy(period_start("month", "l_shipdate").alias("ship_month")).agg(
        F.count(F.lit(1)).alias("n_lines"),
        F.sum(F.col("l_extendedprice") * (F.lit(1) - F.col("l_discount"))).alias("revenue"))


def _null_key_target_batch(spark, d):
    a = _raw_activity(spark, d)

    def agg(x):
        return x.groupBy(day_start("block_time").alias("day"), "address").agg(F.count(F.lit(1)).alias("n_rows"))

    return agg(a.where(F.col("block_time") < ts_lit(SPLIT))), agg(a.where(F.col("block_time") >= ts_lit(LOOKBACK_FROM)))


@register("J9")
def j9(spark, d):
    """Merge where part of the key is NULL: such rows never match and are inserted again."""
    target, batch = _null_key_target_batch(spark, d)
    return upsert.merge(target, batch, ["day", "address"])


# ---------------------------------------------------------------- 2.5 aggregations

@register("A1")
def a1(spark, d):
    return revenue.product_prices(_src(spark, d).prices, P)


@register("A2")
def a2(spark, d):
    return _product(_src(spark, d)).select("date", "fee_type", "fee_source", "token", "usd_price", "amount")


@register("A3")
def a3(spark, d):
    r = _src(spark, d).rewards.where(F.col("reward_type").isin(*revenue.NATIVE_REWARD_TYPES))
    return r.groupBy(day_start("block_time").alias("date")).agg(to_tokens(F.sum("lamports")).alias("amount_sol"))


@register("A4")
def a4(spark, d):
    return _chain(_src(spark, d))["jito"]


@register("A5")
def a5(spark, d):
    return _chain(_src(spark, d))["unified"].select("date", "type", "sol_amount", "usdc_amount")


@register("A6")
def a6(spark, d):
    return _chain(_src(spark, d))["unified"].select("date", "type", "sol_price_usd")


@register("A7")
def a7(spark, d):
    return _chain(_src(spark, d))["unified"].select("date", "type", "total_usd_amount")


@register("A8")
def a8(spark, d):
    return epochs.voting_times(_src(spark, d).rewards)


@register("A9")
def a9(spark, d):
    return _tx_counts(_src(spark, d))


def _lineitem_by(period):
    def q(spark, d):
        li = read_table(spark, d, "lineitem").withColumn(
            "rev", F.col("l_extendedprice") * (F.lit(1) - F.col("l_discount")))
        return rollup_by_period(li, "l_shipdate", period, {"quantity": "l_quantity", "revenue": "rev"},
                                out_col="period_start")
    return q


for _p in ("week", "month", "quarter"):
    register(f"A10_{_p}")(_lineitem_by(_p))


@register("A11")
def a11(spark, d):
    ep = epochs.epoch_info(_src(spark, d).rewards, P)
    return ep.agg(F.max("epoch").alias("max_epoch"), F.max("epoch_end_time").alias("max_epoch_end_time"),
                  F.max("date").alias("max_date"),
                  F.coalesce(F.max("epoch"), F.lit(0).cast("bigint")).alias("last_epoch"))


# ---------------------------------------------------------------- 2.6-2.8

@register("W1")
def w1(spark, d):
    return epochs.epoch_info(_src(spark, d).rewards, P)


@register("O2")
def o2(spark, d):
    daily = revenue.revenue_by_period(_chain(_src(spark, d))["unified"], "day")
    return daily.orderBy(F.col("total_usd_amount").desc_nulls_last(), F.col("aggregated_date")).limit(10)


@register("U1")
def u1(spark, d):
    c = _chain(_src(spark, d))
    return revenue.revenue_union(c["product"], c["staking"])


@register("U2")
def u2(spark, d):
    c = _chain(_src(spark, d))
    return (c["native"].select("date", F.lit("native").alias("fee_source"), "amount_sol")
            .unionByName(c["jito"].select("date", F.lit("jito").alias("fee_source"), "amount_sol")))


# ---------------------------------------------------------------- 2.9 scalar functions

@register("F1")
def f1(spark, d):
    return load_events(spark, d).select("event_id", day_start("ts").alias("day"))


@register("F2")
def f2(spark, d):
    li = read_table(spark, d, "lineitem")
    return li.select("l_orderkey", "l_linenumber", *[period_start(p, "l_shipdate").alias(p) for p in
                                                     ("week", "month", "quarter")])


@register("F3")
def f3(spark, d):
    return load_events(spark, d).select("event_id", minus_days(F.col("ts"), P.lookback_days).alias("ts_minus"))


@register("F4")
def f4(spark, d):
    """``now()``: the rolling window at the wall clock (as_of=None), over days relative to today."""
    tx = _src(spark, d).transactions.withColumn(
        "block_date", F.date_sub(F.current_date(), (F.col("block_number") % 4).cast("int")))
    return blocks.tx_per_block(tx, None, 1)


@register("F5")
def f5(spark, d):
    ev = load_events(spark, d)
    return ev.select("event_id",
                     (F.col("ts") >= ts_lit(P.weth_cutoff)).alias("after_cutoff"),
                     (F.col("ts") - F.expr("INTERVAL 1 DAY")).alias("day_before"),
                     (F.col("ts").cast("date") >= F.lit("2024-01-15").cast("date")).alias("after_date"))


@register("F6")
def f6(spark, d):
    return _src(spark, d).prices.select("timestamp", F.lower("symbol").alias("token"), "price")


@register("F7")
def f7(spark, d):
    a = _src(spark, d).activity
    return a.select("block_time", "address", to_tokens(F.abs(F.col("balance_change"))).alias("abs_tokens"))


@register("F8")
def f8(spark, d):
    r = _src(spark, d).responses
    return r.select("user_id", "span", F.size(json_elements(F.col("body"))).alias("n_elements"))


@register("F9")
def f9(spark, d):
    ev = load_events(spark, d)
    return ev.select("event_id", json_scalar(F.col("props"), "k").alias("k"),
                     json_scalar(F.concat(F.lit('{"o":'), F.col("props"), F.lit("}")), "o").alias("nested"))


@register("F10")
def f10(spark, d):
    ev = load_events(spark, d)
    return ev.select("event_id", json_scalar(F.col("props"), "k").cast("int").alias("k"),
                     F.col("value").cast("string").cast("double").alias("value"))


@register("F11")
def f11(spark, d):
    r = _src(spark, d).responses
    el = r.select("user_id", F.explode(json_elements(F.col("body"))).alias("el"))
    return el.groupBy("user_id").agg(F.count(F.lit(1)).alias("n_elements"))


@register("F12")
def f12(spark, d):
    a = _raw_activity(spark, d)
    return a.groupBy(F.coalesce(F.col("address"), F.lit("unmapped")).alias("address")) \
        .agg(F.count(F.lit(1)).alias("n_rows"))


@register("F13")
def f13(spark, d):
    li = read_table(spark, d, "lineitem")
    return li.select("l_orderkey", "l_linenumber", surrogate_key("l_orderkey", "l_linenumber").alias("sk"))


# ---------------------------------------------------------------- 2.10 incremental

def _twin_product(spark, d):
    wh = pipeline.Warehouse(scratch_dir(spark, "twin"))
    first = _first_run_sources(spark, d, F.col("ts") < ts_lit(SPLIT))
    pipeline.run_product_revenue(spark, first, wh, P)
    return pipeline.run_product_revenue(spark, _src(spark, d), wh, P)


@register("T1")
def t1(spark, d):
    """Full run on the first part, incremental run with 3-day lookback on all."""
    return _twin_product(spark, d)


@register("T2")
def t2(spark, d):
    """Weekly rollup: first run on unified rows before the split, then incremental."""
    root = scratch_dir(spark, "t2")
    wh = pipeline.Warehouse(root)
    all_rows = f"{root}/unified_all"
    tables.write_table(_chain(_src(spark, d))["unified"], all_rows)   # the chain runs once
    un = tables.read_stored(spark, all_rows)
    tables.write_table(un.where(F.col("date") < ts_lit(SPLIT)), wh.path("unified_revenue"))
    pipeline.run_rollup(spark, wh, P, "week")
    tables.write_table(un, wh.path("unified_revenue"))
    return pipeline.run_rollup(spark, wh, P, "week")


def _twin_epochs(spark, d, first_cond):
    wh = pipeline.Warehouse(scratch_dir(spark, "epochs"))
    pipeline.run_epoch_info(spark, _first_run_sources(spark, d, first_cond), wh, P)
    return pipeline.run_epoch_info(spark, _src(spark, d), wh, P)


@register("T3")
def t3(spark, d):
    """Voting times of one day arrive late: they are never numbered."""
    late = day_start("ts") == ts_lit(LATE_DAY)
    return _twin_epochs(spark, d, (F.col("ts") < ts_lit(EPOCH_SPLIT)) & ~late)


@register("T4")
def t4(spark, d):
    return _twin_epochs(spark, d, F.col("ts") < ts_lit(EPOCH_SPLIT))


def _template_runs(spark, d, strategy):
    """Run 1 at RUN1_AS_OF sees rows landed by then (7-day window); run 2 at RUN2_AS_OF sees all."""
    s = _src(spark, d)
    landed = s.transactions.where(F.col("block_date") <= ts_lit(RUN1_AS_OF))
    path = scratch_dir(spark, f"tmpl-{strategy}")
    blocks.run_tx_per_block(spark, landed, path, strategy, RUN1_AS_OF)
    return blocks.run_tx_per_block(spark, s.transactions, path, strategy, RUN2_AS_OF)


@register("T5")
def t5(spark, d):
    return _template_runs(spark, d, "merge")


@register("T6")
def t6(spark, d):
    """Late Rent rows from 01-14 on land after the first run; a 7-day lookback from the
    run's clock (not from the stored dates) re-reads them."""
    wh = pipeline.Warehouse(scratch_dir(spark, "t6"))
    cond = (F.col("ts") < ts_lit("2024-01-20 00:00:00")) & ~(
        (F.col("event_type") == "signup") & (F.col("ts") >= ts_lit("2024-01-14 00:00:00")))
    pipeline.run_staking_native(spark, _first_run_sources(spark, d, cond), wh, P)
    backfill = P.with_(lookback_days=7, lookback_anchor="as_of", as_of="2024-01-21 00:00:00")
    return pipeline.run_staking_native(spark, _src(spark, d), wh, backfill)


@register("T7")
def t7(spark, d):
    """A day missing from the first run is filled by the next run's lookback."""
    wh = pipeline.Warehouse(scratch_dir(spark, "t7"))
    cond = (F.col("ts") < ts_lit("2024-01-20 00:00:00")) & (day_start("ts") != ts_lit("2024-01-18 00:00:00"))
    pipeline.run_staking_native(spark, _first_run_sources(spark, d, cond), wh, P)
    return pipeline.run_staking_native(spark, _src(spark, d), wh, P)


@register("T8")
def t8(spark, d):
    """Micro-batch upsert: landed event files stream in, each batch merges the touched days."""
    root = scratch_dir(spark, "t8")
    src_dir = land_event_files(spark, load_events(spark, d), f"{root}/landing")
    target = f"{root}/product_revenue"

    def build(events: DataFrame, since) -> DataFrame:
        b = sources_from(spark, events, read_table(spark, d, "lineitem"))
        return revenue.product_revenue(b.activity, b.prices, b.mapping, P, since, b.mapping_rows)

    stream_upsert(spark, src_dir, load_events(spark, d).schema, target, build, revenue.PRODUCT_KEYS,
                  f"{root}/_checkpoint", time_col="ts", max_files_per_trigger=10)
    return tables.read_stored(spark, target)


# ---------------------------------------------------------------- 2.11 checks

@register("Q1")
def q1(spark, d):
    return checks.check_unique_combination(read_table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"])


@register("Q2")
def q2(spark, d):
    return checks.check_not_null(j7(spark, d), "last_type").select("c_custkey", "c_name")


@register("Q3")
def q3(spark, d):
    return checks.check_unique(read_table(spark, d, "orders"), "o_custkey")


@register("Q4")
def q4(spark, d):
    return checks.check_accepted_values(load_events(spark, d), "event_type", ["view", "click", "purchase", "signup"])


@register("Q5")
def q5(spark, d):
    c = read_table(spark, d, "customer").select("c_custkey", "c_name")
    return checks.check_relationship(c, "c_custkey", _event_users(spark, d), "user_id")


@register("Q6")
def q6(spark, d):
    un = _chain(_src(spark, d))["unified"]
    li = read_table(spark, d, "lineitem")
    c = read_table(spark, d, "customer")
    key = ("l_orderkey", "l_linenumber")
    return checks.check_tables([
        checks.TableChecks("unified_revenue", un, {
            "unique_combination_date_type": checks.Unique(("date", "type")),
            "not_null_date": checks.NotNull("date"), "not_null_type": checks.NotNull("type")}),
        checks.TableChecks("lineitem", li, {"unique_combination_orderkey_linenumber": checks.Unique(key)}),
        checks.TableChecks("customer", c, {
            "relationships_custkey": checks.Related("c_custkey", _event_users(spark, d), "user_id")}),
    ])


@register("Q6_wide")
def q6_wide(spark, d):
    """Six checks of every kind on one table, which is read once."""
    return checks.check_tables([checks.TableChecks("lineitem", read_table(spark, d, "lineitem"), {
        "unique_combination_orderkey_linenumber": checks.Unique(("l_orderkey", "l_linenumber")),
        "unique_partkey": checks.Unique(("l_partkey",), ignore_null=True),
        "not_null_shipdate": checks.NotNull("l_shipdate"),
        "accepted_values_returnflag": checks.Accepted("l_returnflag", ("A", "N")),
        "accepted_values_linestatus": checks.Accepted("l_linestatus", ("O", "F")),
        "relationships_suppkey": checks.Related(
            "l_suppkey", read_table(spark, d, "supplier").where(F.col("s_suppkey") % 2 == 0), "s_suppkey"),
    })])


@register("Q7")
def q7(spark, d):
    return checks.rebuild_equals_incremental("product_revenue", _product(_src(spark, d)), _twin_product(spark, d))


@register("Q7_multi")
def q7_multi(spark, d):
    """Groups of many rows: one side has the values of clicks rounded, lacks some rows and has others twice."""
    ev = load_events(spark, d).select(day_start("ts").alias("day"), "event_type", "value", "event_id")
    other = ev.where(F.col("event_id") % 97 != 0).unionByName(ev.where(F.col("event_id") % 89 == 0)) \
        .withColumn("value", F.when(F.col("event_type") == "click", F.floor("value").cast("double")).otherwise(F.col("value")))
    return checks.rebuild_equals_incremental("events_by_day", ev.drop("event_id"), other.drop("event_id"))


# ---------------------------------------------------------------- 2.12 whole models

@register("M1")
def m1(spark, d):
    return _product(_src(spark, d))


@register("M2")
def m2(spark, d):
    return epochs.epoch_info(_src(spark, d).rewards, P)


@register("M3")
def m3(spark, d):
    return revenue.staking_native(_src(spark, d).rewards, P)


@register("M4")
def m4(spark, d):
    return _chain(_src(spark, d))["jito"]


@register("M5")
def m5(spark, d):
    return _chain(_src(spark, d))["staking"]


@register("M6")
def m6(spark, d):
    return _chain(_src(spark, d))["unified"]


for _i, _p in zip((7, 8, 9, 10), ("day", "week", "month", "quarter")):
    def _mk(period):
        def q(spark, d):
            return revenue.revenue_by_period(_chain(_src(spark, d))["unified"], period)
        return q
    register(f"M{_i}")(_mk(_p))


@register("M11")
def m11(spark, d):
    return blocks.run_tx_per_block(spark, _src(spark, d).transactions, None, "view", AS_OF)


@register("M12")
def m12(spark, d):
    return blocks.run_tx_per_block(spark, _src(spark, d).transactions, scratch_dir(spark, "m12"), "table", AS_OF)


@register("M13")
def m13(spark, d):
    return _template_runs(spark, d, "merge")


@register("M14")
def m14(spark, d):
    return _template_runs(spark, d, "delete_insert")


@register("M15")
def m15(spark, d):
    return _template_runs(spark, d, "append")


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _REGISTRY["M1"](spark, sf_dir)


__all__ = ["queries", "flagship"]
