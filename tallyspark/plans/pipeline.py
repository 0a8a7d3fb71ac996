"""The revenue DAG over stored tables, full or incremental.

Models run in dependency order; each reads its upstream models from their
stored tables (S8), derives its own cutoff from its own target (S7), builds
the batch and upserts it. An empty or missing target counts as a first run:
this is the one planned deviation from the SQL project, where an empty target
makes the cutoff NULL and the run load nothing.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspark.functions.time import as_of_lit, minus_days, period_start
from tallyspark.operators.upsert import lookback_cutoff
from tallyspark.params import Params
from tallyspark.plans import epochs, revenue
from tallyspark.sinks.tables import read_stored, table_exists, write_merge, write_table
from tallyspark.sources.fixtures import Sources

PERIOD_MODELS = {"day": "daily_unified_revenue", "week": "weekly_unified_revenue",
                 "month": "monthly_unified_revenue", "quarter": "quarterly_unified_revenue"}

UNIQUE_KEYS = {
    "product_revenue": revenue.PRODUCT_KEYS,
    "epoch_info": ["epoch"],
    "staking_native": ["date"],
    "staking_revenue": ["date", "fee_source"],
    "unified_revenue": ["date", "type"],
    **{m: ["aggregated_date"] for m in PERIOD_MODELS.values()},
}


@dataclass(frozen=True)
class Warehouse:
    """Where model tables live: ``<root>/<model>`` parquet directories."""

    root: str

    def path(self, model: str) -> str:
        return f"{self.root.rstrip('/')}/{model}"


def _stored(spark: SparkSession, path: str) -> DataFrame | None:
    return read_stored(spark, path) if table_exists(spark, path) else None


def _cutoff(spark: SparkSession, path: str, col: str, days: int, period: str = "day",
            full: bool = False, p: Params | None = None):
    """Lower bound of the recomputed window; None = full build.

    Anchored on the newest stored date (one small aggregate over the target),
    or on the run's clock when ``p.lookback_anchor == "as_of"``.
    """
    if full:
        return None
    t = _stored(spark, path)
    if t is None:
        return None
    if p is not None and p.lookback_anchor == "as_of":
        if t.limit(1).count() == 0:
            return None
        row = t.sparkSession.range(1).select(period_start(period, minus_days(as_of_lit(p.as_of), days)).alias("c"))
        return row.first()["c"]
    return lookback_cutoff(t, col, days, period)


def _materialize(spark: SparkSession, path: str, batch: DataFrame, keys, full: bool,
                 sort_within=None) -> DataFrame:
    if full:
        write_table(batch, path, sort_within=sort_within)
    else:
        # every model batch is grouped on (or numbered by) its unique key
        write_merge(spark, path, batch, keys, sort_within=sort_within, batch_keys_unique=True)
    return read_stored(spark, path)


def run_product_revenue(spark, src: Sources, wh: Warehouse, p: Params, full_refresh=False) -> DataFrame:
    path = wh.path("product_revenue")
    since = _cutoff(spark, path, "date", p.lookback_days, full=full_refresh, p=p)
    batch = revenue.product_revenue(src.activity, src.prices, src.mapping, p, since, src.mapping_rows)
    return _materialize(spark, path, batch, UNIQUE_KEYS["product_revenue"], since is None)


def run_epoch_info(spark, src: Sources, wh: Warehouse, p: Params, full_refresh=False) -> DataFrame:
    path = wh.path("epoch_info")
    t = None if full_refresh else _stored(spark, path)
    last = t.agg(F.max("epoch").alias("e"), F.max("epoch_end_time").alias("t")).first() if t is not None else None
    if last is None or last["e"] is None:
        batch = epochs.epoch_info(src.rewards, p)
        return _materialize(spark, path, batch, ["epoch"], True, sort_within=["epoch_end_time"])
    batch = epochs.epoch_info(src.rewards, p, last_epoch=last["e"], last_time=last["t"])
    return _materialize(spark, path, batch, ["epoch"], False, sort_within=["epoch_end_time"])


def run_staking_native(spark, src: Sources, wh: Warehouse, p: Params, full_refresh=False) -> DataFrame:
    path = wh.path("staking_native")
    since = _cutoff(spark, path, "date", p.lookback_days, full=full_refresh, p=p)
    batch = revenue.staking_native(src.rewards, p, since)
    return _materialize(spark, path, batch, ["date"], since is None)


def staking_jito_view(spark, src: Sources, wh: Warehouse) -> DataFrame:
    """K2: recomputed on every read from the landed responses and stored epochs."""
    return revenue.staking_jito(src.responses, read_stored(spark, wh.path("epoch_info")))


def run_staking_revenue(spark, src: Sources, wh: Warehouse, p: Params, full_refresh=False) -> DataFrame:
    path = wh.path("staking_revenue")
    since = _cutoff(spark, path, "date", p.lookback_days, full=full_refresh, p=p)
    native = read_stored(spark, wh.path("staking_native"))
    since_jito = "same"
    if since is not None and p.per_source_cutoff:
        t = read_stored(spark, path)
        row = t.agg(*[minus_days(F.max(F.when(F.col("fee_source") == src_name, F.col("date"))),
                                 p.lookback_days).alias(src_name) for src_name in ("native", "jito")]).first()
        since, since_jito = row["native"], row["jito"]
    batch = revenue.staking_revenue(native, staking_jito_view(spark, src, wh), src.prices, since, since_jito)
    return _materialize(spark, path, batch, UNIQUE_KEYS["staking_revenue"], since is None)


def run_unified_revenue(spark, wh: Warehouse, p: Params, full_refresh=False) -> DataFrame:
    path = wh.path("unified_revenue")
    since = _cutoff(spark, path, "date", p.lookback_days, full=full_refresh, p=p)
    batch = revenue.unified_revenue(read_stored(spark, wh.path("product_revenue")),
                                    read_stored(spark, wh.path("staking_revenue")), since)
    return _materialize(spark, path, batch, UNIQUE_KEYS["unified_revenue"], since is None)


def run_rollup(spark, wh: Warehouse, p: Params, period: str, full_refresh=False) -> DataFrame:
    model = PERIOD_MODELS[period]
    path = wh.path(model)
    since = _cutoff(spark, path, "aggregated_date", p.lookback_days, period, full=full_refresh, p=p)
    batch = revenue.revenue_by_period(read_stored(spark, wh.path("unified_revenue")), period, since)
    return _materialize(spark, path, batch, ["aggregated_date"], since is None)


def run_all(spark: SparkSession, src: Sources, wh: Warehouse, p: Params,
            full_refresh: bool = False) -> dict[str, str]:
    """Run the whole DAG in order; returns model -> table path."""
    run_product_revenue(spark, src, wh, p, full_refresh)
    run_epoch_info(spark, src, wh, p, full_refresh)
    run_staking_native(spark, src, wh, p, full_refresh)
    run_staking_revenue(spark, src, wh, p, full_refresh)
    run_unified_revenue(spark, wh, p, full_refresh)
    for period in PERIOD_MODELS:
        run_rollup(spark, wh, p, period, full_refresh)
    return {m: wh.path(m) for m in ["product_revenue", "epoch_info", "staking_native", "staking_revenue",
                                    "unified_revenue", *PERIOD_MODELS.values()]}
