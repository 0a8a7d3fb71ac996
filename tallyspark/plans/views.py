"""Sources and models as Spark SQL temporary views (the ``view`` materialization, K2).

Users who query the models by name keep doing so:

    register_views(spark, src, Params())
    spark.sql("SELECT date, total_usd_amount FROM unified_revenue WHERE type = 'swap'")

Views are lazy: every query re-plans the model from its sources, so filters
in the query reach the source scans.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from tallyspark.params import Params
from tallyspark.plans import blocks, epochs, revenue
from tallyspark.plans.pipeline import PERIOD_MODELS
from tallyspark.sources.readers import Sources


def register_views(spark: SparkSession, src: Sources, p: Params, prefix: str = "") -> list[str]:
    """Create or replace one temporary view per source and model; returns the view names."""
    product = revenue.product_revenue(src.activity, src.prices, src.mapping, p, mapping_rows=src.mapping_rows)
    ep = epochs.epoch_info(src.rewards, p)
    native = revenue.staking_native(src.rewards, p)
    jito = revenue.staking_jito(src.responses, ep)
    staking = revenue.staking_revenue(native, jito, src.prices)
    unified = revenue.unified_revenue(product, staking)
    views = {
        "account_activity": src.activity, "prices_day": src.prices, "rewards": src.rewards,
        "transactions": src.transactions, "fee_address_mapping": src.mapping,
        "product_revenue": product, "epoch_info": ep, "staking_native": native, "staking_jito": jito,
        "staking_revenue": staking, "unified_revenue": unified,
        "tx_per_block": blocks.tx_per_block(src.transactions, p.as_of, blocks.INCREMENTAL_DAYS),
        **{model: revenue.revenue_by_period(unified, period) for period, model in PERIOD_MODELS.items()},
    }
    for name, df in views.items():
        df.createOrReplaceTempView(prefix + name)
    return [prefix + n for n in views]
